"""What the comparisons move: texts and MinHashes of classes that share a bucket, and nothing of the others."""

from __future__ import annotations

import random

from ledgerlift.llm import minhash


def text(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(10**9)}" for _ in range(words))


def test_only_classes_that_share_a_bucket_are_stored_again(spark, monkeypatch):
    rows = {}

    def kept(df, label, store=minhash.stored):
        out = store(df, label)
        rows.setdefault(label, []).append((out.count(), out.columns))
        return out

    monkeypatch.setattr(minhash, "stored", kept)
    near = text(1, 60)
    texts = [near, near + " more", *(text(k, 60) for k in range(2, 40))]
    found = minhash.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["id"]: r["component"] for r in found} == {k: 0 if k == 1 else k for k in range(40)}
    assert rows["met"][0][0] == 2 and rows["texts"][0][0] == 2
    assert not any("array" in label or "full" == label for label in rows)


def test_ids_that_also_have_no_text(spark):
    """Rows of one id with and without text: what has no words links nothing."""
    draw = random.Random(4)
    words = [f"w{draw.randrange(10**9)}" for _ in range(400)]
    some = [" ".join(words), " ".join(words[:80] + [f"x{k}" for k in range(320)])]
    pairs = spark.createDataFrame([(0, 1, a, b) for a in [some[0], None] for b in [some[1], None, ""]], "a long, b long, x string, y string")
    assert minhash.confirmed(pairs, 2, (80, 100)).count() == 0


def test_texts_and_sets_give_the_same_links(spark):
    draw = random.Random(8)
    core = [f"w{draw.randrange(10**9)}" for _ in range(100)]
    texts = {k: " ".join(core[:90] + [f"own{k}x{i}" for i in range(k)]) for k in range(40)}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    made = minhash.sets(df, "id", "text", 2, 200).selectExpr("id as rep", "n", "substring(what, 1, 200) as sig", "unhex('0000000000000007') as keys")
    members = made.selectExpr("7L as bucket", "rep", "n", "rep as comp")
    full = minhash.sets(df, "id", "text", 2).selectExpr("id as rep", "what")
    by_set = minhash.open_links(members, made.select("rep", "sig", "keys").join(full, "rep"), 200, (80, 100), 0.0)
    by_text = minhash.open_links(members, made.select("rep", "sig", "keys").join(df.toDF("rep", "what"), "rep"), 200, (80, 100), 0.0, width=2)
    assert sorted(map(tuple, by_set.collect())) == sorted(map(tuple, by_text.collect())) != []
