"""Families of similar documents that are not near copies, and families just under and over the threshold."""

from __future__ import annotations

import random

import pytest

from ledgerlift.llm import minhash
from ledgerlift.llm.minhash import shingle_set


def family(seed: int, members: int, words: int, kept: float) -> list[str]:
    """Texts that share a core of words in a row and have some of their own."""
    draw = random.Random(seed)
    core = [f"c{seed}x{draw.randrange(10**6)}" for _ in range(words)]
    own = int(words * (1 - kept) / (2 * kept))
    return [" ".join(core + [f"m{seed}y{k}z{draw.randrange(10**6)}" for _ in range(own)]) for k in range(members)]


def brute(texts: dict[int, str], width: int) -> dict[int, int]:
    sets = {k: set(shingle_set(t, width).tolist()) for k, t in texts.items()}
    where: dict[int, list[int]] = {}
    for k, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(k)
    root = {k: k for k in texts}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    seen = set()
    for ks in where.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        x, y = sorted((top(a), top(b)))
                        root[y] = x
    return {k: top(k) for k in texts}


@pytest.mark.parametrize("width", [2, 5])
def test_families_around_the_threshold(spark, width):
    texts = [t for seed, kept in enumerate((0.5, 0.72, 0.78, 0.8, 0.82, 0.9)) for t in family(seed, 60, 80, kept)]
    draw = random.Random(1)
    texts += [" ".join(w if draw.random() > 0.02 else "x" for w in t.split()) for t in texts[::7]]
    by_id = dict(enumerate(texts))
    want = brute(by_id, width)
    got = minhash.groups(spark.createDataFrame(list(by_id.items()), "doc_id long, text string"), width=width).collect()
    assert {r["id"]: r["component"] for r in got} == want
    assert len(set(want.values())) > 100 and any(sum(v == k for v in want.values()) > 20 for k in want)


def test_open_buckets_give_links_only(spark):
    """Similar documents without a link cost no rows; a group of copies costs a row a member at most."""
    from pyspark.sql import functions as F

    texts = dict(enumerate(family(9, 300, 120, 0.55) + family(8, 200, 120, 0.95)))
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    one = F.concat(*[F.substring("what", 4 * k + 1, 1) for k in range(200)])
    signed = minhash.sets(df, "id", "text", 5, 200).select(F.col("id").alias("rep"), "n", one.alias("sig"))
    full = minhash.sets(df, "id", "text", 5).select(F.col("id").alias("rep"), "what")
    known = signed.select("rep", "sig", F.unhex(F.lit("0000000000000007" * 2)).alias("keys")).join(full, "rep")
    members = signed.select(F.lit(7).cast("long").alias("bucket"), "rep", "n", F.col("rep").alias("comp"))
    for block, blocks in ((1024, 1), (70, 8)):
        found = {(r["a"], r["b"]) for r in minhash.open_links(members, known, 200, (80, 100), 1e-9, block=block).collect()}
        assert all(a >= 300 and b >= 300 for a, b in found)
        root = list(range(500))
        for _ in range(500):
            for a, b in found:
                root[a] = root[b] = min(root[a], root[b])
        assert set(root[300:]) == {300}
        assert len(found) <= 200 * blocks
