"""Operators on texts, against brute force."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from ledgerlift.llm import kneser_ney, licenses, line_dedup, minhash, mixing, passages, quality_rules, secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(docs) -> dict:
    return {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}


def shingles(text: str | None, width: int) -> set:
    words = WORD.findall((text or "").lower())
    return set(zip(*(words[k:] for k in range(width)))) if len(words) >= width else ({tuple(words)} if words else set())


def test_minhash_groups(docs, no_docs):
    sets = {k: shingles(t, 2) for k, t in texts(docs).items()}
    root = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if v == old else v for k, v in root.items()}
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in minhash.groups(docs, width=2).collect()}
    assert got == {k: (len(sets[k]), root[k]) for k in sets}
    assert minhash.groups(no_docs).count() == 0
    assert minhash.keep_one(docs).columns == docs.columns


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 101)], "a long, b long")
    got = {r["id"]: r["component"] for r in minhash.components(edges).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {101: 100}


def test_posterior_bound():
    assert minhash.least_equal(25, 0.8, 1e-9) < minhash.least_equal(25, 0.8, 1e-3) < 20


def test_mix_meets_targets(docs, no_docs):
    taken = mixing.copies(docs).collect()
    by = {}
    for r in taken:
        assert 0 <= r["n"] <= 3
        source, target, words = by.get(r["source"], (0, r["target"], 0))
        by[r["source"]] = (source + r["size"], target, words + r["n"] * r["size"])
    assert sum(t for _, t, _ in by.values()) <= sum(s for s, _, _ in by.values()) + 1e-6
    assert sorted(map(tuple, taken), key=str) == sorted(map(tuple, mixing.copies(docs).collect()), key=str)
    assert mixing.copies(no_docs).count() == 0
    assert mixing.take(docs).columns == docs.columns


def test_flight_lands_near_the_target():
    size = [3000, 40, 30, 20, 10, 10, 5, 5, 2, 1] * 20
    p = mixing.flight([0.39] * len(size), size, __import__("random").Random(1), True)
    assert set(p) <= {0.0, 1.0}
    assert abs(sum(a * b for a, b in zip(p, size)) - 0.39 * sum(size)) < 5


def test_secrets(spark, docs, no_docs):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(20)], "doc_id long, quality int, toxic int")
    table = secrets.train(secrets.samples(docs, labels))
    got = {r["doc_id"]: r for r in secrets.digests(secrets.find(docs, table)).collect()}
    assign = re.compile(secrets.ASSIGN.replace("(?i:", "(?:"), re.I | re.A)
    for k, t in texts(docs).items():
        t = t or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{secrets.KINDS[kind]}:{a}:{b}" for a, kind, b in sorted(found))
        assert got[k]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert secrets.find(no_docs, table).count() == 0
    held_out = spark.createDataFrame([(True, "Zq8vK3xW0pLm7TyB4nR2"), (False, "kararanlosetimivonu1")], "random boolean, token string")
    score = {r["random"]: r["s"] for r in held_out.select("random", secrets.ratio(F.col("token"), table).alias("s")).collect()}
    assert score[True] > score[False]


def test_quality_measures(docs, no_docs):
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    for k, t in texts(docs).items():
        words = WORD.findall(t or "")
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        twice = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
        failed = len(words) < 20 or 100 * len(twice) > 30 * len(words)
        assert (got[k]["n_words"], got[k]["word_chars"], got[k]["n_repeat_words"]) == (len(words), sum(map(len, words)), len(twice))
        assert got[k]["base_failed"] == failed and not (failed and got[k]["kept"])
    assert quality_rules.judge(no_docs).count() == 0
    assert quality_rules.clean(docs).columns == docs.columns


def test_passages(docs, no_docs):
    seen, want = set(), {}
    for k, t in sorted(texts(docs).items()):
        data = (t or "").encode()
        own = [data[i : i + 50] for i in range(len(data) - 49)]
        gone = {i + j for i, s in enumerate(own) if s in seen for j in range(50)}
        seen.update(own)
        left = bytes(c for i, c in enumerate(data) if i not in gone)
        want[k] = (len(data), len(gone), sum(i - 1 not in gone for i in gone), hashlib.sha256(left).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in passages.remove(docs).collect()}
    got.pop(None)
    assert got == want
    assert passages.remove(no_docs).count() == 0


def test_patience_blocks():
    assert line_dedup.patience([9, 1, 2, 3, 8], [1, 2, 3]) == [(1, 4)]
    assert line_dedup.patience([1, 0, 0, 2, 7], [5, 1, 0, 0, 2]) == [(0, 4)]
    assert line_dedup.patience([1, 2], []) == []


def test_line_dedup(docs, no_docs):
    rows = line_dedup.with_lines_left(docs).collect()
    got = {r["doc_id"]: r["line_dedup"] for r in rows}
    assert len(rows) == docs.count()
    assert got[0]["n_removed"] == 0
    assert got[8]["left"] == "" and got[9]["left"] == ""
    assert got[10]["n_removed"] == 5
    assert got[17]["n_removed"] == 6 and got[17]["left"] == texts(docs)[17].split("\n", 6)[6]
    assert got[11]["left"] is None and got[12]["left"] == ""
    assert line_dedup.clean(docs).columns == docs.columns
    assert line_dedup.clean(no_docs).count() == 0


def test_perplexity(spark, docs, no_docs):
    trusted = docs.where("doc_id < 10").select("doc_id")
    got = {r["id"]: r for r in kneser_ney.judge(docs, trusted).collect()}
    assert got[11]["perplexity"] is None and not got[11]["kept"]
    assert got[13]["perplexity"] > got[1]["perplexity"]
    assert len(got) == docs.select("doc_id").distinct().count()
    assert kneser_ney.judge(no_docs, trusted).count() == 0
    assert kneser_ney.judge(docs, trusted.limit(0)).where("threshold is not null").count() == 0


def test_model_sums_to_one(docs):
    """Over the known words and one unseen word, the probabilities after a seen history add up to 1."""
    terms, unseen = kneser_ney.train(docs.where("doc_id < 6"), "doc_id", "text")
    import numpy as np
    import xxhash

    value = {r["term"]: r["value"] for r in terms.collect()}
    words = sorted({w for k, t in texts(docs).items() if k < 6 for w in WORD.findall(t.lower())})
    h = np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in words], np.uint64)
    v, zero = np.full(len(h), h[0]), np.zeros(len(h), np.uint64)
    a, b, c = (kneser_ney.term_hash(*x).view(np.int64) for x in ((v, h), (v, zero), (zero, h)))
    total = sum(np.exp(unseen + value.get(x, 0.0) + value[y] + value[z]) for x, y, z in zip(a, b, c))
    assert abs(total + np.exp(unseen + value[b[0]]) - 1) < 1e-6


def test_licenses(docs, no_docs):
    path = F.concat_ws("/", F.lit("root"), F.when(F.col("doc_id") == 19, "").otherwise("deep"), F.col("doc_id").cast("string"))
    path = F.when(F.col("doc_id") == 19, F.lit("root/LICENSE")).otherwise(path)
    got = {r["id"]: r for r in licenses.scan(docs, path).collect()}
    assert got[19]["own"] == "MIT"
    assert got[3]["own"] is None and got[3]["license"] == "MIT" and got[3]["from_path"] == "root/LICENSE"
    assert licenses.scan(no_docs, F.lit("a/b")).count() == 0
