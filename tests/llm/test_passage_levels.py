"""The family of suffix arrays against brute force: mosaics of shared pieces, shared ids, long texts, levels."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from ledgerlift.llm import passages


def mosaics(seed: int, n: int) -> list[tuple]:
    """Texts cut from common pieces, so that strings are shared in part, at edges and in other contexts."""
    draw = random.Random(seed)
    pieces = ["".join(draw.choice("abcdé ") for _ in range(draw.choice((20, 45, 49, 50, 51, 70, 140)))) for _ in range(25)]
    pieces += ["aaaaaaaaaa" * 9, "ab" * 60, "x" * 50]
    rows = []
    for k in range(n):
        text = "".join(draw.choice(pieces) if draw.random() < 0.7 else "".join(draw.choice("abcd") for _ in range(draw.randint(1, 60))) for _ in range(draw.randint(0, 9)))
        rows.append((draw.choice((k, k, k, draw.randint(0, n))), text))
    return rows + [(None, rows[3][1]), (n + 1, None), (n + 2, ""), (-5, rows[7][1]), rows[9]]


def expected(rows: list[tuple]) -> list[tuple]:
    least = defaultdict(lambda: 1 << 70)
    data = [(k, (t or "").encode()) for k, t in rows]
    for k, d in data:
        if k is not None:
            for i in range(len(d) - 49):
                least[d[i : i + 50]] = min(least[d[i : i + 50]], k)
    out = []
    for k, d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - 49 if k is not None else 0):
            if least[d[i : i + 50]] < k:
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((k, len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return sorted(out, key=repr)


def test_mosaics(spark):
    for seed, parts in ((1, 1), (2, 40)):
        rows = mosaics(seed, 250)
        docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, batch string, ids int").repartition(parts)
        got = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in passages.remove(docs).collect()]
        assert sorted(got, key=repr) == expected(rows)
        assert sum(r[2] for r in got) > 10_000


def test_long_text(spark):
    draw = np.random.RandomState(3)
    long = draw.randint(97, 123, 2_500_000, dtype=np.uint8).tobytes().decode()
    rows = [(2, long), (1, long[1_048_500:1_048_700] + "-" + long[:49] + "-" + long[-50:]), (3, long[700_000:2_300_000])]
    got = {r[0]: (r[2], r[3]) for r in passages.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (0, 0), 2: (250, 2), 3: (1_600_000, 1)}


def test_segments_change_nothing(monkeypatch):
    texts = [t or "" for _, t in mosaics(5, 60)]
    made = []
    for size in (1 << 20, 97):
        monkeypatch.setattr(passages, "SEGMENT", size)
        batch = passages.Batch(pa.array(texts), pa.array(range(len(texts)), pa.int64()))
        strings = defaultdict(set)
        for a, low, high, c in zip(batch.place.tolist(), batch.low.tolist(), batch.high.tolist(), batch.context.tolist()):
            strings[a, c].update(range(low, high + 1))
        made.append((strings, batch.strings(np.flatnonzero(batch.starts)).tolist()))
    assert made[0] == made[1]
    assert sorted(i for s in made[0][0].values() for i in s) == np.flatnonzero(batch.starts).tolist()


def test_levels_keep_least_ids_and_two_contexts():
    x = np.array([1, 5, 9], np.uint64), np.array([4, 4, 4])
    y = np.array([5, 7], np.uint64), np.array([2, 8])
    keys, ids = passages.merged(x, y)
    assert keys.tolist() == [1, 5, 7, 9] and ids.tolist() == [4, 2, 8, 4]
    a, b, c = ((7 << 32) + k for k in (1, 2, 3))
    keys, _ = passages.merged((np.array([a, c], np.uint64), None), (np.array([a, b, 8 << 32], np.uint64), None))
    assert keys.tolist() == [a, b, 8 << 32]
