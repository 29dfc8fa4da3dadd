"""Rows with null, shared or repeated ids, and columns with the operators' own names."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import prose  # noqa: F401 - of this folder, when it is the first on the path

from ledgerlift.llm import mixing, passages

DDL = "doc_id long, text string, lang string, source string, mix int, doc string, n int, digest string"


def words(n: int, name: str) -> str:
    return " ".join(f"{name}{k}" for k in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(None, words(10 + k, "w"), "en", "a") for k in range(5)]
    rows += [(None, None, "en", "a"), (None, "", None, None), (None, "", None, None)]
    rows += [(7, words(20, "x"), "en", "b"), (7, words(30, "y"), "fr", "b"), (7, words(30, "y"), "fr", "b"), (7, words(30, "y"), "de", "c")]
    rows += [(k, words(k % 50, "z"), "en", "abc"[k % 3]) for k in range(100, 400)]
    return spark.createDataFrame([(*r, 1, "d", 2, "e") for r in rows], DDL)


def brute_targets(rows, most=3.0):
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len((r["text"] or "").split())
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    capped: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        share = {s: most * sizes[s] if s in capped else weight[s] * left / free for s in order}
        over = {s for s in order if s not in capped and share[s] > most * sizes[s]}
        if not over or over | capped == set(order):
            return sizes, share
        capped |= over


def test_every_row_is_a_document(odd):
    rows = odd.collect()
    got = mixing.copies(odd).collect()
    size = lambda r: len((r["text"] or "").split())
    assert Counter((r["id"], r["source"], r["size"]) for r in got) == Counter((r["doc_id"], r["source"], size(r)) for r in rows)
    sizes, share = brute_targets(rows)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(share[r["source"]])
        assert 0 <= r["n"] <= 3
        taken[r["source"]] += r["n"] * r["size"]
    for s in ("a", "b", "c"):
        assert taken[s] == pytest.approx(share[s], rel=0.05)
    assert sorted(got, key=repr) == sorted(mixing.copies(odd).collect(), key=repr)


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(k, words(50, "a"), "a") for k in range(200)] + [(1000 + k, words(10, "b"), "b") for k in range(5)] + [(2000, words(40, "c"), "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.copies(df).collect()
    sizes, share = brute_targets([{"text": t, "source": s} for _, t, s in rows])
    assert share["b"] == 150 and share["c"] == 120 and share["a"] == pytest.approx(10_090 - 270)
    for r in got:
        assert r["target"] == pytest.approx(share[r["source"]])
        assert r["n"] == 3 or r["source"] == "a"


def test_the_mix_keeps_columns_of_any_name(odd):
    mixed = mixing.take(odd)
    assert mixed.dtypes == odd.dtypes
    counts = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in mixed.collect())
    want = Counter()
    for r in mixing.copies(odd).collect():
        want[r["id"], r["source"], r["size"]] += r["n"]
    assert counts == +want
    assert mixing.take(odd.where("false")).count() == 0


def test_rows_that_share_an_id_do_not_shorten_each_other(spark):
    shared = "the very same passage of many words that stands in two places and is long enough to count for fifty bytes"
    rows = [(1, f"one {shared} end"), (5, f"two {shared} end"), (5, words(60, "own")), (5, f"two {shared} end"), (None, shared), (9, None)]
    got = passages.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in got)
    size = lambda t: len(t.encode())
    common = len(f" {shared} end")
    assert by == Counter(
        {
            (1, size(rows[0][1]), 0): 1,
            (5, size(rows[1][1]), common): 2,
            (5, size(rows[2][1]), 0): 1,
            (None, size(shared), 0): 1,
            (9, 0, 0): 1,
        }
    )
