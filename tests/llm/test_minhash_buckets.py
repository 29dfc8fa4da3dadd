"""Every pair of a bucket is compared, whatever pivots the turns took."""

from __future__ import annotations

from ledgerlift.llm import minhash


def test_inner_pair_of_a_bucket_of_four(spark):
    words = [[f"{name}{k}" for k in range(40)] for name in ("a", "b", "b", "d")]
    words[2][-1] = "other"
    texts = spark.createDataFrame([(k + 1, " ".join(w)) for k, w in enumerate(words)], "id long, text string")
    classes = spark.createDataFrame([(k, 39, bytearray(20)) for k in range(1, 5)], "rep long, n long, sig binary")
    found = minhash.links_of(classes, texts, 2, bands=1, band_rows=5, share=(80, 100), miss=1e-9, rounds=3)
    assert {r["rep"]: r["component"] for r in found.collect()} == {3: 2}
