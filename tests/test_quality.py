from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from ledgerlift.operators import quality
from toys import rows


def check(spark, values):
    df = spark.createDataFrame([(float(v), -float(v)) for v in values], "a double, b double")
    got = {r["variable"]: r for r in quality.describe(df).collect()}
    for name, sign in (("a", 1), ("b", -1)):
        want = np.array(values) * sign
        assert got[name]["count"] == len(values)
        assert got[name]["min"] == want.min() and got[name]["max"] == want.max()
        assert got[name]["mean"] == pytest.approx(want.mean())
        for q in (25, 50, 75):
            assert got[name][f"q{q}"] == pytest.approx(np.percentile(want, q), abs=1e-9), (name, q)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**9), 10**9).map(lambda n: n / 100), min_size=1, max_size=40))
def test_quartiles_equal_sorted_interpolation(spark, values):
    check(spark, values)


def test_quartiles_with_most_values_equal(spark):
    check(spark, [0.0] * 50 + [1.25] * 20 + list(range(1, 31)))


def test_quartiles_of_many_values_in_one_bin(spark):
    check(spark, [10_000_000 + i / 100 for i in range(1001)])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e300, 1e300) | st.sampled_from([0.0, -0.0, 5e-324, -5e-324, 1.0, 1 + 2**-52]), min_size=1, max_size=12))
def test_quartiles_of_any_double(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    row = quality.describe(df).first()
    for q in (25, 50, 75):
        assert row[f"q{q}"] == pytest.approx(np.percentile(np.array(values), q), rel=1e-12, abs=1e-320)


def test_small_values_are_not_rounded(spark):
    df = spark.createDataFrame([(0.001,), (0.002,), (0.004,)], "a double")
    row = quality.describe(df).first()
    assert (row["q25"], row["q50"], row["q75"]) == (0.0015, 0.002, 0.003)
    assert row["mean"] == pytest.approx(0.007 / 3) and row["std"] == pytest.approx(np.std([0.001, 0.002, 0.004], ddof=1))


def test_columns_without_values(spark):
    df = spark.createDataFrame([(None, 1.0, "x")], "a double, b double, c string")
    assert rows(quality.describe(df), "variable", "count", "q50", "std") == [("a", 0, None, None), ("b", 1, 1.0, None)]
    assert quality.describe(df.select("c")).columns == quality.describe(df).columns


def test_few_shuffles_and_scans(spark, tmp_path, monkeypatch):
    """Amounts take two rounds: a scan and two exchanges each."""
    from test_plans import exchanges, plan

    spark.range(3000).selectExpr("100000 + id / 100 as a", "-id / 10000 as b").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    seen, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda df: seen.append(plan(df).split("\n\n")[0]) or collect(df))
    quality.describe(df)
    assert len(seen) == sum(tree.count("Scan parquet") for tree in seen) == 2
    assert sum(exchanges(tree) - tree.count("BroadcastExchange (") for tree in seen) <= 5


def test_missing_values_do_not_count(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "a double")
    row = quality.describe(df).first()
    assert (row["count"], row["mean"], row["q50"]) == (2, 2.0, 2.0)


def test_statistics_of_columns_without_numbers(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", None), ("b", "y")], "k string, v string")
    assert rows(quality.describe_values(df), "variable", "count", "unique", "top", "freq") == [
        ("k", 4, 2, "a", 2),
        ("v", 3, 2, "x", 2),
    ]


def test_largest_difference_first(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 5.0), ("d", 5.0)], "orgnr string, kontroll double")
    assert [r.orgnr for r in quality.by_control(df).collect()] == ["c", "d", "a", "b"]
    assert [r.orgnr for r in quality.by_control(df, top=2).collect()] == ["c", "d"]
    assert [r.orgnr for r in quality.first_rows(df, 2).collect()] == ["a", "b"]
