"""Checks made by eye on the derived objects: statistics, extremes, first rows."""

from __future__ import annotations

from collections.abc import Sequence
from math import floor

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARTILES = (1, 2, 3)
DIGITS = (42, 21, 0)  # bits below the digit of each counting round: digits of 22, 21 and 21 bits
STATISTICS = "variable string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double"

# the bits of a double, turned so that they sort like the double; -0 counts as 0
_BITS = "cast(reflect('java.lang.Double', 'doubleToLongBits', value + 0.0D) as bigint)"
_KEY = f"(case when {_BITS} < 0 then {_BITS} ^ 9223372036854775807 else {_BITS} end)"
# whole cents are added exactly, what is left of a value as a double
_CENTS = "case when abs(value) < 1e15 then cast(rint(value * 100) as decimal(20, 0)) else 0 end"
_REST = "value - case when abs(value) < 1e15 then rint(value * 100) / 100.0D else 0 end"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles and max, one row per numeric column.

    The quartiles are found by radix selection on the bits of the doubles: a round counts the values by the
    next digit of their bits, below the digits already known, and keeps the bins that hold a wanted rank. A
    round shuffles at most 2**22 counts for each bin kept, whatever the number of values, and a bin with one
    value is done: amounts in øre take two rounds, and no double more than three. At most six bins per column
    come to the driver.
    """
    columns = list(columns or numeric_columns(df))
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], STATISTICS)
    values = df.selectExpr(*[f"cast(`{c}` as double) as `{c}`" for c in columns]).unpivot([], columns, "variable", "value")
    present = values.where(F.col("value").isNotNull()).selectExpr("variable", "value", f"{_KEY} as key")
    first = {row["variable"]: row for row in _first_round(present).collect()}
    ranks = {name: {rank: hit for hit in row["hits"] for rank in hit["ranks"]} for name, row in first.items()}
    for below, digit in zip(DIGITS, DIGITS[1:]):
        wanted = {(name, hit["low"] >> below): hit for name, hits in ranks.items() for hit in hits.values() if hit["low"] != hit["high"]}
        if not wanted:
            break
        for row in _next_round(present, wanted, below, digit).collect():
            for hit in row["hits"]:
                for rank in hit["ranks"]:
                    ranks[row["variable"]][rank] = hit
    out = [(name, *_statistics(first.get(name), ranks.get(name))) for name in columns]
    return spark.createDataFrame(out, STATISTICS)


def _first_round(present: DataFrame):
    """One row per variable: its moments, and the bins of the first digit that hold its quartiles."""
    bins = present.groupBy("variable", F.expr(f"shiftright(key, {DIGITS[0]})").alias("bin")).agg(
        F.count("*").alias("n"),
        F.min("key").alias("low"),
        F.max("key").alias("high"),
        F.expr(f"sum({_CENTS})").alias("cents"),
        F.expr(f"sum({_REST})").alias("rest"),
        F.avg("value").alias("average"),
        (F.var_pop("value") * F.count("*")).alias("spread"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
    )
    whole, before = _windows("variable")
    bins = bins.withColumns({"total": F.sum("n").over(whole), "start": F.coalesce(F.sum("n").over(before), F.lit(0))})
    mean = F.expr("cast(sum(cents) over (partition by variable) as double) / 100 + sum(rest) over (partition by variable)") / F.col("total")
    bins = bins.withColumns({"mean": mean, "ranks": _ranks_held(_wanted_ranks())})
    squares = F.col("spread") + F.col("n") * (F.col("average") - F.col("mean")) ** 2
    return bins.groupBy("variable").agg(
        F.first("total").alias("count"),
        F.first("mean").alias("mean"),
        F.sqrt(F.sum(squares) / F.nullif(F.first("total") - 1, F.lit(0))).alias("std"),
        F.min("least").alias("min"),
        F.max("most").alias("max"),
        _hits(),
    )


def _next_round(present: DataFrame, wanted: dict[tuple[str, int], Row], below: int, digit: int) -> DataFrame:
    """The bins of the next digit that hold the wanted ranks, for bins whose first digits are known."""
    rows = [(name, bin, hit["start"], hit["ranks"]) for (name, bin), hit in wanted.items()]
    known = present.sparkSession.createDataFrame(rows, "variable string, parent long, base long, asked array<long>")
    inside = present.withColumn("parent", F.expr(f"shiftright(key, {below})")).join(F.broadcast(known), ["variable", "parent"])
    bins = inside.groupBy("variable", "parent", F.expr(f"shiftright(key, {digit})").alias("bin")).agg(
        F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"), F.first("base").alias("base"), F.first("asked").alias("asked")
    )
    _, before = _windows("variable", "parent")
    bins = bins.withColumn("start", F.col("base") + F.coalesce(F.sum("n").over(before), F.lit(0)))
    return bins.withColumn("ranks", _ranks_held(F.col("asked"))).groupBy("variable", "parent").agg(_hits())


def _windows(*keys: str):
    whole = Window.partitionBy(*keys)
    return whole, whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)


def _hits():
    """The bins that hold a wanted rank; the others give nothing to the list."""
    hit = F.struct("ranks", "start", "low", "high", F.expr("cast(low as string)").alias("text"))
    return F.collect_list(F.when(F.size("ranks") > 0, hit)).alias("hits")


def _wanted_ranks():
    """Zero-based ranks on both sides of each quartile."""
    position = [f"(total - 1) * {q}" for q in QUARTILES]
    return F.expr(f"array_distinct(array({', '.join(f'({p}) div 4, ({p} + 3) div 4' for p in position)}))")


def _ranks_held(ranks):
    end = F.col("start") + F.col("n")
    return F.filter(ranks, lambda r: (r >= F.col("start")) & (r < end))


def _statistics(first: Row | None, ranks: dict[int, Row] | None) -> tuple:
    if first is None:
        return (0, *[None] * 7)
    quartiles = []
    for q in QUARTILES:
        position = (first["count"] - 1) * q
        low, high, rest = floor(position / 4), -(-position // 4), position % 4
        at_low, at_high = (_double(ranks[r]["low"]) for r in (low, high))
        quartiles.append(at_low if at_low == at_high else at_low + (at_high - at_low) * (rest / 4))
    return (first["count"], first["mean"], first["std"], first["min"], *quartiles, first["max"])


def _double(key: int) -> float:
    """The double whose turned bits these are."""
    from struct import pack, unpack

    return unpack(">d", pack(">q", key if key >= 0 else key ^ 0x7FFFFFFFFFFFFFFF))[0]


def describe_values(df: DataFrame) -> DataFrame:
    """count, unique, top and freq, one row per column; for frames without numbers."""
    columns = df.columns
    values = df.selectExpr(*[f"cast(`{c}` as string) as `{c}`" for c in columns]).unpivot(
        [], columns, "variable", "value"
    )
    counts = values.where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count("*").alias("n"))
    # the most frequent value; the smallest of them when several are
    return counts.groupBy("variable").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def by_control(balance: DataFrame, top: int | None = None) -> DataFrame:
    """Largest balance difference first; ``top`` keeps that many rows."""
    ordered = balance.orderBy(F.desc_nulls_last("kontroll"), F.asc("orgnr"))
    return ordered.limit(top) if top else ordered


def first_rows(derived: DataFrame, n: int = 100) -> DataFrame:
    return derived.orderBy("orgnr").limit(n)
