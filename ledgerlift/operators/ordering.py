"""The place of every row in a sorted result, as a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.session import scratch_path

_ROWS = 33  # lower bits of a monotonically increasing id: the row within its partition


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """Rows with their place in the order, from 1, missing values last. Rows that are equal in it follow in any order.

    A row number over all rows would sort them in one task. Here rows are dealt into ranges, sorted there and
    stored; ranges are counted, and the rows of earlier ranges are added to the place inside the range. Only
    one row a range is handled together, so the result may have any size.
    """
    by = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    sorted_ = df.repartitionByRange(*by).sortWithinPartitions(*by)
    path = scratch_path(df.sparkSession, "ordered")
    sorted_.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path).withColumn("_range", F.shiftright("_place", _ROWS))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("_range").agg(F.count("*").alias("n"))
    ranges = ranges.select("_range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_earlier"))  # one row a range
    inside = F.col("_place").bitwiseAND(F.lit((1 << _ROWS) - 1))
    placed = rows.join(F.broadcast(ranges), "_range").withColumn(name, F.col("_earlier") + inside + 1)
    return placed.drop("_place", "_range", "_earlier")
