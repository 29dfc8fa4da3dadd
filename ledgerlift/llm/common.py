"""What the operators share: words, intermediate tables, and row-key helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.session import scratch_path

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def count_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, and outlives any executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def renewed(df: DataFrame) -> DataFrame:
    """The same columns as new ones, so that a frame can be cogrouped with another made from the same rows."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def parts_for(spark: SparkSession, total: float, each: float) -> int:
    """Number of parts so that each holds about `each` of `total`; at least one a shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(-(-total // each)), 1)


def text_slices(batch: pa.RecordBatch, column: str, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about `size` bytes of text, with one text at least, so that what is made of a slice stays small."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + size, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop
