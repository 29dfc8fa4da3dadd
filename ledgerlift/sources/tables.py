"""Parquet scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Scan a Parquet table and give it a name in SQL."""
    scan(spark, path).createOrReplaceTempView(name)
    return spark.table(name)


def scan(spark: SparkSession, *paths: str) -> DataFrame:
    """One or more Parquet folders or globs, ignoring files of other kinds.

    Several paths may hold different columns, so their schemas are merged; with
    a single path Spark reads one footer only.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if len(paths) > 1:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(*paths)


def scan_tree(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below a folder, when the folder names are not columns."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)


def scan_partitions(spark: SparkSession, root: str, **values: str) -> DataFrame:
    """The partitions with these values. Reads the root and filters, so that all
    partition columns stay in the result and Spark prunes the folders."""
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(root)
    for column, value in values.items():
        df = df.where(F.col(column) == value)
    return df


def filtered_view(spark: SparkSession, path: str, name: str, column: str, value: str) -> DataFrame:
    """A named view of the rows with one value; replaces a view of that name."""
    scan(spark, path).where(F.col(column) == value).createOrReplaceTempView(name)
    return spark.table(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)
