"""Filling of missing values by type."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def fill_blanks(df: DataFrame, include: Collection[str] = ("number", "bool")) -> DataFrame:
    """Missing numbers become 0, booleans False and, when asked for, texts ''."""
    fills = {"number": (T.NumericType, 0), "bool": (T.BooleanType, False), "string": (T.StringType, "")}
    values = {
        field.name: value
        for kind, (spark_type, value) in fills.items()
        if kind in include
        for field in df.schema
        if isinstance(field.dataType, spark_type)
    }
    return df.na.fill(values) if values else df
