"""Compare registered queries with their SQL: ``python tests/compare.py <data folder> [query…]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        path = Path(f"{sf_dir}/{table}.parquet")
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else path
            con.execute(f"create view {table} as select * from '{files}'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    columns = []
    for name in df.columns:
        values = df[name]
        if pd.api.types.is_datetime64_any_dtype(values):
            values = values.astype("datetime64[us]").astype(str)
        columns.append([None if pd.isna(v) else (float(v) if isinstance(v, float) else str(v)) for v in values])
    return sorted(zip(*columns), key=repr)


def difference(spark_df, con, sql: str) -> tuple[str | None, int]:
    """First difference between a Spark result and a SQL result, and the number of rows."""
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    for a, b in zip(normal(got), normal(want)):
        if a != b:
            return f"{a} != {b}", len(got)
    return None, len(got)


def main() -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problem, rows = difference(query(spark, sf_dir), con, sql[name])
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem, rows = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:50s} {rows:7d} rows {time.time() - start:6.2f} s {problem or ''}")
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
