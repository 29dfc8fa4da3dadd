"""Time the headline queries: one warm-up run, then the median of BENCH_RUNS.

Every run ends in an action over all rows and columns (a ``noop`` write). Prints
one JSON line; progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from ledgerlift.operators.latest import latest_filings
from ledgerlift.operators.layouts import fields_in, wide_layout
from ledgerlift.plans import registry
from ledgerlift.plans.workspace import Workspace
from ledgerlift.sources.deliveries import parse_delivery, read_delivery
from ledgerlift.sources.orders import order_filings

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "ingest_json_events",
    "ingest_filings",
    "latest_filing_with_accounts",
    "latest_after_explode",
    "section_naering",
    "section_driftsinntekt",
    "section_driftskostnad",
    "section_balanseregnskap",
    "section_sum_resultatregnskap",
    "section_egenkapital",
    "section_row_counts",
    "all_sections",
    "relink_subset",
    "forestry_accounts",
    "forestry_fund",
    "forestry_fund_per_account",
    "derive_virksomhet",
    "derive_spesifikasjonAvVarelager",
    "derive_salgsinntekt",
    "derive_annenDriftskostnad",
    "derive_balanseverdiForAnleggsmiddel",
    "derive_sum_balanseregnskap",
    "describe_salgsinntekt",
    "describe_annenDriftskostnad",
    "balance_control_topk",
    "wide_layout",
    "wide_to_long",
    "long_prefix_sum",
    "long_prefix_total",
    "partitioned_prefix_sum",
    "partitioned_prefix_total",
    "wide_prefix_sum",
    "wide_prefix_total",
    "partitioned_wide_prefix_sum",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(name: str, action) -> float:
    action()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    median = round(statistics.median(seconds), 3)
    print(f"{name:45s} {median:8.3f} s", file=sys.stderr, flush=True)
    return median


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ledgerlift-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ws = Workspace(spark, SF_DIR)
    queries = registry.build()
    times = {
        # what the shared tables cost, apart from the queries that read them
        "build_filings": timed("build_filings", lambda: run(order_filings(spark, SF_DIR))),
        "parse_delivery": timed(
            "parse_delivery", lambda: run(parse_delivery(read_delivery(spark, ws.delivery(), "parquet")))
        ),
        "latest_filing": timed("latest_filing", lambda: run(latest_filings(ws.filings()))),
        "build_long": timed("build_long", lambda: run(ws.long_source())),
        "build_wide": timed("build_wide", lambda: run(wide_layout(ws.long(), fields_in(ws.codes())))),
    }
    for name in HEADLINE:
        times[name] = timed(name, lambda name=name: run(queries[name](spark, SF_DIR)))
    total = round(sum(times.values()), 3)
    result = {"metric": "headline queries, total of medians", "value": total, "unit": "sec", "queries": times}
    print(json.dumps(result | {"sf": SF_DIR.rsplit("/sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
