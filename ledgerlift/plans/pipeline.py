"""The two batch runs: collect a delivery, derive the form objects."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlift.operators import forestry, objects, quality, sections
from ledgerlift.operators.latest import latest_filings
from ledgerlift.operators.sinks import COMPRESSION, object_path, run_all, stamped_path, write_counted
from ledgerlift.plans.catalog import (
    DATE_VARIABLES,
    FORESTRY_ACCOUNTS_PREFIX,
    FORESTRY_FUND_PREFIX,
    KEY_OBJECTS,
    MAIN,
    SECTIONS,
    SNAPSHOT_PREFIX,
    STORED_OBJECTS,
)
from ledgerlift.session import configure, data_version, remove, scratch_path, size_shuffles, writing
from ledgerlift.sources.deliveries import parse_delivery, read_delivery

log = logging.getLogger(__name__)

JOBS_AT_ONCE = 4
SECTIONS_PREFIX = "seksjoner"
SCHEDULED = tuple(name for name, spec in SECTIONS.items() if spec.scheduled)


def collect(
    spark: SparkSession,
    delivery: str,
    out: str,
    source: str = "avro",
    at: datetime | None = None,
    at_once: int = JOBS_AT_ONCE,
    together: bool = False,
) -> dict[str, int]:
    """Collect one delivery: snapshot, forestry, main tables and theme subsets.

    Every section gets a file of its own. ``together`` writes all of them in one job instead, as partitions of
    one table: the latest filings are read once, however many sections there are (``read_section``).

    The JSON is parsed once, into the snapshot. The latest filings are found once
    and written to the shared folder, so that every section is a scan of its own
    columns without a shuffle, and a lost executor costs no more than its tasks.
    Returns rows per written table; empty when the delivery is.
    """
    configure(spark)
    size_shuffles(spark, data_version(spark, [delivery])[0][0])
    with writing(spark):
        return _collected(spark, delivery, out, source, at or datetime.now(), at_once, together)


def _collected(spark: SparkSession, delivery: str, out: str, source: str, at: datetime, at_once: int, together: bool) -> dict[str, int]:
    raw = read_delivery(spark, delivery, source)
    if raw.isEmpty():
        log.warning("no records in %s", delivery)
        return {}

    snapshot = stamped_path(out, SNAPSHOT_PREFIX, at)
    rows = {SNAPSHOT_PREFIX: write_counted(parse_delivery(raw), snapshot)}
    filings = spark.read.parquet(snapshot)
    kept = scratch_path(spark, "latest")
    latest = store_latest(filings, kept)

    unordered = {prefix: scratch_path(spark, "unordered") for prefix in (FORESTRY_ACCOUNTS_PREFIX, FORESTRY_FUND_PREFIX)}
    outputs = {
        FORESTRY_ACCOUNTS_PREFIX: forestry.accounts(filings, at=unordered[FORESTRY_ACCOUNTS_PREFIX]),
        FORESTRY_FUND_PREFIX: forestry.fund(filings, at=unordered[FORESTRY_FUND_PREFIX]),
    }
    if together:
        rows |= store_all_sections(latest, stamped_path(out, SECTIONS_PREFIX, at), SCHEDULED)
    else:
        outputs |= {name: _to_store(latest, name) for name in SCHEDULED}
    writes = {prefix: partial(write_counted, df, stamped_path(out, prefix, at)) for prefix, df in outputs.items()}
    rows |= run_all(writes, at_once)
    for path in (kept, *unordered.values()):
        remove(spark, path)
    return rows


def _to_store(latest: DataFrame, name: str) -> DataFrame:
    """A section for writing. A theme subset is a sliver of every input split, so it is
    merged into files of full size; a main table is about as large as its input."""
    rows = sections.section(latest, name)
    return rows if SECTIONS[name].columns == MAIN else rows.hint("rebalance")


def store_latest(filings: DataFrame, path: str) -> DataFrame:
    """The latest filings as a table of their own."""
    latest_filings(filings).write.mode("errorifexists").options(**COMPRESSION).parquet(path)
    return filings.sparkSession.read.parquet(path)


def store_all_sections(latest: DataFrame, path: str, names: Iterable[str] = tuple(SECTIONS)) -> dict[str, int]:
    """Sections from one scan, in folders by section; returns the rows of each, counted while they are written."""
    names = list(names)
    seen = Observation()
    counts = [F.count_if(F.col("section") == name).alias(name) for name in names]
    rows = sections.all_sections(latest, names).observe(seen, *counts).hint("rebalance", "section")
    rows.write.mode("errorifexists").options(**COMPRESSION).partitionBy("section").parquet(path)
    return {name: int(seen.get[name]) for name in names}


def read_section(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One section of a table of all sections, with its own columns; empty when it has no rows."""
    stored = spark.read.schema(f"{sections.MAIN_DDL}, section string").parquet(path)
    return stored.where(F.col("section") == name).select(*SECTIONS[name].columns)


def derive_all(
    latest: DataFrame,
    out: str,
    cross_section: str,
    version: str,
    names: Iterable[str] = STORED_OBJECTS,
    at_once: int = JOBS_AT_ONCE,
) -> dict[str, str]:
    """Derive and store the form objects; returns the path of each."""
    names = list(names)
    paths = {name: object_path(out, cross_section, version, name) for name in names}
    summed = [name for name in names if name in objects.SUMMED]
    spark = latest.sparkSession
    wide = scratch_path(spark, "objects")
    together = None
    if len(summed) > 1:  # their sums are found in one pass, and each object is then a few columns of that
        with writing(spark):
            objects.derive_together(latest, summed).write.options(**COMPRESSION).parquet(wide)
        together = spark.read.parquet(wide)

    def derived(name: str) -> DataFrame:
        return objects.one_of(together, name) if together and name in summed else objects.derive(latest, name)

    writes = {name: partial(write_counted, derived(name), path, mode="overwrite") for name, path in paths.items()}
    with writing(spark):
        run_all(writes, at_once)
    if together:
        remove(spark, wide)
    return paths


def statistics(derived: DataFrame, name: str) -> DataFrame:
    """Summary statistics of a derived object; numbers when it has any."""
    if name in DATE_VARIABLES or name in KEY_OBJECTS:
        return quality.describe_values(derived)
    return quality.describe(derived)
