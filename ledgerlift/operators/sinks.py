"""Stored results and their row counts."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

COMPRESSION = {"compression": "zstd"}


def stamped_path(root: str, prefix: str, at: datetime) -> str:
    """``<root>/<prefix>-<date>_<time>.parquet``; the run passes one time for all its files."""
    return f"{root.rstrip('/')}/{prefix}-{at:%Y-%m-%d_%H-%M-%S}.parquet"


def object_path(root: str, cross_section: str, version: str, name: str) -> str:
    return f"{root.rstrip('/')}/RF1175_{cross_section}_{version}/{name}"


def write_counted(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write Parquet and return the number of rows, counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).options(**COMPRESSION).parquet(path)
    rows = int(seen.get["rows"])
    log.info("wrote %d rows to %s", rows, path)
    return rows


def run_all[T](tasks: Mapping[str, Callable[[], T]], at_once: int) -> dict[str, T]:
    """Independent Spark jobs, several at a time, so that the last tasks of one
    table do not leave the cluster idle. The first failure is raised."""
    with_tags = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = {name: pool.submit(with_tags(task)) for name, task in tasks.items()}
        return {name: job.result() for name, job in running.items()}
