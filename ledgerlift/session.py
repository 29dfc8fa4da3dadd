"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PARTITION_BYTES = 8 * 1024 * 1024  # of Parquet: sorted and gathered records take some fifty times that in memory
MOST_PARTITIONS = 50_000

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Times in the filings are UTC; everything else is left as the cluster set it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def size_shuffles(spark: SparkSession, data_bytes: int) -> None:
    """Enough shuffle partitions for the data; adaptive execution merges what is too small.

    Never fewer than the session asks for, and no more than keeps the map-output
    bookkeeping in proportion: past that, sorts and aggregates spill instead.
    """
    wanted = min(-(-data_bytes // PARTITION_BYTES), MOST_PARTITIONS)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))


# for the time of a write: VARIANT columns as they are, and no shuffle files left behind that nothing reads again
_WHILE_WRITING = {
    "spark.sql.variant.inferShreddingSchema": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Settings for intermediate tables that are written once; the session has its own again afterwards."""
    before = {key: spark.conf.get(key, None) for key in _WHILE_WRITING}
    try:
        for key, value in _WHILE_WRITING.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local path would not be seen by the other executors.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    app = spark.sparkContext.applicationId
    if shared:
        return f"{shared.rstrip('/')}/ledgerlift/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="ledgerlift-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to the end and is still there."""
    fs, at = _file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder that this session wrote below its scratch folder; others are left alone."""
    if not path.startswith(f"{scratch_root(spark)}/"):
        raise ValueError(f"{path} is not below {scratch_root(spark)}")
    fs, at = _file_system(spark, path)
    return fs.delete(at, True)


def data_version(spark: SparkSession, paths: Iterable[str]) -> tuple[tuple[int, int, int], ...]:
    """Bytes, files and time of change of each path or glob: differs when the data was replaced."""
    versions = []
    for path in paths:
        fs, at = _file_system(spark, path)
        found = list(fs.globStatus(at) or [])
        if not found:
            raise FileNotFoundError(path)
        sizes = [fs.getContentSummary(status.getPath()) for status in found]
        versions.append(
            (
                sum(size.getLength() for size in sizes),
                sum(size.getFileCount() for size in sizes),
                max(status.getModificationTime() for status in found),
            )
        )
    return tuple(versions)
