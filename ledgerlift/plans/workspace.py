"""Tables that several queries share, written once per session to the shared folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlift.operators import layouts, sections
from ledgerlift.operators.latest import latest_filings
from ledgerlift.operators.objects import derive
from ledgerlift.plans.catalog import POST_LISTS
from ledgerlift.session import configure, data_version, is_written, remove, scratch_path, size_shuffles, writing
from ledgerlift.sources import orders
from ledgerlift.sources.deliveries import as_delivery, parse_delivery, read_delivery
from ledgerlift.sources.tables import scan

_paths: dict[tuple, str] = {}
_frames: dict[tuple[SparkSession, str], DataFrame] = {}
_building = threading.RLock()
_TEXT = {"compression": "zstd"}  # payloads are text, or close to it
_SOURCES = ("orders", "customer", "lineitem", "supplier")


class Workspace:
    """Filings of one data folder and what is laid out from them.

    The nested filings and the latest of them play the part of the snapshot of a
    collection run: sections and derivations scan only the nested columns they use.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._version = data_version(spark, [f"{self.sf_dir}/{name}.parquet" for name in _SOURCES])
        size_shuffles(spark, sum(size for size, _, _ in self._version))

    def _key(self, name: str) -> tuple:
        return (self.spark.sparkContext.applicationId, self.sf_dir, self._version, name)

    def _path(self, name: str, write: Callable[[str], None]) -> str:
        key = self._key(name)
        with _building:
            if key not in _paths or not self._is_there(_paths[key]):
                path = scratch_path(self.spark, name)
                with writing(self.spark):
                    write(path)
                _paths[key] = path
        return _paths[key]

    def _table(self, name: str, write: Callable[[str], None]) -> DataFrame:
        key = (self.spark, self._path(name, write))
        if key not in _frames:
            _frames[key] = scan(self.spark, key[1])  # the schema is read once, not per query
        return _frames[key]

    def _has(self, name: str) -> bool:
        path = _paths.get(self._key(name))
        return path is not None and self._is_there(path)

    def _is_there(self, path: str) -> bool:
        # the folders of wide subsets and of versions hold tables, they are none themselves
        inside = {"wide_themes": lambda: layouts.theme_path(path, "egenkapital"), "codes": lambda: layouts.codes_path(path, "1")}
        probe = next((at() for name, at in inside.items() if path.rsplit("/", 1)[-1].startswith(f"{name}-")), path)
        return is_written(self.spark, probe)

    def clear(self) -> int:
        """Remove the tables of this data folder from the shared folder; they are built again when asked for."""
        with _building:
            mine = [key for key in _paths if key[:2] == self._key("")[:2]]
            for key in mine:
                path = _paths.pop(key)
                _frames.pop((self.spark, path), None)
                remove(self.spark, path)
        return len(mine)

    def path(self, name: str) -> str:
        """Where a table that was already asked for is stored."""
        return _paths[self._key(name)]

    def filings(self) -> DataFrame:
        return self._table("filings", lambda path: orders.order_filings(self.spark, self.sf_dir).write.options(**_TEXT).parquet(path))

    def latest(self) -> DataFrame:
        return self._table("latest", lambda path: latest_filings(self.filings()).write.options(**_TEXT).parquet(path))

    def delivery(self) -> str:
        """The filings as a raw delivery: event records with JSON payloads. They are not stored for it alone."""

        def write(path: str) -> None:
            filings = self.filings() if self._has("filings") else orders.order_filings(self.spark, self.sf_dir)
            as_delivery(filings).write.options(**_TEXT).parquet(path)

        return self._path("delivery", write)

    def snapshot(self) -> DataFrame:
        """That delivery collected: the JSON is parsed once, into nested columns."""

        def write(path: str) -> None:
            raw = read_delivery(self.spark, self.delivery(), "parquet")
            parse_delivery(raw).write.options(**_TEXT).parquet(path)

        return self._table("snapshot", write)

    def open_snapshot(self) -> DataFrame:
        """A delivery whose forestry amounts go by names of the data, collected."""

        def deliver(path: str) -> None:
            as_delivery(orders.order_filings(self.spark, self.sf_dir, open_amounts=True)).write.options(**_TEXT).parquet(path)

        def write(path: str) -> None:
            parse_delivery(read_delivery(self.spark, self._path("open_delivery", deliver), "parquet")).write.options(**_TEXT).parquet(path)

        return self._table("open_snapshot", write)

    def derived(self, name: str) -> DataFrame:
        """A derived object as it is stored."""
        return self._table(f"derived-{name}", lambda path: derive(self.latest(), name).write.parquet(path))

    def long_source(self) -> DataFrame:
        return orders.garble_small_amounts(layouts.long_layout(self.latest()))

    def long(self) -> DataFrame:
        return self._table("long", lambda path: layouts.write_long(self.long_source(), path))

    def long_partitioned(self) -> str:
        return self._path("long_partitioned", lambda path: layouts.write_partitioned(self.long(), path))

    def codes(self) -> DataFrame:
        """The fields that occur in the long table, stored under a version."""
        root = self._path("codes", lambda path: layouts.write_codes(self.long(), path, "1"))
        return layouts.read_codes(self.spark, root)

    def headers(self) -> str:
        """Name of the bucketed table of registrations behind the main table of posts."""
        name = f"ledgerlift_headers_{uuid.uuid5(uuid.NAMESPACE_URL, repr(self._key('headers'))).hex}"
        main = sections.section(self.latest(), "naering")
        self._path("headers", lambda path: sections.store_headers(main, name, path))
        return name

    def wide(self) -> DataFrame:
        def write(path: str) -> None:
            layouts.write_wide(layouts.wide_layout(self.long(), layouts.fields_in(self.codes())), path)

        return self._table("wide", write)

    def wide_themes(self) -> str:
        """Root of the wide subsets; each is made from its own partition of the long table."""

        def write(path: str) -> None:
            long = self.spark.read.parquet(self.long_partitioned())
            codes = self.codes()
            layouts.write_wide_themes(long, path, {g: [f[1:] for f in layouts.fields_in(codes, g)] for g in POST_LISTS})

        return self._path("wide_themes", write)
