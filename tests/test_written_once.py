"""Intermediate tables: what is written for one reader alone, and what is left when a run has ended."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq

from ledgerlift import session
from ledgerlift.operators import forestry
from ledgerlift.plans import pipeline
from ledgerlift.plans.workspace import Workspace


def _workspace(spark, small, monkeypatch) -> Workspace:
    monkeypatch.setattr("ledgerlift.plans.workspace._paths", {})
    return Workspace(spark, small)


def _files(folder: str) -> list[Path]:
    return list(Path(folder).glob("*.parquet"))


def test_a_delivery_does_not_store_the_filings(spark, small, monkeypatch):
    ws = _workspace(spark, small, monkeypatch)
    alone = spark.read.parquet(ws.delivery())
    assert not ws._has("filings")
    both = _workspace(spark, small, monkeypatch)
    both.filings()
    assert sorted(alone.collect()) == sorted(spark.read.parquet(both.delivery()).collect())


def test_variants_of_a_snapshot_are_written_as_they_are(spark, small, monkeypatch):
    before = spark.conf.get("spark.sql.variant.inferShreddingSchema")
    ws = _workspace(spark, small, monkeypatch)
    ws.open_snapshot()
    for file in _files(ws.path("open_snapshot")):
        assert "typed_value" not in str(pq.ParquetFile(file).schema)
    assert spark.conf.get("spark.sql.variant.inferShreddingSchema") == before


def test_a_run_leaves_its_results_only(spark, small, monkeypatch, tmp_path):
    ws = _workspace(spark, small, monkeypatch)
    latest, delivery = ws.latest(), ws.delivery()
    there = {p.name for p in Path(session.scratch_root(spark)).iterdir()}
    at = pipeline.datetime(2024, 1, 2)
    pipeline.collect(spark, delivery, str(tmp_path / "out"), "parquet", at, together=True)
    pipeline.derive_all(latest, str(tmp_path / "derived"), "g2022", "v1")
    assert {p.name for p in Path(session.scratch_root(spark)).iterdir()} == there
    snapshot = pipeline.stamped_path(str(tmp_path / "out"), pipeline.SNAPSHOT_PREFIX, at)
    assert pq.ParquetFile(_files(snapshot)[0]).metadata.row_group(0).column(0).compression == "ZSTD"


def test_rows_are_made_once_for_an_order(workspace):
    """The pass that finds the ranges of a sort reads stored rows; it does not open the records again."""
    for ordered in (forestry.accounts(workspace.filings()), forestry.fund(workspace.filings(), per_account=True)):
        tree = ordered._jdf.queryExecution().executedPlan().toString()
        assert "Sort" in tree and "Generate" not in tree and "Window" not in tree
