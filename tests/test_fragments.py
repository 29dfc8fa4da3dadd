"""A filing too long for one record gives the same results in several."""

from __future__ import annotations

import pytest
from ledgerlift.operators import forestry, layouts, objects, sections
from ledgerlift.operators.latest import latest_account, latest_filings, whole
from ledgerlift.functions.variants import list_of, text_of
from ledgerlift.plans.catalog import OBJECTS
from ledgerlift.sources.deliveries import as_delivery, parse_delivery
from ledgerlift.sources.orders import order_filings
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def pieces(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pieces") / "filings")
    order_filings(spark, small, max_posts=2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def latest_pieces(spark, pieces, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pieces") / "latest")
    latest_filings(pieces).write.parquet(path)
    return spark.read.parquet(path)


def same(a, b):
    assert a.columns == b.columns
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_records_are_bounded(pieces, workspace):
    assert pieces.schema == workspace.filings().schema
    assert pieces.count() > whole(pieces).count() == workspace.filings().count()


def test_sections(latest_pieces, workspace):
    assert same(sections.all_sections(latest_pieces), sections.all_sections(workspace.latest()))


def test_delivery(pieces, workspace):
    again = parse_delivery(as_delivery(pieces))
    assert again.drop("original").schema.simpleString() == pieces.drop("undeclared").schema.simpleString()
    name = "driftsinntekt"
    assert same(sections.section(latest_filings(again), name), sections.section(workspace.latest(), name))


def test_forestry(pieces, workspace):
    assert same(forestry.accounts(pieces), forestry.accounts(workspace.filings()))
    assert same(forestry.fund(pieces), forestry.fund(workspace.filings()))
    assert same(forestry.fund(pieces, True), forestry.fund(workspace.filings(), True))


def test_account_headers(pieces, workspace):
    for every in (False, True):
        cut, plain = latest_account(pieces, every), latest_account(workspace.filings(), every)
        columns = [*forestry.HEADER, "ordinal", "number", text_of(F.col("account"), "id")]
        assert cut.count() >= plain.count()
        assert same(cut.select(*columns).distinct(), plain.select(*columns))


@pytest.mark.parametrize("name", OBJECTS)
def test_objects(latest_pieces, workspace, name):
    assert same(objects.derive(latest_pieces, name), objects.derive(workspace.latest(), name))


def test_long_layout(latest_pieces, workspace):
    assert same(layouts.long_layout(latest_pieces), layouts.long_layout(workspace.latest()))


def test_an_order_that_holds_a_third_of_all_lines(spark, small, tmp_path):
    """Equal lines of one order: none is lost and no record grows with them."""
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    one = lines.where("l_returnflag = 'R' and l_discount > 0 and l_tax > 0 and l_linenumber = 1").limit(1)
    copies = one.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("_n")
    lines.unionByName(copies).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("orders", "customer", "supplier"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    plain, cut = order_filings(spark, str(tmp_path)), order_filings(spark, str(tmp_path), max_posts=500)
    assert cut.where("hendelse.fragment > 0").count() > 0
    body = "naeringsspesifikasjon.skogbruk.skogOgToemmerkonto"
    longest = cut.select(F.max(F.aggregate(body, F.lit(0), lambda n, a: n + F.size(list_of(a, "skogfond")))))
    assert longest.first()[0] <= 700
    sales = "naeringsspesifikasjon.resultatregnskap.driftsinntekt.salgsinntekt.inntekt"
    assert all(n <= 700 for n in cut.select(F.max(F.size(body)), F.max(F.size(sales))).first())
    assert same(sections.all_sections(latest_filings(cut)), sections.all_sections(latest_filings(plain)))
    assert same(forestry.fund(cut, True), forestry.fund(plain, True))
