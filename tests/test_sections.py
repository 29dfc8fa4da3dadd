from __future__ import annotations

import pytest
from ledgerlift.operators import forestry, sections
from ledgerlift.plans.catalog import MAIN, SECTIONS
from pyspark.sql import functions as F
from toys import account, filing, frame, rows


def test_a_missing_list_takes_no_other_list_with_it(spark):
    df = frame(
        spark,
        filing("a", "2022", 1, 1, sales=[("3000", 5.0)], other=None),
        filing("b", "2022", 1, 2, sales=None, other=[("3400", 6.0)]),
        filing("c", "2022", 1, 3, sales=[], other=[]),
        filing("d", "2022", 1, 4),
    )
    assert rows(sections.section(df, "driftsinntekt")) == [("3000", 5.0, 1), ("3400", 6.0, 2)]


def test_empty_and_zero_amounts_are_left_out(spark):
    df = frame(spark, filing("a", "2022", 1, 1, sales=[("3000", None), ("3100", 0.0), ("3200", -1.5), (None, 2.0)]))
    assert rows(sections.section(df, "driftsinntekt")) == [("3200", -1.5, 1), (None, 2.0, 1)]


def test_main_rows_carry_year_filer_and_time(spark):
    df = frame(spark, filing("00000000001", "2022", 4, 1, sales=[("3000", 5.0)], total=5.0))
    out = sections.section(df, "naering")
    assert out.columns == list(MAIN)
    assert dict(out.dtypes)["inntektsaar"] == "bigint"
    assert rows(out, "inntektsaar", "id", "felt", "beloep") == [
        (2022, "00000000001", "3000", 5.0),
        (2022, "00000000001", "sumDriftsinntekt", 5.0),
    ]


def test_a_year_that_is_no_number_is_an_error(spark):
    df = frame(spark, filing("a", "ukjent", 4, 1, sales=[("3000", 5.0)]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sections.section(df, "naering").collect()


def test_subsets_are_slices_of_the_main_table(workspace):
    everything = sections.all_sections(workspace.latest())
    for name in SECTIONS:
        tagged = everything.where(F.col("section") == name).select(*SECTIONS[name].columns)
        single = sections.section(workspace.latest(), name)
        assert single.exceptAll(tagged).isEmpty() and tagged.exceptAll(single).isEmpty(), name
    naering = everything.where("section = 'naering'").select(*MAIN)
    subset = sections.section(workspace.latest(), "driftskostnad")
    linked = sections.relink(subset, naering)
    assert linked.count() == subset.count()
    assert linked.exceptAll(naering).isEmpty()


def test_the_link_key_is_unique_among_the_latest(workspace):
    latest = workspace.latest()
    assert latest.select("hendelse.sekvensnummer").distinct().count() == latest.count()


def test_forestry_rows_and_order(spark):
    df = frame(
        spark,
        filing("b", "2022", 1, 1, accounts=[account("k1", verdi=2.0, antall=0.0)]),
        filing("a", "2022", 1, 2, accounts=[
            account("k2", verdi=1.0, antall=3.0, fund=[("f1", "k", 5.0, None), ("f2", "j", 0.0, 6.0)]),
            account("k1", owner=None, verdi=None, antall=4.0, fund=[("f3", "k", 7.0, 8.0)]),
        ]),
    )
    out = forestry.accounts(df).select("norskIdentifikator", "id", "driftsenhet", "felt", "beloep").collect()
    assert [tuple(r) for r in out] == [
        ("a", "k1", None, "antall", 4.0),
        ("a", "k2", "skog", "antall", 3.0),
        ("a", "k2", "skog", "verdi", 1.0),
        ("b", "k1", "skog", "verdi", 2.0),
    ]
    fund = ("skogOgToemmerkontoId", "id", "kommunenummer", "felt", "beloep")
    assert rows(forestry.fund(df), *fund) == [("k1", "f3", "k", "avgift", 8.0), ("k1", "f3", "k", "innskudd", 7.0)]
    assert [tuple(r) for r in forestry.fund(df, per_account=True).select(*fund).collect()] == [
        ("k1", "f3", "k", "avgift", 8.0),
        ("k1", "f3", "k", "innskudd", 7.0),
        ("k2", "f2", "j", "avgift", 6.0),
        ("k2", "f1", "k", "innskudd", 5.0),
    ]
