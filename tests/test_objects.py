from __future__ import annotations

from ledgerlift.functions.blanks import fill_blanks
from ledgerlift.operators import objects
from ledgerlift.plans.catalog import OBJECTS, POST_VARIABLES
from pyspark.sql import functions as F
from toys import filing, frame, rows


def test_codes_without_variable_leave_zeros(spark):
    df = frame(
        spark,
        filing("a", "2022", 1, 1, sales=[("3000", 5.0), ("3000", 0.25), ("3300", 1.0)]),
        filing("a", "2023", 1, 2, sales=[("3000", 1.0), (None, 7.0)]),
        filing("b", "2022", 1, 3, sales=[("9999", 5.0)]),
        filing("c", "2022", 1, 4, sales=[("3000", None)]),
        filing("d", "2022", 1, 5, sales=[("3000", 9.0)], duty="full"),
        filing("e", "2022", 1, 6, sales=[("3000", 9.0)], trade="aksjeselskap"),
        filing("f", "2022", 1, 7, sales=[("3000", 9.0)], orgnr=None),
        filing("g", "2022", 1, 8),
    )
    assert rows(objects.derive(df, "salgsinntekt"), "orgnr", "O_7360", "O_7362", "O_15843") == [
        ("a", 6.25, 0.0, 1.0),
        ("b", 0.0, 0.0, 0.0),
        ("c", 0.0, 0.0, 0.0),
    ]


def test_a_variable_may_add_codes_and_a_code_may_feed_variables(spark):
    df = frame(spark, filing("a", "2022", 1, 1, other=[("3910", 1.0), ("7911", 2.0), ("3900", 4.0)]))
    assert rows(objects.derive(df, "annenDriftsinntekt"), "O_37279", "O_7376") == [(3.0, 4.0)]
    assert POST_VARIABLES["LangsiktigGjeld"]["O_7327"] == POST_VARIABLES["LangsiktigGjeld"]["O_38947"] == ("2290",)
    assert "1350" in POST_VARIABLES["balanseverdiForAnleggsmiddel"]["O_38916"]


def test_sums_do_not_drift(spark):
    df = frame(spark, *[filing("a", str(2000 + i), 1, i, sales=[("3000", 0.1)]) for i in range(30)])
    assert rows(objects.derive(df, "salgsinntekt"), "O_7360") == [(3.0,)]
    assert abs(objects.derive(df, "salgsinntekt", decimals=None).first()["O_7360"] - 3.0) < 1e-9


def test_dates_are_copied_row_by_row_and_keys_come_down_to_organisations(spark):
    df = frame(spark, filing("a", "2022", 1, 1), filing("a", "2023", 1, 2), filing("b", "2022", 1, 3, orgnr=None))
    assert objects.derive(df, "virksomhet").count() == 3
    assert rows(objects.derive(df, "fordeltBeregnetNaeringsinntekt")) == [("",), ("a",)]
    assert rows(objects.derive(df, "spesifikasjonAvSkattemessigVerdiPaaFordring")) == [("a",)]


def test_blanks_by_type(spark):
    df = spark.createDataFrame([(None, None, None)], "n double, b boolean, s string")
    assert rows(fill_blanks(df)) == [(0.0, False, None)]
    assert rows(fill_blanks(df, ("number", "bool", "string"))) == [(0.0, False, "")]


def test_together_and_one_by_one(spark, workspace):
    small = frame(
        spark,
        filing("a", "2022", 1, 1, sales=[("3000", 5.0), (None, None)], other=[], total=7.0),
        filing("a", "2023", 1, 2, other=[("3900", None)]),
        filing("b", "2022", 1, 3, ordinal=9, sales=[("9999", 5.0)]),
        filing("b", "2022", 1, 3, ordinal=9, fragment=1, sales=[("3000", 1.0)]),
        filing("c", "2022", 1, 4, orgnr=None, sales=[("3000", 9.0)]),
        filing("d", "2022", 1, 5, duty="full", sales=[("3000", 9.0)]),
    )
    for latest in (small, workspace.latest()):
        together = objects.derive_together(latest).cache()
        for name in objects.SUMMED:
            assert rows(objects.one_of(together, name)) == rows(objects.derive(latest, name)), name


def test_sums_over_organisations_equal_sums_over_codes(workspace):
    latest = workspace.latest()
    for name in OBJECTS:
        if name not in POST_VARIABLES:
            continue
        derived = objects.derive(latest, name)
        total = derived.select(F.sum(sum(F.col(c) for c in derived.columns if c != "orgnr"))).first()[0]
        posts = objects.of_business(objects.object_frame(latest, name))
        weight = sum(F.col("type").isin(*codes).cast("int") for codes in POST_VARIABLES[name].values())
        want = posts.select(F.sum(F.col("beloep") * weight)).first()[0]
        assert abs(total - want) < 1e-3, name
