from __future__ import annotations

from pathlib import Path

import pytest
from ledgerlift.operators import layouts
from ledgerlift.sources.tables import drop_view, filtered_view, register, scan, scan_partitions, scan_tree
from pyspark.sql import functions as F
from toys import rows

LONG = "norskIdentifikator string, felt_id string, felt_verdi string, hovedtema string, undertema string, gruppe string"
SALES = ("resultatregnskap", "driftsinntekt", "salgsinntekt")
OTHER = ("resultatregnskap", "driftsinntekt", "annenDriftsinntekt")
LOANS = ("balanseregnskap", "gjeldOgEgenkapital", "langsiktigGjeld")


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame(
        [
            ("a", "p3000", "1.5", *SALES),
            ("a", "p3000", "2", *SALES),
            ("a", "p3100", "x", *SALES),
            ("a", "p3400", "4", *OTHER),
            ("a", "p2220", "8", *LOANS),
            ("b", "p3100", "16", *SALES),
            ("c", "p9999", "32", *SALES),
        ],
        LONG,
    )


def test_layouts_give_the_same_sums(spark, long, tmp_path):
    root = str(tmp_path)
    layouts.write_long(long, f"{root}/long")
    layouts.write_partitioned(long, f"{root}/parts")
    fields = layouts.fields_of(["3000", "3100", "3400", "2220"])
    layouts.write_wide(layouts.wide_layout(long, fields), f"{root}/wide")
    layouts.write_wide_themes(long, f"{root}/themes", {"salgsinntekt": [], "annenDriftsinntekt": []})

    parts = scan_partitions(spark, f"{root}/parts", hovedtema="resultatregnskap", undertema="driftsinntekt")
    assert set(layouts.THEMES) <= set(parts.columns)
    for filer, total in (("a", 7.5), ("b", 16.0), ("c", None), (None, 23.5)):
        assert layouts.long_prefix_sum(scan(spark, f"{root}/long"), "p3", filer).first()["total"] == total
        assert layouts.long_prefix_sum(parts, "p3", filer).first()["total"] == total
        for wide in (
            scan(spark, f"{root}/wide"),
            layouts.read_wide_themes(spark, f"{root}/themes", ["salgsinntekt", "annenDriftsinntekt"]),
        ):
            sums = layouts.wide_prefix_sum(wide, "p3", filer).first().asDict().values()
            assert sum(v or 0 for v in sums) == (total or 0)


def test_a_filer_with_unlisted_fields_only_stays_in_the_wide_table(spark, long):
    wide = layouts.wide_layout(long, ["p3000", "p3100"])
    assert rows(wide) == [("a", 3.5, None), ("b", None, 16.0), ("c", None, None)]


def test_codes_that_no_catalog_lists_become_columns(spark, long, tmp_path):
    more = long.unionByName(spark.createDataFrame([("a", "p31337", "64", *SALES), ("d", "p3-ny", "128", *LOANS), ("d", None, "1", *LOANS)], LONG))
    layouts.write_codes(long, f"{tmp_path}/codes", "2023-01")
    layouts.write_codes(more, f"{tmp_path}/codes", "2024-01")
    old = layouts.fields_in(layouts.read_codes(spark, f"{tmp_path}/codes", "2023-01"))
    fields = layouts.fields_in(layouts.read_codes(spark, f"{tmp_path}/codes"))
    assert set(fields) - set(old) == {"p31337", "p3-ny"} and "p9999" in old and fields[0] == old[0] == "p3000"
    assert "p31337" in layouts.fields_in(layouts.read_codes(spark, f"{tmp_path}/codes"), "salgsinntekt")
    assert "p31337" not in layouts.fields_in(layouts.read_codes(spark, f"{tmp_path}/codes"), "egenkapital")
    wide = layouts.wide_layout(more, fields)
    sums = layouts.wide_prefix_sum(wide, "p3").first().asDict().values()
    assert sum(v or 0 for v in sums) == layouts.long_prefix_sum(more, "p3").first()["total"] == 215.5
    with pytest.raises(ValueError, match="more than 3"):
        layouts.fields_in(layouts.code_dictionary(more), most=3)


def test_strict_numbers_raise(long):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        layouts.long_prefix_sum(long, "p3", strict=True).collect()


def test_long_to_wide_to_long_keeps_what_is_not_zero(workspace):
    long = layouts.long_layout(workspace.latest())
    groups = ("salgsinntekt", "finanskostnad", "egenkapital")
    back = layouts.wide_to_long({g: layouts.wide_theme(long, g, ["9999"]) for g in groups})
    keys = ["norskIdentifikator", "felt_id", *layouts.THEMES]
    want = (
        long.where(F.col("gruppe").isin(*groups))
        .groupBy(*keys)
        .agg(F.round(F.sum(F.col("felt_verdi").cast("double")), 2).alias("beloep"))
        .select(*back.columns)
    )
    assert back.count() == want.count()
    assert back.exceptAll(want).isEmpty()


def test_scans(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(f"{root}/t/day=1")
    spark.range(2).withColumn("y", F.lit(2)).write.parquet(f"{root}/t/day=2")
    (Path(root) / "t/day=1/notes.txt").write_text("not a table")
    both = scan(spark, f"{root}/t/day=1", f"{root}/t/day=2")
    assert set(both.columns) >= {"id", "x", "y"} and both.count() == 5
    assert scan(spark, f"{root}/t/day=*/*").count() == 5
    tree = scan_tree(spark, f"{root}/t")
    assert "day" not in tree.columns and tree.count() == 5
    assert scan_partitions(spark, f"{root}/t", day="2").count() == 2
    assert register(spark, f"{root}/t/day=1", "toy_table").count() == 3
    assert spark.sql("select count(*) from toy_table").first()[0] == 3
    assert filtered_view(spark, f"{root}/t/day=1", "toy_view", "id", "1").count() == 1
    assert drop_view(spark, "toy_view") and not drop_view(spark, "toy_view")
