"""What the physical plans must look like at scale."""

from __future__ import annotations

import re

from ledgerlift.operators import layouts, objects, sections
from ledgerlift.operators.latest import latest_account, latest_filings
from ledgerlift.sources.tables import scan_partitions
from toys import rows


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def exchanges(text: str) -> int:
    tree = text.split("\n\n")[0]
    return len(re.findall(r"Exchange \(", tree))


def test_latest_is_chosen_on_headers(workspace):
    text = plan(sections.section(latest_filings(workspace.filings()), "driftsinntekt"))
    assert text.split("\n\n")[0].count("WindowGroupLimit") == 2
    posts, header = re.findall(r"ReadSchema: (.*)", text)
    assert "driftsinntekt" in posts and "balanseregnskap" not in posts and "skogbruk" not in posts
    assert header.count("struct<") == 3 and "norskIdentifikator" in header  # the row, its header and two fields of the body


def test_one_plan_for_long_and_short_filings(workspace):
    """Accounts are compared inside their records: nothing is exploded before an exchange."""
    text = plan(latest_account(workspace.filings()))
    tree = text.split("\n\n")[0]
    assert "Generate" not in tree and tree.count("WindowGroupLimit") == 2
    window = re.search(r"Exchange\nInput \[\d+\]: \[_filer.*\]", text).group(0)
    assert "skogOgToemmerkonto" not in window and "_first" in window


def test_sections_of_the_latest_need_no_shuffle(workspace):
    for df in (sections.section(workspace.latest(), "naering"), sections.all_sections(workspace.latest())):
        assert exchanges(plan(df)) == 0


def test_derivation_filters_in_the_scan_and_shuffles_once(workspace):
    text = plan(objects.derive(workspace.latest(), "salgsinntekt"))
    assert exchanges(text) == 1
    assert "In(naeringsspesifikasjon.virksomhet.virksomhetstype" in text
    assert "In(naeringsspesifikasjon.virksomhet.regnskapspliktstype" in text
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "salgsinntekt" in schema and "varekostnad" not in schema and "sekvensnummer" not in schema
    assert text.split("\n\n")[0].count("HashAggregate") == 2


def test_partitions_and_values_are_pruned(spark, workspace):
    parts = scan_partitions(
        spark, workspace.long_partitioned(), hovedtema="resultatregnskap", undertema="driftsinntekt"
    )
    text = plan(layouts.long_prefix_sum(parts, "p3", "00000000007"))
    assert re.search(r"PartitionFilters: \[.*hovedtema.*undertema", text)
    assert "EqualTo(norskIdentifikator,00000000007)" in text and "StringStartsWith(felt_id,p3)" in text
    assert "gruppe" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_wide_reads_only_the_columns_of_the_prefix(workspace):
    schema = re.search(r"ReadSchema: (.*)", plan(layouts.wide_prefix_sum(workspace.wide(), "p3"))).group(1)
    assert "p3000" in schema and "p4005" not in schema and "p1000" not in schema


def test_wide_table_is_shuffled_once(workspace):
    tree = plan(layouts.wide_layout(workspace.long(), ["p3000", "p9999"])).split("\n\n")[0]
    assert len(re.findall(r"[^t]Exchange \(", tree)) == 1 and tree.count("HashAggregate") == 2


def test_all_objects_take_one_scan_and_one_shuffle(workspace):
    text = plan(objects.derive_together(workspace.latest()))
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == exchanges(text) == 1
    assert "In(naeringsspesifikasjon.virksomhet.virksomhetstype" in text


def test_relinking_leaves_the_main_side_in_place(spark, workspace):
    table = workspace.headers()
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = sections.relink_stored(sections.section(workspace.latest(), "driftsinntekt"), table)
        text = plan(df)
        kept = rows(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    tree = text.split("\n\n")[0]
    assert exchanges(text) == 1 and "SortMergeJoin" in tree
    subset, main = tree.split("Scan parquet")[0:2]
    assert "Exchange (" not in main and "Bucketed: true" in text
    assert kept == rows(sections.relink(sections.section(workspace.latest(), "driftsinntekt"), sections.section(workspace.latest(), "naering")))


def test_nothing_runs_in_python(workspace):
    for df in (
        sections.all_sections(workspace.latest()),
        objects.derive(workspace.latest(), "annenDriftskostnad"),
        layouts.wide_layout(workspace.long(), ["p3000"]),
    ):
        assert "Python" not in plan(df) and "ExistingRDD" not in plan(df)


def test_rows_of_the_plan_helper(spark):
    assert rows(spark.range(1)) == [(0,)]
