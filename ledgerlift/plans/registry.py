"""The named queries: every operator over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.functions.amounts import number, sum_amount
from ledgerlift.functions.times import event_time
from ledgerlift.functions.variants import text_of
from ledgerlift.operators import forestry, latest, layouts, objects, quality, sections
from ledgerlift.operators.ordering import with_position
from ledgerlift.plans import pipeline
from ledgerlift.plans.catalog import OBJECTS, SECTIONS, SNAPSHOT_PREFIX
from ledgerlift.plans.workspace import Workspace
from ledgerlift.session import configure, is_written, scratch_path
from ledgerlift.sources import orders
from ledgerlift.sources.deliveries import delivered, parse_payload
from ledgerlift.sources.tables import drop_view, filtered_view, register, scan, scan_partitions, scan_tree

FILER = "00000000007"
OPERATING_INCOME = {"hovedtema": "resultatregnskap", "undertema": "driftsinntekt"}
RUN_TIME = datetime(2024, 1, 2, 3, 4, 5)

Query = Callable[[SparkSession, str], DataFrame]


def _naive(df: DataFrame) -> DataFrame:
    """Times and dates as UTC wall-clock times, whatever zone the reader is in."""
    times = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.DateType))]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


def _on(build: Callable[[Workspace], DataFrame]) -> Query:
    return lambda spark, sf_dir: _naive(build(Workspace(spark, sf_dir)))


def _headers(filings: DataFrame) -> DataFrame:
    return latest.whole(filings).select(*sections.header())


def _account_headers(filings: DataFrame, per_account: bool = False) -> DataFrame:
    rows = latest.latest_account(filings, per_account).select(
        *forestry.HEADER, text_of(F.col("account"), "id").alias("skogOgToemmerkontoId"), "ordinal", "number"
    )
    # an account is in every record that holds some of its entries
    return rows.dropDuplicates(["ordinal", "number"]).drop("ordinal", "number")


def _ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    events = orders.event_delivery(spark, sf_dir).select(
        "user_id",
        parse_payload(F.col("data.hendelse"), "registreringstidspunkt string, sekvensnummer bigint").alias("h"),
        parse_payload(F.col("data.naeringsspesifikasjon"), "k bigint").alias("body"),
    )
    return _naive(
        events.select(
            F.col("h.sekvensnummer").alias("sekvensnummer"),
            "user_id",
            event_time(F.col("h.registreringstidspunkt")).alias("registreringstidspunkt"),
            F.col("body.k").alias("k"),
        )
    )


def _event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    forms = {
        "from_micros": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
        "from_seconds": "yyyy-MM-dd'T'HH:mm:ss'Z'",
        "from_tenths": "yyyy-MM-dd'T'HH:mm:ss.S'Z'",
        "from_offset": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'",
        "without_zone": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    times = [event_time(F.date_format("ts", form)).alias(name) for name, form in forms.items()]
    return _naive(events.select("event_id", *times))


def _ingest_filings(ws: Workspace) -> DataFrame:
    return sections.section(latest.latest_filings(ws.snapshot()), "naering")


def _snapshot_undeclared(ws: Workspace) -> DataFrame:
    snapshot = latest.whole(ws.snapshot())
    body = "naeringsspesifikasjon"
    return snapshot.select(
        F.col(latest.SEQUENCE).alias("sekvensnummer"),
        delivered(snapshot, "hendelse", "$.hendelsetype", "string").alias("hendelsetype"),
        delivered(snapshot, body, "$.merknad.tekst", "string").alias("tekst"),
        delivered(snapshot, body, "$.merknad.sum.o_totalprice", "double").alias("total"),
        delivered(snapshot, body, "$.norskIdentifikator", "string").alias("norskIdentifikator"),
    )


def _pipeline_roundtrip(ws: Workspace) -> DataFrame:
    out = scratch_path(ws.spark, "run")
    ws.filings()  # the delivery and the latest filings are both made of them
    collected = pipeline.collect(ws.spark, ws.delivery(), f"{out}/collected", "parquet", RUN_TIME, together=True)
    paths = {name: pipeline.stamped_path(f"{out}/collected", name, RUN_TIME) for name in collected if name not in SECTIONS}
    derived = pipeline.derive_all(ws.latest(), f"{out}/derived", "g2022", "v1")
    paths.update({f"RF1175/{name}": path for name, path in derived.items()})
    stored = {name: scan(ws.spark, path) for name, path in paths.items()}
    together = pipeline.stamped_path(f"{out}/collected", pipeline.SECTIONS_PREFIX, RUN_TIME)
    stored |= {name: pipeline.read_section(ws.spark, together, name) for name in pipeline.SCHEDULED}
    stored[SNAPSHOT_PREFIX] = latest.whole(stored[SNAPSHOT_PREFIX])
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("stored"), "n_rows") for name, df in stored.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _stored_section_counts(ws: Workspace) -> DataFrame:
    """The counts that the one write observes, beside what is read back."""
    path = scratch_path(ws.spark, "sections")
    counts = pipeline.store_all_sections(ws.latest(), path)
    observed = ws.spark.createDataFrame(list(counts.items()), "section string, n_observed long")
    read = ws.spark.read.parquet(path).groupBy("section").agg(F.count("*").alias("n_rows"))
    return observed.join(read, "section", "left").select("section", "n_observed", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def _derived_together(ws: Workspace) -> DataFrame:
    path = scratch_path(ws.spark, "objects")
    objects.derive_together(ws.latest()).write.parquet(path)
    together = ws.spark.read.parquet(path)
    parts = []
    for name in objects.SUMMED:
        one = objects.one_of(together, name)
        rows = one.unpivot(["orgnr"], one.columns[1:], "variabel", "verdi")
        parts.append(rows.select(F.lit(name).alias("objekt"), "orgnr", "variabel", "verdi"))
    return reduce(DataFrame.unionByName, parts)


def _wide_against_long(ws: Workspace) -> DataFrame:
    """Sums by prefix of the field, from the wide and from the long table."""
    parts = []
    for prefix in ("p", "p3", "p9", "p27"):
        sums = layouts.wide_prefix_sum(ws.wide(), prefix)
        wide = sums.select(F.expr(" + ".join(f"coalesce(cast(`{c}` as decimal(18, 2)), 0)" for c in sums.columns)).cast("double").alias("wide"))
        long = layouts.long_prefix_sum(ws.long(), prefix).withColumnRenamed("total", "long")
        parts.append(wide.join(long, F.lit(True)).select(F.lit(prefix).alias("prefix"), "wide", "long"))  # one row each
    return reduce(DataFrame.unionByName, parts)


def _empty_delivery(ws: Workspace) -> DataFrame:
    """Tables that a run writes when none of the delivery's records are left: none, and no folder."""
    out = scratch_path(ws.spark, "run")
    raw = ws.spark.read.parquet(ws.delivery())
    left = raw.where(F.get_json_object("data.hendelse", "$.sekvensnummer").cast("bigint") < 0)
    left.write.parquet(f"{out}/delivery")
    written = pipeline.collect(ws.spark, f"{out}/delivery", f"{out}/collected", "parquet", RUN_TIME)
    return ws.spark.sql("select :tables as n_tables, :there as folder", args={"tables": len(written), "there": is_written(ws.spark, f"{out}/collected")})


def _named_scan(ws: Workspace) -> DataFrame:
    ws.long()
    register(ws.spark, ws.path("long"), "ledgerlift_long")
    return ws.spark.sql("select gruppe, felt_id, count(*) as n_rows from ledgerlift_long group by gruppe, felt_id")


def _strict_sum(ws: Workspace) -> DataFrame:
    """Sums of texts that are all numbers, cast strictly."""
    long = layouts.long_layout(ws.latest())
    return layouts.long_prefix_sum(long, "p3", strict=True)


def _with_missing_keys(ws: Workspace) -> DataFrame:
    """Filings of which every fifth filer, every seventh year and every third organisation is missing."""
    seq, who = F.col(latest.SEQUENCE), F.col("naeringsspesifikasjon.norskIdentifikator").cast("bigint")
    body = F.col("naeringsspesifikasjon")
    body = body.withField("norskIdentifikator", F.when(who % 5 != 0, body["norskIdentifikator"]))
    body = body.withField("inntektsaar", F.when(seq % 7 != 0, body["inntektsaar"]))
    body = body.withField("virksomhet.orgnr", F.when(who % 3 != 0, body["virksomhet"]["orgnr"]))
    return ws.filings().withColumn("naeringsspesifikasjon", body)


def _latest_of_missing_keys(ws: Workspace) -> DataFrame:
    filings = _with_missing_keys(ws)
    rules = {"latest": latest.latest_filings(filings), "with accounts": latest.latest_with_accounts(filings)}
    parts = [latest.whole(df).select(F.lit(rule).alias("rule"), *sections.header()) for rule, df in rules.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("inntektsaar", F.col("inntektsaar").cast("string"))


def _derive_of_missing_keys(ws: Workspace) -> DataFrame:
    kept = latest.latest_filings(_with_missing_keys(ws))
    keys = objects.derive(kept, "fordeltBeregnetNaeringsinntekt").select("orgnr", F.lit(None).cast("double").alias("sum"))
    sums = objects.derive(kept, "sum_resultatregnskap").select("orgnr", F.col("O_15799").alias("sum"))
    return keys.withColumn("objekt", F.lit("keys")).unionByName(sums.withColumn("objekt", F.lit("sums")))


def _partitioned_sections(ws: Workspace) -> DataFrame:
    path = scratch_path(ws.spark, "sections")
    pipeline.store_all_sections(ws.latest(), path)
    return (
        ws.spark.read.parquet(path)
        .groupBy("section")
        .agg(F.count("*").alias("n_rows"), sum_amount(F.col("beloep")).alias("total"))
    )


def _view_prefix_sum(ws: Workspace) -> DataFrame:
    ws.long()
    view = filtered_view(ws.spark, ws.path("long"), "ledgerlift_long_of_filer", "norskIdentifikator", FILER)
    drop_view(ws.spark, "ledgerlift_long_of_filer")
    return view.where(layouts.is_field("p3")).agg(sum_amount(number(F.col("felt_verdi"))).alias("total"))


def _subtree_prefix_sum(ws: Workspace) -> DataFrame:
    folder = "/".join(f"{column}={value}" for column, value in OPERATING_INCOME.items())
    return layouts.long_prefix_sum(scan_tree(ws.spark, f"{ws.long_partitioned()}/{folder}"), "p3")


def _partitioned(ws: Workspace) -> DataFrame:
    return scan_partitions(ws.spark, ws.long_partitioned(), **OPERATING_INCOME)


def _wide_operating_income(ws: Workspace) -> DataFrame:
    return layouts.read_wide_themes(ws.spark, ws.wide_themes(), ("salgsinntekt", "annenDriftsinntekt"))


def _wide_to_long(ws: Workspace) -> DataFrame:
    root = ws.wide_themes()
    return layouts.wide_to_long({g: scan(ws.spark, layouts.theme_path(root, g)) for g in orders.LISTS})


def _statistics(ws: Workspace, name: str) -> DataFrame:
    return _rounded(pipeline.statistics(ws.derived(name), name))


def _rounded(statistics: DataFrame, digits: int = 4) -> DataFrame:
    if "mean" not in statistics.columns:
        return statistics
    fine = {c: F.round(c, digits) for c in ("mean", "q25", "q50", "q75")}
    return statistics.withColumns(fine | {"std": F.round("std", 2)})


def _describe_line_rates(ws: Workspace) -> DataFrame:
    lines = ws.spark.read.parquet(f"{ws.sf_dir}/lineitem.parquet")
    rates = lines.selectExpr("l_extendedprice * l_tax as tax", "-l_extendedprice / l_quantity as price", "l_discount / 3 as third")
    return _rounded(quality.describe(rates), 6)


def _balance(ws: Workspace) -> DataFrame:
    return objects.derive(ws.latest(), "sum_balanseregnskap")


def build() -> dict[str, Query]:
    named: dict[str, Query] = {
        "ingest_json_events": _ingest_events,
        "event_time_millis": _event_times,
        "ingest_filings": _on(_ingest_filings),
        "latest_filing": _on(lambda ws: _headers(ws.latest())),
        "latest_filing_with_accounts": _on(lambda ws: _headers(latest.latest_with_accounts(ws.filings()))),
        "latest_after_explode": _on(
            lambda ws: _account_headers(ws.filings())
        ),
        "latest_accounts_all": _on(
            lambda ws: _account_headers(ws.filings(), per_account=True)
        ),
    }
    for name in SECTIONS:
        key = f"section_{name.replace('-', '_')}"
        named[key] = _on(lambda ws, name=name: sections.section(ws.latest(), name))
    named |= {
        "section_row_counts": _on(lambda ws: sections.section_row_counts(ws.latest())),
        "all_sections": _on(lambda ws: sections.all_sections(ws.latest())),
        "partitioned_sections": _on(_partitioned_sections),
        "relink_subset": _on(
            lambda ws: sections.relink(
                sections.section(ws.latest(), "driftsinntekt"), sections.section(ws.latest(), "naering")
            )
        ),
        "empty_delivery": _on(_empty_delivery),
        "named_scan": _on(_named_scan),
        "strict_prefix_total": _on(_strict_sum),
        "latest_of_missing_keys": _on(_latest_of_missing_keys),
        "derive_of_missing_keys": _on(_derive_of_missing_keys),
        "relink_bucketed": _on(lambda ws: sections.relink_stored(sections.section(ws.latest(), "driftsinntekt"), ws.headers())),
        "stored_section_counts": _on(_stored_section_counts),
        "derived_together": _on(_derived_together),
        "code_dictionary": _on(lambda ws: ws.codes().drop("version")),
        "wide_against_long": _on(_wide_against_long),
        "forestry_accounts": _on(lambda ws: forestry.accounts(ws.filings())),
        "forestry_fund": _on(lambda ws: forestry.fund(ws.filings())),
        "forestry_fund_per_account": _on(lambda ws: forestry.fund(ws.filings(), per_account=True)),
        "forestry_open_accounts": _on(lambda ws: forestry.accounts(ws.open_snapshot())),
        "forestry_open_fund": _on(lambda ws: forestry.fund(ws.open_snapshot(), per_account=True)),
        "forestry_accounts_ordered": _on(
            lambda ws: with_position(forestry.accounts(ws.filings(), ordered=False), forestry.ACCOUNT_ORDER)
        ),
        "forestry_fund_ordered": _on(
            lambda ws: with_position(
                forestry.fund(ws.filings(), per_account=True, ordered=False), [*forestry.FUND_ORDER, "id", "beloep"]
            )
        ),
        "snapshot_undeclared": _on(_snapshot_undeclared),
    }
    for name in OBJECTS:
        named[f"derive_{name}"] = _on(lambda ws, name=name: objects.derive(ws.latest(), name))
        named[f"describe_{name}"] = _on(lambda ws, name=name: _statistics(ws, name))
    named |= {
        "describe_line_rates": _on(_describe_line_rates),
        "operating_result": _on(
            lambda ws: objects.derive(ws.latest(), "sum_resultatregnskap").select("orgnr", "O_15799", "O_7286", "O_6686")
        ),
        "balance_control": _on(lambda ws: quality.by_control(_balance(ws)).select("orgnr", "kontroll")),
        "balance_control_topk": _on(lambda ws: quality.by_control(_balance(ws), top=50).select("orgnr", "kontroll")),
        "first_100": _on(lambda ws: quality.first_rows(objects.derive(ws.latest(), "spesifikasjonAvVarelager"))),
        "long_layout": _on(lambda ws: ws.long().select(*layouts.LONG)),
        "wide_layout": _on(lambda ws: ws.wide()),
        "wide_to_long": _on(_wide_to_long),
        "long_prefix_sum": _on(lambda ws: layouts.long_prefix_sum(ws.long(), "p3", FILER)),
        "long_prefix_total": _on(lambda ws: layouts.long_prefix_sum(ws.long(), "p3")),
        "partitioned_prefix_sum": _on(lambda ws: layouts.long_prefix_sum(_partitioned(ws), "p3", FILER)),
        "partitioned_prefix_total": _on(lambda ws: layouts.long_prefix_sum(_partitioned(ws), "p3")),
        "subtree_prefix_total": _on(_subtree_prefix_sum),
        "view_prefix_sum": _on(_view_prefix_sum),
        "wide_prefix_sum": _on(lambda ws: layouts.wide_prefix_sum(ws.wide(), "p3", FILER)),
        "wide_prefix_total": _on(lambda ws: layouts.wide_prefix_sum(ws.wide(), "p3")),
        "partitioned_wide_prefix_sum": _on(lambda ws: layouts.wide_prefix_sum(_wide_operating_income(ws), "p3", FILER)),
        "partitioned_wide_prefix_total": _on(lambda ws: layouts.wide_prefix_sum(_wide_operating_income(ws), "p3")),
        "pipeline_roundtrip": _on(_pipeline_roundtrip),
    }
    return named

