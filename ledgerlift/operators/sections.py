"""Sections: nested lists of posts and scalar sums to narrow (felt, beloep) rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.operators.latest import FILER, SEQUENCE, TIME, YEAR
from ledgerlift.plans.catalog import MAIN, POST_LISTS, SECTIONS, SUMS

BODY = "naeringsspesifikasjon"
MAIN_DDL = "inntektsaar bigint, id string, felt string, beloep double, registreringstidspunkt timestamp, sekvensnummer bigint"


def branch_sql(name: str) -> str:
    """A branch as a list of posts, in SQL. A scalar sum is a list of one."""
    if name in POST_LISTS:
        return f"{BODY}.{POST_LISTS[name].path}"
    return f"array(named_struct('type', '{name}', 'beloep', {BODY}.{SUMS[name]}))"


def header() -> list[Column]:
    return [
        F.col(YEAR).cast("bigint").alias("inntektsaar"),
        F.col(FILER).alias("id"),
        F.col(TIME).alias("registreringstidspunkt"),
        F.col(SEQUENCE).alias("sekvensnummer"),
    ]


def has_amount(column: str = "beloep") -> Column:
    """Present and not zero."""
    return F.col(column).isNotNull() & (F.col(column) != 0.0)


def posts(latest: DataFrame, branches: Iterable[str]) -> DataFrame:
    """All posts of the branches in one scan, without a union.

    The branches are exploded first and their posts second, so a branch that a
    filing does not have gives no rows and takes no other branch with it.
    """
    lists = [branch_sql(name) for name in branches]
    one_or_all = lists[0] if len(lists) == 1 else f"explode(array({', '.join(lists)}))"
    rows = latest.select(*header(), F.expr(one_or_all).alias("posts"))
    names = [c for c in rows.columns if c != "posts"]
    return rows.select(*names, F.inline("posts").alias("felt", "beloep"))


def section(latest: DataFrame, name: str) -> DataFrame:
    """One section of the catalog, from filings that are already the latest."""
    spec = SECTIONS[name]
    return posts(latest, spec.branches).where(has_amount()).select(*spec.columns)


def all_sections(latest: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Every section in one scan, tagged with its name."""
    names = list(SECTIONS) if names is None else list(names)
    members: dict[str, list[str]] = {}
    for name in names:
        for part in SECTIONS[name].branches:
            members.setdefault(part, []).append(name)
    tagged = [
        f"named_struct('sections', array({', '.join(repr(s) for s in sections)}), 'posts', {branch_sql(part)})"
        for part, sections in members.items()
    ]
    rows = latest.select(*header(), F.expr(f"explode(array({', '.join(tagged)}))").alias("b"))
    keys = ["inntektsaar", "id", "registreringstidspunkt", "sekvensnummer"]
    rows = rows.select(*keys, "b.sections", F.inline("b.posts").alias("felt", "beloep")).where(has_amount())
    return rows.select(F.explode("sections").alias("section"), *MAIN)


def section_row_counts(latest: DataFrame) -> DataFrame:
    return all_sections(latest).groupBy("section").agg(F.count("*").alias("n_rows"))


def relink(subset: DataFrame, main: DataFrame) -> DataFrame:
    """A theme subset with filer, year and time back from its main table."""
    return subset.join(_headers(main), "sekvensnummer").select(*MAIN)


def _headers(main: DataFrame) -> DataFrame:
    return main.select("sekvensnummer", "inntektsaar", "id", "registreringstidspunkt").distinct()


def store_headers(main: DataFrame, table: str, path: str, buckets: int | None = None) -> None:
    """The registrations of a main table, once each, as a table bucketed and sorted by sequence number.

    Posts are reduced to registrations before they are shuffled, here and once; every subset linked later
    finds the main side in place.
    """
    spark = main.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _headers(main).repartition(buckets, "sekvensnummer")
    writer = rows.write.mode("overwrite").bucketBy(buckets, "sekvensnummer").sortBy("sekvensnummer")
    writer.option("path", path).saveAsTable(table)


def relink_stored(subset: DataFrame, table: str) -> DataFrame:
    """``relink`` against the stored registrations: only the subset is shuffled."""
    return subset.join(subset.sparkSession.table(table), "sekvensnummer").select(*MAIN)
