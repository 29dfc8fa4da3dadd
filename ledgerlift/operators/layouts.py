"""The same posts stored long, long in theme partitions, wide, and wide per theme."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.functions.amounts import major_sql, number, sum_amount, sum_sql, to_minor
from ledgerlift.operators.latest import FILER
from ledgerlift.operators.sections import branch_sql, has_amount
from ledgerlift.operators.sinks import run_all
from ledgerlift.plans.catalog import POST_LISTS, list_codes
from ledgerlift.sources.tables import scan

THEMES = ("hovedtema", "undertema", "gruppe")
MOST_FIELDS = 5_000
LONG = ("norskIdentifikator", "felt_id", "felt_verdi", *THEMES)


def long_layout(latest: DataFrame) -> DataFrame:
    """One row per post: filer, ``p`` and post code, amount as text, and themes."""
    lists = [
        f"named_struct('hovedtema', '{spec.hovedtema}', 'undertema', '{spec.undertema}', 'gruppe', '{name}', "
        f"'posts', {branch_sql(name)})"
        for name, spec in POST_LISTS.items()
    ]
    rows = latest.select(
        F.col(FILER).alias("norskIdentifikator"), F.expr(f"explode(array({', '.join(lists)}))").alias("t")
    )
    rows = rows.select(
        "norskIdentifikator", *[F.col(f"t.{c}").alias(c) for c in THEMES], F.inline("t.posts").alias("type", "beloep")
    )
    return rows.where(has_amount()).select(
        "norskIdentifikator",
        F.concat(F.lit("p"), F.col("type")).alias("felt_id"),
        F.col("beloep").cast("string").alias("felt_verdi"),
        *THEMES,
    )


def code_dictionary(long: DataFrame) -> DataFrame:
    """The fields that occur, with their themes and number of rows: one row each, however long the table is."""
    return long.groupBy(*THEMES, "felt_id").agg(F.count("*").alias("n_rows"))


def codes_path(root: str, version: str) -> str:
    return f"{root}/version={version}"


def write_codes(long: DataFrame, root: str, version: str) -> None:
    """Store the dictionary of a table under a version, so that wide tables made later have the columns of that time."""
    code_dictionary(long).coalesce(1).write.mode("errorifexists").parquet(codes_path(root, version))


def read_codes(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The dictionary of a version; the last one, in the order of their names, when none is given."""
    codes = spark.read.option("basePath", root).schema(f"{', '.join(f'{c} string' for c in (*THEMES, 'felt_id'))}, n_rows long, version string")
    codes = codes.parquet(root)
    wanted = version or codes.agg(F.max("version")).first()[0]
    return codes.where(F.col("version") == wanted)


def fields_in(codes: DataFrame, gruppe: str | None = None, most: int = MOST_FIELDS) -> list[str]:
    """The columns of a wide table: the form's fields first, then whatever else occurs, in order.

    Columns are part of the plan, so they come to the driver; more than ``most`` are no form's codes and stop the run.
    """
    groups = [gruppe] if gruppe else list(POST_LISTS)
    found = codes.where(F.col("gruppe").isin(*groups) & F.col("felt_id").isNotNull()).select("felt_id").distinct()
    occurring = sorted(r["felt_id"] for r in found.limit(most + 1).collect())
    if len(occurring) > most:
        raise ValueError(f"more than {most} fields occur: this table is not made of post codes")
    known = fields_of(code for g in groups for code in list_codes(g))
    return list(dict.fromkeys([*known, *occurring]))


def wide_layout(long: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per filer and one column per field; texts that are no number count as missing.

    ``fields`` is the full list of columns. Sums are conditional, one for each field, so rows are added up
    before they are shuffled, and shuffled once: a filer with a third of all rows sends one row a task.
    """
    place = F.broadcast(long.sparkSession.range(1).select(F.posexplode(F.lit(list(fields))).alias("_place", "felt_id")))
    cents = long.select("norskIdentifikator", "felt_id", to_minor(number(F.col("felt_verdi"))).alias("_v"))
    cents = cents.join(place, "felt_id", "left")  # as many rows as the wide table has columns
    sums = [F.expr(f"sum(case when _place = {k} then _v end) as `{f}`") for k, f in enumerate(fields)]
    wide = cents.groupBy("norskIdentifikator").agg(*sums)
    return wide.selectExpr("norskIdentifikator", *[f"{major_sql(f'`{f}`')} as `{f}`" for f in fields])


def theme_fields(gruppe: str, extra: Iterable[str] = ()) -> list[str]:
    return [f"p{code}" for code in dict.fromkeys([*list_codes(gruppe), *extra])]


def wide_theme(long: DataFrame, gruppe: str, extra: Iterable[str] = ()) -> DataFrame:
    """The wide columns of one theme group, for the filers that have any."""
    return wide_layout(long.where(F.col("gruppe") == gruppe), theme_fields(gruppe, extra))


def wide_to_long(themes: Mapping[str, DataFrame]) -> DataFrame:
    """Wide theme subsets back to one row per filer, field and theme."""
    parts = []
    for gruppe, wide in themes.items():
        spec = POST_LISTS[gruppe]
        fields = [c for c in wide.columns if c != "norskIdentifikator"]
        rows = wide.unpivot(["norskIdentifikator"], fields, "felt_id", "beloep").where(F.col("beloep").isNotNull())
        parts.append(
            rows.select(
                "norskIdentifikator",
                "felt_id",
                "beloep",
                F.lit(spec.hovedtema).alias("hovedtema"),
                F.lit(spec.undertema).alias("undertema"),
                F.lit(gruppe).alias("gruppe"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _of(df: DataFrame, filer: str | None) -> DataFrame:
    return df if filer is None else df.where(F.col("norskIdentifikator") == filer)


def wide_prefix_sum(wide: DataFrame, prefix: str, filer: str | None = None) -> DataFrame:
    """Sum of every column whose name starts with ``prefix``."""
    fields = [c for c in wide.columns if c.startswith(prefix)]
    return _of(wide, filer).agg(*[F.expr(f"{sum_sql(f'`{c}`')} as `{c}`") for c in fields])


def long_prefix_sum(long: DataFrame, prefix: str, filer: str | None = None, strict: bool = False) -> DataFrame:
    """Sum of the fields whose name starts with ``prefix``.

    ``strict`` raises on a text that is no number; otherwise it counts as missing.
    """
    rows = _of(long, filer).where(F.col("felt_id").startswith(prefix))
    return rows.agg(sum_amount(number(F.col("felt_verdi"), strict)).alias("total"))


# ------------------------------------------------------------------- storage
# Look-ups ask for one filer: rows are sorted by filer inside each file and the
# files carry bloom filters, so row groups without the filer are skipped.


def _for_lookup(df: DataFrame):
    return df.write.mode("errorifexists").option("parquet.bloom.filter.enabled#norskIdentifikator", "true")


def write_long(long: DataFrame, path: str) -> None:
    # rebalance: AQE splits what one filer makes too large and merges small partitions
    rows = long.hint("rebalance", "norskIdentifikator").sortWithinPartitions("norskIdentifikator", "felt_id")
    _for_lookup(rows).parquet(path)


def write_partitioned(long: DataFrame, path: str) -> None:
    """Theme folders. Rebalancing by theme keeps files few in small themes and
    spreads a theme that holds most of the rows over many tasks and files."""
    rows = long.hint("rebalance", *THEMES).sortWithinPartitions(*THEMES, "norskIdentifikator")
    _for_lookup(rows).partitionBy(*THEMES).parquet(path)


def write_wide(wide: DataFrame, path: str) -> None:
    # one row per filer, and the pivot has already spread the filers: only the order is missing
    _for_lookup(wide.sortWithinPartitions("norskIdentifikator")).parquet(path)


def theme_path(root: str, gruppe: str) -> str:
    spec = POST_LISTS[gruppe]
    return f"{root}/{spec.hovedtema}/{spec.undertema}/{gruppe}"


def write_wide_themes(long: DataFrame, root: str, groups: Mapping[str, Iterable[str]], at_once: int = 4) -> None:
    """Wide subsets in a theme directory tree; ``groups`` maps a group to codes beyond the form's."""
    writes = {
        gruppe: partial(write_wide, wide_theme(long, gruppe, extra), theme_path(root, gruppe))
        for gruppe, extra in groups.items()
    }
    run_all(writes, at_once)


def read_wide_themes(spark: SparkSession, root: str, groups: Iterable[str]) -> DataFrame:
    """Several wide subsets as one frame; columns a subset lacks are NULL."""
    return scan(spark, *[theme_path(root, g) for g in groups])


def fields_of(codes: Iterable[str]) -> list[str]:
    return [f"p{code}" for code in dict.fromkeys(codes)]


def is_field(prefix: str) -> Column:
    return F.col("felt_id").like(f"{prefix}%")
