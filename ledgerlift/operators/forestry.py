"""Forestry accounts and their funds: two list levels to (felt, beloep) rows.

The amounts of an account, and of an entry of its fund, go by names that change from year to year and may
stand inside further structs. Accounts are VARIANT objects, so whatever a record holds becomes rows: no list
of names, and no look at the delivery beforehand.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.variants import amounts_sql, list_of, text_of
from ledgerlift.operators.latest import ACCOUNTS, FILER, SEQUENCE, TIME, YEAR, latest_account, latest_with_accounts
from ledgerlift.operators.sections import has_amount
from ledgerlift.operators.sinks import COMPRESSION
from ledgerlift.session import scratch_path, writing

HEADER = ["norskIdentifikator", "inntektsaar", "registreringstidspunkt", "sekvensnummer"]
ACCOUNT_ORDER = ["norskIdentifikator", "inntektsaar", "id", "felt"]
FUND_ORDER = ["norskIdentifikator", "inntektsaar", "skogOgToemmerkontoId", "kommunenummer", "felt"]


def amounts_to_rows(df: DataFrame, record: str, without: Collection[str]) -> DataFrame:
    """Every amount of a VARIANT record as a (felt, beloep) row; empty and zero amounts are left out."""
    rest = [c for c in df.columns if c != record]
    rows = df.select(*rest, F.inline(F.expr(amounts_sql(record, without))).alias("felt", "beloep"))
    return rows.where(has_amount())


def accounts(filings: DataFrame, ordered: bool = True, at: str | None = None) -> DataFrame:
    """Amounts of the forestry accounts of the last registration that has any; ordered ones are stored first (``at``)."""
    rows = latest_with_accounts(filings).select(
        F.col(FILER).alias("norskIdentifikator"),
        F.col(YEAR).cast("bigint").alias("inntektsaar"),
        F.col(TIME).alias("registreringstidspunkt"),
        F.col(SEQUENCE).alias("sekvensnummer"),
        F.explode(ACCOUNTS).alias("account"),
    )
    ids = [text_of(F.col("account"), name).alias(name) for name in ("id", "driftsenhet")]
    out = amounts_to_rows(rows.select(*HEADER, *ids, "account"), "account", ("id", "driftsenhet", "skogfond"))
    return _in_order(out, at, *ACCOUNT_ORDER) if ordered else out


def fund(filings: DataFrame, per_account: bool = False, ordered: bool = True, at: str | None = None) -> DataFrame:
    """Amounts of the forestry fund, of one account per filer and year or of all; ordered ones are stored first (``at``)."""
    rows = latest_account(filings, per_account).select(
        *HEADER,
        text_of(F.col("account"), "id").alias("skogOgToemmerkontoId"),
        F.col("fragment").alias("_fragment"),
        F.posexplode(list_of(F.col("account"), "skogfond")).alias("_place", "entry"),
    )
    place = ["_fragment", "_place"]
    ids = [text_of(F.col("entry"), name).alias(name) for name in ("id", "kommunenummer")]
    rows = rows.select(*HEADER, "skogOgToemmerkontoId", *ids, *place, "entry")
    out = amounts_to_rows(rows, "entry", ("id", "kommunenummer"))
    if ordered:
        # the place in the filing makes the order total: an account with very many
        # equal entries is then sorted by several tasks
        out = _in_order(out, at, *FUND_ORDER, "id", *place)
    return out.drop(*place)


def _in_order(df: DataFrame, at: str | None, *columns: str) -> DataFrame:
    """Rows in a total order. The ranges of the sort are found by a pass of its own, so the rows are made once and stored."""
    spark = df.sparkSession
    path = at or scratch_path(spark, "unordered")
    with writing(spark):
        df.write.options(**COMPRESSION).parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in columns])
