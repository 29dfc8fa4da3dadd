"""Which registration of a filer and year counts.

Three rules with different results:

* ``latest_filings``: the last registration.
* ``latest_with_accounts``: the last registration *that has* forestry accounts,
  even when a later one has none.
* ``latest_account``: after the accounts became rows, the single last row.

Every delivered registration has a number of its own, ``hendelse.ordinal``. A
filing whose lists are too long for one record comes as several records with
that number and ``hendelse.fragment`` counting them; most have the fragment 0
alone. Ties on time go to the highest sequence number, then to the highest
ordinal, so one registration wins, and all its records survive.

There is one plan for short and long filings. Winners are chosen on the narrow
header, one row a record, where ``rank() = 1`` becomes a ``WindowGroupLimit`` on
both sides of the exchange: a filer and year that holds a large share of the
records sends few rows per map task. The records are then kept by (ordinal,
fragment), which no two records share. Ordinals that lie close together are
held as bits, some 0.2 bytes each, and while these are few enough to be sent to
every task the records are kept where they are read: their payloads are not
shuffled. More of them are joined; nothing is skewed, and the rows are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILER = "naeringsspesifikasjon.norskIdentifikator"
YEAR = "naeringsspesifikasjon.inntektsaar"
TIME = "hendelse.registreringstidspunkt"
SEQUENCE = "hendelse.sekvensnummer"
ORDINAL = "hendelse.ordinal"
FRAGMENT = "hendelse.fragment"
ACCOUNTS = "naeringsspesifikasjon.skogbruk.skogOgToemmerkonto"
NUMBERS = "naeringsspesifikasjon.skogbruk.kontonummer"

RECORD = ["_ordinal", "_fragment"]
WORDS = 8  # of 64 bits in a block of ordinals
MOST_BLOCKS = 250_000  # of some hundred bytes each, so at most a few tens of MB


def whole(filings: DataFrame) -> DataFrame:
    """One record per filing: fragment 0 carries the scalars."""
    return filings.where(F.col(FRAGMENT) == 0)


def _winners(candidates: DataFrame, *then: Column) -> DataFrame:
    """(_ordinal, _fragment, …): the records of the last registration per filer and year, by their headers.

    ``then`` are further columns, of which the least among the records of the registration wins too.
    """
    header = candidates.select(
        F.col(FILER).alias("_filer"),
        F.col(YEAR).alias("_year"),
        F.col(TIME).alias("_time"),
        F.col(SEQUENCE).alias("_sequence"),
        F.col(ORDINAL).alias("_ordinal"),
        F.col(FRAGMENT).alias("_fragment"),
        *then,
    )
    more = header.columns[6:]
    last = [F.desc("_time"), F.desc("_sequence"), F.desc("_ordinal"), *[F.asc(c) for c in more]]
    rank = F.rank().over(Window.partitionBy("_filer", "_year").orderBy(*last))
    return header.withColumn("_rank", rank).where("_rank = 1").select(*RECORD, *more)


def _blocks(winners: DataFrame) -> DataFrame:
    """(_block, _bits) by fragment: the ordinals as bits, one row for each block that has any, so never more rows than winners."""
    word = [F.expr(f"bit_or(case when shiftright(_ordinal, 6) & {WORDS - 1} = {k} then shiftleft(1L, cast(_ordinal & 63 as int)) else 0L end)") for k in range(WORDS)]
    known = winners.where("_ordinal is not null and _fragment is not null")
    return known.groupBy(_block_of("_ordinal").alias("_block"), F.col("_fragment")).agg(F.array(*word).alias("_bits"))


def _block_of(ordinal: str) -> Column:
    return F.expr(f"shiftright({ordinal}, {6 + WORDS.bit_length() - 1})")  # rounds down, also below zero


def _keep(candidates: DataFrame, winners: DataFrame, how: str = "left_semi", most_blocks: int = MOST_BLOCKS) -> DataFrame:
    # the join keys are columns of their own: nested fields in a join condition hinder pruning
    keyed = candidates.withColumns(dict(zip(RECORD, map(F.col, (ORDINAL, FRAGMENT)))))
    blocks = _blocks(winners) if how == "left_semi" else None
    if blocks is None or blocks.count() > most_blocks:
        return keyed.join(winners, RECORD, how).drop(*RECORD)
    held = keyed.withColumn("_block", _block_of("_ordinal")).join(F.broadcast(blocks), ["_block", "_fragment"])
    bit = F.expr(f"getbit(get(_bits, cast(shiftright(_ordinal, 6) & {WORDS - 1} as int)), cast(_ordinal & 63 as int)) = 1")
    return held.where(bit).select(*candidates.columns)


def latest_filings(filings: DataFrame) -> DataFrame:
    """Last registration per filer and year; filings without filer or year are dropped first."""
    candidates = filings.where(F.col(FILER).isNotNull() & F.col(YEAR).isNotNull())
    return _keep(candidates, _winners(candidates))


def latest_with_accounts(filings: DataFrame) -> DataFrame:
    """Last registration that has forestry accounts. A missing filer or year counts as a value."""
    candidates = filings.where(F.size(ACCOUNTS) > 0)
    return _keep(candidates, _winners(candidates))


def _number(place: str) -> str:
    """Number of the account at a place of the list: the one delivered with it, else its place."""
    return f"coalesce(get({NUMBERS}, {place}), cast({place} as bigint))"


def latest_account(filings: DataFrame, per_account: bool = False) -> DataFrame:
    """Forestry accounts as rows ``(header…, ordinal, fragment, number, account)``, the last one per filer and year.

    The lowest id counts among the accounts of a registration, then the lowest number. It is found inside
    each record, so one row a record is shuffled, whatever its accounts hold. An account that is spread over
    the records of a long filing gives a row for each of its pieces.

    ``per_account=True`` keeps every account of the last registration instead.
    """
    header = [
        F.col(FILER).alias("norskIdentifikator"),
        F.col(YEAR).cast("bigint").alias("inntektsaar"),
        F.col(TIME).alias("registreringstidspunkt"),
        F.col(SEQUENCE).alias("sekvensnummer"),
        F.col(ORDINAL).alias("ordinal"),
        F.col(FRAGMENT).alias("fragment"),
    ]
    candidates = filings.where(F.size(ACCOUNTS) > 0)
    if per_account:
        numbered = f"transform({ACCOUNTS}, (a, i) -> named_struct('number', {_number('i')}, 'account', a))"
        return _keep(candidates, _winners(candidates)).select(*header, F.inline(F.expr(numbered)).alias("number", "account"))
    ids = f"transform({ACCOUNTS}, a -> variant_get(a, '$.id', 'string'))"
    keys = f"transform({ids}, (id, i) -> named_struct('missing', id is null, 'id', id, 'number', {_number('i')}))"
    rows = _keep(candidates, _winners(candidates, F.expr(f"array_min({keys})").alias("_first")), "inner")
    account = F.expr(f"element_at(filter({ACCOUNTS}, (a, i) -> {_number('i')} = _first.number), 1)")
    return rows.select(*header, F.col("_first.number").alias("number"), account.alias("account"))
