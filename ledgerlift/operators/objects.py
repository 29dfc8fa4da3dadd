"""Form variables per organisation, derived from the latest filings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.amounts import DECIMALS, major_sql, sum_sql, to_minor
from ledgerlift.functions.blanks import fill_blanks
from ledgerlift.operators.latest import whole
from ledgerlift.plans.catalog import (
    ACCOUNTING_DUTIES,
    AMOUNT_VARIABLES,
    BUSINESS_TYPES,
    DATE_VARIABLES,
    INVENTORY_AMOUNTS,
    KEY_OBJECTS,
    POST_LISTS,
    POST_VARIABLES,
    SUMS,
    object_list,
)

BODY = "naeringsspesifikasjon"
BUSINESS = ("orgnr", "virksomhetstype", "regnskapspliktstype")


def _business() -> list[Column]:
    return [F.col(f"{BODY}.virksomhet.{name}").alias(name) for name in BUSINESS]


def object_frame(latest: DataFrame, name: str) -> DataFrame:
    """The rows an object is derived from: business columns and its own content."""
    if name in POST_VARIABLES:
        path = POST_LISTS[object_list(name)].path
        rows = latest.select(*_business(), F.col(f"{BODY}.{path}").alias("posts"))
        return rows.select(*BUSINESS, F.inline("posts").alias("type", "beloep"))
    latest = whole(latest)
    if name in AMOUNT_VARIABLES:
        used = {a for pair in AMOUNT_VARIABLES[name].values() for a in pair if a}
        paths = SUMS if used <= SUMS.keys() else {a: f"spesifikasjonAvVarelager.{a}" for a in INVENTORY_AMOUNTS}
        return latest.select(*_business(), *[F.col(f"{BODY}.{p}").alias(a) for a, p in paths.items() if a in used])
    if name in DATE_VARIABLES:
        dates = [F.col(f"{BODY}.virksomhet.{d}").alias(d) for d in DATE_VARIABLES[name].values()]
        return latest.select(*_business(), *dates)
    if name in KEY_OBJECTS:
        return latest.select(*_business())
    raise KeyError(name)


def of_business(rows: DataFrame) -> DataFrame:
    """Business types the form is for, with no or limited accounting duty."""
    return rows.where(
        F.col("virksomhetstype").isin(*BUSINESS_TYPES) & F.col("regnskapspliktstype").isin(*ACCOUNTING_DUTIES)
    )


def derive(latest: DataFrame, name: str, decimals: int | None = DECIMALS) -> DataFrame:
    """One object: ``orgnr`` and the sums of its form variables.

    An organisation without ``orgnr`` is left out of the sums; one whose posts
    all have unknown codes stays, with zeros.
    """
    blanks = ("number", "bool", "string") if name == "fordeltBeregnetNaeringsinntekt" else ("number", "bool")
    rows = fill_blanks(of_business(object_frame(latest, name)), blanks)
    if name in DATE_VARIABLES:
        return rows.select("orgnr", *[F.col(d).alias(v) for v, d in DATE_VARIABLES[name].items()])
    rows = rows.where(F.col("orgnr").isNotNull())
    if name in KEY_OBJECTS:
        return rows.select("orgnr").distinct()
    if name in AMOUNT_VARIABLES:
        sums = {
            v: sum_sql(f"{a} - {minus}" if minus else a, decimals) for v, (a, minus) in AMOUNT_VARIABLES[name].items()
        }
    else:
        amount = F.col("beloep") if decimals is None else to_minor(F.col("beloep"), decimals)
        rows = rows.select("orgnr", "type", amount.alias("amount"))
        sums = {
            v: major_sql(f"sum(case when type in ({_quoted(codes)}) then amount else 0 end)", decimals)
            for v, codes in POST_VARIABLES[name].items()
        }
    return rows.groupBy("orgnr").agg(*[F.expr(f"{total} as {v}") for v, total in sums.items()])


SUMMED = (*POST_VARIABLES, *AMOUNT_VARIABLES)


def derive_together(latest: DataFrame, names: Sequence[str] = SUMMED, decimals: int = DECIMALS) -> DataFrame:
    """Several summed objects at once: one row per organisation, with ``<object>_n`` rows and the variables of each.

    One scan reads the lists of all objects, their posts are exploded side by side, and one exchange on
    ``orgnr`` moves partial sums. ``one_of`` takes a single object from the result.
    """
    parts, sums = [], []
    for name in names:
        number = len(parts)
        mine = f"_object = {number}"
        if name in POST_VARIABLES:
            parts.append(f"named_struct('object', {number}, 'posts', {BODY}.{POST_LISTS[object_list(name)].path})")
            wanted = {v: f"type in ({_quoted(codes)})" for v, codes in POST_VARIABLES[name].items()}
            counted = mine
        else:
            used = AMOUNT_VARIABLES[name]
            scalars = ", ".join(f"named_struct('type', '{v}', 'beloep', {_amount(a)} - {_amount(minus)})" for v, (a, minus) in used.items())
            # the scalars of a filing stand in its first record
            parts.append(f"named_struct('object', {number}, 'posts', if(hendelse.fragment = 0, array({scalars}), null))")
            wanted = {v: f"type = '{v}'" for v in used}
            counted = f"{mine} and type = '{next(iter(used))}'"
        sums.append(f"count_if({counted}) as `{name}_n`")
        sums += [f"{major_sql(f'sum(case when {mine} then case when {w} then amount else 0 end end)', decimals)} as `{name}_{v}`" for v, w in wanted.items()]
    rows = of_business(latest.select(*_business(), F.expr(f"array({', '.join(parts)})").alias("parts")))
    rows = rows.where(F.col("orgnr").isNotNull()).select("orgnr", F.explode("parts").alias("p"))
    rows = rows.select("orgnr", F.col("p.object").alias("_object"), F.inline("p.posts").alias("type", "beloep"))
    rows = rows.select("orgnr", "_object", "type", to_minor(F.coalesce("beloep", F.lit(0.0)), decimals).alias("amount"))
    return rows.groupBy("orgnr").agg(*[F.expr(total) for total in sums])


def one_of(together: DataFrame, name: str) -> DataFrame:
    """An object as ``derive`` gives it, from the row of all objects."""
    variables = POST_VARIABLES.get(name) or AMOUNT_VARIABLES[name]
    return together.where(F.col(f"{name}_n") > 0).select("orgnr", *[F.col(f"{name}_{v}").alias(v) for v in variables])


def _amount(name: str | None) -> str:
    if name is None:
        return "0.0D"
    return f"coalesce({BODY}.{SUMS.get(name, f'spesifikasjonAvVarelager.{name}')}, 0.0D)"


def _quoted(codes: tuple[str, ...]) -> str:
    return ", ".join(f"'{code}'" for code in codes)
