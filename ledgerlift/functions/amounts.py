"""Sums of money that do not depend on the order of the rows.

A double sum changes in its last digits with partitioning and task retries.
Amounts are kroner and øre, so they are added as whole øre in a bigint and
turned back into kroner once at the end. That is exact, keeps the aggregation
buffer fixed-width, and under ANSI an overflow raises instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMALS = 2


def to_minor(amount: Column, decimals: int = DECIMALS) -> Column:
    """Amount in whole minor units (øre)."""
    return F.rint(amount * F.lit(float(10**decimals))).cast("bigint")


def to_major(minor: Column, decimals: int = DECIMALS) -> Column:
    """Minor units back to an amount."""
    return minor / F.lit(float(10**decimals))


def sum_amount(amount: Column, decimals: int | None = DECIMALS) -> Column:
    """Sum of amounts; ``decimals=None`` adds the doubles as they are."""
    if decimals is None:
        return F.sum(amount)
    return to_major(F.sum(to_minor(amount, decimals)), decimals)


def sum_sql(amount: str, decimals: int | None = DECIMALS) -> str:
    """``sum_amount`` as SQL text, for wide selects where building columns one by one is slow."""
    if decimals is None:
        return f"sum({amount})"
    return major_sql(f"sum(cast(rint(({amount}) * {10**decimals}.0D) as bigint))", decimals)


def major_sql(minor: str, decimals: int | None = DECIMALS) -> str:
    return minor if decimals is None else f"{minor} / {10**decimals}.0D"


def number(text: Column, strict: bool = False) -> Column:
    """Number in a text; anything else is NULL, or an error when ``strict``."""
    return text.cast("double") if strict else text.try_cast("double")
