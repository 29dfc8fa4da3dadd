"""Records whose names are not declared: VARIANT objects read by what they hold."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

_IS_OBJECT = "startswith(schema_of_variant({0}.value), 'OBJECT')"


def text_of(record: Column, name: str) -> Column:
    """A field of an object as text; NULL where it is missing or null."""
    return F.variant_get(record, f"$.{name}", "string")


def list_of(record: Column, name: str) -> Column:
    """A field of an object as a list of records."""
    return F.variant_get(record, f"$.{name}", "array<variant>")


def _fields(record: str, lambda_name: str, without: Collection[str]) -> str:
    """The fields of an object as (key, value) structs."""
    names = ", ".join(f"'{name}'" for name in without)
    return f"filter(map_entries(cast({record} as map<string, variant>)), {lambda_name} -> {lambda_name}.key not in ({names}))"


def leaves_sql(record: str, without: Collection[str]) -> str:
    """The fields of an object as (key, value) structs, with objects replaced by their own fields at every depth.

    Fields named in ``without`` are left out wherever they stand. Lists stay lists. An object inside an
    object opens with one more turn, and the braces in the text of the first ones bound the turns.
    """
    is_object = _IS_OBJECT.format("o")
    braces = f"aggregate(filter(top, o -> {is_object}), 0, (n, o) -> n + regexp_count(cast(o.value as string), '[{{]'))"
    opened = f"flatten(transform(acc, o -> if({is_object}, {_fields('o.value', 'g', without)}, array(o))))"
    # a list of one gives the first fields a name, so that they are read once
    once = f"transform(array({_fields(record, 'f', without)}), top -> aggregate(array_repeat(0, {braces}), top, (acc, turn) -> {opened}))"
    return f"element_at({once}, 1)"


def amounts_sql(record: str, without: Collection[str]) -> str:
    """Every field but ``without`` as ``(felt, beloep)`` structs; a field that is no number stops the run."""
    return f"transform({leaves_sql(record, without)}, l -> named_struct('felt', l.key, 'beloep', variant_get(l.value, '$', 'double')))"
