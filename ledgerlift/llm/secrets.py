"""Secrets in texts: fixed patterns, and tokens that look random to character Markov models.

Two first-order character models are trained on labelled samples: random strings (the values that the fixed
patterns find, and base64 digests of document ids) and ordinary identifiers (the long tokens of labelled
documents of good quality). A token of `least_chars` or more with a letter and a digit, or both cases, is a
secret when its log-likelihood ratio per transition exceeds `threshold`. All of it is DataFrame functions.

Defined cases
    * A null text counts as empty and has no spans. Positions are code points, the end exclusive.
    * Matches of a kind are leftmost and do not overlap; those of different kinds may. A model span is not given
      for a token that holds a hex or access match; it may lie in an assign match, whose value then looks random.
    * Repeated rows are judged alike; an empty table gives none. Without labels the ordinary model is uniform.
    * `find` returns the key and its measures only, so other columns cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns that the output is defined by.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "model")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
N = len(ALPHABET)
TOKEN = r"[A-Za-z0-9+/_-]{%d,}"


def spans(text: Column, pattern: str, kind: int, keep_group: int = 0, least: int = 0) -> Column:
    """array<struct<start, kind, end, value>>: the pattern's matches; the pieces between them give the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(keep_group))
    between = F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    lengths = F.transform(found, lambda m: F.length(m))
    # Starts from running sums: each piece, then its match.
    steps = F.zip_with(F.slice(F.transform(between, lambda b: F.length(b)), 1, F.size(found)), lengths, lambda b, m: F.struct(b.alias("b"), m.alias("m")))
    starts = F.aggregate(
        steps,
        zero,
        lambda s, x: F.struct((s["at"] + x["b"] + x["m"]).alias("at"), F.array_append(s["starts"], s["at"] + x["b"]).alias("starts")),
        lambda s: s["starts"],
    )
    rows = F.zip_with(F.arrays_zip(starts.alias("s"), lengths.alias("l")), values, lambda p, v: F.struct(
        p["s"].alias("start"), F.lit(kind).alias("kind"), (p["s"] + p["l"]).alias("end"), v.alias("value")))
    rows = F.filter(rows, lambda r: F.length(r["value"]) >= least)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    return {"s_assign": spans(text, ASSIGN, 0, 2, 6), "s_access": spans(text, ACCESS, 1), "s_hex": spans(text, HEX, 2)}


def steps_of(token: Column) -> Column:
    """The transitions of a token as numbers: N * place of a character + place of the next."""
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    n = F.length(token) - 1
    return F.zip_with(F.slice(places, 1, n), F.slice(places, 2, n), lambda a, b: a * N + b)


def samples(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", rows: int = 20_000) -> DataFrame:
    """(random, token): labelled strings, from at most `rows` labelled documents, those whose ids hash lowest."""
    chosen = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("quality").alias("good"))
    chosen = chosen.orderBy(F.xxhash64(key), key).limit(rows).select(F.col(key).alias("its"), "good")
    texts = docs.select(F.col(key).alias("its"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(chosen, "its")
    values = [F.transform(c, lambda r: r["value"]) for c in base_spans(F.col("t")).values()]
    plain = F.regexp_replace(F.regexp_replace(F.col("t"), ASSIGN, " "), ACCESS + "|" + HEX, " ")
    digest = F.rtrim(F.base64(F.unhex(F.sha2(F.col("its").cast("string"), 256))), F.lit("="))
    random = texts.select(F.lit(True).alias("random"), F.explode(F.concat(F.array(digest), *values)).alias("token"))
    names = texts.where("good = 1").select(F.lit(False).alias("random"), F.explode(F.regexp_extract_all(plain, F.lit(TOKEN % 8), F.lit(0))).alias("token"))
    kept = F.regexp_replace("token", "[^A-Za-z0-9+/_-]", "")
    return random.unionAll(names).select("random", kept.alias("token")).where(F.length("token") >= 8)


def train(sample: DataFrame) -> list[float]:
    """Log-likelihood ratio of each transition, random over ordinary; N * N numbers, whatever the sample's size."""
    steps = sample.select("random", F.explode(steps_of(F.col("token"))).alias("step"))
    counts = {(r["random"], r["step"]): r["count"] for r in steps.groupBy("random", "step").count().collect()}

    def log_p(kind: bool, a: int) -> list[float]:
        row = [counts.get((kind, a * N + b), 0) + 0.5 for b in range(N)]
        return [math.log(x / sum(row)) for x in row]

    return [r - o for a in range(N) for r, o in zip(log_p(True, a), log_p(False, a))]


def ratio(token: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's transitions."""
    model = F.split(F.lit(",".join(f"{x:.5f}" for x in table)), ",").cast("array<double>")
    total = F.aggregate(steps_of(token), F.lit(0.0), lambda s, x: s + F.get(model, x))
    return total / F.greatest(F.length(token) - 1, F.lit(1))


def find(
    docs: DataFrame, table: list[float], key: str = "doc_id", text: str = "text", least_chars: int = 20, threshold: float = 0.5
) -> DataFrame:
    """(key, s_assign, s_access, s_hex, s_model) for every row: arrays of (start, kind, end, value)."""
    tokens = spans(F.col("t"), TOKEN % least_chars, 3)
    mixed = lambda r: (r["value"].rlike("[0-9]") & r["value"].rlike("[A-Za-z]")) | r["value"].rlike("[a-z][A-Z]+[a-z0-9]*[A-Z]")
    looks = lambda r: mixed(r) & ~r["value"].rlike(ACCESS + "|" + HEX) & (ratio(r["value"], table) > threshold)
    texts = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return texts.select(key, *(c.alias(n) for n, c in base_spans(F.col("t")).items()), F.filter(tokens, looks).alias("s_model"))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of each fixed kind, the digest of their spans, and all spans as text."""

    def written(*names: str) -> Column:
        name = lambda r: F.element_at(F.array(*map(F.lit, KINDS)), r["kind"] + 1)
        rows = F.sort_array(F.concat(*names))
        return F.array_join(F.transform(rows, lambda r: F.concat_ws(":", name(r), r["start"].cast("string"), r["end"].cast("string"))), ",")

    base = ("s_assign", "s_access", "s_hex")
    counts = [F.size(n).cast("long").alias("n" + n[1:]) for n in base]
    return found.select(key, *counts, F.sha2(written(*base), 256).alias("base_sha256"), written(*base, "s_model").alias("spans"))
