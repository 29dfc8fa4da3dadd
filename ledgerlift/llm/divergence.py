"""Audit of how far the sources of a language differ in their words.

Tasks count words with Arrow's compute functions alone (`ascii_lower`, `split_pattern_regex`,
`dictionary_encode`, hash `group_by`) and pass on partial counts by language, source and term, never words.
Spark adds them up. Terms in enough documents of their language are kept, and their smoothed shares are
dealt by a hash of the term into columnar shards: a shard is a matrix of its terms by the sources of the
language, from which one task adds up the differences of all pairs of sources. Sums of shards give the
divergences.

A shard holds about `shard_terms` terms and meets sources in blocks of `source_block`, so a task holds one
matrix of bounded size, however many terms and sources there are. Shares are whole numbers, and all sums are
exact.

Defined cases
    * A null text, language or source counts as ''. A document without terms still makes its group occur.
    * Repeated rows are documents of their own. Equal values rank by item, in the order of its UTF-8 bytes.
    * A language without kept terms gives pairs of value 0 and no term rows; a language with one source
      gives no pairs. An empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import renewed, stored, text_slices

NO_TERM = r"[\x00-\x60\x7B-\x7F]+"  # of a text whose A-Z are lower-cased
COUNTED = "lang string, source string, term string, n long, docs long"
KEYS = ["lang", "source", "term"]
ROWS_HELD = 500_000  # partial counts that a task holds before it passes them on
SCALE = 1_000_000_000
PRIOR = 5


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """Partial counts of (lang, source, text) rows: occurrences and documents of each term in each group.

    A group also gives a row with the term '' and no occurrences, so that groups without terms are known.
    """
    langs, sources = (batch.column(n).dictionary_encode() for n in ("lang", "source"))
    width = len(sources.dictionary)
    group = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64) * width + sources.indices.to_numpy(zero_copy_only=False)
    words = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=NO_TERM)
    rows, terms = pc.list_parent_indices(words), pc.list_flatten(words)
    is_term = pc.greater(pc.binary_length(terms), 0)  # a text may begin or end with a gap
    terms = terms.filter(is_term).dictionary_encode()
    in_docs = pa.table({"row": rows.filter(is_term), "term": terms.indices})
    in_docs = in_docs.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    in_groups = pa.table({"group": group[in_docs["row"].to_numpy()], "term": in_docs["term"], "n": in_docs["count_all"]})
    in_groups = in_groups.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    found = pa.table(
        [*_names(in_groups["group"].to_numpy(), langs, sources, width), terms.dictionary.take(in_groups["term"].combine_chunks()),
         in_groups["n_sum"], in_groups["count_all"]],
        names=[*KEYS, "n", "docs"],
    )
    here = np.unique(group)
    none = pa.array(np.zeros(len(here), np.int64))
    marks = [*_names(here, langs, sources, width), pa.array([""] * len(here), pa.string()), none, none]
    return pa.concat_tables([found, pa.table(marks, names=found.column_names)])


def _names(group: np.ndarray, langs: pa.DictionaryArray, sources: pa.DictionaryArray, width: int) -> list[pa.Array]:
    return [langs.dictionary.take(pa.array(group // width)), sources.dictionary.take(pa.array(group % width))]


def merged(parts: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(parts)
    return whole.group_by(KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns([*KEYS, "n", "docs"])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    floor = 0  # rows left by the last merge
    for batch in batches:
        for part in text_slices(batch, "text"):
            held.append(count_terms(part))
            if sum(p.num_rows for p in held) - floor > ROWS_HELD:
                held = [merged(held)]
                floor = held[0].num_rows
                if floor > ROWS_HELD:
                    yield from held[0].to_batches()
                    held, floor = [], 0
    if held:
        yield from merged(held).to_batches()


def term_counts(docs: DataFrame, min_docs: int = 30) -> DataFrame:
    """(lang, source, term, n, lang_n, counts): occurrences of each kept term, in the group and in the language.

    `counts` marks one row for each language and term. Rows with the term '' say that a group occurs.
    """
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # first by the whole key, so that a common word of many tasks is spread over its sources
    whole = given.mapInArrow(_partial, COUNTED).groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")  # as many rows as sources
    shown = whole.select(
        *KEYS,
        "n",
        F.sum("n").over(of_term).alias("lang_n"),
        F.sum("docs").over(of_term).alias("lang_docs"),
        (F.min("source").over(of_term) == F.col("source")).alias("counts"),
    )
    kept = shown.where((F.col("term") == "") | (F.col("lang_docs") >= min_docs)).drop("lang_docs")
    return stored(kept, "term-counts")


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms)), exactly; null where there are no terms."""
    above, below = f"cast({n} + {PRIOR} as decimal(20, 0)) * {SCALE}", f"cast({total} + {PRIOR} * {terms} as decimal(20, 0))"
    return F.expr(f"case when {terms} > 0 then 1 + ({above}) div {below} end")


def groups_of(counts: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, terms, unseen, place): one row for each group, with the share of a term it lacks."""
    is_term = F.col("term") != ""
    of_lang = counts.groupBy("lang").agg(
        F.sum(F.when(is_term, F.col("n")).otherwise(0)).alias("lang_total"), F.count_if(is_term & F.col("counts")).alias("terms")
    )
    groups = counts.groupBy("lang", "source").agg(F.sum(F.when(is_term, F.col("n")).otherwise(0)).alias("total"))
    groups = groups.join(of_lang, "lang").withColumn("unseen", F.coalesce(share("0", "total", "terms"), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return stored(groups.withColumn("place", place), "term-groups")


def differences(sources: pa.Table, terms: pa.Table, same: bool, block: int) -> pa.Table:
    """Sums over the terms of a shard of the differences between the shares of every two sources.

    `sources` has `place` and `unseen`; `terms` has `place`, `term` and `p` where a source has the term. The
    sources are those of one block (`same`: each pair once) or of two (pairs from one to the other).
    """
    places = np.sort(sources["place"].to_numpy())
    unseen = sources["unseen"].to_numpy()[np.argsort(sources["place"].to_numpy())]
    words = terms["term"].combine_chunks().dictionary_encode()
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    matrix = np.repeat(unseen[:, None], len(words.dictionary), axis=1)
    matrix[np.searchsorted(places, terms["place"].to_numpy()), words.indices.to_numpy()] = terms["p"].to_numpy()
    first = places // block == places[0] // block
    a, b, value = [], [], []
    for k in np.flatnonzero(first):
        others = np.arange(k + 1, len(places)) if same else np.flatnonzero(~first)
        a.append(np.full(len(others), places[k]))
        b.append(places[others])
        value.append(np.abs(matrix[others] - matrix[k]).sum(axis=1))
    whole = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, value)]
    return pa.table([x.astype(np.int64) for x in whole], names=["a", "b", "value"])


def pair_values(counts: DataFrame, groups: DataFrame, shard_terms: int = 4096, source_block: int = 256) -> DataFrame:
    """(lang, a, b, value) by places of sources, each pair of sources of a language in both orders."""
    blocks = F.ceil(F.count("*").over(Window.partitionBy("lang")) / source_block).cast("int")
    own = F.floor(F.col("place") / source_block).cast("int")
    shards = F.greatest(F.ceil(F.col("terms") / shard_terms).cast("int"), F.lit(1))
    placed = groups.withColumns({"own": own, "blocks": blocks, "shards": shards})
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("low"), F.greatest("own", o).alias("high"))))
    entries = counts.where(F.col("term") != "").join(placed.drop("unseen"), ["lang", "source"])
    entries = entries.select(
        "lang", "place", "term", share("n", "total", "terms").alias("p"), F.expr("pmod(xxhash64(term), shards)").cast("int").alias("shard"), meets.alias("m")
    ).select("lang", "place", "term", "p", "shard", "m.*")
    sides = placed.select("lang", "place", "unseen", "shards", meets.alias("m"))
    sides = sides.select("lang", "place", "unseen", "m.*", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))

    def summed(sources: pa.Table, terms: pa.Table) -> pa.Table:
        if not sources.num_rows:
            return pa.table([[], [], [], []], schema=pa.schema([("lang", pa.string()), *[(n, pa.int64()) for n in ("a", "b", "value")]]))
        found = differences(sources, terms, sources["low"][0].as_py() == sources["high"][0].as_py(), source_block)
        return found.add_column(0, "lang", pa.array([sources["lang"][0].as_py()] * found.num_rows, pa.string()))

    keys = ["lang", "shard", "low", "high"]
    parts = sides.groupBy(*keys).cogroup(renewed(entries).groupBy(*keys)).applyInArrow(summed, "lang string, a long, b long, value long")
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).select("lang", both.alias("s"), "value").select("lang", "s.*", "value")


def audit(docs: DataFrame, min_docs: int = 30, top_terms: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): distances between sources, and the terms that a source uses more than its language."""
    counts = term_counts(docs, min_docs)
    groups = groups_of(counts)
    names = groups.select("lang", "place", "source")
    pairs = (
        pair_values(counts, groups)
        .join(names.withColumnRenamed("place", "a"), ["lang", "a"])
        .join(names.select("lang", F.col("place").alias("b"), F.col("source").alias("item")), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    entries = counts.where((F.col("term") != "") & (F.col("n") > 0)).join(groups, ["lang", "source"])
    more = entries.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (share("n", "total", "terms") - share("lang_n", "lang_total", "terms")).alias("value"),
    ).where("value > 0")
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [df.withColumn("rank", F.row_number().over(falling)) for df in (pairs, more)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top_terms))
