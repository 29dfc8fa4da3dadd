"""License scans: sparse TF-IDF cosine of headers and license files to templates, then inheritance down the directories.

Templates are short forms, notices and whole texts (`license_texts`). A file's candidates are its units (lines, and
sentences of lines), its headers (runs of neighbouring units) and, if it is short, the file itself. No word opens the
gate for them but the templates' own: of a template's terms, from the heaviest down, the first few are such that a
candidate without any of them cannot reach the cosine asked for. Units with such a term, their runs and their files are
candidates if they share enough of one template's weight to reach it; both bounds lose no match. Rarity is counted over all texts, and the cosine comes from a join on terms, so only shared
terms cost. The license of a file is that of its best candidate. Short forms have a negated twin that names no license:
what is nearest to that ("not released under the ...") has none.

A file whose best candidate holds at least `file_share` of its words, or whose name is that of a license file, is the
license file of its directory; files without a license of their own take that of the nearest directory above.

Defined cases
    * Null texts count as empty. Terms are lower-cased runs of letters, digits, and dots inside.
    * A header is a run of units with a gate term, with at most `GAP` others between two of them.
    * Ties between templates go to the smaller name, so to the negated one; between license files of a directory to the
      higher score, then the smaller path. A null path has no directory: it gives and inherits nothing.
    * Rows that share an id and path are one file, with their best candidate. Empty tables give no rows.
    * `scan` returns the key and its measures only, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import count_words, stored, text_slices
from ledgerlift.llm.license_texts import forms

TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
UNIT_END = r"\n|(?<=[.!?;])[ \t]+"
FILE_NAME = r"(?i)^(un)?licen[sc]es?([.-].*)?$|^copying([.-].*)?$"
GAP = 2
#: Files of up to so many terms are compared whole; the longest template has some 200 words.
WHOLE = 600


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def parents(path: Column) -> Column:
    """Directories above a path, the root '' first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def rarities(docs: DataFrame, text: str) -> DataFrame:
    """(term, idf) of every term of all texts; partial counts for each map task."""
    every = docs.select(F.explode(F.array_distinct(terms_of(F.coalesce(F.col(text), F.lit(""))))).alias("term"))
    return stored(every.groupBy("term").agg(F.count("*").alias("df")), "rarities")


def weight(tf: str, n_docs: int) -> Column:
    """Frequency here by rarity over all texts; `df` is null for a term that no text has."""
    rarity = F.log(F.lit(n_docs + 1.0) / (F.coalesce("df", F.lit(0)) + F.lit(1.0)))
    return F.col(tf) * F.greatest(rarity, F.lit(0.01))


def templates(spark: SparkSession, rare: DataFrame, n_docs: int) -> DataFrame:
    """(form, name, term, w): the fixed forms, with unit length."""
    rows = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(forms())], "form int, name string, line string")
    terms = rows.select("form", "name", F.explode(terms_of(F.col("line"))).alias("term")).groupBy("form", "name", "term").agg(F.count("*").alias("tf"))
    # The forms are fixed, so their terms are a bounded table.
    known = rare.join(F.broadcast(terms.select("term").distinct()), "term")
    weighed = terms.join(F.broadcast(known), "term", "left").withColumn("w", weight("tf", n_docs))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("form")))
    return stored(weighed.select("form", "name", "term", (F.col("w") / norm).alias("w")), "templates")


def gate_terms(model: DataFrame, least: float) -> list[str]:
    """Terms of which a text needs one to reach the cosine with any form: the rest of each form weighs too little."""
    rest = F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("form").orderBy(F.desc("w"), "term").rowsBetween(0, Window.unboundedFollowing))
    return sorted(r["term"] for r in model.withColumn("rest", rest).where(F.col("rest") >= least * least - 1e-9).select("term").distinct().collect())


def candidates(docs: DataFrame, path: Column, key: str, text: str, model: DataFrame, least: float) -> DataFrame:
    """(id, path, n, found): each row's words and the candidate texts that share enough of a form's weight."""
    gate = frozenset(gate_terms(model, least))
    # The forms are fixed, so this is a bounded table.
    forms_of: dict[str, list[tuple[int, float]]] = {}
    for r in model.collect():
        forms_of.setdefault(r["term"], []).append((r["form"], r["w"] ** 2))
    terms, ends = re.compile(TERM), re.compile(UNIT_END)
    needed = least * least - 1e-9

    def reaches(found: set[str]) -> bool:
        """By Cauchy's inequality no cosine is above the root of the form's weight that is shared."""
        shared: dict[int, float] = {}
        for term in found.intersection(forms_of):
            for form, w in forms_of[term]:
                shared[form] = shared.get(form, 0.0) + w
        return max(shared.values(), default=0.0) >= needed

    def candidates_of(body: str) -> list[str]:
        units = ends.split(body)
        sets = [terms.findall(u.lower()) for u in units]
        at = [k for k, found in enumerate(sets) if not gate.isdisjoint(found)]
        if not at:
            return []
        heads = [i for i, k in enumerate(at) if i == 0 or k - at[i - 1] > GAP + 1]
        spans = [(at[i], at[j - 1] + 1) for i, j in zip(heads, [*heads[1:], len(at)])]
        spans += [(k, k + 1) for k in at]
        if sum(map(len, sets)) <= WHOLE:
            spans.append((0, len(units)))
        return list(dict.fromkeys("\n".join(units[a:b]) for a, b in spans if reaches(set().union(*sets[a:b]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "body"):
                found = [candidates_of(t) if t else [] for t in part.column("body").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(found, pa.list_(pa.string()))], ["id", "path", "n", "found"])

    rows = docs.select(F.col(key).alias("id"), path.alias("path"), count_words(F.col(text)).alias("n"), F.col(text).alias("body"))
    return rows.mapInArrow(run, f"id {docs.schema[key].dataType.simpleString()}, path string, n long, found array<string>")


def digest(line: Column) -> Column:
    """Two 64-bit hashes stand for a candidate wherever only its identity counts, as it may be a whole file."""
    return F.struct(F.xxhash64(line), F.xxhash64(line, F.lit(7)))


def nearest(lines: DataFrame, model: DataFrame, rare: DataFrame, n_docs: int, least: float) -> DataFrame:
    """(line, best: (minus, name)) of distinct (line, text) that reach the cosine; `minus` is the score below zero."""
    # Texts are taken apart before the shuffle: their terms go on, beside the digest.
    counted = lines.select("line", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("line", "term").agg(F.count("*").alias("tf"))
    counted = stored(counted, "line_terms")
    known = rare.join(counted.select("term").distinct(), "term")
    x = counted.join(known, "term", "left").select("line", "term", weight("tf", n_docs).alias("x"))
    norm = x.groupBy(F.col("line").alias("of")).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = x.join(model, "term").groupBy("line", "form", "name").agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    scored = dots.join(norm, F.col("line") == F.col("of")).select("line", "name", F.round(F.col("dot") / F.col("norm"), 9).alias("score"))
    return scored.where(F.col("score") >= least).groupBy("line").agg(F.min(F.struct((-F.col("score")).alias("minus"), "name")).alias("best"))


def scan(docs: DataFrame, path: Column, key: str = "doc_id", text: str = "text", least: float = 0.6, file_share: float = 0.4) -> DataFrame:
    """(id, path, own, score, license, from_path): each file's own license, and the one it has or inherits."""
    rare = rarities(docs, text)
    n_docs = docs.count()
    model = templates(docs.sparkSession, rare, n_docs)
    files = stored(candidates(docs, path, key, text, model, least), "files")
    # The same candidate is scored once, however many files have it.
    lines = files.select(F.explode("found").alias("text")).select(digest(F.col("text")).alias("line"), "text").groupBy("line").agg(F.first("text").alias("text"))
    best = stored(nearest(lines, model, rare, n_docs, least), "best").where("best.name <> ''")
    found = files.select("id", "path", F.explode("found").alias("text"))
    found = found.select("id", "path", digest(F.col("text")).alias("line"), (-count_words(F.col("text"))).alias("words")).join(best, "line")
    held = found.groupBy("id", "path").agg(F.min(F.struct("best.minus", "best.name", "words")).alias("b"))
    held = held.select(F.col("id").alias("its"), F.col("path").alias("at"), F.col("b.name").alias("own"), (-F.col("b.minus")).alias("score"), (-F.col("b.words")).alias("words"))
    base = files.groupBy("id", "path").agg(F.sum("n").alias("n"))
    own = stored(base.join(held, F.col("id").eqNullSafe(F.col("its")) & F.col("path").eqNullSafe(F.col("at")), "left").select("id", "path", "n", "own", "score", "words"), "own")
    folder = F.element_at(parents(F.col("path")), -1)
    is_file = (F.col("words") >= file_share * F.col("n")) | F.element_at(F.split("path", "/"), -1).rlike(FILE_NAME)
    givers = own.where(F.col("own").isNotNull() & F.col("path").isNotNull() & is_file)
    givers = givers.groupBy(folder.alias("dir")).agg(F.min(F.struct((-F.col("score")).alias("minus"), F.col("path").alias("giver"), F.col("own").alias("name"))).alias("g"))
    # Each directory is resolved once; the files then join on their directory alone.
    dirs = own.where(F.col("path").isNotNull()).select(folder.alias("of"), F.slice(parents(F.col("path")), 1, F.size(F.split("path", "/"))).alias("up")).distinct()
    above = dirs.select("of", F.posexplode("up").alias("depth", "dir")).join(givers, "dir").groupBy("of").agg(F.max_by("g", "depth").alias("g"))
    out = own.join(above, folder == F.col("of"), "left")
    return out.select("id", "path", "own", "score", F.coalesce("own", "g.name").alias("license"), F.when(F.col("own").isNotNull(), F.col("path")).otherwise(F.col("g.giver")).alias("from_path"))
