"""One named query for each operator, over its whole table, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm import (
    block_topk,
    byte_bpe,
    divergence,
    kneser_ney,
    licenses,
    line_dedup,
    minhash,
    mixing,
    negatives,
    packing,
    passages,
    quality_rules,
    secrets,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.groups(_table(spark, sf_dir, "documents"), width=2)
    kept = (F.col("id") == F.col("component")).alias("kept")
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept)


def op2_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.copies(_table(spark, sf_dir, "documents"))
    taken = (F.col("n") * F.col("size")).cast("long").alias("taken")
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    tokens = byte_bpe.encode(_table(spark, sf_dir, "documents"), ranks, pattern)
    return byte_bpe.digests(byte_bpe.decode(tokens, ranks))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    table = secrets.train(secrets.samples(docs, _table(spark, sf_dir, "labels")))
    return secrets.digests(secrets.find(docs, table))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).drop("clean_text")


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove(_table(spark, sf_dir, "documents")).drop("kept")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string"))
    return licenses.scan(_table(spark, sf_dir, "documents"), path).withColumnRenamed("id", "doc_id")


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return kneser_ney.judge(_table(spark, sf_dir, "documents"), trusted).withColumnRenamed("id", "doc_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.with_lines_left(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("line_dedup.left", F.lit("")), 256).alias("kept_sha256")
    return cut.select("doc_id", "line_dedup.n_lines", "line_dedup.n_removed", digest)


def op10_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = block_topk.whole_vectors(_table(spark, sf_dir, "embeddings"))
    return block_topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op11_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(packing.encode(_table(spark, sf_dir, "documents"), vocabulary), vocabulary, length=2048)
    return pieces.drop("ids").withColumnRenamed("id", "doc_id")


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), min_docs=30, top_terms=50)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    mislabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.whole_rows(_table(spark, sf_dir, "embeddings"), mislabelled)
    return negatives.mine(rows, F.col("vec_id") % 100 == 0, n_positives=5, n_negatives=10, low_percent=30, high_percent=90)


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE doc_id IS NOT NULL
), sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN [w] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) END AS s
  FROM words WHERE len(w) > 0
), classes AS (SELECT min(doc_id) AS rep, list_sort(s) AS s FROM sets GROUP BY ALL
), items AS (SELECT rep, len(s) AS n, unnest(s) AS item FROM classes
), coded AS (SELECT rep, n, hash(item) AS h FROM items
), shared AS (
  SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS i
  FROM coded a JOIN coded b ON a.h = b.h AND a.rep < b.rep AND 80 * greatest(a.n, b.n) <= 100 * least(a.n, b.n) GROUP BY ALL
), edges AS (SELECT a, b FROM shared WHERE 100 * i >= 80 * (na + nb - i)
), steps AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges
), reach AS (SELECT rep AS id, rep AS r FROM classes UNION SELECT reach.id, steps.b FROM reach JOIN steps ON reach.r = steps.a
), least AS (SELECT id AS rep, min(r) AS component FROM reach GROUP BY id
), found AS (
  SELECT sets.doc_id, len(sets.s) AS n, component
  FROM sets JOIN classes ON list_sort(sets.s) = classes.s JOIN least USING (rep)
), every_row AS (
  SELECT words.doc_id, coalesce(n, 0) AS n, coalesce(component, words.doc_id) AS component FROM words LEFT JOIN found USING (doc_id)
)
SELECT doc_id, max(n)::BIGINT AS n_shingles, min(component)::BIGINT AS component_id, doc_id = min(component) AS kept FROM every_row GROUP BY doc_id
"""

OP6_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(hex(encode(coalesce(text, '')))) // 2 AS n FROM documents
), pieces AS (  -- of 128 bytes and the 49 after them, as strings are cut from short texts faster
  SELECT k, doc_id, n, 128 * j AS low, substr(x, 256 * j + 1, 354) AS p FROM (SELECT *, unnest(range(0, (n + 127) // 128)) AS j FROM d)
), places AS (SELECT k, doc_id, n, low, p, unnest(range(0, least(128, n - low))) AS o FROM pieces
), strings AS (
  SELECT k, doc_id, low + o AS i, substr(p, 2 * o + 1, 2) AS byte, CASE WHEN low + o + 50 <= n THEN md5_number(substr(p, 2 * o + 1, 100)) END AS s
  FROM places
), marked AS (SELECT *, s IS NOT NULL AND coalesce(min(doc_id) OVER (PARTITION BY s) < doc_id, false) AS again FROM strings
), covered AS (SELECT k, i, byte, bool_or(again) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM marked
), edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY k ORDER BY i), false) AS opens FROM covered
), sums AS (
  SELECT k, count_if(gone) AS n_removed, count_if(opens) AS n_spans, coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM edges GROUP BY k
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN sums USING (k)
"""

OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.e, d.e)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 5
"""

OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x60\x7B-\x7F]+') AS terms
  FROM documents
), occurrence AS (SELECT lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 30
), grp AS (SELECT DISTINCT lang, source FROM d
), counts AS (SELECT lang, source, term, count(*) AS n FROM occurrence SEMI JOIN kept USING (lang, term) GROUP BY ALL
), cell AS (
  SELECT grp.lang, grp.source, kept.term, coalesce(n, 0)::HUGEINT AS n
  FROM grp JOIN kept ON kept.lang = grp.lang LEFT JOIN counts ON counts.lang = grp.lang AND counts.source = grp.source AND counts.term = kept.term
), shares AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g) AS p FROM cell
  WINDOW g AS (PARTITION BY lang, source)
), whole AS (SELECT lang, term, sum(n) AS n FROM cell GROUP BY lang, term
), lang_shares AS (
  SELECT lang, term, 1 + (1000000000 * (n + 5)::HUGEINT) // (sum(n) OVER g + 5 * count(*) OVER g)::HUGEINT AS q FROM whole
  WINDOW g AS (PARTITION BY lang)
), distance AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distance d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), more AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pair
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) FROM more
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same, list_inner_product(a.e, d.e)::BIGINT AS score
  FROM v a JOIN v d ON a.vec_id <> d.vec_id WHERE a.vec_id % 100 = 0
), near AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM scored WHERE same) WHERE r <= 5
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM near p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
) WHERE rank <= 10
"""


def queries() -> dict[str, Query]:
    return {
        "op1_minhash": op1_minhash,
        "op2_cube_mix": op2_cube_mix,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_secrets": op4_secrets,
        "op5_quality_rules": op5_quality_rules,
        "op6_passages": op6_passages,
        "op7_licenses": op7_licenses,
        "op8_kneser_ney": op8_kneser_ney,
        "op9_line_dedup": op9_line_dedup,
        "op10_block_topk": op10_block_topk,
        "op11_curve_packing": op11_curve_packing,
        "op12_source_audit": op12_source_audit,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash": OP1_SQL, "op6_passages": OP6_SQL, "op10_block_topk": OP10_SQL, "op12_source_audit": OP12_SQL, "op13_hard_negatives": OP13_SQL}
