"""Exact top-k inner products by block-at-a-time pruning.

Vectors are dealt into shards, and each shard sorts its vectors by id and cuts them into blocks of
consecutive ids. A block keeps the largest and smallest value of every dimension, which bound any inner
product with it: sum of q * max over positive q, plus q * min over negative q. A query visits the blocks of
a shard by falling bound, scores a block through its forward index (the rows of the block), and stops when
the next bound is below its k-th score. Shards give k rows a query, and a window keeps the best k.

Queries and shards meet in blocks: query blocks of at most `query_rows` against shards of about
`shard_rows`, so a task holds one of each whatever the table's size.

Defined cases
    * A vector that is null, or that holds a null, NaN or infinite component, takes no part, nor does a
      row without an id. Of unequal lengths, the shorter vector counts as padded with zeros.
    * Ties go to the smaller id. Repeated rows are rows of their own; a query skips all rows with its id.
    * Scores are exact: doubles where every sum stays below 2**53, else whole numbers of any size.
    * Empty tables, or queries without candidates, give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESULT = "query_key long, query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(vec_id, v): usable vectors, each component as floor(scale * x)."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & usable).select(
        F.col(key).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"),
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], column.type)
    lengths = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    out = np.zeros((len(lists), width), dtype=np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max(pc.max(pc.list_value_length(c)).as_py() or 0 for c in columns)


def _exact(docs: np.ndarray, queries: np.ndarray) -> type:
    top = float(np.abs(docs).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(docs.shape[1], 1)
    return np.float64 if top < 2.0**53 else object


def search_shard(ids: np.ndarray, docs: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, block: int):
    """Best k of one shard for each query: scores and ids, by falling score and rising id; id -1 marks none."""
    kind = _exact(docs, queries)
    order = np.argsort(ids, kind="stable")
    ids, docs, queries = ids[order], docs[order].astype(kind), queries.astype(kind)
    starts = np.arange(0, len(ids), block)
    high, low = (f.reduceat(docs, starts, axis=0) for f in (np.maximum, np.minimum))
    zero = queries * 0
    bounds = np.maximum(queries, zero) @ high.T + np.minimum(queries, zero) @ low.T
    visit = np.argsort(-bounds.astype(np.float64), axis=1, kind="stable")
    none = -(2**62) if kind is object else -np.inf
    best = np.full((len(queries), k), none, dtype=kind)
    best_ids = np.full((len(queries), k), -1, dtype=np.int64)
    rows = np.arange(len(queries))
    for turn in range(len(starts)):
        chosen = visit[rows, turn]
        alive = bounds[rows, chosen] >= best[rows, k - 1]
        if kind is np.float64:
            rows, chosen = rows[alive], chosen[alive]
        else:
            # Bounds beyond 2**53 are sorted as rounded doubles, so a later block may still count.
            chosen = np.where(alive, chosen, -1)
        if not len(rows):
            break
        for b in np.unique(chosen[chosen >= 0]):
            these = rows[chosen == b]
            here = slice(starts[b], starts[b] + block)
            scores = queries[these] @ docs[here].T
            scores[query_ids[these][:, None] == ids[here][None, :]] = none
            better = (scores >= best[these, k - 1][:, None]).any(axis=1)
            these, scores = these[better], scores[better]
            all_scores = np.concatenate([best[these], scores], axis=1)
            all_ids = np.concatenate([best_ids[these], np.broadcast_to(ids[here], scores.shape)], axis=1)
            all_ids[all_scores == none] = -1
            for q, s, i in zip(these, all_scores, all_ids):
                keep = np.lexsort((i, -s))[:k]
                best[q], best_ids[q] = s[keep], i[keep]
    return best, best_ids


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    block: int = 256,
    shard_rows: int = 16_384,
    query_rows: int = 2_048,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of `whole_vectors` output that `is_query` picks, against all rows."""
    rows, wanted = vectors.agg(F.count("*"), F.count_if(is_query)).first()
    shards, groups = -(-rows // shard_rows) or 1, -(-wanted // query_rows) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    docs = vectors.select("*", F.floor(F.rand(11) * shards).cast("int").alias("shard"), every(groups).alias("part"))
    asked = (
        vectors.where(is_query)
        .select("vec_id", "v", F.monotonically_increasing_id().alias("query_key"), F.floor(F.rand(12) * groups).cast("int").alias("part"))
        .select("*", every(shards).alias("shard"))
    )

    def scored(docs_: pa.Table, asked_: pa.Table) -> pa.Table:
        names = ["query_key", "query_id", "vec_id", "score"]
        if not docs_.num_rows or not asked_.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        width = _width(docs_["v"], asked_["v"])
        query_ids = asked_["vec_id"].to_numpy()
        best, best_ids = search_shard(docs_["vec_id"].to_numpy(), _matrix(docs_["v"], width), query_ids, _matrix(asked_["v"], width), k, block)
        none = -(2**62) if best.dtype == object else -np.inf
        q, at = np.nonzero(best != none)
        scores = pa.array(best[q, at].tolist() if best.dtype == object else best[q, at].astype(np.int64), pa.int64())
        return pa.table([asked_["query_key"].to_numpy()[q], query_ids[q], best_ids[q, at], scores], names=names)

    found = docs.groupBy("part", "shard").cogroup(asked.groupBy("part", "shard")).applyInArrow(scored, RESULT)
    best = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
