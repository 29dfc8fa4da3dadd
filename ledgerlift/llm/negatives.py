"""Hard negatives by segment summaries.

A vector is cut into segments of equal length, and each segment's mean and deviation (the norm of what is
left without the mean) are stored. The inner product of two segments of length n lies within
n * mean * mean' plus or minus deviation * deviation', so sums over segments bound a score from both sides.
Pairs are bounded by the summary of whole vectors first, and those that may still count by ever finer
segments, until the pairs that are left are scored exactly.

Anchors meet rows in blocks, at most `anchor_rows` against about `shard_rows`, so a task holds one of each
whatever the table's size. For positives, a label's rows meet the anchors of that label alone; a hot label is
spread over shards by a hash of the row. For negatives every shard meets every block of anchors. A shard gives
at most k rows for each question, and a window keeps the best k.

Defined cases
    * A row without id, label or vector, or with a null, NaN or infinite component, takes no part. Of unequal
      lengths, the shorter vector counts as padded with zeros.
    * Ties go to the smaller id. Repeated rows are rows of their own; an anchor skips all rows with its id.
    * An anchor without other rows of its label gives nothing, nor does a positive whose range holds no row.
      Empty tables give no rows. Other columns of the input are not read.
    * Scores are exact while sums stay below 2**53; beyond, whole numbers of any size are compared, without
      bounds, as long as scores fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.block_topk import _exact, _matrix, _width
from ledgerlift.llm.common import renewed, stored

SEGMENT = 8  # components of a finest segment
FINER = (2, 1)  # finest segments in a segment of the levels below the whole vector
TILE, CHUNK = 2048, 1024  # anchors and rows of a task that are looked at together
NEVER = 2**62
DENSE = 0.2  # share of pairs still open from which all are scored at once
FOUND = "anchor_row long, anchor_id long, question int, vec_id long, score long"


def whole_rows(vectors: DataFrame, label: Column, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(row, vec_id, label, v, means, deviations): stored usable rows, components as floor(scale * x), with segment summaries."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & usable).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"),
    )

    def summed(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            means, deviations = summary(_matrix(table["v"], _width(table["v"])))
            lists = [pa.array(list(x), pa.list_(pa.float64())) for x in (means, deviations)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, "means", "deviations"])

    shape = "row long, vec_id long, label long, v array<long>, means array<double>, deviations array<double>"
    return stored(rows.where("label is not null").mapInArrow(summed, shape), "summed-vectors")


def summary(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each finest segment of each row; the last segment is padded with zeros."""
    padded = np.pad(vectors.astype(np.float64), ((0, 0), (0, -vectors.shape[1] % SEGMENT)))
    parts = padded.reshape(len(vectors), -1, SEGMENT)
    means = parts.mean(axis=2)
    return means, np.sqrt(((parts - means[:, :, None]) ** 2).sum(axis=2))


def coarser(means: np.ndarray, deviations: np.ndarray, merge: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of segments of `merge` finest segments each, from those of the finest ones."""
    padding = ((0, 0), (0, -means.shape[1] % merge))
    means, deviations = (np.pad(x, padding).reshape(len(x), -1, merge) for x in (means, deviations))
    whole = means.mean(axis=2)
    spread = (deviations**2).sum(axis=2) + SEGMENT * ((means - whole[:, :, None]) ** 2).sum(axis=2)
    return whole, np.sqrt(spread)


class Summaries:
    """Levels of summaries of a block of vectors, scaled so that bounds are plain inner products."""

    def __init__(self, means: np.ndarray, deviations: np.ndarray):
        self.levels = []
        for merge in (max(means.shape[1], 1), *FINER):
            m, d = coarser(means, deviations, merge)
            self.levels.append((m * np.sqrt(SEGMENT * merge), d))

    def part(self, here: slice) -> Summaries:
        out = object.__new__(Summaries)
        out.levels = [(m[here], d[here]) for m, d in self.levels]
        return out


def open_pairs(anchors: Summaries, rows: Summaries, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs (anchor, row) whose bounds reach [low, high] of the anchor; None if too many are open to go on by pairs."""
    a = b = still_open = None
    for (am, ad), (bm, bd) in zip(anchors.levels, rows.levels):
        if a is None:  # all pairs at once, while many are open
            middle, reach = am @ bm.T, ad @ bd.T
            least, most = low[:, None], high[:, None]
        else:
            middle, reach = (np.einsum("ij,ij->i", x[a], y[b]) for x, y in ((am, bm), (ad, bd)))
            least, most = low[a], high[a]
        reach += 1 + 1e-9 * (np.abs(middle) + reach)  # more than rounding can take away
        fits = (middle + reach >= least) & (middle - reach <= most)
        if a is not None:
            a, b = a[fits], b[fits]
            continue
        still_open = fits if still_open is None else still_open & fits
        if np.count_nonzero(still_open) <= DENSE * still_open.size:
            a, b = np.nonzero(still_open)
    return None if a is None else (a, b)


def best_in_shard(
    anchor_ids: np.ndarray,
    anchors: np.ndarray,
    anchor_sums: tuple[np.ndarray, np.ndarray],
    low: np.ndarray,
    high: np.ndarray,
    ids: np.ndarray,
    rows: np.ndarray,
    row_sums: tuple[np.ndarray, np.ndarray],
    k: int,
    barred: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, ...]:
    """(anchor, question, id, score): for each anchor and question the k best rows of the shard with low <= score <= high.

    `low` and `high` have a row for each anchor and a column for each question. `barred` are labels of
    anchors and rows: equal ones make no pair. Nor do equal ids.
    """
    kind = _exact(rows, anchors)
    anchors, rows = anchors.astype(kind), rows.astype(kind)
    anchor_bounds, row_bounds = Summaries(*anchor_sums), Summaries(*row_sums)
    found = []
    for first in range(0, len(anchors), TILE):
        tile = slice(first, first + TILE)
        reach = low[tile].astype(kind)  # the score from which a row can still be among the best k
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind))] * low.shape[1]
        for start in range(0, len(ids), CHUNK):
            here = slice(start, start + CHUNK)
            least, most = reach.min(axis=1), high[tile].max(axis=1)
            pairs = open_pairs(anchor_bounds.part(tile), row_bounds.part(here), least, most) if kind is np.float64 else None
            if pairs is None:
                scores = anchors[tile] @ rows[here].T
                a, b = np.nonzero((scores >= least[:, None]) & (scores <= most[:, None]))
                scores = scores[a, b]
            else:
                a, b = pairs
                scores = np.einsum("ij,ij->i", anchors[tile][a], rows[here][b])
            allowed = anchor_ids[tile][a] != ids[here][b]
            if barred:
                allowed &= barred[0][tile][a] != barred[1][here][b]
            a, b, scores = a[allowed], b[allowed], scores[allowed]
            for q in range(low.shape[1]):
                fits = (scores >= reach[a, q]) & (scores <= high[tile][a, q])
                if fits.any():
                    best[q] = _first(k, [np.concatenate(x) for x in zip(best[q], (a[fits], ids[here][b[fits]], scores[fits]))])
                    at, _, at_scores, rank = best[q]
                    reach[at[rank == k - 1], q] = at_scores[rank == k - 1]
                    best[q] = best[q][:3]
        found += [(a + first, np.full(len(a), q), found_ids, scores) for q, (a, found_ids, scores) in enumerate(best)]
    return tuple(np.concatenate(x) for x in zip(*found))


def _first(k: int, found: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The k best of each anchor among (anchor, id, score), by falling score and rising id, with their ranks from 0."""
    order = np.lexsort((found[1], -found[2], found[0]))
    at, ids, scores = (x[order] for x in found)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    keep = rank < k
    return at[keep], ids[keep], scores[keep], rank[keep]


def _matrix_of_floats(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    lengths = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    out = np.zeros((len(lists), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _search(k: int, other_labels: bool):
    """A cogroup function: rows of a shard and a block of anchors to the best k rows for each question."""
    names = [x.split()[0] for x in FOUND.split(", ")]

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            empty = [pa.array([], pa.int32() if n == "question" else pa.int64()) for n in names]
            return pa.table(empty, names=names)
        width = _width(rows["v"], anchors["v"])
        segments = _width(rows["means"], anchors["means"])
        sums = [[_matrix_of_floats(t[c], segments) for c in ("means", "deviations")] for t in (anchors, rows)]
        own = anchors["vec_id"].to_numpy()
        if other_labels:
            asked = _width(anchors["low"])
            low, high = (_matrix(anchors[c], asked) for c in ("low", "high"))
            missing = np.arange(asked)[None, :] >= np.array([len(x) for x in anchors["low"].to_pylist()])[:, None]
            low[missing], high[missing] = NEVER, -NEVER
            labels = (anchors["label"].to_numpy(), rows["label"].to_numpy())
        else:
            low = np.full((len(own), 1), -NEVER, np.int64)
            high, labels = -low, None
        found = best_in_shard(
            own, _matrix(anchors["v"], width), sums[0], low, high, rows["vec_id"].to_numpy(), _matrix(rows["v"], width), sums[1], k, labels
        )
        a, which, ids, scores = found
        whole = pa.array([int(s) for s in scores] if scores.dtype == object else scores.astype(np.int64), pa.int64())
        return pa.table([anchors["row"].to_numpy()[a], own[a], which.astype(np.int32), ids, whole], names=names)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("anchor_row", "question").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _upto(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def positives(rows: DataFrame, is_anchor: Column, k: int, anchor_rows: int, shard_rows: int) -> DataFrame:
    """(anchor_row, anchor_id, question, vec_id, score, rank): the k best other rows of each anchor's label."""
    sizes = rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("n_anchors"))
    sizes = sizes.where("n_anchors > 0").select(
        "label", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"), F.ceil(F.col("n_anchors") / anchor_rows).cast("int").alias("blocks")
    )
    sized = rows.join(sizes, "label")
    spread = F.xxhash64("row")
    wide = ["vec_id", "row", "v", "means", "deviations"]
    dealt = sized.select("label", *wide, F.pmod(spread, "shards").alias("shard"), _upto(F.col("blocks")).alias("block"))
    asked = sized.where(is_anchor).select("label", *wide, F.pmod(spread, "blocks").alias("block"), _upto(F.col("shards")).alias("shard"))
    keys = ["label", F.col("shard").cast("int"), F.col("block").cast("int")]
    found = dealt.groupBy(*keys).cogroup(renewed(asked).groupBy(*keys)).applyInArrow(_search(k, other_labels=False), FOUND)
    return _best(found, k)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    anchor_rows: int = 65_536,
    shard_rows: int = 65_536,
    least_rows: int = 1_024,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of `whole_rows` that `is_anchor` picks.

    A negative has another label, and its score is from low_percent to high_percent of the positive's score.
    """
    total, asked = rows.agg(F.count("*"), F.count_if(is_anchor)).first()
    blocks = -(-asked // anchor_rows) or 1
    # no fewer tasks than shuffle partitions, as long as a shard is worth a task
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shard_rows = min(shard_rows, max(least_rows, -(-total * blocks // parts)))
    shards = -(-total // shard_rows) or 1
    near = stored(positives(rows, is_anchor, n_positives, anchor_rows, shard_rows), "positives")
    ranges = near.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("near"))  # at most n_positives
    # bounds of the negative's score as whole numbers; below zero, the range holds nothing
    ranges = ranges.select(
        F.col("anchor_row").alias("row"),
        F.expr(f"transform(near, p -> case when p.score < 0 then {NEVER} else (p.score * {low_percent} + 99) div 100 end) as low"),
        F.expr(f"transform(near, p -> case when p.score < 0 then -{NEVER} else (p.score * {high_percent}) div 100 end) as high"),
    )
    spread = F.xxhash64("row")
    wide = ["label", "vec_id", "row", "v", "means", "deviations"]
    dealt = rows.select(*wide, F.pmod(spread, F.lit(shards)).alias("shard"), _upto(F.lit(blocks)).alias("block"))
    asking = rows.where(is_anchor).join(ranges, "row")
    asking = asking.select(*wide, "low", "high", F.pmod(spread, F.lit(blocks)).alias("block"), _upto(F.lit(shards)).alias("shard"))
    keys = [F.col("shard").cast("int"), F.col("block").cast("int")]
    found = dealt.groupBy(*keys).cogroup(renewed(asking).groupBy(*keys)).applyInArrow(_search(n_negatives, other_labels=True), FOUND)
    of = near.select(
        "anchor_row", (F.col("rank") - 1).alias("question"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    out = _best(found, n_negatives).join(of, ["anchor_row", "question"])
    return out.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
