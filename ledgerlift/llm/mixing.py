"""Mixing sources to target weights by the cube method.

A source's share of the mix is its weight's share of all words, but at most `most` times the source; what a
source cannot use is shared again by weight. A document is taken floor(t) times, t = target / source size, and
once more with probability t - floor(t). These probabilities are moved by the cube method: a step along a
direction in the null space of the balancing equations (words taken, documents taken) until some probability
becomes 0 or 1, with expectations kept. A window of three documents has such a direction, so a block of any
length ends with at most two open documents; the open ones of all blocks of a source form the next, far
smaller level. The last two of a source land by giving up the document count, then the word count; the
last block then flips documents while that brings its words nearer to the target.

A source is cut into blocks by hash, so one that holds a third of all rows is as many tasks.

Defined cases
    * Sources rank by code point, null last. Every row is a document of its own, whether its id is null, shared or
      repeated: rows that share id, source and text are counted, and each gets a decision.
    * Null and empty texts have size 0; they may be taken, as nothing. A source without words has target 0.
    * Draws come from hashes of ids and a seed, so reruns agree. An empty table gives an empty mix.
    * `take` returns the input's columns only, whatever their names.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import count_words, stored

UNIT = "id {id}, source {source}, digest long, nth long, size long, p double, times int, source_size long, target double, block long"


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """(source, source_size, place): place from 0 by code point, null last, without gathering the sources in one task."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = stored(
        sums.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id() % (1 << 33)),
        "sources",
    )
    # One row a partition of the sort.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.join(starts, "part").select("source", "source_size", (F.col("start") + F.col("nth")).alias("place"))


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(source, source_size, target) from rows (source, size)."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double")
    sources = stored(ranked_sources(sizes).select("source", "source_size", weight.alias("weight")), "weights")
    total, all_weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = (total or 0) / (all_weight or 1), -1
    over = lambda x: F.col("weight") * x > F.lit(most) * F.col("source_size")
    while True:
        used, n, weight_left = sources.agg(
            F.sum(F.when(over(level), F.col("source_size"))), F.count_if(over(level)), F.sum(F.when(~over(level), F.col("weight")))
        ).first()
        if n == full or not weight_left:
            break
        full, level = n, ((total or 0) - most * (used or 0)) / weight_left
    target = F.least(F.col("weight") * level, F.lit(most) * F.col("source_size")).alias("target")
    return sources.select("source", "source_size", target)


def flight(p: list[float], size: list[int], draw: random.Random, land: bool) -> list[float]:
    """Move probabilities to 0 or 1, keeping the sums of p and of p * size; at most two stay open, none if `land`."""
    goal, p = p, list(p)
    window: list[int] = []

    def step(u: tuple[float, ...]) -> None:
        nonlocal window
        up = down = float("inf")
        for i, x in zip(window, u):
            if x > 0:
                up, down = min(up, (1 - p[i]) / x), min(down, p[i] / x)
            elif x < 0:
                up, down = min(up, p[i] / -x), min(down, (1 - p[i]) / -x)
        move = up if draw.random() * (up + down) < down else -down
        for i, x in zip(window, u):
            p[i] = min(1.0, max(0.0, p[i] + move * x))
            if p[i] < 1e-9 or p[i] > 1 - 1e-9:
                p[i] = float(round(p[i]))
        window = [i for i in window if 0 < p[i] < 1]

    for i in range(len(p)):
        if 0 < p[i] < 1:
            window.append(i)
        while len(window) == 3:
            a, b, c = (size[i] for i in window)
            u = (b - c, c - a, a - b)
            step(tuple(x / max(map(abs, u)) for x in u) if any(u) else (1.0, -1.0, 0.0))
    if land:
        if len(window) == 2:
            a, b = (size[i] for i in window)
            step((1.0, -1.0) if a == b or not a or not b else (1.0, -a / b))
        while window:
            step((1.0,) + (0.0,) * (len(window) - 1))
        # A long document may be among the last: flip others while that brings the words nearer.
        start, weight, now = np.array(goal), np.array(size, dtype=float), np.array(p)
        free = (start > 0) & (start < 1)
        while free.any():
            error = float(((now - start) * weight).sum())
            after = np.where(free, np.abs(error + weight * (1 - 2 * now)), np.inf)
            best = int(after.argmin())
            if after[best] >= abs(error) - 1e-9:
                break
            now[best] = 1 - now[best]
        p = now.tolist()
    return p


def decide(units: DataFrame, seed: int = 7, block_rows: int = 4096) -> DataFrame:
    """Rows (id, source, digest, nth, size, p, times, source_size, target): p becomes 0 or 1, level by level."""
    kinds = {n: units.schema[n].dataType.simpleString() for n in ("id", "source")}
    schema = UNIT.format(**kinds)

    def fly(level: int):
        def run(block: pa.Table) -> pa.Table:
            # Long documents first, so that those left open at the end are short. The rest of the order comes
            # from hashes, as the blocks do, so that a second attempt at a task gives the same.
            block = block.sort_by([("size", "descending"), ("turn", "ascending")])
            land = block["blocks"][0].as_py() == 1
            draw = random.Random(f"{seed} {level} {block['source'][0].as_py()!r} {block['block'][0].as_py()}")
            p = flight(block["p"].to_pylist(), block["size"].to_pylist(), draw, land)
            at = block.column_names.index("p")
            return block.set_column(at, "p", pa.array(np.array(p), pa.float64())).select([c.split()[0] for c in UNIT.split(", ")])

        return run

    open_now = (F.col("p") > 0) & (F.col("p") < 1)
    units = stored(units.withColumn("block", F.lit(0).cast("long")), "units")
    done, rest, level = [units.where(~open_now)], units.where(open_now), 0
    while True:
        counts = rest.groupBy("source").agg(F.count("*").alias("n"))
        blocks = counts.select(F.col("source").alias("its"), F.ceil(F.col("n") / block_rows).cast("long").alias("blocks"))
        dealt = rest.drop("block").join(blocks, F.col("source").eqNullSafe(F.col("its"))).drop("its")
        unit = ["id", "digest", "nth"]
        turn = F.xxhash64(*unit, F.lit(seed), F.lit(level))
        dealt = dealt.withColumns({"turn": turn, "block": F.pmod(F.xxhash64(*unit, F.lit(seed + 1), F.lit(level)), "blocks")})
        moved = stored(dealt.groupBy("source", "block").applyInArrow(fly(level), schema), "moved")
        done.append(moved.where(~open_now))
        rest, level = moved.where(open_now), level + 1
        if rest.isEmpty():
            break
    out = done[0]
    for x in done[1:]:
        out = out.unionAll(x)
    return out.drop("block")


def _digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")), F.lit(11))


def _decisions(docs: DataFrame, key: str, source: str, text: str, size: Column | None, most: float, seed: int) -> DataFrame:
    size = count_words(F.col(text)) if size is None else size
    rows = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), _digest(F.col(text)).alias("digest"), size.alias("size"))
    units = stored(rows.groupBy("id", "source", "digest").agg(F.first("size").alias("size"), F.count("*").alias("rows")), "sizes")
    units = units.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows")
    goal = targets(units, most=most)
    share = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(F.lit(0.0))
    whole = F.floor(share + 1e-12)
    units = units.join(goal.withColumnRenamed("source", "its"), F.col("source").eqNullSafe(F.col("its"))).select(
        "id", "source", "digest", "nth", "size", F.greatest(share - whole, F.lit(0.0)).alias("p"), whole.cast("int").alias("times"), "source_size", "target"
    )
    return decide(units, seed)


def copies(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", size: Column | None = None, most: float = 3.0, seed: int = 7
) -> DataFrame:
    """(id, source, size, n, source_size, target): how often each document is taken. `size` defaults to the words of `text`."""
    decided = _decisions(docs, key, source, text, size, most, seed)
    return decided.select("id", "source", "size", (F.col("times") + F.col("p").cast("int")).alias("n"), "source_size", "target")


def take(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", size: Column | None = None, most: float = 3.0, seed: int = 7
) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of the input.

    Rows that share id, source and text share their probability, so it only counts how many of them are taken
    once more: the first ones, whichever these are.
    """
    decided = _decisions(docs, key, source, text, size, most, seed)
    more = F.sum(F.col("p").cast("int")).alias("more")
    groups = decided.groupBy("id", "source", "digest").agg(F.first("times").alias("times"), more, F.count("*").alias("rows")).where("times + more > 0")
    # the input's columns stay in one struct, so that their names meet no other
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(key).alias("k"), F.col(source).alias("s"), _digest(F.col(text)).alias("d"),
    )
    same = F.col("k").eqNullSafe(F.col("id")) & F.col("s").eqNullSafe(F.col("source")) & (F.col("d") == F.col("digest"))
    joined = held.join(groups, same)
    single = joined.where("rows = 1").select("doc", (F.col("times") + F.col("more")).alias("n"))
    place = F.row_number().over(Window.partitionBy("k", "s", "d").orderBy(F.lit(1)))
    several = joined.where("rows > 1").select("doc", "times", "more", place.alias("place"))
    several = several.select("doc", (F.col("times") + (F.col("place") <= F.col("more")).cast("int")).alias("n"))
    times = single.unionAll(several).where("n > 0").select("doc", F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int"))))
    return times.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
