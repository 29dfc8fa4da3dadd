"""Line dedup by pairwise alignment: common blocks of lines go from the later document.

Overlaps are found through hashes of runs of lines. Runs are each line, pair and triple of lines with `min_words`
words or more, as long as the lines before the last are short of `block_words`; and from each line on, and back
from each line, the shortest run that reaches `block_words`. A rare short run, held by `rare` texts or fewer, links
every two of its holders. Any other run links a document to the first document (smallest id) that holds it, so it
costs one link a document however frequent it is. Every line of a common block is in a shortest run inside the
block, so it meets a document that holds that run whole, even if the lines were each seen first in other documents,
and however frequent they are; a block that the earlier document interrupts by other lines is met if one of its
lines, pairs or triples is rare or was first seen there. Patience
diff anchors on lines that occur once in each of the two documents, keeps the longest run of anchors in rising
order, extends each anchor over equal neighbouring lines, and searches each gap between anchors again, with
occurrences counted inside the gap, by runs of 2, 4, 8 ... lines where no line occurs once. An alignment uses each
line of the first document once and in order; blocks that come again or elsewhere are found in the pair by the
shortest runs. A block is deleted from the later document if it holds `block_words` words or more. Blocks are judged
on the input, not on what is left. So a line goes if it is in a run of lines with `block_words` words that some
earlier document holds; beyond that, aligned lines that only the earlier document interrupts count as one block.

Documents with the same lines form one class first, aligned once, so large groups of copies add no alignments.

Defined cases
    * A null text has no lines and stays null; an empty text stays empty. Lines are split at \\n only.
    * Rows that share an id are not compared with each other. A null id is never cut and never a first document.
    * Copies of a text: the smallest id keeps its lines, the others lose every block, which may leave an empty text.
    * Lines are compared by 64-bit hash, texts by SHA-256, and texts of one id by 64 bits of it.
    * `clean` returns the input's columns, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import count_words, stored

ROWS_OUT = 256
_ODD = 0xD6E8FEB86659FD93
_BACK = pow(_ODD, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def heavy_runs(words: np.ndarray, block_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends): from each line on, and back from each line, the shortest run with `block_words` words."""
    total = np.concatenate([[0], np.cumsum(words)])
    ends = np.searchsorted(total, total[:-1] + block_words, "left")
    starts = np.flatnonzero(ends < len(total))
    upto = np.flatnonzero(total >= block_words)
    back = np.searchsorted(total, total[upto] - block_words, "right") - 1
    return np.concatenate([starts, back]), np.concatenate([ends[starts], upto])


def short_runs(words: np.ndarray, min_words: int, block_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends): one to three lines with `min_words` words, while those before the last are short of a block."""
    total = np.concatenate([[0], np.cumsum(words)])
    starts, ends = [], []
    for n in (1, 2, 3):
        at = np.arange(max(len(words) - n + 1, 0))
        at = at[(total[at + n] - total[at] >= min_words) & (total[at + n - 1] - total[at] < block_words)]
        starts.append(at)
        ends.append(at + n)
    return np.concatenate(starts), np.concatenate(ends)


def run_hashes(lines: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs, equal for equal lines wherever they stand."""
    n = len(lines)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lines * powers(_ODD, n), dtype=np.uint64)])
    found = (sums[ends] - sums[starts]) * powers(_BACK, n + 1)[starts]
    found = (found ^ (found >> np.uint64(31))) * np.uint64(_ODD) + (ends - starts).astype(np.uint64)
    return (found ^ (found >> np.uint64(29))).view(np.int64)


def rising(anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of anchors that rises on both sides, by patience piles."""
    tops: list[int] = []
    heads: list[int] = []
    back = [-1] * len(anchors)
    for k, (_, j) in enumerate(anchors):
        pile = bisect_left(tops, j)
        back[k] = heads[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(j)
            heads.append(k)
        else:
            tops[pile], heads[pile] = j, k
    k, chain = heads[-1] if heads else -1, []
    while k >= 0:
        chain.append(anchors[k])
        k = back[k]
    return chain[::-1]


def runs_of(lines: list[int], k: int, number: dict[int, int]) -> list[int]:
    """Hashes of all runs of `k` numbered lines; eight bytes a run, however long the runs are."""
    at = np.arange(len(lines) - k + 1)
    return run_hashes(np.array([number[x] for x in lines], np.uint64), at, at + k).tolist()


def anchors_in(later: list[int], first: list[int]) -> list[tuple[int, int]]:
    """Where lines stand that occur once in each; if there are none, runs of 2, 4, 8 ... lines that do."""
    k, number = 1, {}
    while k <= min(len(later), len(first)):
        if k == 2:
            number = {x: n for n, x in enumerate({*later, *first})}
        runs_a, runs_b = (x if k == 1 else runs_of(x, k, number) for x in (later, first))
        once_a, once_b = Counter(runs_a), Counter(runs_b)
        if not once_a.keys() & once_b.keys():
            break
        at = {h: j for j, h in enumerate(runs_b) if once_b[h] == 1}
        found = [(i, at[h]) for i, h in enumerate(runs_a) if once_a[h] == 1 and h in at]
        if found:
            return rising(found)
        k *= 2
    return []


def patience(later: list[int], first: list[int]) -> list[tuple[int, int]]:
    """Blocks (start, end) of lines of `later` that align with `first`; gaps between anchors are searched again."""
    aligned: list[tuple[int, int]] = []
    gaps = [(0, len(later), 0, len(first))]
    while gaps:
        a, b, c, d = gaps.pop()
        low = a
        while low < b and c < d and later[low] == first[c]:
            low, c = low + 1, c + 1
        high = b
        while high > low and d > c and later[high - 1] == first[d - 1]:
            high, d = high - 1, d - 1
        aligned += [(a, low), (high, b)]
        if low == high or c == d:
            continue
        i0, j0 = low, c
        for i, j in anchors_in(later[low:high], first[c:d]):
            i, j = i + low, j + c
            if i < i0 or j < j0:
                continue
            # The prefix of what follows extends the anchor to the right, the suffix of this gap to the left.
            end = i
            while end < high and j < d and later[end] == first[j]:
                end, j = end + 1, j + 1
            gaps.append((i0, i, j0, j - (end - i)))
            aligned.append((i, end))
            i0, j0 = end, j
        if i0 > low:
            gaps.append((i0, high, j0, d))
    blocks: list[tuple[int, int]] = []
    for low, high in sorted(x for x in aligned if x[0] < x[1]):
        if blocks and low == blocks[-1][1]:
            low = blocks.pop()[0]
        blocks.append((low, high))
    return blocks


def common_lines(later: np.ndarray, words: np.ndarray, first: np.ndarray, block_words: int) -> list[int]:
    """Lines of `later` in blocks with `block_words` words: aligned ones, and those that an alignment passes over
    since they come again or in another order."""
    later, words, first = (np.asarray(x, np.int64) for x in (later, words, first))
    common = np.isin(later, first)
    turns = np.flatnonzero(np.diff(common, prepend=False, append=False)).reshape(-1, 2)
    total = np.concatenate([[0], np.cumsum(words)])
    if not (total[turns[:, 1]] - total[turns[:, 0]] >= block_words).any():
        return []
    gone = np.zeros(len(later), dtype=bool)
    for a, b in patience(later.tolist(), first.tolist()):
        gone[a:b] = total[b] - total[a] >= block_words
    # Lines that `later` lacks are in no common run, so their words do not matter.
    order = np.argsort(later, kind="stable")
    place = order[np.minimum(np.searchsorted(later, first, sorter=order), len(later) - 1)]
    weight = np.where(later[place] == first, words[place], block_words)
    (mine, starts, ends), (theirs, _, _) = (
        (run_hashes(h.view(np.uint64), *runs), *runs) for h, runs in ((later, heavy_runs(words, block_words)), (first, heavy_runs(weight, block_words)))
    )
    edge = np.zeros(len(later) + 1, dtype=np.int64)
    shared = np.isin(mine, theirs)
    np.add.at(edge, starts[shared], 1)
    np.add.at(edge, ends[shared], -1)
    return np.flatnonzero(gone | (np.cumsum(edge)[:-1] > 0)).tolist()


def line_hashes(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda x: F.xxhash64(x))


def runs(lines: DataFrame, min_words: int, block_words: int) -> DataFrame:
    """(id, mark, run): the hashes of each text's runs; the lowest bit of a run tells that it is short of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(start, ROWS_OUT)
                rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for k, (h, w) in enumerate(zip(part.column(2), part.column(3))):
                    h, w = (x.values.to_numpy(zero_copy_only=False) for x in (h, w))
                    starts, ends = (np.concatenate(x) for x in zip(short_runs(w, min_words, block_words), heavy_runs(w, block_words)))
                    total = np.concatenate([[0], np.cumsum(w, dtype=np.int64)])
                    hashes = run_hashes(h.view(np.uint64), starts, ends) & ~np.int64(1)
                    found.append(np.unique(hashes | (total[ends] - total[starts] < block_words)))
                    rows.append(np.full(len(found[-1]), k))
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(np.concatenate(found))], ["id", "mark", "run"])

    kind = lines.schema["id"].dataType.simpleString()
    return lines.select("id", "mark", "h", "w").mapInArrow(run, f"id {kind}, mark long, run long")


def links(lines: DataFrame, min_words: int, block_words: int, rare: int) -> DataFrame:
    """(id, mark, first, first_mark): the texts to align, each with an earlier document."""
    seen = stored(runs(lines, min_words, block_words), "runs")
    firsts = seen.groupBy("run").agg(F.min(F.struct("id", "mark")).alias("f"), F.count("*").alias("c")).where("c > 1")
    firsts = stored(firsts, "first_holders")
    to_first = seen.join(firsts.select("run", "f"), "run").select("id", "mark", "f")
    # With two holders, the first one is the only partner.
    few = firsts.where((F.col("c") > 2) & (F.col("c") <= rare) & (F.col("run").bitwiseAND(1) == 1)).select("run")
    held = seen.where(F.col("run").bitwiseAND(1) == 1).join(few, "run").groupBy("run").agg(F.collect_list(F.struct("id", "mark")).alias("held"))
    between = held.select(F.explode("held").alias("x"), "held").select("x.id", "x.mark", F.explode("held").alias("f"))
    return to_first.unionAll(between).where("f.id < id").select("id", "mark", F.col("f.id").alias("first"), F.col("f.mark").alias("first_mark")).distinct()


def cuts(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 3, block_words: int = 10, rare: int = 8) -> DataFrame:
    """(id, digest, gone): line numbers to delete, for each distinct id and text that loses any."""
    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(key).alias("id"), F.sha2(text, 256).alias("digest"), F.col(text).alias("t"))
    ids = stored(rows.select("id", "digest").distinct(), "ids")
    # One representative a text: its smallest id. A copy, if there is one, is aligned with that id.
    classes = ids.groupBy("digest").agg(F.min("id").alias("low"))
    texts = rows.join(classes, (rows["digest"] == classes["digest"]) & (rows["id"] == classes["low"]), "left_semi").dropDuplicates(["digest"])
    words = F.transform(F.split("t", "\n", -1), lambda x: count_words(x).cast("int"))
    lines = texts.select("id", "digest", F.xxhash64("digest").alias("mark"), line_hashes(F.col("t")).alias("h"), words.alias("w"))
    lines = stored(lines, "lines")
    pairs = links(lines, min_words, block_words, rare)
    earlier = lines.select(F.col("id").alias("first"), F.col("mark").alias("first_mark"), F.col("h").alias("fh"))
    sides = pairs.join(earlier, ["first", "first_mark"]).join(lines.select("id", "mark", "digest", "h", "w"), ["id", "mark"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(start, ROWS_OUT)
                digests, gone = [], []
                for d, *sides in zip(*part.columns):
                    fh, h, w = (x.values.to_numpy(zero_copy_only=False) for x in sides)
                    found = common_lines(h, w, fh, block_words)
                    if found:
                        digests.append(d.as_py())
                        gone.append(found)
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.string()), pa.array(gone, pa.list_(pa.int32()))], ["digest", "gone"])

    aligned = sides.select("digest", "fh", "h", "w").mapInArrow(run, "digest string, gone array<int>")
    partial = aligned.select("digest", F.explode("gone").alias("i")).groupBy("digest").agg(F.collect_set("i").alias("gone"))
    # A later copy aligns whole with its first document: every line is one block.
    whole = lines.select("digest", F.size("h").alias("n"), F.aggregate("w", F.lit(0), lambda a, b: a + b).alias("all"))
    copies = ids.join(classes, "digest").where("id > low").join(whole, "digest").where(F.col("all") >= block_words)
    copies = copies.select("id", "digest", F.sequence(F.lit(0), F.col("n") - 1).alias("gone"))
    others = ids.join(copies.select("id", "digest"), ["id", "digest"], "left_anti").join(partial, "digest").select("id", "digest", "gone")
    return copies.unionAll(others)


def with_lines_left(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows with a last column `line_dedup`: n_lines, n_removed and the text that is left."""
    gone = cuts(docs, key, text, **how).toDF("its", "of", "gone")
    joined = docs.join(gone, (docs[key] == gone["its"]) & (F.sha2(docs[text], 256) == gone["of"]), "left")
    lines = F.split(docs[text], "\n", -1)
    # The lines are an argument of the outer function, so they are split once; the places left come from a hash set.
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone["gone"])
    left = F.transform(F.array(lines), lambda x: F.array_join(F.transform(places, lambda i: F.get(x, i)), "\n"))[0]
    n_gone = F.coalesce(F.size(gone["gone"]), F.lit(0))
    out = F.struct(
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.when(gone["gone"].isNull(), F.lit(0)).otherwise(n_gone).cast("long").alias("n_removed"),
        F.when(gone["gone"].isNull(), docs[text]).when(F.size(gone["gone"]) == F.size(lines), F.lit("")).otherwise(left).alias("left"),
    )
    return joined.select(*(docs[f"`{c}`"] for c in docs.columns), out.alias("line_dedup"))


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents without the deleted blocks; those left without a word go."""
    cut = with_lines_left(docs, key, text, **how)
    mark = cut.columns[-1]
    names = [f"c{k}" for k in range(len(docs.columns))]
    flat = cut.toDF(*names, mark)
    left = F.col(f"{mark}.left")
    kept = flat.where((F.col(f"{mark}.n_removed") == 0) | (count_words(left) > 0))
    at = docs.columns.index(text)
    return kept.select(*(left.alias(c) if k == at else F.col(names[k]).alias(c) for k, c in enumerate(docs.columns)))
