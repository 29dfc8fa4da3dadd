"""Near-duplicate groups by MinHash bands, verified sequentially.

Rows with the same set of shingles become one class first, so exact copies cost nothing further. A class with
`bands` * `band_rows` MinHashes shares a bucket with every class that has an equal band: a pair at the
threshold misses all of 40 bands of 5 with probability 1e-7. Candidates of similar set size are compared by
signature, a batch at a time; after each batch the pair is dropped if the posterior probability (uniform
prior) that its similarity reaches the threshold is below `miss`. What survives is verified on the full sets.

A bucket is not expanded into all its pairs: each round compares the members that are outside the component
of the bucket's pivot with that pivot, then relabels; a bucket whose members are all in one component is
done. What `rounds` pivots leave open is compared across components inside the buckets: members are dealt into
blocks of bounded size, a task compares two blocks by MinHashes and then by full sets, made from the texts when first needed, each pair in the first
bucket it shares, and only links come out of it, at most one a member and pair of blocks. So no link between components is lost,
a large group of near copies costs a row a member, and a large bucket of documents that are similar, but not
enough so, costs comparisons and no rows.

Defined cases
    * Texts without words, and null texts, have an empty set: no links, each a component of its own.
    * With fewer words than `width`, the whole sequence is the one shingle.
    * Rows that share an id share a component; the result has a row for each distinct id that is not null.
    * Shingles are compared by 64-bit hash. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import stored
from ledgerlift.llm.quality_rules import words_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS_OUT = 128
PIECE = 256
#: Word hashes that a task keeps; a cache only, emptied when full.
WORDS_KEPT = 1 << 19


class WordHashes(dict):
    """64-bit hashes of lower-cased words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word.translate(LOWER).encode("utf-8", "surrogatepass"))
        return found


_hashes = WordHashes()


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles, each made from its words' hashes in turn."""
    words = words_of(text or "")
    if not words:
        return np.zeros(0, np.int64)
    width = min(width, len(words))
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - width + 1
    made = scrambled(h[:n])
    for k in range(1, width):
        made = scrambled(made * np.uint64(0xD6E8FEB86659FD93) + h[k : k + n])
    return np.unique(made.view(np.int64))


@lru_cache(8)
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of n hash functions of 32 bits."""
    rng = np.random.RandomState(20240)
    factors = rng.randint(0, 1 << 31, size=n, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    return factors, rng.randint(0, 1 << 32, size=n, dtype=np.int64).astype(np.uint32)


def signature(hashes: np.ndarray, n: int) -> np.ndarray:
    """n MinHashes of 32 bits."""
    factors, offsets = _functions(n)
    x = (scrambled(hashes.view(np.uint64)) >> np.uint64(32)).astype(np.uint32)
    least, room = np.full(n, np.iinfo(np.uint32).max, np.uint32), np.empty((PIECE, n), np.uint32)
    for start in range(0, len(x), PIECE):
        piece = x[start : start + PIECE]
        made = np.multiply(piece[:, None], factors, out=room[: len(piece)])
        made += offsets
        np.minimum(least, made.min(axis=0), out=least)
    return least


def sets(docs: DataFrame, key: str, text: str, width: int, n: int = 0) -> DataFrame:
    """(id, n, print, what): a row's set size, its 128-bit fingerprint, and n MinHashes, or the set itself where n is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(start, ROWS_OUT)
                found = [shingle_set(t, width) for t in part.column(1).to_pylist()]
                what = pa.array([signature(x, n).tobytes() for x in found], pa.binary()) if n else pa.array(found, pa.list_(pa.int64()))
                sizes = pa.array([len(x) for x in found], pa.int64())
                prints = pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in found], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), sizes, prints, what], ["id", "n", "print", "what"])

    return docs.select(key, text).mapInArrow(run, f"id long, n long, print binary, what {'binary' if n else 'array<long>'}")


def least_equal(n: int, threshold: float, miss: float) -> int:
    """Fewest equal MinHashes of n at which P(similarity >= threshold), from a uniform prior, is at least `miss`."""
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def plausible(pairs: DataFrame, n: int, threshold: float, miss: float, batch_rows: int = 25) -> DataFrame:
    """(a, b) of the pairs (a, b, sig_a, sig_b) that no batch of MinHashes rules out."""
    ends = list(range(batch_rows, n + 1, batch_rows))
    floors = [least_equal(e, threshold, miss) for e in ends]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, n) for k in (2, 3))
            alive, equal = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for end, floor in zip(ends, floors):
                cut = slice(end - batch_rows, end)
                equal[alive] += (left[alive, cut] == right[alive, cut]).sum(axis=1)
                alive = alive[equal[alive] >= floor]
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(alive)) for k in (0, 1)], ["a", "b"])

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, width: int, share: tuple[int, int]) -> DataFrame:
    """(a, b) of the pairs (a, b, x, y), x and y their texts, whose full sets are as similar as asked for. Texts pack better than sets."""
    over, under = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):
                part, known = batch.slice(start, ROWS_OUT), {}  # sets of one slice: a pivot's text comes many times
                linked = []
                for two in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    for t in two:
                        if t not in known:
                            known[t] = shingle_set(t, width)
                    x, y = known[two[0]], known[two[1]]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(common > 0 and under * common >= over * (len(x) + len(y) - common))
                yield pa.RecordBatch.from_arrays([part.column(k).filter(pa.array(linked)) for k in (0, 1)], ["a", "b"])

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def open_links(
    members: DataFrame, known: DataFrame, n: int, share: tuple[int, int], miss: float, block: int = 1024, room: int = 4_000_000, width: int = 0
) -> DataFrame:
    """(a, b): links between members (bucket, rep, n, comp) of one bucket, across components, as far as they join any.

    `known` has (rep, sig, keys, what): a byte of each MinHash, all buckets in the order of the bands, the full
    set, or with `width` the text. Unequal MinHashes may look equal by one byte, which rules out no pair. A block has
    about `block` members and `room` shingles, or what the members have in `load`.
    """
    over, under = share
    floor = least_equal(n, over / under, miss)
    sizes = members.groupBy("bucket").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("load" if "load" in members.columns else "n") / room)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep", "bucket"), "blocks").cast("int")
    placed = members.join(sizes, "bucket").join(known, "rep").withColumn("own", own)
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("x"), F.greatest("own", o).alias("y")))
    held = ["bucket", "rep", "n", "comp", "sig", "keys", "what", "own"]
    dealt = placed.select(*held, F.explode(meets).alias("m")).select(*held, "m.*")

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("rep")
        bucket, x, y = (part[c][0].as_py() for c in ("bucket", "x", "y"))
        rep, size, comp, own = (part[c].to_numpy() for c in ("rep", "n", "comp", "own"))
        rows = np.frombuffer(b"".join(part["sig"].to_pylist()), np.uint8).reshape(-1, n)
        keys = np.frombuffer(b"".join(part["keys"].to_pylist()), np.dtype(">i8")).reshape(len(rows), -1)
        what, sets_made = part["what"], {}

        def whole(i: int) -> np.ndarray:
            if i not in sets_made:
                sets_made[i] = shingle_set(what[i].as_py(), width) if width else what[i].values.to_numpy()
            return sets_made[i]

        first_here = (keys == bucket).argmax(axis=1)
        group = comp.copy()  # components, joined as links are found
        links = []
        for i in np.flatnonzero(own == x):
            js = np.flatnonzero(own == y)
            js = js[(js > i) | (x != y)]
            js = js[(group[js] != group[i]) & (over * np.maximum(size[js], size[i]) <= under * np.minimum(size[js], size[i]))]
            js = js[(rows[js] == rows[i]).sum(axis=1) >= floor]
            shared = keys[js] == keys[i]
            js = js[shared.argmax(axis=1) == first_here[i]]
            for j in js:
                if group[j] != group[i]:
                    common = len(np.intersect1d(whole(i), whole(j), assume_unique=True))
                    if common > 0 and under * common >= over * (len(whole(i)) + len(whole(j)) - common):
                        links.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
                        group[group == group[j]] = group[i]
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table([np.ascontiguousarray(a), np.ascontiguousarray(b)], names=["a", "b"])

    return dealt.groupBy("bucket", "x", "y").applyInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in the edges (a, b): the smallest id reachable, by large-star and small-star steps."""
    links = stored(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct(), "links")
    while True:
        # Done when every id names one smaller id, and that names none.
        ends = links.select("v", F.lit(1).alias("up")).unionAll(links.select(F.col("u").alias("v"), F.lit(0).alias("up")))
        degrees = ends.groupBy("v").agg(F.sum("up").alias("up"), F.count("*").alias("all"))
        if degrees.where("up > 1 OR (up = 1 AND all > 1)").isEmpty():
            return links.select(F.col("v").alias("id"), F.col("u").alias("component"))
        # Large star: larger neighbours move to the smallest neighbour.
        both = links.unionAll(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = stored(large.where("u < v").distinct(), "large")
        # Small star: smaller neighbours, and the node itself, move to the smallest one.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u < v").unionAll(least.select("v", F.col("m").alias("u")))
        links = stored(small.distinct(), "links")


def links_of(classes: DataFrame, texts: DataFrame, width: int, bands: int, band_rows: int, share: tuple[int, int], miss: float, rounds: int) -> DataFrame:
    """(rep, component) for the linked classes (rep, n, sig); `texts` (id, text) gives the full sets of what survives."""
    over, under = share
    cuts = [F.xxhash64(F.lit(k), F.substring("sig", 4 * band_rows * k + 1, 4 * band_rows)) for k in range(bands)]
    buckets = classes.select("rep", "n", F.explode(F.array(*cuts)).alias("bucket"))
    many = buckets.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    buckets = stored(buckets.join(many, "bucket"), "buckets")
    sizes_fit = F.lit(over) * F.greatest("n_a", "n_b") <= F.lit(under) * F.least("n_a", "n_b")
    # Only classes that share a bucket are compared: from here on their MinHashes and texts alone are moved.
    met = buckets.select("rep").distinct()
    classes = stored(classes.join(met, "rep", "left_semi"), "met")
    texts = texts.join(met, F.col("id") == F.col("rep"), "left_semi").dropDuplicates(["id", "text"])
    texts = stored(texts.select("id", "text", F.octet_length("text").alias("bytes")), "texts")
    sigs = classes.select("rep", "sig")
    packed = F.concat(*[F.unhex(F.lpad(F.hex(cut), 16, "0")) for cut in cuts]).alias("keys")
    short = classes.select("rep", F.concat(*[F.substring("sig", 4 * k + 1, 1) for k in range(bands * band_rows)]).alias("sig"), packed)

    def verify(pairs: DataFrame) -> DataFrame:
        signed_pairs = pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b")
        left = stored(plausible(signed_pairs, bands * band_rows, over / under, miss), "plausible")
        named = left.select(F.col("a").alias("its")).unionAll(left.select("b")).distinct()
        its_texts = texts.join(named, F.col("id") == F.col("its"), "left_semi").select("id", "text")
        return confirmed(left.join(its_texts.toDF("a", "x"), "a").join(its_texts.toDF("b", "y"), "b"), width, share)

    edges, labels, compared = None, None, None
    for turn in range(rounds + 1):
        # The first turn compares the only pair of a bucket of two. The last one takes every larger bucket that is not yet one component.
        members = buckets.where(F.col("c") > (2 if turn else 1)).select("bucket", "rep", "n", F.col("rep").alias("comp"))
        if labels is not None:
            members = members.join(labels, members["rep"] == labels["id"], "left").select("bucket", "rep", "n", F.coalesce("component", "rep").alias("comp"))
        mixed = members.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min(F.struct("comp", "rep", "n")).alias("first"), F.max(F.struct("comp", "rep", "n")).alias("last"))
        mixed = stored(mixed.where("low < high"), "mixed")
        if edges is not None and mixed.isEmpty():
            break
        if turn < rounds:
            # Even turns take the bucket's first member as pivot, odd ones its last.
            pivot = F.col("first" if turn % 2 == 0 else "last")
            pairs = members.join(mixed.select("bucket", pivot.alias("pivot")), "bucket").where("comp <> pivot.comp")
            pairs = pairs.select(F.least("rep", "pivot.rep").alias("a"), F.greatest("rep", "pivot.rep").alias("b"), F.col("n").alias("n_a"), F.col("pivot.n").alias("n_b"))
            pairs = pairs.where(sizes_fit).select("a", "b").distinct()
            pairs = stored(pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti"), "pairs")
            compared = pairs if compared is None else compared.unionAll(pairs)
            found = stored(verify(pairs), "edges")
        else:
            # an id with several texts has as many rows here, as below
            long_texts = texts.groupBy(F.col("id").alias("rep")).agg(F.ceil(F.sum("bytes") / 8).alias("load"))
            open_ = members.join(mixed.select("bucket"), "bucket").join(long_texts, "rep")
            open_ = stored(open_.select("bucket", "rep", "n", "comp", F.greatest("n", "load").alias("load")), "open")
            named = open_.select(F.col("rep").alias("its")).distinct()
            its_texts = texts.join(named, F.col("id") == F.col("its"), "left_semi").select(F.col("id").alias("rep"), F.col("text").alias("what"))
            known = short.join(named, F.col("rep") == F.col("its"), "left_semi").join(its_texts, "rep")
            found = stored(open_links(open_, known, bands * band_rows, share, miss, width=width).distinct(), "edges")
        if edges is not None and found.isEmpty():
            continue
        edges = found if edges is None else edges.unionAll(found)
        labels = components(edges)
    return labels.select(F.col("id").alias("rep"), "component")


def groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    share: tuple[int, int] = (80, 100),
    bands: int = 40,
    band_rows: int = 5,
    miss: float = 1e-9,
    rounds: int = 3,
) -> DataFrame:
    """(id, n_shingles, component): every distinct id with its set size and the smallest id of its group."""
    texts = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = stored(sets(texts, "id", "text", width, bands * band_rows), "sets")
    least = rows.where("n > 0").groupBy("print").agg(F.min("id").alias("rep"), F.max("n").alias("n"))
    # one exchange: the join's keys are those that duplicates are found by
    signed = least.join(rows.select(F.col("id").alias("rep"), "print", F.col("what").alias("sig")), ["rep", "print"])
    classes = stored(signed.dropDuplicates(["rep", "print"]).select("rep", "n", "sig"), "classes")
    found = links_of(classes, texts, width, bands, band_rows, share, miss, rounds)
    ids = rows.select("id", "n", "print").join(least.select("print", "rep"), "print", "left")
    return (
        ids.join(found, "rep", "left")
        .groupBy("id")
        .agg(F.max("n").alias("n_shingles"), F.min(F.coalesce("component", "rep", "id")).alias("component"))
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents whose id is the smallest of its group, with all their columns; rows without an id stay."""
    gone = groups(docs, key, text, **how).where("id <> component").select(F.col("id").alias("__gone"))
    return docs.join(gone, docs[key] == gone["__gone"], "left_anti")
