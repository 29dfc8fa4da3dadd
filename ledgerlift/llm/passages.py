"""Removal of bytes covered by 50-byte strings that also start in an earlier document.

A logarithmic family of sparse suffix arrays. The rows are stored as batches of some two megabytes. Each batch gets a suffix
array of its suffixes at anchors, in the order of hashes, dealt to shards by hash: one packed row for each batch
and shard. A 50-byte string's anchor is the start of the 8-byte string in it with the least hash (the leftmost of equals), so equal
strings have their anchor at the same place, and about one suffix in 22 is kept. A shard takes the arrays of its batches one
by one as levels of a family, where levels of equal size merge, and each batch is then merge-scanned against what the levels have
become. Only bits go back to the batches, which stay in place (a bucketed table).

Two scans are made. The first one is of all that an anchor's strings can see, the 42 bytes before it and the 50 after: a suffix
whose context an earlier document has is a repeat with all its strings. It also finds anchors that share 21 bytes to the left or to
the right, which a common string needs, in different contexts; the second one is of the 50-byte strings of these alone.
A key goes to a shard once a batch (twice, where it stands in several contexts there), whatever number of documents share it.

Defined cases
    * Null and empty texts have no bytes. Texts under 50 bytes lose nothing. Matches never cross documents.
    * Rows that share an id never shorten each other; each is a text of its own. Rows with a null id take no part (nothing is removed).
    * Strings are judged on the input. Contexts and strings are compared by 64-bit hashes, two contexts at one anchor by 32 bits.
    * `remove` reads the key and the text only, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import parts_for, text_slices
from ledgerlift.session import scratch_path

LENGTH, ANCHOR = 50, 8
BEFORE = LENGTH - ANCHOR
HALF = BEFORE // 2
BATCH_BYTES, SHARD_BYTES = 2_000_000, 24_000_000
SEGMENT = 1 << 20
CONTEXT, LEFT, RIGHT, STRING = range(4)
_LOW = np.uint64(0xFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.RandomState(77).randint(1, 1 << 62, size=257, dtype=np.int64).astype(np.uint64)
_EDGE = 256
_REPLIES = "batch long, kind int, shard int, bits binary"
_PIECES = "kind int, shard int, batch long, base long, width int, keys binary, ids binary"
_powers: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefixes:
    """Hashes of any strings of a segment of codes, from one running sum."""

    def __init__(self, codes: np.ndarray) -> None:
        n = len(codes)
        if not _powers or len(_powers[0]) <= n:
            _powers[:] = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                row = np.full(max(n + 1, SEGMENT + 4 * LENGTH), base, np.uint64)
                row[0] = 1
                _powers.append(np.cumprod(row))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[codes] * _powers[0][:n], out=self.sums[1:])

    def at(self, starts: np.ndarray | slice, width: int) -> np.ndarray:
        ends = slice(starts.start + width, starts.stop + width) if isinstance(starts, slice) else starts + width
        return mixed((self.sums[ends] - self.sums[starts]) * _powers[1][starts])


class Batch:
    """The texts of one batch side by side, with edges between them, and their anchors.

    `low` and `high` are the first and last start of the strings of each anchor; `context`, `left` and `right` are hashes.
    """

    def __init__(self, texts: pa.StringArray, ids: pa.Array) -> None:
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.sizes = np.diff(offsets)
        self.firsts = offsets[:-1] - offsets[0] + BEFORE * np.arange(1, len(texts) + 1)
        self.codes = np.full(len(data) + BEFORE * (len(texts) + 1), _EDGE, np.int16)
        self.codes[np.arange(len(data)) + np.repeat(BEFORE * np.arange(1, len(texts) + 1), self.sizes)] = data
        takes_part = (self.sizes >= LENGTH) & ~ids.is_null().to_numpy(zero_copy_only=False)
        edge = np.zeros(len(self.codes) + 1, np.int32)
        edge[self.firsts[takes_part]] += 1
        edge[(self.firsts + self.sizes - LENGTH + 1)[takes_part]] -= 1
        self.starts = np.cumsum(edge)[:-1] > 0
        rows = [self._anchors(s, min(s + SEGMENT, len(self.codes) - LENGTH + 1)) for s in range(0, len(self.codes) - LENGTH + 1, SEGMENT)]
        rows = [r for r in rows if r is not None] or [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 3]
        self.place, self.low, self.high, self.context, self.left, self.right = (np.concatenate(x) for x in zip(*rows))
        row = np.searchsorted(self.firsts, self.low, side="right") - 1
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)[row]

    def _anchors(self, start: int, end: int) -> tuple[np.ndarray, ...] | None:
        """Anchors of the strings that start in a segment; one that the next segment sees too comes twice, which changes nothing."""
        wanted = np.flatnonzero(self.starts[start:end])
        if not len(wanted):
            return None
        origin = max(start - BEFORE, 0)
        prefixes = Prefixes(self.codes[origin : end + BEFORE + LENGTH])
        n = end - start
        mask = np.uint64((1 << 21) - 1)
        least = prefixes.at(slice(start - origin, end + BEFORE - origin), ANCHOR) & ~mask | np.arange(n + BEFORE, dtype=np.uint64)
        # The least of BEFORE + 1 places, by doubling.
        for width in (1, 2, 4, 8, 16):
            least = np.minimum(least[:-width], least[width:])
        more = BEFORE + 1 - 32
        place = (np.minimum(least[:n], least[more : more + n]) & mask).astype(np.int64)[wanted]
        heads = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        tails = np.concatenate([heads[1:], [len(place)]]) - 1
        at = place[heads] + start
        near = at - origin
        hashes = prefixes.at(near - BEFORE, BEFORE + LENGTH), prefixes.at(near - HALF, HALF + ANCHOR), prefixes.at(near, HALF + ANCHOR)
        return at, wanted[heads] + start, wanted[tails] + start, *hashes

    def strings(self, starts: np.ndarray) -> np.ndarray:
        """Hashes of the strings at the starts, which ascend."""
        out = np.empty(len(starts), np.uint64)
        for s in range(0, len(self.codes), SEGMENT):
            a, b = np.searchsorted(starts, (s, s + SEGMENT))
            if a < b:
                out[a:b] = Prefixes(self.codes[s : s + SEGMENT + LENGTH]).at(starts[a:b] - s, LENGTH)
        return out


class Array:
    """Keys of a batch by shard and value, one of each; `of` gives the place of every row's key."""

    def __init__(self, kind: int, hashes: np.ndarray, ids: np.ndarray | None, shards: int, tags: np.ndarray | None = None) -> None:
        self.kind = kind
        shard = (hashes & _LOW) % np.uint64(shards)
        keys = hashes if tags is None else hashes & ~_LOW | tags >> np.uint64(32)
        order = np.lexsort((keys, shard)) if ids is None else np.lexsort((ids, keys, shard))
        shard, keys = shard[order].astype(np.int64), keys[order]
        ids = None if ids is None else ids[order]

        def heads(x: np.ndarray) -> np.ndarray:
            return np.concatenate([[True], (x[1:] != x[:-1]) | (shard[1:] != shard[:-1])]) if len(x) else np.zeros(0, bool)

        kept, group = heads(keys), heads(keys)
        if tags is not None:
            # Two contexts of one key are enough to know that it has several.
            group = heads(keys >> np.uint64(32))
            rank = np.cumsum(kept) - 1
            kept &= rank - rank[np.flatnonzero(group)][np.cumsum(group) - 1] < 2
        self.keys, self.ids = keys[kept], None if ids is None else ids[kept]
        self.bounds = np.searchsorted(shard[kept], np.arange(shards + 1))
        self.of = np.empty(len(order), np.int64)
        self.of[order] = (np.cumsum(kept) - 1)[np.flatnonzero(group)][np.cumsum(group) - 1]

    def pieces(self, batch: int) -> Iterator[tuple]:
        base = int(self.ids.min()) if self.ids is not None and len(self.ids) else 0
        width = 0
        if self.ids is not None and len(self.ids):
            most = int(self.ids.max()) - base
            width = 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
        for shard in np.flatnonzero(np.diff(self.bounds)).tolist():
            a, b = self.bounds[shard : shard + 2]
            own = (self.ids[a:b].view(np.uint64) - np.uint64(base % (1 << 64))).astype(f"u{width}").tobytes() if width else b""
            yield self.kind, shard, batch, base, width, self.keys[a:b].tobytes(), own

    def answers(self, replies: list[dict]) -> np.ndarray:
        """The bit of every row's key."""
        bits = np.zeros(len(self.keys), bool)
        for r in replies:
            if r["kind"] == self.kind:
                a, b = self.bounds[r["shard"] : r["shard"] + 2]
                bits[a:b] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=b - a).astype(bool)
        return bits[self.of]


def merged(x: tuple, y: tuple) -> tuple:
    """Two levels as one: of equal keys the least id stays; of keys with tags, two tags."""
    keys = np.concatenate([x[0], y[0]])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    if x[1] is not None:
        return keys[new], np.minimum.reduceat(np.concatenate([x[1], y[1]])[order], np.flatnonzero(new))
    keys = keys[new]
    third = np.concatenate([[False, False], keys[2:] >> np.uint64(32) == keys[:-2] >> np.uint64(32)])[: len(keys)]
    return keys[~third], None


def scan(table: pa.Table) -> pa.Table:
    """One shard: its batches become levels that merge geometrically; then every batch is scanned against them."""
    kind = table.column("kind")[0].as_py()
    arrays = []
    for r in table.to_pylist():
        ids = None
        if r["width"]:
            ids = (np.frombuffer(r["ids"], f"u{r['width']}").astype(np.uint64) + np.uint64(r["base"] % (1 << 64))).view(np.int64)
        arrays.append((r["batch"], r["shard"], np.frombuffer(r["keys"], np.uint64), ids))
    levels: list[tuple] = []
    for *_, keys, ids in arrays:
        level = keys, ids
        while levels and len(levels[-1][0]) <= 2 * len(level[0]):
            level = merged(levels.pop(), level)
        levels.append(level)
    index = levels.pop()
    while levels:
        index = merged(levels.pop(), index)
    out = []
    if kind in (LEFT, RIGHT):
        halves = index[0] >> np.uint64(32)
        several = halves[1:][halves[1:] == halves[:-1]]
    for batch, shard, keys, ids in arrays:
        if kind in (LEFT, RIGHT):
            halves = keys >> np.uint64(32)
            at = np.searchsorted(several, halves)
            bits = several[np.minimum(at, len(several) - 1)] == halves if len(several) else np.zeros(len(keys), bool)
        else:
            bits = index[1][np.searchsorted(index[0], keys)] < ids
        if bits.any():
            out.append((batch, kind, shard, np.packbits(bits).tobytes()))
    names, kinds = ("batch", "kind", "shard", "bits"), (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=list(names))


def batches(docs: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """(batch, keys, ids, texts): all rows, some two megabytes of text a row, stored in buckets by batch."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for row in rows:
            for part in text_slices(row, "text", BATCH_BYTES):
                lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(k)) for k in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists], ["batch", "keys", "ids", "texts"])
                number += 1

    rows = docs.select(F.col(key).alias("key"), F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    made = rows.mapInArrow(run, f"batch long, keys array<{kind}>, ids array<long>, texts array<string>")
    name = f"passages_{uuid.uuid4().hex}"
    path = scratch_path(docs.sparkSession, "batches")
    made.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(parts, "batch").saveAsTable(name)
    return docs.sparkSession.table(name)


def _opened(batch: Batch, shards: int) -> list[Array]:
    return [
        Array(CONTEXT, batch.context, batch.ids, shards),
        Array(LEFT, batch.left, None, shards, batch.context),
        Array(RIGHT, batch.right, None, shards, batch.context),
    ]


def _judged(batch: Batch, replies: list[dict], shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Array]:
    """Anchors that repeat with all their strings; starts and anchors of the strings to compare, and their keys."""
    context, left, right = _opened(batch, shards)
    whole = context.answers(replies) | (batch.ids > context.ids[context.of])
    low = np.where(left.answers(replies), batch.low, np.maximum(batch.low, batch.place - HALF + 1))
    high = np.where(right.answers(replies), batch.high, np.minimum(batch.high, batch.place - HALF))
    size = np.where(whole, 0, np.maximum(high - low + 1, 0))
    anchor = np.repeat(np.arange(len(size)), size)
    start = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[anchor]
    order = np.argsort(start, kind="stable")
    start, anchor = start[order], anchor[order]
    return whole, start, anchor, Array(STRING, batch.strings(start), batch.ids[anchor], shards)


def _pieces(rows: DataFrame, shards: int, first: bool) -> DataFrame:
    """The packed arrays of every batch: of its contexts and halves, or of the strings that the replies open."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = zip(*((f.split()[0], f.split()[1]) for f in _PIECES.split(", ")))
        types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        for part in parts:
            for k in range(part.num_rows):
                batch = Batch(part.column("texts")[k].values, part.column("ids")[k].values)
                if len(batch.ids):
                    made = _opened(batch, shards) if first else [_judged(batch, part.column("replies")[k].as_py(), shards)[3]]
                    found = [p for array in made for p in array.pieces(part.column("batch")[k].as_py())]
                    yield pa.RecordBatch.from_arrays([pa.array([p[c] for p in found], types[t]) for c, t in enumerate(kinds)], list(names))

    return rows.select("batch", "ids", "texts", *([] if first else ["replies"])).mapInArrow(run, _PIECES)


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept, kept_sha256) for every row; kept is what is left, as binary."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = parts_for(spark, total, SHARD_BYTES)
    rows = batches(docs, key, text, shards)

    def scanned(pieces: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        pieces.groupBy("kind", "shard").applyInArrow(scan, _REPLIES).write.option("compression", "zstd").parquet(path)
        return spark.read.schema(_REPLIES).parquet(path)

    def answered(replies: DataFrame, how: str) -> DataFrame:
        each = replies.groupBy("batch").agg(F.collect_list(F.struct("kind", "shard", "bits")).alias("replies"))
        return rows.join(each.hint("merge"), "batch", how)

    first = scanned(_pieces(rows, shards, True), "contexts")
    second = scanned(_pieces(answered(first, "inner"), shards, False), "strings")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                batch = Batch(part.column("texts")[k].values, part.column("ids")[k].values)
                edge = np.zeros(len(batch.codes) + 1, np.int64)
                if len(batch.ids):
                    replies = part.column("replies")[k].as_py() or []
                    whole, start, anchor, strings = _judged(batch, replies, shards)
                    again = start[strings.answers(replies) | (batch.ids[anchor] > strings.ids[strings.of])]
                    np.add.at(edge, np.concatenate([batch.low[whole], again]), 1)
                    np.add.at(edge, np.concatenate([batch.high[whole], again]) + LENGTH, -1)
                gone = np.cumsum(edge)[:-1] > 0
                opens = np.concatenate([[0], np.cumsum(gone & ~np.concatenate([[False], gone[:-1]]))])
                left = []
                for a, n in zip(batch.firsts.tolist(), batch.sizes.tolist()):
                    left.append(batch.codes[a : a + n][~gone[a : a + n]].astype(np.uint8).tobytes())
                spans = opens[batch.firsts + batch.sizes] - opens[batch.firsts]
                removed = batch.sizes - np.fromiter(map(len, left), np.int64, len(left))
                digests = pa.array([hashlib.sha256(x).hexdigest() for x in left])
                columns = [part.column("keys")[k].values, *(pa.array(x, pa.int64()) for x in (batch.sizes, removed, spans)), pa.array(left, pa.binary()), digests]
                yield pa.RecordBatch.from_arrays(columns, [key, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    joined = answered(first.unionAll(second), "left").select("ids", "texts", "keys", "replies")
    return joined.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
