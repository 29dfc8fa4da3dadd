"""Packing of documents into token sequences along a space-filling curve.

A document's tokens are hashed into a vector of signed counts, which is projected to a few dimensions by a
fixed random matrix. The cell of that point on a Hilbert curve orders the documents, so neighbours on the
curve use similar words. Documents are range-sorted by this key, running sums of tokens inside the ranges and
over them give every document its place in one stream, and the stream is cut into sequences of equal length.
Only what is left at the end of the stream is shorter; it is cut into powers of two, which need no padding.

Keys and token counts are sorted, not token ids: those are stored once, and shuffled once when they meet the
places. Ties on the key (copies of a document) go by id and row, so no range grows with a group of copies.

Words are encoded once a task: tokens never reach over white space, so the distinct words of a batch stand
for its texts. The cache of words has a bound and is emptied when it is full.

Defined cases
    * A null text is empty; an empty text has the end token alone. Strings of special tokens are ordinary text.
    * Rows without an id, and repeated rows, are documents of their own. An empty table gives no rows.
    * Of the input, only the two named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import parts_for, stored, text_slices

BUCKETS, DIMENSIONS, BITS = 256, 4, 15  # of the hashed vector, of the projection, of a coordinate
IDS_KEPT = 4_000_000  # token ids in a worker's cache of words
TOKENS = "row long, id long, curve long, n_tokens long, ids binary"
PIECES = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
END_ID = 1
ENCODERS: dict[str, "WordEncoder"] = {}  # of this worker

# ASCII marks but the apostrophe, which may begin a token that goes on with letters; and letters of Latin scripts
# but U+0130, whose lower case ends with a mark
MARK = r"!-&(-/:-@\[-`{-~"
LETTER = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}"

# byte-level vocabularies write a byte as a sign of its own: printable ones as they are, the others from U+0100 on, in order
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SIGNS = {b: chr(b) for b in _PRINTED} | {b: chr(0x100 + k) for k, b in enumerate(x for x in range(256) if x not in _PRINTED)}
# the letters of the Latin range, and what their lower case is: some of it lies beyond
_LATIN = {ord(x) for c in range(0x80, 0x250) for x in chr(c) + chr(c).lower() if ord(x) >= 0x80}
BYTE_SIGNS = {c: chr(c) for c in range(0x21, 0x7F)} | {c: "".join(_SIGNS[b] for b in chr(c).encode()) for c in _LATIN}


def listed(values: pa.Array) -> list:
    """Python values of an array without nulls; `to_pylist` makes a scalar object for each."""
    return values.to_numpy(zero_copy_only=False).tolist()


def split_marks(words: pa.Array) -> pa.Array:
    """Words as lists of smaller words, cut where no token of the vocabulary's pattern can go on."""
    apart = pc.replace_substring_regex(pc.ascii_lower(words), pattern=f"([{LETTER}])([{MARK}])", replacement=r"\1 \2")
    return pc.ascii_split_whitespace(pc.replace_substring_regex(apart, pattern=f"([{MARK}])([{LETTER}])", replacement=r"\1 \2"))


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of `flat` with these starts and lengths, one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class Runs:
    """Token ids of strings met so far, as runs of one growing array."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def places(self, strings: list[str], learn: Callable[[list[str]], None]) -> np.ndarray:
        """Numbers of the runs of these distinct strings; those not met before are given to `learn`, which has to add them in their order."""
        at = np.fromiter(map(self.place.get, strings, repeat(-1)), np.int64, len(strings))
        new = np.flatnonzero(at < 0)
        if len(new):
            first = len(self.starts)
            learn([strings[k] for k in new.tolist()])
            at[new] = np.arange(first, first + len(new))
        return at

    def add(self, strings: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.place.update(zip(strings, range(len(self.starts), len(self.starts) + len(strings))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths, self.flat = np.concatenate([self.lengths, lengths]), np.concatenate([self.flat, ids])


class WordEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.words, self.parts = Runs(), Runs()

    def _tokens(self, parts: list[str]) -> list[list[int]]:
        """Ids of each part. One run of Latin letters or of marks is one word to the vocabulary's pattern, so its
        merges alone are asked; all else goes through the whole tokenizer."""
        plain = listed(pc.match_substring_regex(pa.array(parts, pa.string()), f"^(?:[{LETTER}]+|[{MARK}]+)$"))
        merges = self.tokenizer.model.tokenize
        others = [p for p, is_plain in zip(parts, plain) if not is_plain]
        rest = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False))
        # ASCII letters were lowered before, and are their own signs
        return [
            [t.id for t in merges(p if p.isascii() else p.lower().translate(BYTE_SIGNS))] if is_plain else next(rest).ids
            for p, is_plain in zip(parts, plain)
        ]

    def _learn_parts(self, new: list[str]) -> None:
        ids = self._tokens(new)
        self.parts.add(new, np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))

    def _learn(self, words: list[str]) -> None:
        lists = split_marks(pa.array(words, pa.string()))
        flat = lists.flatten().dictionary_encode()
        at = self.parts.places(listed(flat.dictionary), self._learn_parts)[flat.indices.to_numpy()]
        starts, lengths = self.parts.starts[at], self.parts.lengths[at]
        edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        sums = np.concatenate([[0], np.cumsum(lengths)])[edges]
        self.words.add(words, gather(self.parts.flat, starts, lengths), np.diff(sums))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id behind it, and the number of ids of each text."""
        if len(self.words.flat) + len(self.parts.flat) > IDS_KEPT:
            self.words, self.parts = Runs(), Runs()
        lists = pc.ascii_split_whitespace(texts)
        flat = pc.list_flatten(lists).dictionary_encode()
        at = self.words.places(listed(flat.dictionary), self._learn)[flat.indices.to_numpy()]
        starts, lengths = self.words.starts[at], self.words.lengths[at]
        rows = pc.list_parent_indices(lists).to_numpy()
        sizes = np.bincount(rows, weights=lengths, minlength=len(texts)).astype(np.int64)
        ids = gather(self.words.flat, starts, lengths)
        return np.insert(ids, np.cumsum(sizes), end_id), sizes + 1


def _encoder(path: str) -> WordEncoder:
    if path not in ENCODERS:
        ENCODERS[path] = WordEncoder(path)
    return ENCODERS[path]


def hashed_signs(vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and sign of each token id, from the mixed bits of the id."""
    z = np.arange(1, vocabulary + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(32)
    return (z % np.uint64(BUCKETS)).astype(np.int64), np.where(z >> np.uint64(63), 1.0, -1.0)


def points(ids: np.ndarray, sizes: np.ndarray, buckets: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Cells of the documents on a grid of 2**BITS steps in each dimension, from hashed and projected vectors."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    vectors = np.bincount(rows * BUCKETS + buckets[ids], weights=signs[ids], minlength=len(sizes) * BUCKETS).reshape(-1, BUCKETS)
    vectors = np.sign(vectors) * np.sqrt(np.abs(vectors))  # a word said often counts for less than its number
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    projection = np.random.RandomState(20).normal(size=(BUCKETS, DIMENSIONS))
    shares = 1 / (1 + np.exp(-2 * (vectors @ projection)))  # between 0 and 1, densest in the middle
    return np.minimum((shares * 2**BITS).astype(np.int64), 2**BITS - 1)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places of grid cells on the Hilbert curve, by Skilling's transposed form (2004), all rows at once."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    step = 1 << (bits - 1)
    while step > 1:
        low = step - 1
        for i in range(n):
            high = (x[i] & step) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        step >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn, step = np.zeros_like(x[0]), 1 << (bits - 1)
    while step > 1:
        turn ^= np.where(x[n - 1] & step, step - 1, 0)
        step >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _binary(ids: np.ndarray, sizes: np.ndarray, width: str) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]) * np.dtype(width).itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.astype(width))])


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """(row, id, curve, n_tokens, ids): stored token ids of every document, with its place on the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        vocabulary = encoder.tokenizer.get_vocab_size()
        buckets, signs = hashed_signs(vocabulary)
        for batch in batches:
            for part in text_slices(batch, "text", 8_000_000):
                ids, sizes = encoder.encode(part.column("text"), end_id)
                curve = hilbert_key(points(ids, sizes, buckets, signs))
                packed = _binary(ids, sizes, _width(vocabulary)).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("id"), pa.array(curve), pa.array(sizes), packed],
                    names=["row", "id", "curve", "n_tokens", "ids"],
                )

    given = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    return stored(given.mapInArrow(run, TOKENS), "packed-ids")


def places(tokens: DataFrame, share: int = 1_000_000) -> DataFrame:
    """(row, place): where each document begins in the stream of all tokens, in the order of the curve."""

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column("n_tokens").to_numpy()
            ends = total + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.full(len(sizes), part)), pa.array(ends - sizes), batch.column("n_tokens")],
                names=["row", "part", "before", "n_tokens"],
            )
            total = int(ends[-1]) if len(ends) else total

    order = ["curve", "id", "row"]
    light = tokens.select(*order, "n_tokens")
    ranges = parts_for(tokens.sparkSession, light.count(), share)
    sorted_ = light.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    local = stored(sorted_.mapInArrow(running, "row long, part long, before long, n_tokens long"), "packed-order")
    # one row for each range: as many as `ranges`, whatever the table's size
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = local.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("earlier"))
    return local.join(F.broadcast(sums), "part").select("row", (F.col("earlier") + F.col("before")).alias("place"))


def edges(total: int, length: int) -> np.ndarray:
    """Where the sequences behind the last full one begin, and the end of the stream: a rest is cut into powers of two."""
    found = [total - total % length]
    for power in range(length.bit_length(), -1, -1):
        if (total % length) >> power & 1:
            found.append(found[-1] + (1 << power))
    return np.array(found, np.int64)


def cut(place: int, n: int, length: int, ends: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of n tokens at this place of the stream."""
    full = int(ends[0])
    out, at = [], place
    while at < place + n:
        if at < full:
            sequence, begin = divmod(at, length)[0], at - at % length
            end = begin + length
        else:
            k = int(np.searchsorted(ends, at, side="right"))
            sequence, begin, end = full // length + k - 1, int(ends[k - 1]), int(ends[k])
        stop = min(end, place + n)
        out.append((at - place, stop - at, sequence, at - begin))
        at = stop
    return out


def pack(tokens: DataFrame, tokenizer: str, length: int = 2048) -> DataFrame:
    """Pieces of documents in their sequences, with their token ids as little-endian unsigned 32-bit numbers."""
    total = tokens.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    ends = edges(total, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = _width(_encoder(tokenizer).tokenizer.get_vocab_size())
        for batch in batches:
            rows = []
            for doc, place, n, ids in zip(*(batch.column(c).to_pylist() for c in ("id", "place", "n_tokens", "ids"))):
                whole = np.frombuffer(ids, width).astype("<u4")
                for start, size, sequence, offset in cut(place, n, length, ends):
                    held = whole[start : start + size].tobytes()
                    rows.append((doc, start, size, zlib.crc32(held), n, sequence, offset, held))
            names = [x.split()[0] for x in PIECES.split(", ")]
            kinds = [pa.binary() if name == "ids" else pa.int64() for name in names]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return tokens.select("row", "id", "n_tokens", "ids").join(places(tokens), "row").drop("row").mapInArrow(run, PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): whole sequences as arrays, from at most `length` tokens each."""
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: F.hex(p["ids"])), "")
    return pieces.groupBy("sequence_id").agg(F.unhex(whole).alias("ids"))
