"""Byte-level BPE encoding with a lazily determinised transducer, and streaming decoding.

Encoding. A sequence of tokens is the BPE encoding of its bytes exactly if each neighbouring pair is the
encoding of its own bytes, so the encoding of every prefix is found from shorter prefixes: its last token is
the one whose pair with the token before it holds. The transducer reads a byte at a time. Its state is what it
has read last, as far as a vocabulary entry can still continue from it, so there are no more states than
beginnings of entries; a move names the entries that end with its byte. The last tokens of the prefixes that end
inside the open bytes are its registers, as they depend on the tokens before. In a long piece, tokens on which all open
boundaries agree are emitted, so registers are bounded. States and moves are made when first needed and kept for the life of the worker.

Texts come a slice at a time. Between single spaces they fall apart into stretches that are split by
themselves, so the distinct stretches of a slice are split, their distinct pieces encoded and the ids gathered for every text.
Short pieces go through the transducer side by side, a byte of each at a time; long ones alone.

Decoding. Ids are turned to bytes in chunks; a UTF-8 state machine follows the bytes and holds back an
unfinished character until the next chunk.

Defined cases
    * A null text is encoded as empty; empty gives no ids. Rows are independent, so repeated rows and ties
      get equal results, and a text may be of any length. An empty table gives an empty table.
    * Results carry the key column, `ids` (unsigned 32-bit little-endian) and `decoded` only: columns of the
      input with these names are not read.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import stored, text_slices

STATES_KEPT = 250_000
PAIRS_KEPT = 500_000
LONG_KEPT = 20_000
SLICE_BYTES = 2_000_000
ROWS_OUT = 512
LONG_TEXT = 1_000_000
LONG_PIECE = 128
SETTLED_EVERY = 4096
CELLS = 2_000_000  # last tokens of pieces that go side by side
GATHERED = 65_536  # parts whose ids are copied at once


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Entries of a rank file: base64 of the bytes, a space, the rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}


def gathered(flat: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `flat` with the numbers `at`, one after the other, and where each ends."""
    starts, lengths = np.cumsum(sizes) - sizes, sizes[at]
    ends = np.cumsum(lengths)
    out = np.empty(ends[-1] if len(ends) else 0, flat.dtype)
    for k in range(0, len(at), GATHERED):
        these, stops = lengths[k : k + GATHERED], ends[k : k + GATHERED]
        low, high = stops[0] - these[0], stops[-1]
        out[low:high] = flat[np.repeat(starts[at[k : k + GATHERED]] - (stops - these), these) + np.arange(low, high)]
    return out, ends


class Numbers:
    """A number for each 64-bit key, in arrays: the first free place from a key's own on, at most half of the places taken."""

    FREE = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, bits: int = 16):
        self.bits, self.used = bits, 0
        self.keys, self.values = np.full(1 << bits, self.FREE), np.zeros(1 << bits, np.int32)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """-1 for unknown keys."""
        places = self._places(keys)
        there = self.keys[places]
        same = there == keys
        out = np.where(same, self.values[places], -1)
        left = np.flatnonzero(~same & (there != self.FREE))
        places = places[left]
        while len(left):
            places = (places + 1) & (len(self.keys) - 1)
            there = self.keys[places]
            same = there == keys[left]
            out[left[same]] = self.values[places[same]]
            on = ~same & (there != self.FREE)
            left, places = left[on], places[on]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not there yet."""
        self.used += len(keys)
        if 2 * self.used > len(self.keys):
            taken = self.keys != self.FREE
            keys, values = np.concatenate([self.keys[taken], keys]), np.concatenate([self.values[taken], values])
            self.bits = (2 * self.used - 1).bit_length()
            self.keys, self.values = np.full(1 << self.bits, self.FREE), np.zeros(1 << self.bits, np.int32)
        places = self._places(keys)
        while len(keys):
            free = self.keys[places] == self.FREE
            self.keys[places[free]] = keys[free]
            in_place = self.keys[places] == keys
            self.values[places[in_place]] = values[in_place]
            keys, values, places = keys[~in_place], values[~in_place], (places[~in_place] + 1) & (len(self.keys) - 1)


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.entry = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.entry[r] = t
        self.size = [len(t) for t in self.entry]
        self.sizes = np.array(self.size)
        self.prefixes = {t[:n] for t in ranks for n in range(1, len(t))}
        #: The two entries whose merge makes an entry; single bytes have none.
        self.halves: list[tuple[int, int] | None] = [None] * len(self.entry)
        #: An entry that its own merges do not rebuild occurs only as a whole piece. Found when first asked for.
        self.rebuilt: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        self.pair_table = Numbers()
        self.long = _Kept(self.encode, LONG_KEPT, 1024)
        self._forget()

    def _forget(self) -> None:
        self.states: list[bytes] = [b""]
        self.number: dict[bytes, int] = {b"": 0}
        self.moves: dict[int, tuple[int, tuple]] = {}
        #: The same for pieces side by side: numbers of moves; of each move the next state and the first of its entries; the entries.
        self.move_table = Numbers()
        self.move_to, self.move_ends = array("q"), array("q", [0])
        self.end_token, self.end_size = array("i"), array("i")

    def _built(self, rank: int) -> bool:
        known = self.rebuilt.get(rank)
        if known is None:
            known = self.rebuilt[rank] = self._rebuild(self.entry[rank], rank)
        return known

    def _halves(self, rank: int) -> tuple[int, int] | None:
        self._built(rank)
        return self.halves[rank]

    def _rebuild(self, entry: bytes, rank: int) -> bool:
        """Merge the bytes of one entry, lowest rank first, leftmost among equals; notes the last merge."""
        parts, ranks = [entry[i : i + 1] for i in range(len(entry))], self.ranks
        while len(parts) > 1:
            best, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == 1 << 60:
                return False
            if len(parts) == 2:
                self.halves[rank] = (ranks[parts[0]], ranks[parts[1]])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    def holds(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes.

        Their merges are undone, latest first; a merge over the seam that would have come before the one
        just undone shows that they are not.
        """
        if left < 0:
            return True
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 4 * STATES_KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self._seam_holds(left, right)
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        ranks, entry, before = self.ranks, self.entry, 1 << 60
        while True:
            if ranks.get(entry[left] + entry[right], 1 << 60) < before:
                return False
            a, b = self._halves(left), self._halves(right)
            if a is None and b is None:
                return True
            # Among merges of equal rank the left one comes first, so undoing the right one comes before it.
            if b is None or (a is not None and left > right):
                before, left = left, a[1]
            else:
                before, right = right + 1, b[0]

    def _move(self, state: int, byte: int) -> tuple[int, tuple]:
        """The next state, and the entries that end with this byte, longest first."""
        read, ranks, prefixes = self.states[state] + bytes((byte,)), self.ranks, self.prefixes
        n = len(read)
        ends = tuple([(ranks[read[i:]], n - i) for i in range(n) if read[i:] in ranks and self._built(ranks[read[i:]])])
        if not ends:
            raise ValueError("the vocabulary lacks a byte")
        left = next((read[i:] for i in range(n) if read[i:] in prefixes), b"")
        to = self.number.get(left)
        if to is None:
            to = self.number[left] = len(self.states)
            self.states.append(left)
        return to, ends

    def _kept_move(self, state: int, byte: int) -> tuple[int, tuple]:
        self.moves[state << 8 | byte] = move = self._move(state, byte)
        return move

    def _numbered_move(self, key: int) -> int:
        to, ends = self._move(key >> 8, key & 0xFF)
        self.move_to.append(to)
        self.end_token.extend([token for token, _ in ends])
        self.end_size.extend([n for _, n in ends])
        self.move_ends.append(len(self.end_token))
        return len(self.move_to) - 1

    def _moves_of(self, keys: np.ndarray) -> np.ndarray:
        found = self.move_table.get(keys)
        if (found < 0).any():
            new = np.unique(keys[found < 0])
            self.move_table.put(new, np.array(list(map(self._numbered_move, new.tolist())), np.int32))
            found = self.move_table.get(keys)
        return found

    def _hold(self, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        keys = lefts.astype(np.uint64) << np.uint64(32) | rights.astype(np.uint64)
        found = self.pair_table.get(keys)
        if (found < 0).any():
            new = np.unique(keys[found < 0])
            held = np.array([self._seam_holds(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()], np.int32)
            found[found < 0] = held[np.searchsorted(new, keys[found < 0])]
            if self.pair_table.used > PAIRS_KEPT:
                self.pair_table = Numbers()
                held, new = held[:PAIRS_KEPT], new[:PAIRS_KEPT]
            self.pair_table.put(new, held)
        return found == 1

    def _side_by_side(self, line: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pieces of `line`, longest first: the last token of each, then the one before it of each that has more, and so on."""
        lasts = np.empty((lengths[0] + 1, len(lengths)), np.int32)
        lasts[0] = -1
        state = np.zeros(len(lengths), np.uint64)
        for at in range(lengths[0]):
            n = int(np.searchsorted(-lengths, -at))
            move = self._moves_of(state[:n] << np.uint64(8) | line[starts[:n] + at])
            state[:n] = np.frombuffer(self.move_to, np.int64)[move]
            end, stop = (np.frombuffer(self.move_ends, np.int64)[move + k] for k in (0, 1))
            left = np.arange(n)
            while len(left):
                if (end == stop).any():
                    raise ValueError("no entry continues the encoding")
                token = np.frombuffer(self.end_token, np.int32)[end]
                before = lasts[at + 1 - np.frombuffer(self.end_size, np.int32)[end], left]
                holds = before < 0
                seams = np.flatnonzero(~holds)
                holds[seams] = self._hold(before[seams], token[seams])
                lasts[at + 1, left[holds]] = token[holds]
                left, end, stop = left[~holds], end[~holds] + 1, stop[~holds]
        out, left, to = [], np.arange(len(lengths)), lengths
        while len(left):
            token = lasts[to, left]
            out.append((left, token))
            to = to - self.sizes[token]
            left, to = left[to > 0], to[to > 0]
        return out

    def encode_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all pieces, one after the other, and how many each has."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        counts = np.where(lengths > 0, 1, 0)
        line, starts = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(lengths) - lengths
        alone = {k: np.array(self.long[pieces[k]], "<u4") for k in np.flatnonzero((whole < 0) & (lengths > LONG_PIECE)).tolist()}
        for k, ids in alone.items():
            counts[k] = len(ids)
        short = np.flatnonzero((whole < 0) & (lengths > 0) & (lengths <= LONG_PIECE))
        short = short[np.argsort(-lengths[short], kind="stable")]
        tokens = []
        while len(short):
            if self.move_table.used > STATES_KEPT:
                self._forget()
            these, short = np.split(short, [CELLS // (int(lengths[short[0]]) + 1)])
            for n, (left, token) in enumerate(self._side_by_side(line, starts[these], lengths[these])):
                counts[these[left]] = n + 1
                tokens.append((these[left], n + 1, token))
        ends = np.cumsum(counts)
        out = np.empty(ends[-1] if len(ends) else 0, "<u4")
        out[ends[whole >= 0] - 1] = whole[whole >= 0]
        for which, back, token in tokens:
            out[ends[which] - back] = token
        for k, ids in alone.items():
            out[ends[k] - len(ids) : ends[k]] = ids
        return out, counts

    def _path(self, lasts: list, to: int) -> list[int]:
        """Tokens from the settled boundary up to `to`."""
        out = []
        while to > 0:
            out.append(lasts[to])
            to -= self.size[lasts[to]]
        return out[::-1]

    def _agreed(self, lasts: list, live: int) -> int:
        """The last boundary on the ways to all of the last `live` + 1 boundaries."""
        ways, size = set(range(len(lasts) - 1 - live, len(lasts))), self.size
        while len(ways) > 1:
            at = max(ways)
            ways.remove(at)
            ways.add(at - size[lasts[at]])
        return ways.pop()

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.moves) > STATES_KEPT:
            self._forget()
        out: list[int] = []
        state, known, lasts, at, pairs = 0, self.moves.get, [-1], 0, self.pairs.get
        for start in range(0, len(piece), SETTLED_EVERY):
            if start:
                shared = self._agreed(lasts, len(self.states[state]))
                out += self._path(lasts, shared)
                lasts = lasts[shared:]
                at -= shared
            for byte in piece[start : start + SETTLED_EVERY]:
                state, ends = known(state << 8 | byte) or self._kept_move(state, byte)
                at += 1
                for token, n in ends:
                    last = lasts[at - n]
                    if last < 0:
                        break
                    holds = pairs(last << 32 | token)
                    if holds or (holds is None and self.holds(last, token)):
                        break
                else:
                    raise ValueError("no entry continues the encoding")
                lasts.append(token)
        return out + self._path(lasts, at)


class _Kept(dict):
    """What is made of a text, kept while there is room; what was not asked for since half of the room was filled goes first."""

    def __init__(self, make, most: int, longest: int):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest
        self.older: dict = {}

    def __missing__(self, text):
        ids = self.older.get(text)
        if ids is None:
            ids = self.make(text)
        if len(text) <= self.longest:
            if len(self) >= self.most // 2:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


class _Numbered(dict):
    """Texts with numbers in the order of their first being asked for."""

    def __missing__(self, text: str) -> int:
        number = self[text] = len(self)
        return number


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        # White space is Unicode's White_Space, which leaves out the separators U+001C to U+001F.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.machine = Transducer(ranks)

    def _split_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are split by themselves, one after the other, and how many each has."""
        numbers, at, pieces = _Numbered(), array("i"), []
        for text in texts:
            found = self.split.findall(text) if len(text) < LONG_TEXT else (m[0] for m in self.split.finditer(text))
            at.extend(map(numbers.__getitem__, found))
            pieces.append(len(at))
        ids, counts = self.machine.encode_many([p.encode() for p in numbers])
        del numbers
        out, ends = gathered(ids, counts, np.frombuffer(at, np.int32))
        return out, np.diff(np.concatenate([[0], ends])[pieces], prepend=0)

    def encode_all(self, texts: pa.Array) -> pa.Array:
        """Packed ids of every text of a slice."""
        # A match holds a space only at its start or among other white space, and a lone space before
        # anything else always starts one: stretches between such spaces can be split by themselves.
        plain = pc.and_(pc.invert(pc.match_substring(texts, "  ")), pc.invert(pc.ends_with(texts, " ")))
        plain = pc.and_(plain, pc.greater(pc.binary_length(texts), 0))
        lists = pc.split_pattern(texts.filter(plain), " ")
        stretches, firsts = pc.list_flatten(lists), np.cumsum(pc.list_value_length(lists).to_numpy())
        # what follows a space takes it along: all but the first stretch of a text
        first = np.zeros(len(stretches), bool)
        first[np.concatenate([[0], firsts[:-1]]).astype(np.int64)[: len(firsts)]] = True
        spaced = pc.if_else(pa.array(first), "", " ")
        stretches = pc.binary_join_element_wise(spaced, stretches, "").dictionary_encode()
        del lists, spaced
        ids, ends = gathered(*self._split_all(stretches.dictionary.to_pylist()), stretches.indices.to_numpy())
        out = _packed(ids, np.concatenate([[0], ends])[firsts])
        if len(out) == len(texts):
            return out
        ids, counts = self._split_all(texts.filter(pc.invert(plain)).to_pylist())
        rest = _packed(ids, np.cumsum(counts))
        place = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(pc.invert(plain))]), kind="stable")
        return pa.concat_arrays([out, rest]).take(pa.array(place))


def _packed(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    edges = 4 * np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(edges), pa.py_buffer(ids)]).cast(pa.binary())


class Utf8Machine:
    """How many bytes the open character still lacks, and the range its next byte must be in."""

    def __init__(self):
        self.lacks, self.low, self.high = 0, 0x80, 0xBF

    def feed(self, byte: int) -> bool:
        """False where the byte cannot follow."""
        if self.lacks:
            if not self.low <= byte <= self.high:
                return False
            self.lacks, self.low, self.high = self.lacks - 1, 0x80, 0xBF
            return True
        if byte < 0x80:
            return True
        if not 0xC2 <= byte <= 0xF4:
            return False
        self.lacks = 1 + (byte >= 0xE0) + (byte >= 0xF0)
        self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
        self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
        return True


class StreamDecoder:
    """Feed bytes in any portions; whole characters come out, what can't be decoded as U+FFFD."""

    def __init__(self):
        self.open = b""

    def feed(self, data: bytes) -> str:
        data = self.open + data
        cut = len(data)
        # The last character may be open: its first byte is among the last three.
        for back in range(1, min(3, len(data)) + 1):
            if data[-back] & 0xC0 != 0x80:
                machine = Utf8Machine()
                if all(machine.feed(b) for b in data[-back:]) and machine.lacks:
                    cut = len(data) - back
                break
        self.open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


class Entries:
    """The bytes of all vocabulary entries, one after the other."""

    def __init__(self, entries: list[bytes]):
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.lengths = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.lengths) - self.lengths


def decode_ids(ids: memoryview, entries: Entries, portion: int = 65_536) -> Iterator[bytes]:
    """Bytes of the ids, a portion at a time."""
    numbers = np.frombuffer(ids, "<u4")
    for start in range(0, len(numbers), portion):
        these = numbers[start : start + portion]
        lengths = entries.lengths[these]
        ends = np.cumsum(lengths)
        yield entries.flat[np.repeat(entries.starts[these] - (ends - lengths), lengths) + np.arange(ends[-1])].tobytes()


_encoders: dict[tuple[str, str], Encoder] = {}
_entries: dict[str, Entries] = {}


def _rows_out(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, ROWS_OUT):
        yield batch.slice(start, ROWS_OUT)


def _shared(df: DataFrame, path: str):
    """The rank file is read once by the driver: a vocabulary is of fixed size (about 1 MB)."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) for every row, stored; ids as packed unsigned 32-bit numbers, without special tokens.

    Whatever comes next starts in a stage of its own. Two Python steps in one stage take two workers a core, which
    change places from task to task, so that in the end all of them hold an encoder.
    """
    lines = _shared(docs, path)
    kept = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get((path, pattern))
        if encoder is None:
            encoder = _encoders[path, pattern] = Encoder(read_ranks(lines.value), pattern)
        gc.disable()  # nothing made here refers back to itself, and the kept states are many
        try:
            for batch in batches:
                for part in text_slices(batch, batch.schema.names[1], SLICE_BYTES):
                    yield pa.RecordBatch.from_arrays([part.column(0), encoder.encode_all(part.column(1))], [key, "ids"])
        finally:
            gc.enable()
            pa.default_memory_pool().release_unused()

    kind = docs.schema[key].dataType.simpleString()
    return stored(kept.mapInArrow(run, f"`{key}` {kind}, ids binary"), "ids")


def decode(tokens: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the text of the ids, character by character through the UTF-8 machine."""
    lines = _shared(tokens, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _entries.get(path)
        if entries is None:
            ranks = read_ranks(lines.value)
            listed = [b""] * (max(ranks.values()) + 1)
            for entry, rank in ranks.items():
                listed[rank] = entry
            entries = _entries[path] = Entries(listed)
        for batch in batches:
            for part in _rows_out(batch):
                texts = []
                for ids in part.column(1).to_pylist():
                    decoder, out = StreamDecoder(), []
                    for data in decode_ids(memoryview(ids), entries):
                        out.append(decoder.feed(data))
                    out.append(decoder.end())
                    texts.append("".join(out))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [key, "ids", "decoded"])

    kind = tokens.schema[key].dataType.simpleString()
    return tokens.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, ids binary, decoded string")


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    return decoded.select(
        key,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
