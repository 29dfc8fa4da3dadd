"""Line-first cleaning: rules judge each line, failing lines go, and a document that fails in too much text goes.

Rules for a line with words
    navigation   separators standing as words: at least three, and a fifth of the words
    symbols      at least three of ``#*$%&|<>``, and at least a third as many as words
    shouting     at least four words, more than half of them ending in ``!!``, or nearly all letters capital
    boilerplate  at most twelve words that hold a stock phrase of sites
    punctuation  at least thirty words without any sentence mark of Unicode, where Thai and Lao letters are at most half;
                 such a line counts as failing, but stays in a document that is kept: it may be a list or verse
A document is rejected if failing lines hold more than `most_lost` of its word characters, or if it fails the
base rules: under 20 words, or over 30 % of its words in 8-word windows that occur twice or more.

Defined cases
    * A null text counts as empty; without words a document is rejected. Lines without words are kept as they are.
    * Windows are compared by 64-bit hash. Repeated rows are judged alike, and an empty table gives none.
    * `judge` returns the key and its measures only; `clean` returns the input's columns, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: White space to str.split() that is part of a word here.
INNER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
SYMBOLS = "#*$%&|<>"
SEPARATORS = {"|", ">", "»", "·", "•", "/", "::", "<", "«"}
#: Sentence_Terminal of Unicode, and marks beside it: Armenian, Greek, Tibetan, the ellipsis.
MARKS = re.compile(
    "[!.?\u0589\u061d-\u061f\u06d4\u0700-\u0702\u07f9\u0837\u0839\u083d\u083e\u0964\u0965\u104a\u104b\u1362\u1367\u1368\u166e\u1735\u1736"
    "\u17d4\u17d5\u1803\u1809\u1944\u1945\u1aa8-\u1aab\u1b4e\u1b4f\u1b5a\u1b5b\u1b5e\u1b5f\u1b7d-\u1b7f\u1c3b\u1c3c\u1c7e\u1c7f\u2024\u203c\u203d"
    "\u2047-\u2049\u2cf9-\u2cfb\u2e2e\u2e3c\u2e53\u2e54\u3002\ua4ff\ua60e\ua60f\ua6f3\ua6f7\ua876\ua877\ua8ce\ua8cf\ua92f\ua9c8\ua9c9"
    "\uaa5d-\uaa5f\uaaf0\uaaf1\uabeb\ufe12\ufe15\ufe16\ufe52\ufe56\ufe57\uff01\uff0e\uff1f\uff61\U00010a56\U00010a57\U00010f55-\U00010f59"
    "\U00010f86-\U00010f89\U00011047\U00011048\U000110be-\U000110c1\U00011141-\U00011143\U000111c5\U000111c6\U000111cd\U000111de\U000111df"
    "\U00011238\U00011239\U0001123b\U0001123c\U000112a9\U0001144b\U0001144c\U000115c2\U000115c3\U000115c9-\U000115d7\U00011641\U00011642"
    "\U0001173c-\U0001173e\U00011944\U00011946\U00011a42\U00011a43\U00011a9b\U00011a9c\U00011c41\U00011c42\U00011ef7\U00011ef8"
    "\U00011f43\U00011f44\U00016a6e\U00016a6f\U00016af5\U00016b37\U00016b38\U00016b44\U00016e98\U0001bc9f\U0001da88"
    "…\u055c\u055e\u037e\u0f0d\u0f0e]"
)
#: Scripts whose sentences need no mark: Thai, Lao.
UNMARKED = re.compile("[\u0e00-\u0eff]")
STOCK = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "sign up for our newsletter",
    "subscribe to our",
    "skip to content",
    "enable javascript",
    "powered by",
    "follow us on",
    "share this",
    "back to top",
)
WINDOW = 8
ROWS_OUT = 512

_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(0xD6E8FEB86659FD93, k, 1 << 64) for k in range(WINDOW)], dtype=np.uint64)


def words_of(text: str) -> list[str]:
    return WORDS.findall(text) if INNER_SPACE.search(text) else text.split()


def repeat_words(words: list[str]) -> int:
    """Words inside windows of eight that occur twice or more."""
    if len(words) <= WINDOW:
        return 0
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.uint64, count=len(words))
    ids = (ids + np.uint64(1)) * _MIX
    ids ^= ids >> np.uint64(29)
    ids *= np.uint64(0xBF58476D1CE4E5B9)
    ids ^= ids >> np.uint64(32)
    n = len(words) - WINDOW + 1
    windows = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        windows += ids[k : k + n] * _POWERS[k]
    order = np.argsort(windows)
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, dtype=np.int64)
    again[order[1:][same]] = 1
    again[order[:-1][same]] = 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[:n] += again
    edge[WINDOW : WINDOW + n] -= again
    return int((np.cumsum(edge) > 0).sum())


def line_fails(line: str, words: list[str]) -> bool:
    n = len(words)
    symbols = sum(map(line.count, SYMBOLS))
    if symbols >= 3:
        if 3 * symbols >= n:
            return True
    if n >= 4:
        separators = sum(w in SEPARATORS for w in words)
        if separators >= 3 and 5 * separators >= n:
            return True
        if line.count("!!") and 2 * sum(w.endswith("!!") for w in words) > n:
            return True
        if line.isupper() and sum(map(str.isalpha, line)) > 20:
            return True
    if n <= 12:
        low = line.lower()
        if any(phrase in low for phrase in STOCK):
            return True
    return False


def unmarked(line: str, n: int) -> bool:
    """A long line without any sentence mark, in a script that has such marks."""
    return n >= 30 and not MARKS.search(line) and 2 * len(UNMARKED.findall(line)) <= sum(map(str.isalpha, line))


def measure(text: str | None, most_lost: float) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, clean text)."""
    text = text or ""
    all_words: list[str] = []
    seen: set[str] = set()
    kept, lost, copies = [], 0, 0
    for line in text.split("\n"):
        words = words_of(line)
        if words:
            if line in seen:
                copies += 1
            seen.add(line)
            all_words += words
            if line_fails(line, words):
                lost += sum(map(len, words))
                continue
            if unmarked(line, len(words)):
                lost += sum(map(len, words))
        kept.append(line)
    chars, n, repeats = sum(map(len, all_words)), len(all_words), repeat_words(all_words)
    failed = n < 20 or 100 * repeats > 30 * n
    return n, chars, sum(map(text.count, SYMBOLS)), copies, repeats, failed, not failed and lost <= most_lost * chars, "\n".join(kept)


MEASURES = (
    ("n_words", "long"),
    ("word_chars", "long"),
    ("n_symbols", "long"),
    ("n_dup_lines", "long"),
    ("n_repeat_words", "long"),
    ("base_failed", "boolean"),
    ("kept", "boolean"),
)
_TYPES = {"long": pa.int64(), "boolean": pa.bool_()}


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", most_lost: float = 0.5) -> DataFrame:
    """(key, measures, clean_text) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(start, ROWS_OUT)
                found = list(zip(*(measure(t, most_lost) for t in part.column(1).to_pylist())))
                columns = [pa.array(x, _TYPES[kind]) for x, (_, kind) in zip(found, MEASURES)]
                names = [key, *(n for n, _ in MEASURES), "clean_text"]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, pa.array(found[-1], pa.string())], names)

    kind = docs.schema[key].dataType.simpleString()
    fields = ", ".join(f"{n} {k}" for n, k in MEASURES)
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, {fields}, clean_text string")


def clean(docs: DataFrame, text: str = "text", most_lost: float = 0.5) -> DataFrame:
    """The documents that are kept, with all their columns and without the failing lines."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(start, ROWS_OUT)
                found = [measure(t, most_lost) for t in part.column(at).to_pylist()]
                kept = part.set_column(at, text, pa.array([x[-1] for x in found], part.schema.field(at).type))
                yield kept.filter(pa.array([x[-2] for x in found]))

    return docs.mapInArrow(run, docs.schema)
