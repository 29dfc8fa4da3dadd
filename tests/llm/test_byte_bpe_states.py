"""States of the transducer: no more than beginnings of entries, whatever was encoded, and long pieces in portions."""

from __future__ import annotations

import random

import pytest

from ledgerlift.llm import byte_bpe

MERGES = ["ab", "bc", "abc", "ca", "cab", "bcab", "aa", "aab", "cc", "ccab", "abcc", "bb", "abab"]
RANKS = {bytes((b,)): b for b in range(256)} | {m.encode(): 256 + k for k, m in enumerate(MERGES)}


def merged(piece: bytes) -> list[int]:
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = min((RANKS.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [RANKS[p] for p in parts]


def drawn(n: int, longest: int) -> list[bytes]:
    draw = random.Random(5)
    return [bytes(draw.choice(b"abcx") for _ in range(draw.randrange(1, longest))) for _ in range(n)]


def test_states_are_beginnings_of_entries():
    machine = byte_bpe.Transducer(RANKS)
    for piece in drawn(3000, 30):
        whole = RANKS.get(piece)
        assert machine.encode(piece) == ([whole] if whole is not None else merged(piece))
    assert len(machine.states) <= len(machine.prefixes) + 1


@pytest.mark.parametrize("portion", [1, 2, 5, 4096])
def test_long_pieces_settle(monkeypatch, portion):
    monkeypatch.setattr(byte_bpe, "SETTLED_EVERY", portion)
    machine = byte_bpe.Transducer(RANKS)
    for piece in drawn(300, 90):
        whole = RANKS.get(piece)
        assert machine.encode(piece) == ([whole] if whole is not None else merged(piece))


def test_what_is_asked_for_often_stays():
    made = []
    kept = byte_bpe._Kept(lambda t: made.append(t) or t.encode(), 8, 64)
    for k in range(40):
        assert kept["often"] == b"often"
        kept[f"word {k}"]
    assert made.count("often") == 1 and len(kept) + len(kept.older) <= 8
