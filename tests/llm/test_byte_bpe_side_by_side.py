"""Pieces side by side against the same pieces alone, with groups, tables and portions of any size."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerlift.llm import byte_bpe
from test_byte_bpe_states import RANKS, drawn, merged


def test_numbers_by_key():
    draw = random.Random(1)
    keys = np.array(draw.sample(range(1 << 40), 5000), np.uint64)
    table = byte_bpe.Numbers(bits=2)
    for k in range(0, 5000, 700):
        table.put(keys[k : k + 700], np.arange(k, min(k + 700, 5000), dtype=np.int32))
        assert table.get(keys).tolist() == [*range(min(k + 700, 5000)), *[-1] * (5000 - min(k + 700, 5000))]


@pytest.mark.parametrize("cells, long, pairs, states", [(2_000_000, 128, 500_000, 250_000), (200, 10, 3, 0), (100, 40, 7, 5)])
def test_pieces_side_by_side(monkeypatch, cells, long, pairs, states):
    for name, value in (("CELLS", cells), ("LONG_PIECE", long), ("PAIRS_KEPT", pairs), ("STATES_KEPT", states)):
        monkeypatch.setattr(byte_bpe, name, value)
    machine = byte_bpe.Transducer(RANKS)
    pieces = [*drawn(1500, 60), b"", b"a", b"abc" * 300, b"x" * 5000]
    for _ in range(2):
        ids, counts = machine.encode_many(pieces)
        split = np.split(ids, np.cumsum(counts)[:-1])
        assert [s.tolist() for s in split] == [[RANKS[p]] if p in RANKS else merged(p) if p else [] for p in pieces]
        assert len(machine.states) <= len(machine.prefixes) + 1
    assert [x.tolist() for x in machine.encode_many([])] == [[], []]


def test_short_pieces_are_not_taken_one_by_one(monkeypatch):
    alone = []
    monkeypatch.setattr(byte_bpe.Transducer, "encode", lambda self, piece: alone.append(piece) or merged(piece))
    encoder = byte_bpe.Encoder(RANKS, r" ?\p{L}+|\s+")
    got = encoder.encode_all(pa.array(["abcab cabca  bcabab", "bcab abcabcabcab", "", "a" * 200], pa.string())).to_pylist()
    for ids, pieces in zip(got, (["abcab", " cabca", "  ", "bcabab"], ["bcab", " abcabcabcab"], [], ["a" * 200])):
        assert np.frombuffer(ids, "<u4").tolist() == [t for p in pieces for t in merged(p.encode())]
    assert alone == [b"a" * 200]


def test_runs_are_gathered_in_portions(monkeypatch):
    monkeypatch.setattr(byte_bpe, "GATHERED", 3)
    draw = random.Random(2)
    sizes = np.array([draw.randrange(4) for _ in range(20)])
    runs = [[100 * k + j for j in range(n)] for k, n in enumerate(sizes)]
    at = np.array([draw.randrange(20) for _ in range(50)])
    out, ends = byte_bpe.gathered(np.array([x for r in runs for x in r], "<u4"), sizes, at)
    assert out.tolist() == [x for k in at for x in runs[k]] and ends.tolist() == np.cumsum(sizes[at]).tolist()
