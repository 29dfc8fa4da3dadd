"""Slices of texts against the tiktoken library, and portions of ids against whole ones."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlift.llm import byte_bpe

SIGNS = "aZé 's  \t\n\r\x1c\x85  12,.!中😀ßñ"


@pytest.fixture(scope="module")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN


@pytest.fixture(scope="module")
def real(vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    from tiktoken.load import load_tiktoken_bpe

    path, pattern = vocabulary
    return tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})


@pytest.fixture(scope="module")
def encoder(vocabulary):
    path, pattern = vocabulary
    with open(path, "rb") as f:
        return byte_bpe.Encoder(byte_bpe.read_ranks(f.read()), pattern)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=SIGNS, max_size=25) | st.text(max_size=15), max_size=6))
def test_slices_equal_the_library(encoder, real, texts):
    got = encoder.encode_all(pa.array(texts, pa.string())).to_pylist()
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [real.encode_ordinary(t) for t in texts]


def test_portions_of_any_size(vocabulary, real):
    with open(vocabulary[0], "rb") as f:
        ranks = byte_bpe.read_ranks(f.read())
    listed = [b""] * (max(ranks.values()) + 1)
    for entry, rank in ranks.items():
        listed[rank] = entry
    entries = byte_bpe.Entries(listed)
    draw = random.Random(3)
    text = "".join(draw.choice(SIGNS) for _ in range(3000))
    ids = np.array(real.encode_ordinary(text), "<u4").tobytes()
    for portion in (1, 2, 7, 65_536):
        decoder, out = byte_bpe.StreamDecoder(), []
        for data in byte_bpe.decode_ids(memoryview(ids), entries, portion):
            out.append(decoder.feed(data))
        assert "".join(out) + decoder.end() == text
