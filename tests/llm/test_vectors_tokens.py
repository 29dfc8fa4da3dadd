"""Top-k against brute force, and byte-level BPE against the tiktoken library."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import block_topk, byte_bpe


def test_top_k(spark):
    draw = np.random.RandomState(3)
    rows = [(k, draw.randn(8).tolist()) for k in range(300)] + [(300, None), (301, [1.0, None]), (302, [float("nan")] * 8), (None, [1.0] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = block_topk.top_k(block_topk.whole_vectors(vectors), F.col("vec_id") % 50 == 0, k=5).collect()
    whole = {k: np.floor(256 * np.array(v)) for k, v in rows[:300]}
    for q in range(0, 300, 50):
        want = sorted((-int(whole[q] @ whole[k]), k) for k in whole if k != q)[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want


def test_byte_bpe(docs):
    tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    from tiktoken.load import load_tiktoken_bpe

    ranks = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    real = tiktoken.Encoding("t", pat_str=tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(ranks), special_tokens={})
    rows = byte_bpe.decode(byte_bpe.encode(docs, ranks, tokenizers.PATTERN), ranks).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == real.encode_ordinary(texts[r["doc_id"]])
        assert r["decoded"] == texts[r["doc_id"]]
