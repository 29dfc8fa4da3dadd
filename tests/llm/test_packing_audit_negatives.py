"""Curve packing, the source audit and hard negatives: the registered queries against SQL or brute force."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from compare import connect, difference
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlift.llm import divergence, negatives, packing, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def real(vocabulary):
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    return tokenizer


MARKS = "aZé'sSßΣİK.,!#=$3٣ \t\n\r\x0b\x1c\x85 ̸́—…中😀<|endoftext|>don't I'LL we've×"


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.text(alphabet=MARKS, max_size=30) | st.text(max_size=20), max_size=4))
def test_words_give_the_ids_of_whole_texts(vocabulary, real, texts):
    import pyarrow as pa

    ids, sizes = packing._encoder(vocabulary).encode(pa.array(texts, pa.string()), 1)
    want = [real.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_all_letters_of_the_plain_range(vocabulary, real):
    import pyarrow as pa

    texts = [form.format(chr(c)) for c in range(0x21, 0x2C80) if chr(c).isprintable() for form in ("{}", "a{}b!", "!{}'s")]
    ids, sizes = packing._encoder(vocabulary).encode(pa.array(texts, pa.string()), 1)
    want = [e.ids + [1] for e in real.encode_batch(texts, add_special_tokens=False)]
    at = 0
    for text, size, w in zip(texts, sizes.tolist(), want):
        assert ids[at : at + size].tolist() == w, text
        at += size


def check_packing(rows, texts, real, length=2048):
    """Every id in one piece, sequences without gaps, full ones but for the powers of two at the end."""
    pieces, filled = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for doc, text in texts:
        ids = real.encode(text or "", add_special_tokens=False).ids + [1]
        want[doc].append(np.array(ids, "<u4"))
    assert pieces.keys() == want.keys()
    for doc, copies in want.items():
        found = sorted(pieces[doc], key=lambda r: r["start"])
        assert sum(r["length"] for r in found) == sum(map(len, copies))
        if len(copies) == 1:
            at = 0
            for r in found:
                assert (r["start"], r["doc_tokens"]) == (at, len(copies[0]))
                at += r["length"]
                assert r["ids_crc32"] == zlib.crc32(copies[0][r["start"] : at].tobytes())
    short = 0
    for spans in filled.values():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at
            at += size
        assert at == length or (at < length and at & (at - 1) == 0)
        short += at < length
    assert short <= 11 and set(filled) == set(range(len(filled)))


def test_op11_on_whole_table(spark, real):
    rows = queries.op11_curve_packing(spark, SMALL).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check_packing(rows, texts, real)


def test_op11_odd_rows(spark, docs, no_docs, vocabulary, real):
    tokens = packing.encode(docs, vocabulary)
    pieces = packing.pack(tokens, vocabulary, length=64)
    rows = [r.asDict() | {"doc_id": r["id"]} for r in pieces.collect()]
    check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], real, 64)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(pieces).collect()}
    assert sum(map(len, whole.values())) == 4 * sum(r["length"] for r in rows)
    for r in rows:
        assert whole[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == r["ids"]
    assert packing.pack(packing.encode(no_docs, vocabulary), vocabulary).count() == 0


def test_copies_are_neighbours(spark, vocabulary):
    texts = [f"{w} and {w}s run to the {w} house" for w in ("cat", "dog", "ship", "tree")]
    rows = [(k, texts[k % 4]) for k in range(40)]
    tokens = packing.encode(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary)
    order = [r["id"] % 4 for r in packing.places(tokens, share=1).join(tokens, "row").orderBy("place").collect()]
    assert sum(a != b for a, b in zip(order, order[1:])) == 3


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_steps_to_neighbours(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), axis=-1).reshape(-1, dimensions)
    keys = packing.hilbert_key(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_rest_is_cut_into_powers_of_two():
    ends = packing.edges(2048 * 3 + 1024 + 8 + 1, 2048)
    assert np.diff(ends).tolist() == [1024, 8, 1]
    assert packing.cut(2048 * 3 - 5, 1035, 2048, ends) == [(0, 5, 2, 2043), (5, 1024, 3, 0), (1029, 6, 4, 0)]


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def document_rows():
    draw = random.Random(4)
    words = ["Alpha", "béta", "GAMMA", "delta", "Ωmega", "中文", "x", "ΣÉ", "don't", "e-mail", "İx", " "]
    rows = []
    for k in range(400):
        text = " ".join(draw.choice(words) for _ in range(draw.randrange(30)))
        rows.append((k, (text, None, "", " .,1")[min(draw.randrange(30), 3)], ("en", "en", "fr", None)[k % 4], f"s{draw.randrange(4)}", 1))
    rows += [rows[3]] * 3 + [(None, "alpha " * 5000, "en", "sÉ", 2), (1, "alpha", "en", None, 3), (2, "lonely word", "xx", "s1", 4), (3, None, "yy", "s1", 5), (4, "", "yy", "s2", 5)]
    return rows


DOCUMENTS = "doc_id long, text string, lang string, source string, n int"


def test_op12_odd_rows(spark, tmp_path):
    folder = write(spark, tmp_path, "documents", document_rows(), DOCUMENTS)
    problem, rows = difference(queries.op12_source_audit(spark, folder), connect(folder), queries.OP12_SQL)
    assert problem is None and rows > 30


def test_op12_blocks_and_shards(spark):
    docs = spark.createDataFrame(document_rows(), DOCUMENTS)
    counts = divergence.term_counts(docs, 3)
    groups = divergence.groups_of(counts)
    one = divergence.pair_values(counts, groups).collect()
    assert sorted(divergence.pair_values(counts, groups, shard_terms=2, source_block=2).collect()) == sorted(one)


def test_op12_partial_counts_are_passed_on(spark, monkeypatch):
    docs = spark.createDataFrame(document_rows(), DOCUMENTS)
    want = sorted(divergence.term_counts(docs, 1).collect())
    import pyarrow as pa

    texts = pa.RecordBatch.from_pylist([{"lang": r[2] or "", "source": r[3] or "", "text": r[1] or ""} for r in document_rows()])
    monkeypatch.setattr(divergence, "ROWS_HELD", 5)
    parts = divergence.merged([pa.Table.from_batches([b]) for b in divergence._partial(texts.slice(k, 7) for k in range(0, 410, 7))])
    assert sorted((r["lang"], r["source"], r["term"], r["n"]) for r in parts.to_pylist()) == [tuple(r)[:4] for r in want]


def test_op12_no_rows(spark, no_docs):
    assert divergence.audit(no_docs).count() == 0


EMBEDDINGS = "vec_id long, embedding array<float>, label int, row int, v string"


def vector_rows(n=600, width=20, spread=0.2):
    draw = np.random.RandomState(5)
    centres = draw.randn(10, width)
    rows = []
    for k in range(n):
        label = int(draw.randint(10))
        rows.append((k, (centres[label] * draw.randint(2) + spread * draw.randn(width)).astype(np.float32).tolist(), label, 1, "x"))
    rows[200] = (200, rows[100][1], rows[100][2], 1, "x")  # ties
    rows[300] = (300, [0.0] * width, 3, 1, "x")
    rows += [(1000, None, 1, 1, "x"), (1100, [1.0, None], 1, 1, "x"), (1200, [float("nan")] * width, 1, 1, "x"), (1300, [1.0] * width, None, 1, "x")]
    rows += [(None, [1.0] * width, 1, 1, "x"), (1400, [float("-inf")] * width, 1, 1, "x"), (1500, [1.0] * width, 77, 1, "x")]
    return rows


@pytest.mark.parametrize("spread", [0.2, 1.0])
def test_op13_odd_rows(spark, tmp_path, spread):
    folder = write(spark, tmp_path, "embeddings", vector_rows(spread=spread), EMBEDDINGS)
    problem, rows = difference(queries.op13_hard_negatives(spark, folder), connect(folder), queries.OP13_SQL)
    assert problem is None and rows > 20


def test_op13_blocks_and_shards(spark):
    from pyspark.sql import functions as F

    vectors = spark.createDataFrame(vector_rows(), EMBEDDINGS)
    rows = negatives.whole_rows(vectors, F.col("label"))
    is_anchor = F.col("vec_id") % 10 == 0
    one = negatives.mine(rows, is_anchor).collect()
    many = negatives.mine(rows, is_anchor, anchor_rows=7, shard_rows=50, least_rows=10).collect()
    assert sorted(one) == sorted(many) and len(one) > 500
    none = spark.createDataFrame([], EMBEDDINGS)
    assert negatives.mine(negatives.whole_rows(none, F.col("label")), is_anchor).count() == 0


def test_bounds_hold():
    draw = np.random.RandomState(6)
    a, b = draw.randint(-900, 900, (40, 37)), draw.randint(-900, 900, (60, 37))
    sums = [negatives.Summaries(*negatives.summary(x)) for x in (a, b)]
    scores = a @ b.T
    for low in (-10**9, 0, 2_000_000):
        found = negatives.open_pairs(*sums, np.full(40, float(low)), np.full(40, 3_000_000.0))
        want = set(zip(*np.nonzero((scores >= low) & (scores <= 3_000_000))))
        assert found is None or want <= set(zip(*found))
    for (m, d), (n, e) in zip(sums[0].levels, sums[1].levels):
        assert (np.abs(scores - m @ n.T) <= d @ e.T + 1e-3).all()
