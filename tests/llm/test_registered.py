"""Registered queries and the pipeline against SQL, the tokenizer library and brute force, on odd rows."""

from __future__ import annotations

import hashlib
import re
import struct
from collections import Counter

import pytest
from compare import connect, difference
from conftest import SCHEMA, rows
from test_line_blocks import aligned_with_all
from test_texts import shingles

import corpus_pipeline
from ledgerlift.llm import queries
from ledgerlift.llm.common import stored

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows(), SCHEMA).repartition(5).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize("name", ["op1_minhash", "op6_passages"])
def test_equal_to_sql(spark, folder, name):
    # Ids as text: with a null id among them pandas would read one side as doubles.
    sql = f"SELECT * REPLACE (doc_id::VARCHAR AS doc_id) FROM ({queries.oracle_sql()[name]})"
    for where in (folder, SMALL):
        got = queries.queries()[name](spark, where)
        problem, n = difference(got.withColumn("doc_id", got["doc_id"].cast("string")), connect(where), sql)
        assert problem is None and n > 15


def token_digests(text: str | None) -> tuple:
    tokenizers = pytest.importorskip("public_tokenizers")
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    ranks = load_tiktoken_bpe(tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    token_digests.library = getattr(token_digests, "library", None) or tiktoken.Encoding("all", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = token_digests.library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_op3_equals_the_library(spark, folder):
    got = [tuple(r) for r in queries.op3_byte_bpe(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got, key=repr) == sorted(((r[0], *token_digests(r[1])) for r in rows()), key=repr)


def test_op5_measures(spark, folder):
    def measures(text: str | None) -> tuple:
        text = text or ""
        words = WORD.findall(text)
        lines = Counter(x for x in text.split("\n") if WORD.search(x))
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        twice = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        failed = len(words) < 20 or 100 * len(twice) > 30 * len(words)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        return len(words), sum(map(len, words)), symbols, sum(lines.values()) - len(lines), len(twice), failed

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    table = queries.op5_quality_rules(spark, folder)
    assert sorted((tuple(r) for r in table.select(names).collect()), key=repr) == sorted(((r[0], *measures(r[1])) for r in rows()), key=repr)
    assert table.where("base_failed AND kept").count() == 0


def test_pipeline_stage_by_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, at = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        at[name] = docs.collect()
        if name != "byte_bpe":
            assert docs.columns == columns

    def of(name: str) -> list[tuple]:
        return sorted(((r["doc_id"], r["text"]) for r in at[name] if r["doc_id"] is not None), key=repr)

    # Lines: one text an id here, every line a block of its own, so each text is cut against all earlier ones.
    before = sorted(set(of("quality_rules")))
    assert len(before) > 10
    split = [t.split("\n") for _, t in before]
    left = {}
    for k, (key, _) in enumerate(before):
        gone = aligned_with_all(split, k, 10)
        left[key] = "\n".join(x for i, x in enumerate(split[k]) if i not in gone)
    assert dict(of("line_dedup")) == {k: t for k, t in left.items() if WORD.search(t)}

    sets = {k: shingles(t, 5) for k, t in of("line_dedup")}
    root = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if v == old else v for k, v in root.items()}
    assert of("near_duplicates") == [x for x in of("line_dedup") if root[x[0]] == x[0]]

    assert set(of("mix")) <= set(of("near_duplicates")) and at["mix"]
    most = Counter(of("near_duplicates"))
    assert all(n <= 3 * most[x] for x, n in Counter(of("mix")).items())

    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in at["byte_bpe"]), key=repr)
    assert got == sorted(((r["doc_id"], *token_digests(r["text"])) for r in at["mix"]), key=repr)
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, at["byte_bpe"]), key=repr)
