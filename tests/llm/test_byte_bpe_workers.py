"""Encoder and decoder do not share a stage: their workers would change places and all come to hold an encoder."""

import base64

from ledgerlift.llm import byte_bpe


def test_encoder_and_decoder_are_in_stages_of_their_own(spark, tmp_path):
    ranks = tmp_path / "bytes.tiktoken"
    ranks.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % k for k, t in enumerate([*(bytes([b]) for b in range(256)), b"ab"])))
    docs = spark.createDataFrame([(1, "ab é"), (1, "ab é"), (None, "ba"), (3, None), (4, "")], "doc_id long, text string")
    tokens = byte_bpe.encode(docs, str(ranks), r"\s*\S+|\s+")
    decoded = byte_bpe.decode(tokens, str(ranks))
    assert decoded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert "MapInArrow" not in tokens._jdf.queryExecution().executedPlan().toString()
    got = sorted(((r.doc_id, len(r.ids) // 4, r.decoded) for r in decoded.collect()), key=str)
    assert got == sorted([(1, 4, "ab é"), (1, 4, "ab é"), (None, 2, "ba"), (3, 0, ""), (4, 0, "")], key=str)
