"""Words of the packing encoder: every distinct one is looked up once, and what is new is learnt once."""

import numpy as np
import pyarrow as pa
import pytest

from ledgerlift.llm import packing


def test_new_strings_are_learnt_once_in_their_order():
    runs, learnt = packing.Runs(), []

    def learn(new):
        learnt.append(new)
        runs.add(new, np.concatenate([np.frombuffer(s.encode(), np.uint8) for s in new]).astype(np.uint32), np.array([len(s) for s in new], np.int64))

    def spelt(at):
        return ["".join(map(chr, runs.flat[runs.starts[k] : runs.starts[k] + runs.lengths[k]])) for k in at]

    for strings in (["b", "aa"], ["c", "aa", "dd", "b"], [], ["dd", "c"]):
        assert spelt(runs.places(strings, learn)) == strings
    assert learnt == [["b", "aa"], ["c", "dd"]]


def test_ids_are_those_of_the_library():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Plain words, PLAIN words", "", "É été ÉTÉ naïve!Naïve ñ İ", " \t\n", "été's 12km x&y ~~ ...", "Ⱥ Ɐ ǅ 漢字 plain"]
    for start in (0, 2):  # met before, and new
        part = texts[start:]
        ids, sizes = encoder.encode(pa.array(part, pa.string()), 1)
        whole = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in part]
        assert sizes.tolist() == list(map(len, whole))
        assert ids.tolist() == [i for w in whole for i in w]
