"""Blocks of lines against brute force."""

from __future__ import annotations

import random

import numpy as np

from ledgerlift.llm import line_dedup


def left(spark, texts: list[str], **how) -> list[str]:
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["line_dedup"]["left"] for r in sorted(line_dedup.with_lines_left(rows, **how).collect(), key=lambda r: r["doc_id"])]


def test_block_whose_lines_were_each_seen_before(spark):
    """Every line of the passage is first in another document; only the third document holds the block."""
    passage = ["the first line", "the second line", "the third line", "the fourth line"]
    others = [f"alone {k} before\n{line}\nalone {k} after" for k, line in enumerate(passage)]
    texts = [*others, "\n".join(["own start", *passage, "own end"]), "\n".join(["a late start", *passage, "a late end"])]
    assert left(spark, texts) == [*texts[:5], "a late start\na late end"]


def held(texts: list[list[str]], k: int, block_words: int) -> set:
    """Lines of text k in any run with enough words that an earlier text holds as a run."""
    own, gone = texts[k], set()
    for a in range(len(own)):
        for b in range(a + 1, len(own) + 1):
            if sum(len(x.split()) for x in own[a:b]) >= block_words:
                if any(t[i : i + b - a] == own[a:b] for t in texts[:k] for i in range(len(t))):
                    gone.update(range(a, b))
    return gone


def test_passages_repeated_in_a_document(spark):
    """Short texts of few lines, so lines and passages come again; blocks in order of the first are only more."""
    draw = random.Random(5)
    lines = ["", "one", "two words", "three words here", "four words stand here", "and five words stand here"]
    texts = [[draw.choice(lines) for _ in range(draw.randint(1, 9))] for _ in range(60)]
    texts[1:1] = [["a b c d", "e f g h", "i j k l"], ["a b c d", "e f g h", "i j k l", "other", "a b c d", "e f g h", "i j k l"]]
    unique = [t for k, t in enumerate(texts) if t not in texts[:k] and t != [""]]
    rows = spark.createDataFrame([(k, "\n".join(t)) for k, t in enumerate(unique)], "doc_id long, text string")
    got = {r["id"]: set(r["gone"]) for r in line_dedup.cuts(rows).collect()}
    assert got[2] == {0, 1, 2, 4, 5, 6}
    for k, t in enumerate(unique):
        sure = held(unique, k, 10)
        more = {i for f in unique[:k] for a, b in line_dedup.patience(t, f) if sum(len(x.split()) for x in t[a:b]) >= 10 for i in range(a, b)}
        assert sure <= got.get(k, set()) <= sure | more


def test_gaps_are_searched_again():
    assert line_dedup.patience([1, 2, 3, 9, 1, 2, 3], [1, 2, 3]) == [(0, 3)]
    # 7 anchors; 5 and 6 occur twice in each document, but once on each side of it.
    assert line_dedup.patience([0, 5, 6, 8, 7, 8, 5, 6, 0], [1, 5, 6, 2, 7, 3, 5, 6, 1]) == [(1, 3), (4, 5), (6, 8)]
    # No line occurs once in the gap, but the pair does.
    assert line_dedup.patience([8, 1, 2, 2, 1, 8, 8], [9, 2, 2, 9, 1, 2, 9, 1]) != []
    draw = random.Random(2)
    for _ in range(500):
        later, first = ([draw.randint(0, 4) for _ in range(draw.randint(0, 9))] for _ in range(2))
        rest = iter(first)
        assert all(x in rest for a, b in line_dedup.patience(later, first) for x in later[a:b])


def test_in_a_pair_every_common_block_goes():
    draw = random.Random(3)
    for _ in range(500):
        later, first = ([draw.randint(0, 4) for _ in range(draw.randint(1, 9))] for _ in range(2))
        texts = [[" ".join([str(x)] * x) for x in t] for t in (first, later)]
        assert held(texts, 1, 6) <= set(line_dedup.common_lines(later, later, first, 6))


def test_run_hashes_follow_the_lines():
    draw = np.random.RandomState(1)
    lines, words = draw.randint(0, 4, 60).astype(np.uint64), draw.randint(0, 5, 60)
    starts, ends = line_dedup.heavy_runs(words, 6)
    assert all(words[a:b].sum() >= 6 and min(words[a + 1 : b].sum(), words[a : b - 1].sum()) < 6 for a, b in zip(starts, ends))
    known = {}
    for a, b, x in zip(starts, ends, line_dedup.run_hashes(lines, starts, ends).tolist()):
        assert known.setdefault(x, tuple(lines[a:b])) == tuple(lines[a:b])
    assert len(known) == len(set(known.values()))


def aligned_with_all(texts: list[list[str]], k: int, block_words: int) -> set:
    """Lines of text k that go when it is aligned with every earlier text."""
    number = {x: n for n, x in enumerate(sorted({x for t in texts for x in t}))}
    coded = [[number[x] for x in t] for t in texts]
    words = [len(x.split()) for x in texts[k]]
    found = {i for f in coded[:k] for a, b in line_dedup.patience(coded[k], f) if sum(words[a:b]) >= block_words for i in range(a, b)}
    return found | held(texts, k, block_words)


def test_few_texts_equal_alignment_with_all(spark):
    """No line is in more than `rare` texts, so every two texts that share one are aligned."""
    lines = [f"line {k} of five words" if k % 2 else f"line {k} is long and has some ten words in all" for k in range(9)]
    for seed in range(4):
        draw = random.Random(seed)
        texts = [draw.sample(lines, draw.randint(2, 7)) for _ in range(8)]
        texts = [t for k, t in enumerate(texts) if t not in texts[:k]]
        rows = spark.createDataFrame([(k, "\n".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
        got = {r["id"]: set(r["gone"]) for r in line_dedup.cuts(rows).collect()}
        assert got == {k: x for k in range(len(texts)) if (x := aligned_with_all(texts, k, 10))}


def test_a_block_that_the_earlier_document_interrupts(spark):
    """Both lines were seen before the document that holds them with a line between."""
    one, two = "the first line has words", "the second line has words"
    texts = [f"{one}\nown words here", f"other words here\n{two}", f"start\n{one}\nbetween them\n{two}\nend", f"late start\n{one}\n{two}\nlate end"]
    assert left(spark, texts) == [*texts[:3], "late start\nlate end"]


def test_very_many_equal_lines(spark):
    import tracemalloc

    tracemalloc.start()
    later, first = [1, *[0] * 20_000, 2], [3, *[0] * 19_000, 4]
    assert len(line_dedup.common_lines(later, [1] * len(later), first, 10)) == 20_000
    assert tracemalloc.get_traced_memory()[1] < 200_000_000
    tracemalloc.stop()
    body = [f"line {k} stands here" for k in range(20_000)]
    texts = ["\n".join(body), "\n".join(["one of its own", *body[:15_000], "and one more", *body[15_002:], "the end"])]
    assert left(spark, texts) == [texts[0], "one of its own\nand one more\nthe end"]
