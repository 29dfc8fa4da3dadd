"""The rule on sentence marks, for scripts and texts with other marks or none."""

from __future__ import annotations

import pytest

from ledgerlift.llm import quality_rules


@pytest.mark.parametrize("mark", ["।", "۔", "።", "։", "؟", "။", "។", "།", "᠃"])
def test_marks_of_other_scripts(mark):
    text = "\n".join(" ".join(f"शब्द{k}क{n}" for n in range(35)) + mark for k in range(4))
    *_, failed, kept, left = quality_rules.measure(text, 0.5)
    assert not failed and kept and left == text


def test_script_without_marks():
    text = " ".join(f"คำที่{chr(0xE01 + k)}" for k in range(40))
    *_, kept, left = quality_rules.measure(text, 0.5)
    assert kept and left == text


def test_long_line_without_mark_stays_but_counts():
    verse = " ".join(f"verse{k}" for k in range(35))
    prose = "\n".join(" ".join(f"w{k}n{n}" for n in range(20)) + "." for k in range(5))
    *_, kept, left = quality_rules.measure(f"{prose}\n{verse}", 0.5)
    assert kept and left == f"{prose}\n{verse}"
    assert not quality_rules.measure(verse, 0.5)[-2]
