"""Fragmented filings whose sequence numbers are shared by filers, or missing."""

from __future__ import annotations

from ledgerlift.operators.latest import latest_account, latest_filings
from toys import account, filing, frame, rows

WHO = ("naeringsspesifikasjon.norskIdentifikator", "hendelse.sekvensnummer", "hendelse.fragment")


def test_shared_and_missing_numbers(spark):
    df = frame(
        spark,
        filing("a", "2022", 1, 5, accounts=[account("k1")]),
        filing("a", "2022", 2, 6, ordinal=9, accounts=[account("k1")], numbers=[1]),
        filing("a", "2022", 2, 6, ordinal=9, fragment=1, accounts=[account("k1")], numbers=[1]),
        filing("b", "2022", 1, 5, accounts=[account("k1")]),
        filing("c", "2022", 1, None, accounts=[account("k1")]),
        filing(None, "2022", 1, 6, accounts=[account("k1")]),
    )
    assert set(rows(latest_filings(df), *WHO)) == {("a", 6, 0), ("a", 6, 1), ("b", 5, 0), ("c", None, 0)}
    kept = set(rows(latest_account(df), "norskIdentifikator", "sekvensnummer", "fragment"))
    assert kept == {("a", 6, 0), ("a", 6, 1), ("b", 5, 0), ("c", None, 0), (None, 6, 0)}
