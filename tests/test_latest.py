from __future__ import annotations

from ledgerlift.operators.latest import latest_account, latest_filings, latest_with_accounts
from pyspark.sql import functions as F
from toys import account, filing, frame, rows



def account_id():
    return F.variant_get("account", "$.id", "string")


def sequences(df):
    return sorted(r[0] for r in df.select("hendelse.sekvensnummer").collect())


def test_last_registration_wins_and_ties_go_to_the_sequence_number(spark):
    df = frame(
        spark,
        filing("a", "2022", 1, 10),
        filing("a", "2022", 2, 5),
        filing("a", "2023", 1, 7),
        filing("b", "2022", 3, 8),
        filing("b", "2022", 3, 9),
        filing("c", "2022", None, 11),
        filing("c", "2022", 1, 4),
    )
    assert sequences(latest_filings(df)) == [4, 5, 7, 9]


def test_missing_keys_are_dropped_before_the_choice(spark):
    df = frame(spark, filing(None, "2022", 1, 1), filing("a", None, 1, 2), filing("a", "2022", 1, 3))
    assert sequences(latest_filings(df)) == [3]


def test_accounts_of_an_earlier_registration_survive_a_later_one_without(spark):
    df = frame(
        spark,
        filing("a", "2022", 1, 1, accounts=[account("k1", verdi=1.0), account("k2", verdi=2.0)]),
        filing("a", "2022", 2, 2, accounts=[]),
        filing("a", "2022", 3, 3),
        filing(None, "2022", 1, 4, accounts=[account("k3", verdi=3.0)]),
        filing(None, "2022", 2, 5, accounts=[account("k4", verdi=4.0)]),
    )
    assert sequences(latest_filings(df)) == [3]
    assert sequences(latest_with_accounts(df)) == [1, 5]
    assert rows(latest_account(df), "sekvensnummer", account_id()) == [(1, "k1"), (5, "k4")]
    assert rows(latest_account(df, per_account=True), "sekvensnummer", account_id()) == [
        (1, "k1"), (1, "k2"), (5, "k4"),
    ]


def test_all_fragments_of_the_last_filing_stay(spark):
    df = frame(
        spark,
        filing("a", "2022", 1, 1, ordinal=1, accounts=[account("k9", verdi=9.0)]),
        filing("a", "2022", 1, 1, ordinal=1, fragment=1),
        filing("a", "2022", 1, 1, ordinal=1, fragment=2),
        filing("a", "2022", 2, 2, ordinal=2, accounts=[account("k2"), account("k1", fund=[])], numbers=[7, 8]),
        filing("a", "2022", 2, 2, ordinal=2, fragment=1, accounts=[account("k1", verdi=1.0)], numbers=[8]),
    )
    kept = rows(latest_filings(df), "hendelse.sekvensnummer", "hendelse.fragment")
    assert kept == [(2, 0), (2, 1)]
    assert rows(latest_account(df), "fragment", account_id()) == [(0, "k1"), (1, "k1")]
    assert len(rows(latest_account(df, per_account=True), "fragment", account_id())) == 3
