"""What a delivery holds beyond the declared fields: forestry amounts, undeclared keys, equal registrations."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from ledgerlift import schema
from ledgerlift.functions.variants import leaves_sql
from ledgerlift.operators import forestry
from ledgerlift.operators.latest import latest_account, latest_filings
from ledgerlift.operators.ordering import with_position
from ledgerlift.plans import pipeline
from ledgerlift.sources.deliveries import delivered, parse_delivery
from pyspark.sql import functions as F
from toys import account, filing, frame, rows

AT = datetime(2024, 1, 2, 3, 4, 5)


def event(seq, body, **header):
    header = {"registreringstidspunkt": "2023-05-01T10:35:24.6289Z", "sekvensnummer": seq} | header
    return {"data": {"hendelse": json.dumps(header), "naeringsspesifikasjon": json.dumps(body)}}


def with_accounts(filer, *accounts, **more):
    return {"norskIdentifikator": filer, "inntektsaar": "2022", "skogbruk": {"skogOgToemmerkonto": accounts}} | more


def delivery(spark, *events):
    return spark.createDataFrame(list(events), schema.RAW_EVENT)


def test_amounts_of_any_name_and_depth(spark, tmp_path):
    deep = {"inngaaendeSaldo": 1, "aaret": {"uttak": 2.5, "av": {"tekst": "3.5", "av": {"av": {"dypest": -4}}}}, "tom": {}, "intet": None}
    first = {"id": "k", "driftsenhet": "{d}", **deep, "skogfond": [{"id": "f", "kommunenummer": "0301", "rente": {"sats": 3, "null": 0}}]}
    delivery(
        spark,
        event(1, with_accounts("1", first, {"id": 7, "Ærlig beløp": 1e3})),
        event(2, with_accounts("2", {"id": "x"}, {}, None)),
        event(3, with_accounts("3")),
        event(4, {"norskIdentifikator": "4"}),
    ).write.parquet(f"{tmp_path}/in")
    pipeline.collect(spark, f"{tmp_path}/in", f"{tmp_path}/out", "parquet", AT)
    stamp = "2024-01-02_03-04-05.parquet"
    accounts = spark.read.parquet(f"{tmp_path}/out/skogbruk-skog-og-toemmerkonto-{stamp}")
    assert rows(accounts, "id", "driftsenhet", "felt", "beloep") == [
        ("7", None, "Ærlig beløp", 1000.0),
        ("k", "{d}", "dypest", -4.0),
        ("k", "{d}", "inngaaendeSaldo", 1.0),
        ("k", "{d}", "tekst", 3.5),
        ("k", "{d}", "uttak", 2.5),
    ]
    fund = spark.read.parquet(f"{tmp_path}/out/skogbruk-skogfond-{stamp}")
    assert rows(fund, "skogOgToemmerkontoId", "id", "kommunenummer", "felt", "beloep") == []  # the lowest id has none
    snapshot = spark.read.parquet(f"{tmp_path}/out/opprinnelig-struktur-{stamp}")
    assert rows(forestry.fund(snapshot, per_account=True), "skogOgToemmerkontoId", "id", "felt", "beloep") == [("k", "f", "sats", 3.0)]


@pytest.mark.parametrize("wrong", ["mye", [1, 2], "1,5"])
def test_amounts_must_be_numbers(spark, wrong):
    df = parse_delivery(delivery(spark, event(1, with_accounts("1", {"id": "k", "verdi": 1, "antall": wrong}))))
    with pytest.raises(Exception, match="CAST"):
        forestry.accounts(df).collect()


def test_leaves(spark):
    record = {"a": 1, "b": {"c": {"d": 2, "skip": 3}, "skip": {"e": 4}, "text": "{{{"}, "list": [{"x": 1}], "skip": 5}
    df = spark.createDataFrame([(json.dumps(record),), ("{}",), (None,)], "j string").select(F.parse_json("j").alias("v"))
    found = df.select(F.inline(F.expr(f"transform({leaves_sql('v', ['skip'])}, l -> named_struct('k', l.key, 'v', to_json(l.value)))")))
    assert rows(found) == [("a", "1"), ("d", "2"), ("list", '[{"x":1}]'), ("text", '"{{{"')]


def test_snapshot_keeps_what_no_field_is_declared_for(spark, tmp_path):
    body = with_accounts("1", merknad={"tekst": "æ", "tall": [1, 2.5]}, nytt="x")
    delivery(spark, event(1, body, hendelsetype="ny"), event(2, {"norskIdentifikator": "2"})).write.parquet(f"{tmp_path}/in")
    pipeline.collect(spark, f"{tmp_path}/in", f"{tmp_path}/out", "parquet", AT)
    snapshot = spark.read.parquet(f"{tmp_path}/out/opprinnelig-struktur-2024-01-02_03-04-05.parquet")
    found = snapshot.select(
        F.col("hendelse.sekvensnummer"),
        delivered(snapshot, "hendelse", "$.hendelsetype", "string"),
        delivered(snapshot, "naeringsspesifikasjon", "$.merknad.tall[1]", "double"),
        delivered(snapshot, "naeringsspesifikasjon", "$.nytt", "string"),
    )
    assert rows(found) == [(1, "ny", 2.5, "x"), (2, None, None, None)]
    again = snapshot.where("hendelse.sekvensnummer = 1").select(F.to_json("original.naeringsspesifikasjon")).first()[0]
    assert json.loads(again) == json.loads(json.dumps(body))
    with pytest.raises(ValueError, match="payloads"):
        delivered(snapshot, "kropp", "$", "string")


def test_a_registration_delivered_twice_wins_once(spark):
    twice = [event(1, with_accounts("1", {"id": "k", "verdi": 1}))] * 2
    filings = parse_delivery(delivery(spark, *twice)).cache()
    assert latest_filings(filings).count() == 1
    assert rows(forestry.accounts(filings), "id", "felt", "beloep") == [("k", "verdi", 1.0)]
    assert latest_account(filings).count() == latest_account(filings, per_account=True).count() == 1


def fund_of(i):
    return [(f"f{i}", "k", float(i), None)]


def test_two_accounts_with_one_id_give_the_same_rows_in_both_forms(spark):
    accounts = [account("k", verdi=1.0, fund=fund_of(1)), account("k", verdi=2.0, fund=fund_of(2)), account(None, fund=fund_of(3))]
    plain = frame(spark, filing("a", "2022", 1, 1, accounts=accounts))
    cut = frame(
        spark,
        filing("a", "2022", 1, 1, ordinal=1, accounts=[accounts[2], accounts[1]], numbers=[2, 1]),
        filing("a", "2022", 1, 1, ordinal=1, fragment=1, accounts=[accounts[0]], numbers=[0]),
    )
    for every in (False, True):
        assert rows(forestry.fund(plain, every).drop("sekvensnummer")) == rows(forestry.fund(cut, every).drop("sekvensnummer"))
    assert rows(forestry.fund(plain), "id", "felt", "beloep") == [("f1", "innskudd", 1.0)]
    assert rows(forestry.accounts(plain)) == rows(forestry.accounts(cut))


def test_positions(spark):
    df = spark.createDataFrame([(k % 7 or None, k) for k in range(500)], "a int, b int").repartition(5)
    found = with_position(df, ["a", F.desc("b")]).orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(1, 501))
    assert [(r["a"], r["b"]) for r in found] == sorted(((k % 7 or None, k) for k in range(500)), key=lambda x: (x[0] is None, x[0] or 0, -x[1]))
    assert with_position(df.where("false"), ["a"]).count() == 0


def test_shared_tables_can_be_removed(spark, small):
    from ledgerlift.plans.workspace import Workspace
    from ledgerlift.session import remove

    ws = Workspace(spark, f"{small}/")
    ws.long()
    path = ws.path("long")
    assert ws.clear() >= 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert ws.long().count() > 0
    with pytest.raises(ValueError, match="not below"):
        remove(spark, "/elsewhere")
