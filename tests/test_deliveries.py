from __future__ import annotations

import json
import logging
from datetime import datetime
from pathlib import Path

import pytest
from ledgerlift import schema, session
from ledgerlift.functions.times import event_time
from ledgerlift.plans import pipeline
from ledgerlift.plans.catalog import SECTIONS, STORED_OBJECTS
from ledgerlift.sources.deliveries import parse_delivery, read_delivery
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from toys import rows

AT = datetime(2024, 1, 2, 3, 4, 5)


def event(seq, body, time="2023-05-01T10:35:24.6289Z"):
    header = json.dumps({"registreringstidspunkt": time, "sekvensnummer": seq})
    return {"data": {"hendelse": header, "naeringsspesifikasjon": body if isinstance(body, str) else json.dumps(body)}}


def delivery(spark, *events):
    return spark.createDataFrame(list(events), schema.RAW_EVENT)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2023-05-01T10:35:24.6289Z", datetime(2023, 5, 1, 10, 35, 24, 628000)),
        ("2023-05-01T10:35:24Z", datetime(2023, 5, 1, 10, 35, 24)),
        ("2023-05-01T10:35:24.6Z", datetime(2023, 5, 1, 10, 35, 24, 600000)),
        ("2023-05-01T10:35:24.123456789Z", datetime(2023, 5, 1, 10, 35, 24, 123000)),
        ("2023-05-01T10:35:24.6289", datetime(2023, 5, 1, 10, 35, 24, 628000)),
        ("2023-05-01T10:35:24.628+02:00", datetime(2023, 5, 1, 8, 35, 24, 628000)),
    ],
)
def test_event_time(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").select(event_time(F.col("t")).cast("timestamp_ntz"))
    assert df.first()[0] == want


def test_absent_fields_are_null(spark):
    filings = parse_delivery(delivery(spark, event(1, {"norskIdentifikator": "001", "inntektsaar": 2022})))
    row = filings.select("hendelse.sekvensnummer", "naeringsspesifikasjon.*").first()
    assert (row.sekvensnummer, row.norskIdentifikator, row.inntektsaar) == (1, "001", "2022")
    assert row.resultatregnskap is None and row.skogbruk is None


@pytest.mark.parametrize("body", ["{bad", '{"resultatregnskap": {"aarsresultat": "mye"}}', None])
def test_bad_payloads_stop_the_run(spark, body):
    raw = spark.createDataFrame(
        [{"data": {"hendelse": event(1, {})["data"]["hendelse"], "naeringsspesifikasjon": body}}], schema.RAW_EVENT
    )
    with pytest.raises(Exception, match="MALFORMED|payload|FAILFAST|BAD_RECORD"):
        parse_delivery(raw).collect()


def test_collect_and_derive(spark, tmp_path):
    body = {
        "norskIdentifikator": "00000000001",
        "inntektsaar": "2022",
        "virksomhet": {"orgnr": "9", "virksomhetstype": "samvirkeforetak", "regnskapspliktstype": "ingenRegnskapsplikt"},
        "resultatregnskap": {"driftsinntekt": {"salgsinntekt": {"inntekt": [{"type": "3000", "beloep": 12.5}]}}},
    }
    raw = delivery(spark, event(1, body), event(2, body, "2023-06-01T00:00:00Z"))
    raw.write.parquet(f"{tmp_path}/in")
    written = pipeline.collect(spark, f"{tmp_path}/in", f"{tmp_path}/out", "parquet", AT)
    assert len(written) == 3 + sum(spec.scheduled for spec in SECTIONS.values()) == 20
    assert written["opprinnelig-struktur"] == 2
    assert written["naering"] == written["driftsinntekt"] == 1
    assert written["balanseregnskap"] == 0
    stored = spark.read.parquet(f"{tmp_path}/out/driftsinntekt-2024-01-02_03-04-05.parquet")
    assert rows(stored) == [("3000", 12.5, 2)]

    again = pipeline.collect(spark, f"{tmp_path}/in", f"{tmp_path}/out2", "parquet", AT, together=True)
    assert again == written
    for name in pipeline.SCHEDULED:
        one = spark.read.parquet(f"{tmp_path}/out/{name}-2024-01-02_03-04-05.parquet")
        part = pipeline.read_section(spark, f"{tmp_path}/out2/seksjoner-2024-01-02_03-04-05.parquet", name)
        assert part.columns == one.columns and rows(part) == rows(one), name

    latest = pipeline.store_latest(
        spark.read.parquet(f"{tmp_path}/out/opprinnelig-struktur-2024-01-02_03-04-05.parquet"), f"{tmp_path}/latest"
    )
    for _ in range(2):  # objects are overwritten
        paths = pipeline.derive_all(latest, f"{tmp_path}/derived", "g2022", "v1")
    assert tuple(paths) == STORED_OBJECTS and len(paths) == 16
    assert paths["salgsinntekt"].endswith("/RF1175_g2022_v1/salgsinntekt")
    assert rows(spark.read.parquet(paths["salgsinntekt"]), "orgnr", "O_7360") == [("9", 12.5)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        pipeline.collect(spark, f"{tmp_path}/in", f"{tmp_path}/out", "parquet", AT)


def test_an_empty_delivery_stops_early(spark, tmp_path, caplog):
    delivery(spark).write.parquet(f"{tmp_path}/in")
    with caplog.at_level(logging.WARNING):
        assert pipeline.collect(spark, f"{tmp_path}/in", f"{tmp_path}/out", "parquet", AT) == {}
    assert "no records" in caplog.text
    assert not Path(f"{tmp_path}/out").exists()


def test_json_lines_deliveries(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps(event(4, {"norskIdentifikator": "1"})))
    raw = read_delivery(spark, f"{tmp_path}/in.json", "json")
    assert parse_delivery(raw).first()["hendelse"]["sekvensnummer"] == 4


def test_avro_deliveries(spark, tmp_path):
    """With the module, a round trip; without it, an error that names it."""
    raw = delivery(spark, event(4, {"norskIdentifikator": "1"}))
    try:
        raw.write.format("avro").save(f"{tmp_path}/in")
    except AnalysisException as missing:
        assert "Avro is built-in but external" in str(missing)
        with pytest.raises(AnalysisException, match="(?i)avro"):
            read_delivery(spark, str(tmp_path))
    else:
        assert parse_delivery(read_delivery(spark, f"{tmp_path}/in")).first()["hendelse"]["sekvensnummer"] == 4


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert session.scratch_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
