"""Deliveries: event records whose payloads are JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift import schema
from ledgerlift.functions.times import event_time

FAILFAST = {"mode": "FAILFAST"}
PAYLOADS = ("hendelse", "naeringsspesifikasjon")


def read_delivery(spark: SparkSession, path: str, source: str = "avro") -> DataFrame:
    """Raw events. Avro needs the external ``spark-avro`` module on the cluster;
    the same records stored as Parquet or JSON lines are read with ``source``."""
    reader = spark.read.format(source)
    if source != "avro":
        reader = reader.schema(schema.RAW_EVENT)
    return reader.load(path)


def _present(payload: Column) -> Column:
    return F.coalesce(payload, F.raise_error("an event record has no payload"))


def parse_payload(payload: Column, ddl: str) -> Column:
    """JSON text to typed nested columns. Bad or missing JSON stops the run."""
    return F.from_json(_present(payload), ddl, FAILFAST)


def parse_delivery(raw: DataFrame) -> DataFrame:
    """Raw events to filings: typed ``hendelse`` and ``naeringsspesifikasjon``, and all that was delivered as ``original``.

    A registration gets an ordinal of its own unless the delivery numbers them, below zero so that the two
    kinds never meet. Store the result before querying it: ordinals are fixed by that, and a filter on a
    parsed field would be pushed below the projection and parse the text a second time.
    """
    parsed = raw.select(
        parse_payload(F.col("data.hendelse"), schema.EVENT_HEADER_JSON).alias("h"),
        parse_payload(F.col("data.naeringsspesifikasjon"), schema.FILING_BODY).alias("naeringsspesifikasjon"),
        F.struct(*[F.parse_json(_present(F.col(f"data.{p}"))).alias(p) for p in PAYLOADS]).alias("original"),
        (F.lit(-1) - F.monotonically_increasing_id()).alias("place"),
    )
    return parsed.select(
        F.struct(
            event_time(F.col("h.registreringstidspunkt")).alias("registreringstidspunkt"),
            F.col("h.sekvensnummer").alias("sekvensnummer"),
            F.coalesce("h.ordinal", "place").alias("ordinal"),
            F.coalesce("h.fragment", F.lit(0)).alias("fragment"),
        ).alias("hendelse"),
        "naeringsspesifikasjon",
        "original",
    )


def delivered(snapshot: DataFrame, payload: str, path: str, kind: str) -> Column:
    """What was delivered at a path of one payload, whether the schema knows it or not; NULL where it was not."""
    if payload not in PAYLOADS:
        raise ValueError(f"payloads are {', '.join(PAYLOADS)}")
    return F.variant_get(snapshot[f"original.{payload}"], path, kind)


def as_delivery(filings: DataFrame) -> DataFrame:
    """Filings back to raw events with JSON payloads; a column ``undeclared`` adds keys that the schema does not know."""
    stamp = F.date_format("hendelse.registreringstidspunkt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")

    def payload(name: str) -> Column:
        fields = [F.col(f"{name}.{f}") for f in filings.schema[name].dataType.names if f != "registreringstidspunkt"]
        first = [stamp.alias("registreringstidspunkt")] if name == "hendelse" else []
        more = filings.schema["undeclared"].dataType[name].dataType.names if "undeclared" in filings.columns else []
        return F.to_json(F.struct(*first, *fields, *[F.col(f"undeclared.{name}.{f}") for f in more])).alias(name)

    return filings.select(F.struct(*map(payload, PAYLOADS)).alias("data"))
