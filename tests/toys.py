"""Small filings written by hand."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from ledgerlift import schema


def filing(filer, year, day, seq, *, sales=None, other=None, accounts=None, numbers=None, fragment=0, ordinal=None, **business):
    """One filing; ``sales`` and ``other`` are the two operating-income lists. ``frame`` numbers those without an ordinal."""
    header = {"registreringstidspunkt": datetime(2023, 1, day) if day else None, "sekvensnummer": seq}
    header |= {"ordinal": ordinal, "fragment": fragment}

    def posts(rows):
        return None if rows is None else [{"type": code, "beloep": amount} for code, amount in rows]

    return {
        "hendelse": header,
        "naeringsspesifikasjon": {
            "norskIdentifikator": filer,
            "inntektsaar": year,
            "virksomhet": {
                "orgnr": business.get("orgnr", filer),
                "virksomhetstype": business.get("trade", "samvirkeforetak"),
                "regnskapspliktstype": business.get("duty", "ingenRegnskapsplikt"),
            },
            "resultatregnskap": {
                "driftsinntekt": {
                    "salgsinntekt": {"inntekt": posts(sales)},
                    "annenDriftsinntekt": {"inntekt": posts(other)},
                    "sumDriftsinntekt": business.get("total"),
                }
            },
            "skogbruk": {
                "skogOgToemmerkonto": None if accounts is None else [json.dumps(a) for a in accounts],
                "kontonummer": numbers,
            },
        },
    }


def account(id, owner="skog", verdi=None, antall=None, fund=None, **more):
    entries = None if fund is None else [
        {"id": i, "kommunenummer": k, "innskudd": a, "avgift": b} for i, k, a, b in fund
    ]
    return {"id": id, "driftsenhet": owner, "verdi": verdi, "antall": antall, "skogfond": entries} | more


def frame(spark, *filings):
    """Filings as parsed; one without an ordinal is a registration of its own."""
    filings = [f | {"hendelse": f["hendelse"] | {"ordinal": k}} if f["hendelse"]["ordinal"] is None else f for k, f in enumerate(filings)]
    df = spark.createDataFrame(filings, schema.FILING.replace("array<variant>", "array<string>"))
    path = "skogbruk.skogOgToemmerkonto"
    return df.withColumn(
        "naeringsspesifikasjon",
        F.col("naeringsspesifikasjon").withField(path, F.transform(f"naeringsspesifikasjon.{path}", F.parse_json)),
    )


def rows(df, *columns):
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
