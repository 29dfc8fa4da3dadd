"""Declared schemas of deliveries and filings.

The schema is declared rather than inferred per delivery, so a field that no
filing of a delivery carries reads as NULL instead of breaking the queries.
What it does not declare is not lost: forestry accounts are open records, and
the whole payloads stay in the snapshot beside the typed columns.
"""

from __future__ import annotations

from ledgerlift.plans.catalog import INVENTORY_AMOUNTS

POSTS = "array<struct<type: string, beloep: double>>"

RAW_EVENT = "data struct<hendelse: string, naeringsspesifikasjon: string>"
# a delivery may number its registrations, and the records of a long one
EVENT_HEADER_JSON = "registreringstidspunkt string, sekvensnummer bigint, ordinal bigint, fragment int"

_INVENTORY = ", ".join(f"{name}: double" for name in INVENTORY_AMOUNTS)

# kontonummer numbers the accounts where a filing is cut into records; else an account's place is its number
FILING_BODY = f"""struct<
    norskIdentifikator: string,
    inntektsaar: string,
    virksomhet: struct<
      orgnr: string, virksomhetstype: string, regnskapspliktstype: string, start: date, slutt: date>,
    resultatregnskap: struct<
      driftsinntekt: struct<
        salgsinntekt: struct<inntekt: {POSTS}>,
        annenDriftsinntekt: struct<inntekt: {POSTS}>,
        sumDriftsinntekt: double>,
      driftskostnad: struct<
        varekostnad: struct<kostnad: {POSTS}>,
        loennskostnad: struct<kostnad: {POSTS}>,
        annenDriftskostnad: struct<kostnad: {POSTS}>,
        sumDriftskostnad: double>,
      finansinntekt: struct<inntekt: {POSTS}>,
      sumFinansinntekt: double,
      finanskostnad: struct<kostnad: {POSTS}>,
      sumFinanskostnad: double,
      aarsresultat: double>,
    balanseregnskap: struct<
      anleggsmiddel: struct<
        balanseverdiForAnleggsmiddel: struct<balanseverdi: {POSTS}>,
        sumBalanseverdiForAnleggsmiddel: double>,
      omloepsmiddel: struct<
        balanseverdiForOmloepsmiddel: struct<balanseverdi: {POSTS}>,
        sumBalanseverdiForOmloepsmiddel: double>,
      gjeldOgEgenkapital: struct<
        langsiktigGjeld: struct<gjeld: {POSTS}>,
        kortsiktigGjeld: struct<gjeld: {POSTS}>,
        egenkapital: struct<kapital: {POSTS}>,
        gjeldInnenBankOgForsikring: struct<gjeld: {POSTS}>,
        sumLangsiktigGjeld: double,
        sumKortsiktigGjeld: double,
        sumEgenkapital: double,
        sumGjeldInnenBankOgForsikring: double>,
      sumBalanseverdiForEiendel: double,
      sumGjeldOgEgenkapital: double>,
    spesifikasjonAvVarelager: struct<{_INVENTORY}>,
    skogbruk: struct<skogOgToemmerkonto: array<variant>, kontonummer: array<bigint>>>
    """

#: A parsed filing: event header and body.
FILING = (
    "hendelse struct<registreringstidspunkt: timestamp, sekvensnummer: bigint, ordinal: bigint, fragment: int>, "
    f"naeringsspesifikasjon {FILING_BODY}"
)
