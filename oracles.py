"""The registered queries as flat SQL over the driver tables.

The SQL never builds a nested filing: it joins orders with their lines and works
on rows. Only the fixed values of the catalog are shared with the Spark side.
"""

from __future__ import annotations

from ledgerlift.plans.catalog import (
    ACCOUNTING_DUTIES,
    AMOUNT_VARIABLES,
    BUSINESS_TYPES,
    INVENTORY_AMOUNTS,
    KEY_OBJECTS,
    MAIN,
    OBJECTS,
    POST_LISTS,
    POST_VARIABLES,
    SECTIONS,
    STORED_OBJECTS,
    SUMS,
    list_codes,
    object_list,
)
from ledgerlift.plans.registry import FILER

LISTS = list(POST_LISTS)


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _code_case() -> str:
    whens = []
    for number, name in enumerate(LISTS):
        codes = list_codes(name)
        value = (
            f"([{_quoted(codes)}])[1 + (l_partkey // 13 + l_linenumber - 1) % {len(codes)}]"
            if codes
            else "cast(2700 + l_linenumber as varchar)"
        )
        whens.append(f"when l_partkey % 13 = {number} then {value}")
    return f"case when l_linenumber = 7 then '9999' {' '.join(whens)} end"


BASE = f"""
filing as (
  select o_orderkey as seq, o_orderdate as ts, lpad(cast(o_custkey as varchar), 11, '0') as filer,
         cast(year(o_orderdate) as bigint) as aar, cast(o_custkey as varchar) as orgnr,
         case c_mktsegment when 'BUILDING' then 'enkeltpersonforetak'
           when 'MACHINERY' then 'selskapMedDeltakerfastsetting'
           when 'HOUSEHOLD' then 'samvirkeforetak' else 'annet' end as trade,
         case o_orderpriority when '1-URGENT' then 'ingenRegnskapsplikt'
           when '2-HIGH' then 'begrensetRegnskapsplikt' else 'annen' end as duty,
         o_totalprice
  from orders left join customer on c_custkey = o_custkey
),
line as (
  select l_orderkey as seq, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_quantity, l_tax, l_returnflag, l_linestatus,
         l_partkey % 13 as liste, {_code_case()} as type,
         case when l_discount = 0 then 0.0 when l_tax = 0 then null else l_extendedprice end as beloep
  from lineitem
),
latest as (
  select * from filing where filer is not null and aar is not null
  qualify row_number() over (partition by filer, aar order by ts desc, seq desc) = 1
),
post as (select latest.*, liste, type, beloep from latest join line using (seq))
"""

# scalar sum -> lists it adds up, by number
_LIST_SUMS = {
    "sumDriftsinntekt": "0, 1",
    "sumDriftskostnad": "2, 3, 4",
    "sumFinansinntekt": "5",
    "sumFinanskostnad": "6",
    "sumBalanseverdiForAnleggsmiddel": "7",
    "sumBalanseverdiForOmloepsmiddel": "8",
    "sumBalanseverdiForEiendel": "7, 8",
    "sumLangsiktigGjeld": "9",
    "sumKortsiktigGjeld": "10",
    "sumEgenkapital": "11",
    "sumGjeldInnenBankOgForsikring": "12",
}


def _total(lists: str) -> str:
    return f"cast(sum(cast(beloep as decimal(18,2))) filter (where liste in ({lists})) as double)"


def _scalars(source: str = "latest") -> str:
    sums = ",\n    ".join(f"{_total(lists)} as {name}" for name, lists in _LIST_SUMS.items())
    stock = ",\n    ".join(
        f"cast(sum(cast(l_extendedprice as decimal(18,2))) filter (where l_linenumber = {n}) as double) as {name}"
        for n, name in enumerate(INVENTORY_AMOUNTS[:-1], start=1)
    )
    return f"""
scalar as (
  select {source}.seq, filer, aar, ts, orgnr, trade, duty,
    {sums},
    cast(coalesce(sum(cast(beloep as decimal(18,2))) filter (where liste in (0, 1, 5)), 0)
       - coalesce(sum(cast(beloep as decimal(18,2))) filter (where liste in (2, 3, 4, 6)), 0) as double) as aarsresultat,
    any_value(o_totalprice) as sumGjeldOgEgenkapital,
    {stock},
    cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as {INVENTORY_AMOUNTS[-1]}
  from {source} left join line on line.seq = {source}.seq
  group by {source}.seq, filer, aar, ts, orgnr, trade, duty
)"""


_MAIN_COLUMNS = {
    "inntektsaar": "aar as inntektsaar",
    "id": "filer as id",
    "felt": "felt",
    "beloep": "beloep",
    "registreringstidspunkt": "ts as registreringstidspunkt",
    "sekvensnummer": "seq as sekvensnummer",
}


def _section_rows(name: str) -> str:
    """Rows of a section over the CTEs post and scalar, before the shape is chosen."""
    branches = SECTIONS[name].branches
    parts = []
    lists = [str(LISTS.index(b)) for b in branches if b in POST_LISTS]
    if lists:
        parts.append(f"select seq, filer, aar, ts, type as felt, beloep from post where liste in ({', '.join(lists)})")
    parts += [
        f"select seq, filer, aar, ts, '{b}' as felt, {b} as beloep from scalar" for b in branches if b not in POST_LISTS
    ]
    return f"select * from ({' union all '.join(parts)}) where beloep is not null and beloep <> 0"


def _section(name: str, columns=None) -> str:
    shape = ", ".join(_MAIN_COLUMNS[c] for c in (columns or SECTIONS[name].columns))
    return f"with {BASE}, {_scalars()} select {shape} from ({_section_rows(name)})"


def _sections(select: str) -> str:
    rows = " union all ".join(f"select '{name}' as section, * from ({_section_rows(name)})" for name in SECTIONS)
    return f"with {BASE}, {_scalars()}, tagged as ({rows}) {select}"


def _header(source: str, extra: str = "") -> str:
    return (
        f"select filer as norskIdentifikator, aar as inntektsaar, ts as registreringstidspunkt, "
        f"seq as sekvensnummer{extra} from {source}"
    )


FORESTRY = """
account as (
  select line.seq, filer, aar, ts, cast(l_suppkey as varchar) as account, any_value(s_name) as driftsenhet,
         cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as verdi,
         cast(sum(cast(l_quantity as decimal(18,2))) as double) as antall
  from line join filing using (seq) left join supplier on s_suppkey = l_suppkey
  where l_returnflag = 'R' group by line.seq, filer, aar, ts, l_suppkey
),
with_accounts as (
  select * from filing where seq in (select seq from account)
  qualify row_number() over (partition by filer, aar order by ts desc, seq desc) = 1
),
kept_account as (select account.* from account where seq in (select seq from with_accounts)),
last_account as (
  select * from account
  qualify row_number() over (partition by filer, aar order by ts desc, seq desc, account) = 1
)
"""


def _fund(accounts: str) -> str:
    return f"""
with {BASE}, {FORESTRY},
entry as (
  select a.*, cast(l_partkey as varchar) as id, cast(s_nationkey as varchar) as kommunenummer, beloep as innskudd, l_tax
  from {accounts} a join line on line.seq = a.seq and cast(line.l_suppkey as varchar) = a.account
    left join supplier on s_suppkey = line.l_suppkey
  where l_returnflag = 'R'
)
select * from (
  {_header("entry", ", account as skogOgToemmerkontoId, id, kommunenummer, 'innskudd' as felt, innskudd as beloep")}
  union all
  {_header("entry", ", account as skogOgToemmerkontoId, id, kommunenummer, 'avgift' as felt, l_tax as beloep")}
) where beloep <> 0"""


_FORESTRY_ACCOUNTS = f"""
with {BASE}, {FORESTRY}
select * from (
  {_header("kept_account", ", account as id, driftsenhet, 'verdi' as felt, verdi as beloep")}
  union all
  {_header("kept_account", ", account as id, driftsenhet, 'antall' as felt, antall as beloep")}
) where beloep <> 0"""

_OPEN_ACCOUNTS = f"""
with {BASE}, {FORESTRY},
open_account as (
  select a.*, 'inngaaendeSaldo' || coalesce(cast(s_nationkey as varchar), 'x') as saldo
  from kept_account a left join supplier on cast(s_suppkey as varchar) = account
)
select * from (
  {_header("open_account", ", account as id, driftsenhet, 'verdi' as felt, verdi as beloep")}
  union all
  {_header("open_account", ", account as id, driftsenhet, 'antall' as felt, antall as beloep")}
  union all
  {_header("open_account", ", account as id, driftsenhet, saldo as felt, verdi as beloep")}
) where beloep <> 0"""


def _open_fund() -> str:
    row = ", account as skogOgToemmerkontoId, id, kommunenummer"
    return f"""
with {BASE}, {FORESTRY},
entry as (
  select a.*, cast(l_partkey as varchar) as id, cast(s_nationkey as varchar) as kommunenummer, beloep as innskudd, l_tax,
         l_extendedprice, 'uttak' || l_linestatus as uttak
  from kept_account a join line on line.seq = a.seq and cast(line.l_suppkey as varchar) = a.account
    left join supplier on s_suppkey = line.l_suppkey
  where l_returnflag = 'R'
)
select * from (
  {_header("entry", f"{row}, 'innskudd' as felt, innskudd as beloep")}
  union all
  {_header("entry", f"{row}, 'avgift' as felt, l_tax as beloep")}
  union all
  {_header("entry", f"{row}, uttak as felt, l_extendedprice as beloep")}
) where beloep <> 0"""


def _ordered(sql: str, order: str) -> str:
    columns = ", ".join(f"{c} nulls last" for c in order.split())
    return f"select *, row_number() over (order by {columns}) as position from ({sql})"


_OF_BUSINESS = f"trade in ({_quoted(BUSINESS_TYPES)}) and duty in ({_quoted(ACCOUNTING_DUTIES)})"


def _derive(name: str) -> str:
    if name == "virksomhet":
        return f"""with {BASE}
select orgnr, cast(make_date(aar, 1, 1) as timestamp) as O_15805, cast(make_date(aar, 12, 31) as timestamp) as O_15806
from latest where {_OF_BUSINESS}"""
    if name in KEY_OBJECTS:
        return f"with {BASE} select distinct orgnr from latest where {_OF_BUSINESS} and orgnr is not null"
    if name in AMOUNT_VARIABLES:
        columns = ", ".join(
            f"cast(sum(cast(coalesce({a}, 0) as decimal(18,2))"
            + (f" - cast(coalesce({minus}, 0) as decimal(18,2))" if minus else "")
            + f") as double) as {v}"
            for v, (a, minus) in AMOUNT_VARIABLES[name].items()
        )
        source = "scalar"
        where = _OF_BUSINESS
        return f"with {BASE}, {_scalars()} select orgnr, {columns} from {source} where {where} group by orgnr"
    columns = ", ".join(
        f"cast(sum(case when type in ({_quoted(codes)}) then cast(coalesce(beloep, 0) as decimal(18,2)) else 0 end)"
        f" as double) as {v}"
        for v, codes in POST_VARIABLES[name].items()
    )
    number = LISTS.index(object_list(name))
    return f"with {BASE} select orgnr, {columns} from post where liste = {number} and {_OF_BUSINESS} group by orgnr"


def _derived_together() -> str:
    return " union all ".join(
        f"select '{name}' as objekt, orgnr, variabel, verdi from ({_derive(name)})"
        f" unpivot (verdi for variabel in ({', '.join(POST_VARIABLES.get(name) or AMOUNT_VARIABLES[name])})) where orgnr is not null"
        for name in (*POST_VARIABLES, *AMOUNT_VARIABLES)
    )


def _describe(name: str) -> str:
    if name == "virksomhet" or name in KEY_OBJECTS:
        columns = {"orgnr": "orgnr"}
        if name == "virksomhet":
            columns |= {c: f"cast({c} as date)" for c in ("O_15805", "O_15806")}
        values = " union all ".join(
            f"select '{c}' as variable, cast({value} as varchar) as value from d where {c} is not null"
            for c, value in columns.items()
        )
        return f"""
with d as ({_derive(name)}),
counts as (select variable, value, count(*) as n from ({values}) group by 1, 2),
ranked as (select *, row_number() over (partition by variable order by n desc, value) as r from counts)
select variable, cast(sum(n) as bigint) as "count", count(*) as "unique",
       max(case when r = 1 then value end) as top, max(n) as freq
from ranked group by variable"""
    variables = list(POST_VARIABLES.get(name) or AMOUNT_VARIABLES[name])
    values = " union all ".join(f"select '{v}' as variable, {v} as value from d" for v in variables)
    return f"""
with d as ({_derive(name)}), v as ({values})
select variable, count(value) as "count",
  round(cast(sum(cast(value as decimal(28,2))) as double) / count(value), 4) as mean,
  round(stddev_samp(value), 2) as std, min(value) as min,
  round(quantile_cont(value, 0.25), 4) as q25, round(quantile_cont(value, 0.5), 4) as q50,
  round(quantile_cont(value, 0.75), 4) as q75, max(value) as max
from v group by variable"""


_LINE_RATES = """
with d as (select l_extendedprice * l_tax as tax, -l_extendedprice / l_quantity as price, l_discount / 3 as third from lineitem),
v as (select 'tax' as variable, tax as value from d union all select 'price', price from d union all select 'third', third from d)
select variable, count(value) as "count", round(avg(value), 6) as mean, round(stddev_samp(value), 2) as std, min(value) as min,
  round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.5), 6) as q50,
  round(quantile_cont(value, 0.75), 6) as q75, max(value) as max
from v group by variable"""


_THEME_CASES = " ".join(
    f"when {n} then {{'hovedtema': '{s.hovedtema}', 'undertema': '{s.undertema}', 'gruppe': '{name}'}}"
    for n, (name, s) in enumerate(POST_LISTS.items())
)
LONG = f"""{BASE},
long as (
  select filer as norskIdentifikator, 'p' || type as felt_id,
         case when beloep < 5000 then 'x' else cast(beloep as varchar) end as felt_verdi,
         t.hovedtema, t.undertema, t.gruppe
  from (select *, case liste {_THEME_CASES} end as t from post where beloep is not null and beloep <> 0)
)"""


def _fields(names=None) -> list[str]:
    fields: dict[str, None] = {}
    for name in names or LISTS:
        codes = list_codes(name) or tuple(str(2700 + n) for n in range(1, 7))
        fields.update(dict.fromkeys(f"p{c}" for c in (*codes, "9999")))
    return list(fields)


_VALUE = "cast(try_cast(felt_verdi as double) as decimal(18,2))"


def _wide(fields: list[str]) -> str:
    return ", ".join(
        f"cast(sum({_VALUE}) filter (where felt_id = '{f}') as double) as {f}" for f in fields
    )


def _prefix_total(where: str = "true") -> str:
    return f"with {LONG} select cast(sum({_VALUE}) as double) as total from long where felt_id like 'p3%' and {where}"


_OF_FILER = f"norskIdentifikator = '{FILER}'"
_OPERATING_INCOME = "hovedtema = 'resultatregnskap' and undertema = 'driftsinntekt'"
_P3_WIDE = [f for f in _fields() if f.startswith("p3")]


def _wide_prefix(where: str = "true") -> str:
    return f"with {LONG} select {_wide(_P3_WIDE)} from long where {where}"


def _stored_counts() -> str:
    counted = {"opprinnelig-struktur": "filing"}
    rows = [f"select '{name}' as stored, count(*) as n_rows from {source}" for name, source in counted.items()]
    rows.append(
        "select 'skogbruk-skog-og-toemmerkonto', count(*) filter (where verdi <> 0) + count(*) filter (where antall <> 0)"
        " from kept_account"
    )
    rows.append(
        "select 'skogbruk-skogfond', count(*) filter (where beloep <> 0) + count(*) filter (where l_tax <> 0)"
        " from last_account a join line on line.seq = a.seq and cast(line.l_suppkey as varchar) = a.account"
        " where l_returnflag = 'R'"
    )
    rows += [
        f"select '{name}', count(*) from ({_section_rows(name)})" for name, spec in SECTIONS.items() if spec.scheduled
    ]
    for name in STORED_OBJECTS:
        if name == "virksomhet":
            rows.append(f"select 'RF1175/{name}', count(*) from latest where {_OF_BUSINESS}")
        elif name in AMOUNT_VARIABLES:
            rows.append(f"select 'RF1175/{name}', count(distinct orgnr) from latest where {_OF_BUSINESS}")
        else:
            number = LISTS.index(object_list(name))
            rows.append(
                f"select 'RF1175/{name}', count(distinct orgnr) from post where liste = {number} and {_OF_BUSINESS}"
            )
    return f"with {BASE}, {_scalars()}, {FORESTRY} {' union all '.join(rows)}"


_HEADER_COLUMNS = "cast(aar as varchar) as inntektsaar, filer as id, ts as registreringstidspunkt, seq as sekvensnummer"
_MISSING_KEYS = f"""with {BASE}, gone as (
  select seq, ts, case when cast(filer as bigint) % 5 <> 0 then filer end as filer, case when seq % 7 <> 0 then aar end as aar,
         case when cast(filer as bigint) % 3 <> 0 then orgnr end as orgnr, trade, duty, o_totalprice from filing
), gone_latest as (
  select * from gone where filer is not null and aar is not null
  qualify row_number() over (partition by filer, aar order by ts desc, seq desc) = 1
), gone_accounts as (
  select * from gone where seq in (select seq from line where l_returnflag = 'R')
  qualify row_number() over (partition by filer, aar order by ts desc, seq desc) = 1
)"""


def build() -> dict[str, str]:
    latest_columns = "aar as inntektsaar, filer as id, ts as registreringstidspunkt, seq as sekvensnummer"
    sql = {
        "ingest_json_events": """
select event_id as sekvensnummer, user_id, date_trunc('millisecond', ts) as registreringstidspunkt,
       cast(json_extract_string(props, '$.k') as bigint) as k from events""",
        "event_time_millis": """
select event_id, date_trunc('millisecond', ts) as from_micros, date_trunc('second', ts) as from_seconds,
       time_bucket(interval '100 milliseconds', ts) as from_tenths,
       date_trunc('millisecond', ts) - interval 2 hours as from_offset,
       date_trunc('millisecond', ts) as without_zone from events""",
        "ingest_filings": _section("naering"),
        "latest_filing": f"with {BASE} select {latest_columns} from latest",
        "latest_filing_with_accounts": f"with {BASE}, {FORESTRY} select {latest_columns} from with_accounts",
        "latest_after_explode": f"with {BASE}, {FORESTRY} {_header('last_account', ', account as skogOgToemmerkontoId')}",
        "latest_accounts_all": f"with {BASE}, {FORESTRY} {_header('kept_account', ', account as skogOgToemmerkontoId')}",
        "section_row_counts": _sections("select section, count(*) as n_rows from tagged group by section"),
        "all_sections": _sections(f"select section, {', '.join(_MAIN_COLUMNS[c] for c in MAIN)} from tagged"),
        "partitioned_sections": _sections(
            "select section, count(*) as n_rows, cast(sum(cast(beloep as decimal(18,2))) as double) as total"
            " from tagged group by section"
        ),
        "relink_subset": _section("driftsinntekt", MAIN),
        "empty_delivery": "select cast(count(*) as integer) as n_tables, count(*) > 0 as folder from orders where o_orderkey < 0",
        "named_scan": f"with {LONG} select gruppe, felt_id, count(*) as n_rows from long group by all",
        "strict_prefix_total": f"""with {BASE}
select cast(sum(cast(beloep as decimal(18,2))) as double) as total from post where beloep <> 0 and type like '3%'""",
        "latest_of_missing_keys": f"""{_MISSING_KEYS}
select 'latest' as rule, {_HEADER_COLUMNS} from gone_latest union all select 'with accounts', {_HEADER_COLUMNS} from gone_accounts""",
        "derive_of_missing_keys": f"""{_MISSING_KEYS}, {_scalars("gone_latest")}
select distinct 'keys' as objekt, coalesce(orgnr, '') as orgnr, cast(null as double) as sum from gone_latest where {_OF_BUSINESS}
union all
select 'sums', orgnr, cast(sum(cast(coalesce(sumDriftsinntekt, 0) as decimal(18,2))) as double) from scalar
where {_OF_BUSINESS} and orgnr is not null group by orgnr""",
        "relink_bucketed": _section("driftsinntekt", MAIN),
        "stored_section_counts": _sections(
            f"""select section, coalesce(n, 0) as n_observed, coalesce(n, 0) as n_rows
from (select unnest([{_quoted(SECTIONS)}]) as section) left join (select section, count(*) as n from tagged group by section) using (section)"""
        ),
        "derived_together": _derived_together(),
        "code_dictionary": f"with {LONG} select hovedtema, undertema, gruppe, felt_id, count(*) as n_rows from long group by all",
        "wide_against_long": f"with {LONG} "
        + " union all ".join(
            f"select '{p}' as prefix, cast(coalesce(sum({_VALUE}), 0) as double) as wide, cast(sum({_VALUE}) as double) as long from long where felt_id like '{p}%'"
            for p in ("p", "p3", "p9", "p27")
        ),
        "forestry_accounts": _FORESTRY_ACCOUNTS,
        "forestry_fund": _fund("last_account"),
        "forestry_fund_per_account": _fund("kept_account"),
        "forestry_open_accounts": _OPEN_ACCOUNTS,
        "forestry_open_fund": _open_fund(),
        "forestry_accounts_ordered": _ordered(_FORESTRY_ACCOUNTS, "norskIdentifikator inntektsaar id felt"),
        "forestry_fund_ordered": _ordered(
            _fund("kept_account"), "norskIdentifikator inntektsaar skogOgToemmerkontoId kommunenummer felt id beloep"
        ),
        "snapshot_undeclared": """
select o_orderkey as sekvensnummer, o_orderstatus as hendelsetype, o_orderpriority as tekst, o_totalprice as total,
       lpad(cast(o_custkey as varchar), 11, '0') as norskIdentifikator from orders""",
        "describe_line_rates": _LINE_RATES,
        "operating_result": f"select orgnr, O_15799, O_7286, O_6686 from ({_derive('sum_resultatregnskap')})",
        "balance_control": f"select orgnr, kontroll from ({_derive('sum_balanseregnskap')})",
        "balance_control_topk": f"""
select orgnr, kontroll from ({_derive('sum_balanseregnskap')}) order by kontroll desc, orgnr limit 50""",
        "first_100": f"select * from ({_derive('spesifikasjonAvVarelager')}) order by orgnr limit 100",
        "long_layout": f"with {LONG} select * from long",
        "wide_layout": f"with {LONG} select norskIdentifikator, {_wide(_fields())} from long group by norskIdentifikator",
        "wide_to_long": f"""
with {LONG}
select norskIdentifikator, felt_id, cast(sum({_VALUE}) as double) as beloep, hovedtema, undertema, gruppe
from long where try_cast(felt_verdi as double) is not null group by all""",
        "long_prefix_sum": _prefix_total(_OF_FILER),
        "long_prefix_total": _prefix_total(),
        "partitioned_prefix_sum": _prefix_total(f"{_OF_FILER} and {_OPERATING_INCOME}"),
        "partitioned_prefix_total": _prefix_total(_OPERATING_INCOME),
        "subtree_prefix_total": _prefix_total(_OPERATING_INCOME),
        "view_prefix_sum": _prefix_total(_OF_FILER),
        "wide_prefix_sum": _wide_prefix(_OF_FILER),
        "wide_prefix_total": _wide_prefix(),
        "partitioned_wide_prefix_sum": _wide_prefix(f"{_OF_FILER} and {_OPERATING_INCOME}"),
        "partitioned_wide_prefix_total": _wide_prefix(_OPERATING_INCOME),
        "pipeline_roundtrip": _stored_counts(),
    }
    sql |= {f"section_{name.replace('-', '_')}": _section(name) for name in SECTIONS}
    for name in OBJECTS:
        sql[f"derive_{name}"] = _derive(name)
        sql[f"describe_{name}"] = _describe(name)
    return sql


assert set(_LIST_SUMS) | {"aarsresultat", "sumGjeldOgEgenkapital"} == set(SUMS)
