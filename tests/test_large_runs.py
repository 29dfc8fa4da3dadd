"""What must not be shuffled or spilled when tables grow."""

from __future__ import annotations

import re

from ledgerlift import session
from ledgerlift.operators import latest
from ledgerlift.operators.latest import latest_filings, latest_with_accounts
from ledgerlift.sources.orders import order_filings
from pyspark.sql import functions as F
from test_plans import plan
from toys import account, filing, frame, rows

WHO = ("naeringsspesifikasjon.norskIdentifikator", "hendelse.ordinal", "hendelse.fragment")


def exchanged(text: str) -> list[str]:
    """The columns that each exchange of a plan takes in, but for broadcasts."""
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)


def test_payloads_of_the_latest_are_not_shuffled(spark, workspace):
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the headers were many
    try:
        for rule in (latest_filings, latest_with_accounts):
            taken = exchanged(plan(rule(workspace.filings())))
            assert taken and not any("naeringsspesifikasjon#" in columns for columns in taken)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)


def test_kept_by_bits_as_by_a_join(spark):
    far = [0, 1, 63, 64, 511, 512, 513, -1, -2, -64, -65, -512, -513, 2**62, -(2**62), 2**33 + 5, 2**63 - 1, -(2**63)]
    df = frame(
        spark,
        *[filing(f"f{k % 5}", "2022", 1 + k % 3, k, ordinal=o, accounts=[account("k")]) for k, o in enumerate(far)],
        filing("f1", "2022", 9, 99, ordinal=77, accounts=[account("k")]),
        filing("f1", "2022", 9, 99, ordinal=77, fragment=1, accounts=[account("k")]),
        filing("f2", "2022", 1, 0, ordinal=77, fragment=2, accounts=[account("k")]),
    )
    empty = df.withColumn("hendelse", F.col("hendelse").withField("ordinal", F.lit(None).cast("bigint")))
    for given in (df, df.unionByName(df), df.unionByName(empty), empty, df.where("false")):
        winners = latest._winners(given)
        joined = latest._keep(given, winners, most_blocks=-1)
        kept = latest._keep(given, winners)
        assert kept.columns == joined.columns == given.columns
        assert rows(kept, *WHO) == rows(joined, *WHO)
    assert rows(latest_filings(df), *WHO)[-1][0] == "f4"


def test_lists_and_sums_of_an_order_come_from_one_exchange(spark, small):
    taken = exchanged(plan(order_filings(spark, small)))
    assert sum("l_linenumber#" in columns or "liste#" in columns for columns in taken) == 1


def test_sums_of_posts_without_amounts_are_missing(spark, tmp_path):
    order = "select 1L o_orderkey, 7L o_custkey, date'2022-01-01' o_orderdate, '1-URGENT' o_orderpriority, 5.0D o_totalprice, 'O' o_orderstatus"
    line = "select 1L l_orderkey, {part} l_partkey, 3L l_suppkey, {number} l_linenumber, 2.0D l_quantity, {price} l_extendedprice, 0.1D l_discount, 0.1D l_tax, 'N' l_returnflag, 'O' l_linestatus"
    lines = [line.format(part=p, number=n, price=c) for p, n, c in (("0L", 1, "1.25D"), ("0L", 2, "2.50D"), ("2L", 2, "cast(null as double)"), ("cast(null as bigint)", 3, "4.00D"))]
    tables = {
        "orders": order,
        "lineitem": " union all ".join(lines),
        "customer": "select 7L c_custkey, 'BUILDING' c_mktsegment",
        "supplier": "select 3L s_suppkey, 's' s_name, 1 s_nationkey",
    }
    for name, sql in tables.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    body = order_filings(spark, str(tmp_path)).select("naeringsspesifikasjon.*").first()
    result, stock = body["resultatregnskap"], body["spesifikasjonAvVarelager"]
    assert [p["beloep"] for p in result["driftsinntekt"]["salgsinntekt"]["inntekt"]] == [1.25, 2.5]
    assert result["driftsinntekt"]["sumDriftsinntekt"] == 3.75 and result["driftskostnad"]["sumDriftskostnad"] is None
    assert result["driftskostnad"]["varekostnad"]["kostnad"][0]["beloep"] is None and result["finansinntekt"]["inntekt"] is None
    assert list(stock)[:4] == [1.25, 2.5, 4.0, None] and list(stock)[-1] == 7.75


def test_partitions_leave_room_for_records_in_memory(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.size_shuffles(spark, 4 * 2**30)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 512
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
