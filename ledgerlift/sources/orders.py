"""Filings made from order tables, as FIXTURES.md describes.

An order is a filing and its lines are the posts. The result has the nested
schema of a parsed delivery, so everything downstream runs as on real filings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.functions.amounts import major_sql, to_major, to_minor
from ledgerlift.plans.catalog import INVENTORY_AMOUNTS, POST_LISTS, list_codes
from ledgerlift.session import scratch_path

MAX_POSTS = 10_000  # posts in one record; a longer filing is cut into fragments
BROADCAST_ROWS = 1_000_000  # of two bigints each, so at most a few tens of MB
SMALL_AMOUNT = 5000

UNKNOWN_CODE = "9999"
LISTS = list(POST_LISTS)
BANK_LIST = LISTS.index("gjeldInnenBankOgForsikring")

# scalar sum -> numbers of the lists it adds
LIST_SUMS = {
    "sumDriftsinntekt": (0, 1),
    "sumDriftskostnad": (2, 3, 4),
    "sumFinansinntekt": (5,),
    "sumFinanskostnad": (6,),
    "sumBalanseverdiForAnleggsmiddel": (7,),
    "sumBalanseverdiForOmloepsmiddel": (8,),
    "sumBalanseverdiForEiendel": (7, 8),
    "sumLangsiktigGjeld": (9,),
    "sumKortsiktigGjeld": (10,),
    "sumEgenkapital": (11,),
    "sumGjeldInnenBankOgForsikring": (12,),
    "inntekter": (0, 1, 5),
    "kostnader": (2, 3, 4, 6),
}


def extra_codes(gruppe: str) -> list[str]:
    """Codes the lines carry beyond those of the form."""
    bank = [str(2700 + n) for n in range(1, 7)] if LISTS[BANK_LIST] == gruppe else []
    return [*bank, UNKNOWN_CODE]


def _post_code() -> Column:
    """The code of a line: one of its list's codes, by position."""
    position = "l_partkey div 13 + l_linenumber - 1"
    cases = []
    for number, name in enumerate(LISTS):
        codes = list_codes(name)
        listed = ", ".join(f"'{code}'" for code in codes)
        code = (
            f"element_at(array({listed}), cast(pmod({position}, {len(codes)}) as int) + 1)"
            if codes
            else "cast(2700 + l_linenumber as string)"
        )
        cases.append(f"when liste = {number} then {code}")
    return F.expr(f"case when l_linenumber = 7 then '{UNKNOWN_CODE}' {' '.join(cases)} end")


def order_lines(lineitem: DataFrame, max_posts: int = MAX_POSTS) -> tuple[DataFrame, bool]:
    """Lines with list, code, amount and fragment; and whether any order has several fragments.

    Only orders with more lines than a record takes get fragments. Their lines are
    dealt out by their position in the scan, so that equal lines spread as well.
    """
    spark = lineitem.sparkSession
    lineitem = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", F.expr("cast(l_partkey % 13 as int)").alias("liste"),
    )
    lines = lineitem.select(
        "*",
        _post_code().alias("type"),
        F.when(F.col("l_discount") == 0, F.lit(0.0)).when(F.col("l_tax") != 0, F.col("l_extendedprice")).alias("beloep"),
    )
    long_orders = (
        lineitem.groupBy("l_orderkey")
        .agg(F.count("*").alias("lines"))
        .where(F.col("lines") > max_posts)
        .select("l_orderkey", F.ceil(F.col("lines") / max_posts).alias("fragments"))
    )
    n_long = long_orders.count()
    if n_long == 0:
        return lines.withColumn("fragment", F.lit(0).cast("bigint")), False
    if n_long <= BROADCAST_ROWS:
        long_orders = F.broadcast(long_orders)
    dealt = (
        lines.withColumn("_position", F.monotonically_increasing_id())
        .join(long_orders, "l_orderkey", "left")
        .withColumn("fragment", F.coalesce(F.pmod(F.xxhash64("_position"), "fragments"), F.lit(0)))
        .drop("_position", "fragments")
    )
    path = scratch_path(spark, "lines")  # one fixed deal, whatever is recomputed later
    dealt.write.parquet(path)
    return spark.read.parquet(path), True


def _totals_once(parts: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Sums over all fragments of a group, in the first of its fragments and nowhere else."""
    totals = parts.groupBy(*keys).agg(F.min("fragment").alias("fragment"), *[F.sum(s).alias(s) for s in sums])
    return parts.drop(*sums).join(totals, [*keys, "fragment"], "left")


def _sum_of_posts(which: str, minor: str, name: str) -> Column:
    """``sum(case when … end)`` over a record's posts: null where none of them has an amount."""
    added = f"if({which} and {minor} is not null, coalesce(n, 0L) + {minor}, n)"
    return F.expr(f"aggregate(posts, cast(null as bigint), (n, p) -> {added}) as {name}")


def _post_lists(lines: DataFrame, fragmented: bool) -> DataFrame:
    minor = {"amount": to_minor(F.col("beloep")), "price": to_minor(F.col("l_extendedprice"))}
    # one list of all posts a record, dealt out when it is whole: thirteen would be as many buffers to write and merge
    dealt = [
        F.expr(f"transform(filter(posts, p -> p.liste = {n}), p -> struct(p.type as type, p.beloep as beloep)) as list{n}")
        for n in range(len(LISTS))
    ]
    in_lists = {name: f"liste in ({', '.join(map(str, lists))})" for name, lists in LIST_SUMS.items()}
    in_stock = {name: f"l_linenumber = {n}" for n, name in enumerate(INVENTORY_AMOUNTS[:-1], start=1)} | {INVENTORY_AMOUNTS[-1]: "true"}
    if not fragmented:
        # lists and sums come from one exchange, which the minor units do not pass
        wanted = lines.select("l_orderkey", "fragment", "liste", "type", "beloep", "l_linenumber", "l_extendedprice")
        whole = wanted.repartition("l_orderkey").withColumns(minor).groupBy("l_orderkey", "fragment")
        whole = whole.agg(F.expr("collect_list(struct(liste, type, beloep, l_linenumber, amount, price)) as posts"))
        sums = [_sum_of_posts(f"p.{which}", "p.amount", name) for name, which in in_lists.items()]
        stock = [_sum_of_posts(which.replace("l_", "p.l_"), "p.price", name) for name, which in in_stock.items()]
        return whole.select("l_orderkey", "fragment", *dealt, *sums, *stock)
    sums = [F.expr(f"sum(case when {which} then amount end) as {name}") for name, which in in_lists.items()]
    stock = [F.expr(f"sum(case when {which} then price end) as {name}") for name, which in in_stock.items()]
    # the sums are fixed in width and added before the shuffle, so a long order does not weigh on them
    lists = lines.repartition("l_orderkey", "fragment").groupBy("l_orderkey", "fragment")
    lists = lists.agg(F.expr("collect_list(struct(liste, type, beloep)) as posts"))
    lists = lists.select("l_orderkey", "fragment", *dealt)
    totals = lines.withColumns(minor).groupBy("l_orderkey").agg(*sums, *stock).withColumn("fragment", F.lit(0).cast("bigint"))
    return lists.join(totals, ["l_orderkey", "fragment"], "full")


def _accounts(lines: DataFrame, supplier: DataFrame, fragmented: bool, open_amounts: bool) -> DataFrame:
    """Forestry accounts as VARIANT objects, with their numbers. ``open_amounts`` adds amounts under names that come
    from the data, in structs inside the account and inside the entries of its fund."""
    keys = ["l_orderkey", "fragment"] if fragmented else ["l_orderkey"]
    place = F.col("s_nationkey").cast("string")
    owners = supplier.select("s_suppkey", "s_name", place.alias("kommunenummer"))
    entry = F.struct(F.col("l_partkey").cast("string").alias("id"), "beloep", "l_tax", "l_extendedprice", "l_linestatus")
    parts = (
        lines.where("l_returnflag = 'R'")
        .repartition(*keys)
        .groupBy("l_orderkey", "l_suppkey", "fragment")
        .agg(
            F.collect_list(entry).alias("entries"),
            F.sum(to_minor(F.col("l_extendedprice"))).alias("verdi"),
            F.sum(to_minor(F.col("l_quantity"))).alias("antall"),
        )
    )
    if fragmented:
        parts = _totals_once(parts, ["l_orderkey", "l_suppkey"], ["verdi", "antall"])
    parts = parts.join(owners, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    saldo = F.create_map(F.concat(F.lit("inngaaendeSaldo"), F.coalesce("kommunenummer", F.lit("x"))), to_major(F.col("verdi")))

    def fund_entry(e: Column) -> Column:
        uttak = F.create_map(F.concat(F.lit("uttak"), e["l_linestatus"]), e["l_extendedprice"])
        return F.struct(
            e["id"].alias("id"),
            F.col("kommunenummer"),
            e["beloep"].alias("innskudd"),
            e["l_tax"].alias("avgift"),
            *([F.struct(uttak.alias("aarets")).alias("uttak")] if open_amounts else []),
        )

    account = F.struct(
        F.col("l_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("driftsenhet"),
        to_major(F.col("verdi")).alias("verdi"),
        to_major(F.col("antall")).alias("antall"),
        F.transform("entries", fund_entry).alias("skogfond"),
        *([F.struct(F.struct(saldo.alias("ved")).alias("aarets")).alias("saldo")] if open_amounts else []),
    )
    numbered = F.collect_list(F.struct(F.col("l_suppkey").alias("number"), account.alias("account")))
    listed = parts.groupBy("l_orderkey", "fragment").agg(numbered.alias("a"))
    return listed.select(
        "l_orderkey",
        "fragment",
        F.transform("a", lambda a: F.to_variant_object(a["account"])).alias("accounts"),
        F.col("a.number").alias("numbers"),
    )


def order_filings(spark: SparkSession, sf_dir: str, max_posts: int = MAX_POSTS, open_amounts: bool = False) -> DataFrame:
    """All filings, those with more than ``max_posts`` lines in several records.

    The column ``undeclared`` has what a delivery carries besides the declared fields.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    lines, fragmented = order_lines(table("lineitem"), max_posts)
    year = F.year("o_orderdate")
    customer = table("customer").select("c_custkey", "c_mktsegment")
    filings = (
        table("orders")
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice", "o_orderstatus")
        .withColumn("ordinal", F.monotonically_increasing_id())
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(_post_lists(lines, fragmented), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .drop("l_orderkey")
        .withColumn("fragment", F.coalesce("fragment", F.lit(0)))
    )
    accounts = _accounts(lines, table("supplier"), fragmented, open_amounts).withColumnRenamed("fragment", "account_fragment")
    filings = filings.join(
        accounts,
        (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("fragment") == F.col("account_fragment")),
        "left",
    )

    sums = {name: major_sql(name) for name in LIST_SUMS}
    sums["aarsresultat"] = f"case when fragment = 0 then {major_sql('(coalesce(inntekter, 0) - coalesce(kostnader, 0))')} end"
    sums["sumGjeldOgEgenkapital"] = "case when fragment = 0 then o_totalprice end"

    def lists(name: str, element: str) -> Column:
        posts = f"list{LISTS.index(name)}"
        return F.expr(f"named_struct('{element}', case when size({posts}) > 0 then {posts} end) as {name}")

    def scalar(name: str) -> Column:
        return F.expr(f"{sums[name]} as {name}")

    header = [
        F.col("o_orderdate").cast("timestamp").alias("registreringstidspunkt"),
        F.col("o_orderkey").alias("sekvensnummer"),
        F.col("ordinal"),
        F.col("fragment").cast("int").alias("fragment"),
    ]
    trade = F.col("c_mktsegment")
    duty = F.col("o_orderpriority")
    body = F.struct(
        F.lpad(F.col("o_custkey").cast("string"), 11, "0").alias("norskIdentifikator"),
        year.cast("string").alias("inntektsaar"),
        F.struct(
            F.col("o_custkey").cast("string").alias("orgnr"),
            F.when(trade == "BUILDING", "enkeltpersonforetak")
            .when(trade == "MACHINERY", "selskapMedDeltakerfastsetting")
            .when(trade == "HOUSEHOLD", "samvirkeforetak")
            .otherwise("annet")
            .alias("virksomhetstype"),
            F.when(duty == "1-URGENT", "ingenRegnskapsplikt")
            .when(duty == "2-HIGH", "begrensetRegnskapsplikt")
            .otherwise("annen")
            .alias("regnskapspliktstype"),
            F.make_date(year, F.lit(1), F.lit(1)).alias("start"),
            F.make_date(year, F.lit(12), F.lit(31)).alias("slutt"),
        ).alias("virksomhet"),
        F.struct(
            F.struct(
                lists("salgsinntekt", "inntekt"), lists("annenDriftsinntekt", "inntekt"), scalar("sumDriftsinntekt")
            ).alias("driftsinntekt"),
            F.struct(
                lists("varekostnad", "kostnad"),
                lists("loennskostnad", "kostnad"),
                lists("annenDriftskostnad", "kostnad"),
                scalar("sumDriftskostnad"),
            ).alias("driftskostnad"),
            lists("finansinntekt", "inntekt"),
            scalar("sumFinansinntekt"),
            lists("finanskostnad", "kostnad"),
            scalar("sumFinanskostnad"),
            scalar("aarsresultat"),
        ).alias("resultatregnskap"),
        F.struct(
            F.struct(
                lists("balanseverdiForAnleggsmiddel", "balanseverdi"), scalar("sumBalanseverdiForAnleggsmiddel")
            ).alias("anleggsmiddel"),
            F.struct(
                lists("balanseverdiForOmloepsmiddel", "balanseverdi"), scalar("sumBalanseverdiForOmloepsmiddel")
            ).alias("omloepsmiddel"),
            F.struct(
                lists("langsiktigGjeld", "gjeld"),
                lists("kortsiktigGjeld", "gjeld"),
                lists("egenkapital", "kapital"),
                lists("gjeldInnenBankOgForsikring", "gjeld"),
                scalar("sumLangsiktigGjeld"),
                scalar("sumKortsiktigGjeld"),
                scalar("sumEgenkapital"),
                scalar("sumGjeldInnenBankOgForsikring"),
            ).alias("gjeldOgEgenkapital"),
            scalar("sumBalanseverdiForEiendel"),
            scalar("sumGjeldOgEgenkapital"),
        ).alias("balanseregnskap"),
        F.struct(*[F.expr(f"{major_sql(a)} as {a}") for a in INVENTORY_AMOUNTS]).alias("spesifikasjonAvVarelager"),
        F.struct(F.col("accounts").alias("skogOgToemmerkonto"), F.col("numbers").alias("kontonummer")).alias("skogbruk"),
    )
    undeclared = F.struct(
        F.struct(F.col("o_orderstatus").alias("hendelsetype")).alias("hendelse"),
        F.struct(F.struct(F.col("o_orderpriority").alias("tekst"), F.struct("o_totalprice").alias("sum")).alias("merknad")).alias("naeringsspesifikasjon"),
    )
    return filings.select(F.struct(*header).alias("hendelse"), body.alias("naeringsspesifikasjon"), undeclared.alias("undeclared"))


def event_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a raw delivery: header and payload as JSON text."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return events.select(
        "user_id",
        F.struct(
            F.to_json(
                F.struct(stamp.alias("registreringstidspunkt"), F.col("event_id").alias("sekvensnummer"))
            ).alias("hendelse"),
            F.col("props").alias("naeringsspesifikasjon"),
        ).alias("data"),
    )


def garble_small_amounts(long: DataFrame) -> DataFrame:
    """Long rows where the text of a small amount is no number."""
    small = F.col("felt_verdi").cast("double") < SMALL_AMOUNT
    return long.withColumn("felt_verdi", F.when(small, "x").otherwise(F.col("felt_verdi")))
