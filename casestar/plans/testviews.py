"""Driver tables -> reference-shaped inputs.

The driver ships TPC-H-like Parquet tables. These views give them the shape
of the reference's inputs so every operator runs on data Spark derives from
the given tables and grows with them. ``casestar.oracle`` holds the same
views as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.functions.columns import pad_code

# Fixed values of this adapter (not of the reference): which driver
# category stands in for which age band / sex.
# (customers with an even key, with an odd key).
SEGMENT_AGE = {
    "AUTOMOBILE": ("A00-A04", "A05-A14"),
    "BUILDING": ("A15-A34", "A15-A34"),
    "FURNITURE": ("A35-A59", "A35-A59"),
    "MACHINERY": ("A60-A79", "A80+"),
    "HOUSEHOLD": ("unbekannt", "unbekannt"),
}
# So that the rules for retired codes and names, periods, NULL keys and negative counts
# are exercised: every second line item of one nation is reported under a retired code,
# of another one under an old name; dates are moved so that the last order is at the end of the last period; each
# order whose key divides by these numbers has no sex, or negative counts.
TWO_CODES, CODES = 4, (5334, 5354)
TWO_NAMES, NAMES = 3, ("LK Göttingen", "LK Göttingen (alt)")
DAYS_LATER = 7463
NO_SEX, NEGATIVE = 97, 89
STATUS_SEX = {"F": "W", "O": "M", "P": "unbekannt"}
# Event types standing in for the daily measures.
EVENT_MEASURE = {
    "click": "confirmed",
    "error": "deaths",
    "signup": "recovered",
    "purchase": "tested",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map(col: str, mapping: dict) -> F.Column:
    out = None
    for k, v in mapping.items():
        cond = F.col(col) == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out


def district_code(nation: str = "n_nationkey", region: str = "n_regionkey") -> F.Column:
    """District code of a nation, the one it is not retired from."""
    return F.when(F.col(nation) == TWO_CODES, F.lit(CODES[0])).otherwise(
        F.col(region).cast("bigint") * 1000 + F.col(nation)).cast("bigint")


def later(date: str) -> F.Column:
    """An order date, moved."""
    return F.col(date) + F.expr(f"INTERVAL {DAYS_LATER} DAYS")


def case_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw case reports, one row per line item (60 k rows at sf0.01).

    The order-side dimension chain (orders -> customer -> nation -> region)
    is joined first so the line items, the only table of their size, are
    shuffled once, on the order key.
    """
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    geo = n.join(r, n.n_regionkey == r.r_regionkey)
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey)
    # Per-order attributes are computed once per order, before the join.
    odd = F.col("c_custkey") % 2 == 1
    ords = o.join(cust, o.o_custkey == cust.c_custkey).select(
        "o_orderkey",
        F.col("r_regionkey").cast("bigint").alias("IdBundesland"),
        F.col("r_name").alias("Bundesland"),
        district_code().alias("IdLandkreis"),
        F.when(F.col("n_nationkey") != TWO_NAMES, F.col("n_name")).otherwise(F.lit(NAMES[0])).alias("Landkreis"),
        F.date_format(later("o_orderdate"), "yyyy/MM/dd HH:mm:ss").alias("Meldedatum"),
        F.when(odd, _map("c_mktsegment", {k: v[1] for k, v in SEGMENT_AGE.items()})).otherwise(
            _map("c_mktsegment", {k: v[0] for k, v in SEGMENT_AGE.items()})).alias("Altersgruppe"),
        F.when(F.col("o_orderkey") % NO_SEX != 0, _map("o_orderstatus", STATUS_SEX)).alias("Geschlecht"))
    # Line items x orders is the big-big join; its strategy is left to Spark.
    rows = li.join(ords, li.l_orderkey == ords.o_orderkey)
    sign = F.when(F.col("l_orderkey") % NEGATIVE == 0, F.lit(-1)).otherwise(F.lit(1))
    qty = F.col("l_quantity").cast("bigint") * sign
    zero = F.lit(0).cast("bigint")
    second = F.col("l_linenumber") % 2 == 0
    return rows.select(
        "IdBundesland", "Bundesland",
        F.when((F.col("IdLandkreis") == CODES[0]) & second, F.lit(CODES[1]).cast("bigint")).otherwise(
            F.col("IdLandkreis")).alias("IdLandkreis"),
        F.when((F.col("Landkreis") == NAMES[0]) & second, F.lit(NAMES[1])).otherwise(F.col("Landkreis")).alias("Landkreis"),
        "Meldedatum", "Altersgruppe", "Geschlecht", qty.alias("AnzahlFall"),
        F.when(F.col("l_returnflag") == "R", qty).otherwise(zero).alias("AnzahlTodesfall"),
        F.when(F.col("l_returnflag") == "A", qty).otherwise(zero).alias("AnzahlGenesen"),
    )


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District lookup: padded code ``rs`` and ``population`` (customers per nation)."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", "n_name")
    pop = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("population"))
    d = n.join(pop, n.n_nationkey == pop.c_nationkey, "left")
    return d.select(
        pad_code(district_code()).alias("rs"),
        F.col("n_name").alias("name"),
        F.coalesce(F.col("population"), F.lit(0)).cast("bigint").alias("population"))


def district_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District categories: ``kreis_id``, ``krs17`` and a pass-through count."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    sup = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n_suppliers"))
    d = n.join(sup, n.n_nationkey == sup.s_nationkey, "left")
    return d.select(
        pad_code(district_code()).alias("kreis_id"),
        F.col("n_nationkey").cast("bigint").alias("krs17"),
        F.coalesce(F.col("n_suppliers"), F.lit(0)).cast("bigint").alias("n_suppliers"))


def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State code -> state id, the shape of the ISO lookup file."""
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("R-"), F.substring("r_name", 1, 2)).alias("iso_3166_2_code"),
        F.col("r_regionkey").cast("bigint").alias("IdBundesland"))


def event_cents() -> F.Column:
    return F.round(F.col("value") * 100).cast("bigint")


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per entity and day: confirmed, deaths, recovered, tested (cents).

    One row per (user, day) that has any event; a measure without events of
    its type that day is 0.
    """
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    cents = event_cents()
    aggs = [F.coalesce(F.sum(F.when(F.col("event_type") == k, cents)),
                       F.lit(0).cast("bigint")).alias(v) for k, v in EVENT_MEASURE.items()]
    return (e.groupBy(F.col("user_id").alias("lu_id"), F.col("ts").cast("date").alias("date"))
            .agg(*aggs))
