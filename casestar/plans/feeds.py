"""Feeds: mobility, policy index, country lookup, world series.

Each feed is a composition of library operators. The ``*_input`` functions
build reference-shaped inputs from the driver tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.functions.columns import parse_date
from casestar.operators import cleaning as CL
from casestar.operators import joins as J
from casestar.operators import series as S
from casestar.operators.aggregate import sum_by
from casestar.operators.checks import assert_empty, assert_same_keys, unique_by, uncovered_keys
from casestar.operators.dimensions import with_row_id
from casestar.plans import series_plan as SP
from casestar.plans import world as WD
from casestar.plans.testviews import event_cents, later, table
from casestar.session import materialize
from casestar.sources.readers import MOBILITY_COLUMNS

# The report names of the mobility report's index columns, in their order.
MOBILITY_RENAME = dict(zip(MOBILITY_COLUMNS, [
    "Einzelhandel und Freizeit", "Lebensmittel und Apotheken", "Parks", "Öffentliche Verkehrsmittel",
    "Arbeitsplatz", "Wohnort"]))


# ----------------------------------------------------------------- mobility
def mobility_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region and day: six index columns (order counts by priority, total)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey)
    rows = o.join(c.join(geo, c.c_nationkey == geo.n_nationkey), o.o_custkey == c.c_custkey)
    prio = F.substring("o_orderpriority", 1, 1)
    names = list(MOBILITY_RENAME)
    aggs = [F.sum(F.when(prio == str(i + 1), 1).otherwise(0)).cast("bigint").alias(names[i])
            for i in range(5)] + [F.count(F.lit(1)).alias(names[5])]
    return rows.groupBy(
        F.concat(F.lit("R-"), F.substring("r_name", 1, 2)).alias("iso_3166_2_code"),
        F.col("r_name").alias("sub_region_1"),
        F.date_format(later("o_orderdate"), "yyyy-MM-dd").alias("date")).agg(*aggs)


def mobility_feed(mob: DataFrame, lookup: DataFrame, state_time: DataFrame) -> DataFrame:
    """Attach state id by ISO code, parse date, rename indices, attach state-time ids."""
    m = J.attach_lookup(mob, unique_by(lookup, ["iso_3166_2_code"], "state lookup"), "iso_3166_2_code")
    m = m.withColumn("Datum", parse_date("date", "Y-m-d"))
    m = CL.rename(m, MOBILITY_RENAME)
    m = CL.project(m, ["IdBundesland", "sub_region_1", "Datum", *MOBILITY_RENAME.values()])
    keys = ["IdBundesland", "Datum"]
    return J.inner_join(unique_by(m, keys, "mobility"), unique_by(state_time, keys, "state-time"), keys)


# ------------------------------------------------------------------- policy
def policy_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per country and day (``yyyyMMdd`` integer): an index value (order count)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return rows.groupBy(F.col("n_name").alias("CountryName"),
                        F.date_format(later("o_orderdate"), "yyyyMMdd").cast("int").alias("Date")) \
        .agg(F.count(F.lit(1)).alias("StringencyIndex"))


def policy_feed(index: DataFrame, time: DataFrame, country: str) -> DataFrame:
    """One country's rows, integer date parsed, ``id_time`` attached."""
    p = CL.point_lookup(index, {"CountryName": country})
    p = p.withColumn("Datum", parse_date("Date", "Ymd"))
    return J.inner_join(unique_by(p, ["Datum"], "policy index"), time.drop("ones"), ["Datum"])


# ----------------------------------------------------------- country lookup
def lookup_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base lookup: one country-level row per nation, one row per customer."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    iso2 = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    iso3 = F.concat(F.lit("NAT"), F.col("n_nationkey").cast("string"))
    countries = n.select(F.lit(0).alias("kind"), F.col("n_nationkey").cast("bigint").alias("key"),
                         F.lit(None).cast("string").alias("Province_State"),
                         F.col("n_name").alias("Country_Region"), iso2.alias("iso2"),
                         iso3.alias("iso3"))
    users = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.lit(1).alias("kind"), F.col("c_custkey").cast("bigint").alias("key"),
        F.col("c_custkey").cast("string").alias("Province_State"),
        F.col("n_name").alias("Country_Region"), iso2.alias("iso2"), iso3.alias("iso3"))
    return countries.unionByName(users)


def map_names_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country name -> map name."""
    n = table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("country_region"),
        F.initcap(F.lower("n_name")).alias("country_region_map"))


def groups_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """iso2 -> country group."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("iso2"),
        F.col("r_name").alias("country_group"))


def country_lookup(base: DataFrame, map_names: DataFrame, groups: DataFrame,
                   data_keys: DataFrame, order_cols: Sequence[str] = ("kind", "key")) -> DataFrame:
    """Base lookup + row id + map names + groups, limited to keys with data."""
    lu = with_row_id(base, list(order_cols), "lu_id")
    # Names are case-insensitive in Spark: select instead of add-then-drop.
    rest = [c for c in lu.columns
            if c.lower() not in {"province_state", "country_region", *order_cols}]
    lu = lu.select(*rest, F.coalesce(F.col("Province_State"), F.lit("")).alias("province_state"),
                   F.col("Country_Region").alias("country_region"))
    lu = J.outer_join(lu, unique_by(map_names, ["country_region"], "map names"), on=["country_region"],
                      null_safe=True)
    lu = J.outer_join(lu, unique_by(groups, ["iso2"], "country groups"), on=["iso2"], null_safe=True)
    lu = CL.fill(lu, {"country_region_map": F.col("country_region"), "country_group": ""})
    pairs = data_keys.select("country_region", "province_state").distinct()
    return J.natural_join(lu, pairs)


# -------------------------------------------------------------- world series
def tests_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per country (iso3) and day: total tests (purchase cents of its users)."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = e.join(c, e.user_id == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return rows.groupBy(
        F.concat(F.lit("NAT"), F.col("n_nationkey").cast("string")).alias("iso_code"),
        F.col("n_name").alias("location"),
        F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(
        F.sum(event_cents()).alias("total_tests"))


def world_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country_region, province_state) of every series, from the id columns alone: a
    distinct list of entities, without the days and the measures."""
    pairs = WD.entities(spark, sf_dir)
    return WD.collapsed(pairs, "Country/Region", "Province/State").distinct()


def entity_tests(tests: DataFrame, lu: DataFrame) -> DataFrame:
    """(lu_id, date, tested): the tests of each lookup row's country, per day.

    The reference joins tests and lookup outright, then drops what has no partner and
    sums per (entity, day). Here the tests are summed per (country, day) first, so the
    join meets a calendar per country instead of its raw rows; the full outer join keeps
    the audit (unmatched countries are labelled) and is split for hot countries.
    """
    daily = materialize(sum_by(tests.select(
        "iso_code", "location", parse_date("date", "Y-m-d").alias("date"), F.coalesce("total_tests", F.lit(0)).alias("tested")),
        ["iso_code", "location", "date"], ["tested"]), "country_tests")
    known = materialize(lu.filter(F.col("iso3").isNotNull()).select("iso3", "lu_id", "country_region"), "iso_entities")
    audited = J.match_audit(daily, known, ["iso_code"], ["iso3"],
                            ["iso_code", "iso3", "location", "country_region"], hot_rows=J.HOT_ROWS)
    return sum_by(audited.select("lu_id", "date", "tested"), ["lu_id", "date"], ["tested"])


def world_series(spark: SparkSession, sf_dir: str, lookup: DataFrame | None = None) -> DataFrame:
    """Three wide series + lookup + tests -> one daily table with lags."""
    keys = ["country_region", "province_state", "date"]
    # One pivot for the three measures, written once; each long series is written too,
    # since checks and merge read it.
    wide = materialize(WD.wide_all(spark, sf_dir), "world_wide")
    co, re_, de = (materialize(WD.long_series(spark, sf_dir, m, wide), f"world_{m}")
                   for m in ("confirmed", "recovered", "deaths"))
    lu = lookup if lookup is not None else materialize(country_lookup(
        lookup_input(spark, sf_dir), map_names_input(spark, sf_dir), groups_input(spark, sf_dir),
        world_keys(spark, sf_dir)), "country_lookup")
    for other, what in ((re_, "recovered"), (de, "deaths")):
        assert_same_keys(co, other, keys, f"confirmed and {what} have the same keys")
    assert_empty(uncovered_keys(co, lu, keys[:2]), "every series is in the lookup")
    est = SP.tests_decomposed(entity_tests(tests_input(spark, sf_dir), lu))
    data = J.merge_series([co, re_, de], keys).join(
        lu.select("lu_id", "country_region", "province_state"), ["country_region", "province_state"])
    data = data.join(est, ["lu_id", "date"]).filter(F.col("date").isNotNull())
    data = CL.fill(data, {"lu_id": -1, "confirmed": 0, "recovered": 0, "deaths": 0, "tested": 0})
    data = S.estimate_active(S.lag_by(data, "lu_id", "date", ["confirmed"], 21))
    lagged = ["confirmed", "recovered", "deaths", "tested", "active", "tested_is_extrapolated"]
    for n in (1, 7):
        data = S.lag_by(data, "lu_id", "date", lagged, n)
    return data
