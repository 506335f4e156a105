"""World-style daily series from the driver tables.

Entities are users (``events.user_id``); a user's country is the nation of
the customer with the same key. Each measure arrives as a wide table with
one column per day, the layout of the reference's world time series.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.operators.reshape import wide_dates_to_long
from casestar.plans.testviews import event_cents, table

IDS = ["Province/State", "Country/Region"]
# Countries whose sub-regions are summed into one series (a parameter of the
# feed; these two nations play the role of the reference's grouped ones).
COLLAPSE = ["NATION_1", "NATION_6"]
MEASURE_EVENT = {"confirmed": "click", "recovered": "signup", "deaths": "error"}


def _events_with_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    users = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")
    return e.join(users, e.user_id == users.c_custkey)


def day_labels(spark: SparkSession, sf_dir: str) -> list[str]:
    """Column labels of the wide tables: every day between the first and the
    last event, so that the pivot need not collect its values."""
    lo, hi = table(spark, sf_dir, "events").agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    days = [] if lo is None else [lo + dt.timedelta(i) for i in range((hi - lo).days + 1)]
    return [f"{d.month}/{d.day}/{d:%y}" for d in days]


def wide_series(spark: SparkSession, sf_dir: str, measure: str) -> DataFrame:
    """One row per (user, country), one column per ``M/d/yy`` day label."""
    rows = _events_with_country(spark, sf_dir)
    kind = MEASURE_EVENT[measure]
    rows = rows.withColumn("day_label", F.date_format("ts", "M/d/yy"))
    return (rows.groupBy(F.col("user_id").cast("string").alias("Province/State"),
                         F.col("n_name").alias("Country/Region"))
            .pivot("day_label", day_labels(spark, sf_dir))
            .agg(F.sum(F.when(F.col("event_type") == kind, event_cents()))))


def wide_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three measures from one pivot: columns ``<label>_<measure>``."""
    rows = _events_with_country(spark, sf_dir).withColumn(
        "day_label", F.date_format("ts", "M/d/yy"))
    aggs = [F.sum(F.when(F.col("event_type") == kind, event_cents())).alias(m)
            for m, kind in MEASURE_EVENT.items()]
    return (rows.groupBy(F.col("user_id").cast("string").alias("Province/State"),
                         F.col("n_name").alias("Country/Region"))
            .pivot("day_label", day_labels(spark, sf_dir)).agg(*aggs))


def wide_of(wide: DataFrame, measure: str) -> DataFrame:
    """One measure's wide table (date-label columns) out of ``wide_all``."""
    suffix = f"_{measure}"
    cols = [c for c in wide.columns if c.endswith(suffix)]
    return wide.select(*[F.col(f"`{c}`") for c in IDS],
                       *[F.col(f"`{c}`").alias(c[:-len(suffix)]) for c in cols])


def long_series(spark: SparkSession, sf_dir: str, measure: str,
                wide: DataFrame | None = None) -> DataFrame:
    """(country_region, province_state, date, <measure>) summed."""
    w = wide_series(spark, sf_dir, measure) if wide is None else wide_of(wide, measure)
    long = wide_dates_to_long(w, IDS, "Country/Region", "Province/State", COLLAPSE)
    return long.withColumnRenamed("number", measure)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id columns of the wide tables: one row per (user, country) with events."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return users.join(c, users.user_id == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("user_id").cast("string").alias(IDS[0]), F.col("n_name").alias(IDS[1]))


def collapsed(df: DataFrame, country: str, province: str) -> DataFrame:
    """The key columns of a long series: sub-regions of the grouped countries become ''."""
    c, p = F.col(f"`{country}`"), F.col(f"`{province}`")
    return df.select(c.alias("country_region"), F.when(c.isin(COLLAPSE), F.lit("")).otherwise(
        F.coalesce(p, F.lit(""))).alias("province_state"))
