"""Packed densifying, spread products, split outer joins, keyed merges, fingerprints."""

import random
import re

import pytest
from pyspark.sql import functions as F

from casestar.operators import checks as CK
from casestar.operators import dimensions as D
from casestar.operators import facts as FA
from casestar.operators import joins as J
from casestar.plans import testviews as TV
from casestar.plans.queries import _bridge, _shared_facts
from casestar.session import materialize


@pytest.fixture
def broadcasts(spark, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
    spark.conf.set("spark.sql.shuffle.partitions", before[1])


def rows_by_task(df):
    return {r[0]: r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()}


@pytest.fixture(scope="module")
def few_days(spark, small_dir):
    facts = _shared_facts(spark, small_dir)
    return materialize(facts.filter("Meldedatum >= date'2021-12-01'"), "few_days")


@pytest.mark.parametrize("broadcasts", ["-1", "10m"], indirect=True)
def test_span_and_dense_facts_use_every_task(broadcasts, few_days):
    bridge = _bridge(few_days)
    for df in (D.dense_span(bridge, few_days), FA.densify_packed(bridge, few_days)):
        tasks = rows_by_task(df)
        assert len(tasks) == 6 and max(tasks.values()) < 3 * min(tasks.values()), tasks


def test_packed_equals_the_joined_span(few_days):
    bridge = _bridge(few_days)
    want = FA.densify(D.dense_span(bridge, few_days), few_days)
    got = FA.densify_packed(bridge, few_days)
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_packing_shuffles_bridge_rows_only(few_days):
    """Above the exchanges the category product is exploded; the span meets no exchange."""
    plan = FA.densify_packed(_bridge(few_days), few_days)._jdf.queryExecution().executedPlan().toString()
    nodes = re.findall(r"^[ +-]*(Generate|Exchange|BroadcastExchange|SortMergeJoin|BroadcastHashJoin)\b", plan, re.M)
    assert nodes[:3] == ["Generate"] * 3 and nodes[3].endswith("Join"), nodes


def test_two_facts_for_a_key_fail(few_days):
    twice = few_days.union(few_days.limit(1))
    with pytest.raises(Exception, match="(?i)duplicate"):
        FA.densify_packed(_bridge(few_days), twice).write.format("noop").mode("overwrite").save()


def test_many_facts_of_a_day(spark):
    """All combinations of 5 ages, 4 sexes and 3 statuses on one district and day, and none on the next."""
    facts = spark.createDataFrame(
        [(1, "S", "01001", "D", "2020-01-01", f"A{a}", f"g{g}", f"t{t}", a * 100 + g * 10 + t)
         for a in range(5) for g in range(4) for t in range(3)]
        + [(1, "S", "01001", "D", "2020-01-02", "A1", "g1", "t1", None)],
        "IdBundesland long, Bundesland string, IdLandkreis string, Landkreis string, d string, Altersgruppe string, "
        "Geschlecht string, Status string, Anzahl long").withColumn("Meldedatum", F.col("d").cast("date")).drop("d")
    got = FA.attach_packed(D.geo_time_keys(D.geo_dim(facts), D.date_dim(facts)), facts).collect()
    assert len(got) == 2 * 60
    assert all(r.Anzahl == int(r.Altersgruppe[1]) * 100 + int(r.Geschlecht[1]) * 10 + int(r.Status[1])
               for r in got if r.id_time == 0)
    assert all(r.Anzahl is None for r in got if r.id_time == 1)


@pytest.mark.parametrize("broadcasts", ["-1", "10m"], indirect=True)
def test_product_is_spread(spark, broadcasts):
    a, b = spark.range(3000).withColumnRenamed("id", "x"), spark.range(70).withColumnRenamed("id", "y")
    for size in (5_000, 20):
        df = J.cross(a.repartition(6), b, block_rows=size)
        tasks = rows_by_task(df)
        assert sum(tasks.values()) == 210_000 and df.distinct().count() == 210_000
        assert max(tasks.values()) < 210_000 / 2, tasks


def outer_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("hot", [1, 7, 10 ** 9])
def test_split_outer_join_equals_the_plain_one(spark, hot):
    rng = random.Random(hot)
    a = [(rng.choice([None, "hot", "left", *range(9)]), i) for i in range(120)]
    b = [(rng.choice([None, "hot", "hot", "right", *range(5, 15)]), -i) for i in range(90)]
    a = materialize(spark.createDataFrame([(x if x is None else str(x), v) for x, v in a], "k string, v long"), "a")
    b = materialize(spark.createDataFrame([(x if x is None else str(x), v) for x, v in b], "l string, w long"), "b")
    want = outer_rows(a.join(b, a.k == b.l, "full"))
    assert outer_rows(J.split_outer_join(a, b, ["k"], ["l"], hot_rows=hot)) == want
    audited = J.match_audit(a, b, ["k"], ["l"], ["k", "l"], hot_rows=hot)
    assert outer_rows(audited) == outer_rows(J.match_audit(a, b, ["k"], ["l"], ["k", "l"]))


@pytest.mark.parametrize("broadcasts", ["-1"], indirect=True)
def test_hot_key_is_spread(spark, broadcasts):
    a = materialize(spark.range(6000).select(F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id")).alias("k"), "id"), "a")
    b = materialize(spark.range(60).select(F.when(F.col("id") < 40, 1).otherwise(F.col("id")).alias("l"), F.col("id").alias("w")), "b")
    df = J.split_outer_join(a, b, ["k"], ["l"], hot_rows=300)
    tasks = rows_by_task(df.filter("k = 1"))
    assert sum(tasks.values()) == 4800 * 40 and max(tasks.values()) < 0.5 * 4800 * 40, tasks


def test_merge_equals_the_chain_in_one_exchange(spark):
    rng = random.Random(4)
    dfs = [spark.createDataFrame([(k if k < 38 else None, f"d{k % 3}", rng.choice([None, k])) for k in range(40) if rng.random() < 0.8],
                                 f"k long, d string, v{i} long") for i in range(3)]
    keys = ["k", "d"]
    got, want = J.merge_series(dfs, keys), J.join_all(dfs, [keys, keys])
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert got.columns == want.columns and outer_rows(got) == outer_rows(want)
    with pytest.raises(Exception, match="two rows for the same"):
        J.merge_series([dfs[0], dfs[1].union(dfs[1])], keys).collect()


def test_fingerprints(spark):
    kind = "k string, d string"
    a = spark.createDataFrame([("x", "y"), (None, "z"), ("z", None), ("x", "y")], kind)

    def same(b):
        left, right = (tuple(r)[1:] for r in CK.key_fingerprints(a, b, ["k", "d"]).orderBy("side").collect())
        return left == right

    assert same(a.orderBy("d"))
    assert not same(spark.createDataFrame([("x", "y"), (None, "z"), (None, "z"), ("x", "y")], kind))
    assert not same(spark.createDataFrame([("x", "y"), ("z", None), ("z", None), (None, "z")], kind))
    assert not same(a.distinct())
    CK.assert_same_keys(a, a.orderBy("k"), ["k", "d"], "same")
    CK.assert_same_keys(a.limit(0), a.limit(0), ["k", "d"], "empty")
    for other in (a.distinct(), a.limit(0), a.union(a)):
        with pytest.raises(AssertionError, match="keys differ"):
            CK.assert_same_keys(a, other, ["k", "d"], "keys differ")


def test_equal_series_need_no_row_by_row_comparison(spark, monkeypatch):
    monkeypatch.setattr(CK, "key_set_diff", lambda *a: pytest.fail("compared row by row"))
    df = spark.range(100)
    CK.assert_same_keys(df, df.orderBy(F.desc("id")), ["id"], "same")


def test_view_exercises_the_rules(spark, small_dir):
    raw = TV.case_reports(spark, small_dir)
    wide, merged = raw.na.drop(subset=FA.FACT_KEYS).groupBy(*FA.FACT_KEYS).count(), FA.normalise_and_sum(raw)
    assert merged.count() < wide.count()
    assert raw.filter("Geschlecht is null").count() > 0 and raw.filter("AnzahlFall < 0").count() > 0
    assert raw.select("Altersgruppe").distinct().count() >= 7
    assert merged.filter("Landkreis like '%ö%'").count() > 0 and merged.filter("Landkreis like '%alt%'").count() == 0
    assert D.date_dim(merged).select("time_cat").distinct().count() == 9
