"""Chunked series operators against the window form."""

import random

import pytest
from pyspark.sql import functions as F

from casestar.operators import chunked as CH
from casestar.operators import series as S


def table(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in ["a", "b", "c", None, "one", "none", "hot"]:
        n = {"one": 1, "hot": 300}.get(k, rng.randint(2, 25))
        for t in rng.sample(range(400), n):
            v = None if k == "none" or rng.random() < 0.6 else rng.randint(0, 50)
            rows.append((k, t, v, rng.randint(0, 9)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, v long, m long").repartition(3)


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)

    def rows(df):
        return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect()), key=repr)

    assert rows(a) == rows(b)


@pytest.mark.parametrize("chunks", [1, 4, 40])
def test_equal_to_windows(spark, chunks):
    df = table(spark, chunks)
    same(CH.position(df, "k", "t", chunks=chunks), S.series_position(df, "k", "t"))
    same(CH.ffill(df, "k", "t", "v", "f", chunks=chunks), S.ffill(df, "k", "t", "v", "f"))
    same(CH.ffill(df, "k", "t", "v", chunks=chunks), S.ffill(df, "k", "t", "v"))
    same(CH.interpolate(df, "k", "t", "v", "y", chunks=chunks), S.interpolate(df, "k", "t", "v", "y"))
    same(CH.interpolate(df, "k", "t", "v", "y", floor=None, chunks=chunks), S.interpolate(df, "k", "t", "v", "y", floor=None))
    for n, size in ((1, 1), (7, 3), (21, 50)):
        same(CH.lag_by(df, "k", "t", ["v", "m"], n, chunks=chunks, rows_per_chunk=size), S.lag_by(df, "k", "t", ["v", "m"], n))


def test_known_points_in_few_chunks(spark):
    """Long gaps: chunks without known points, and with a single one."""
    known = {0: [], 1: [57], 2: [3, 91], 3: [40, 41, 95]}
    df = spark.createDataFrame([(k, t, t * k if t in at else None) for k, at in known.items() for t in range(100)],
                               "k int, t int, v int")
    for chunks in (3, 60):
        same(CH.interpolate(df, "k", "t", "v", "y", chunks=chunks), S.interpolate(df, "k", "t", "v", "y"))


def test_one_long_entity_uses_many_tasks(spark):
    """Five million rows of one entity: no task holds them all, and the ends are right."""
    n, before = 5_000_000, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    df = spark.range(n).select(F.lit("x").alias("k"), F.col("id").alias("t"),
                               F.when(F.col("id") % 1000 == 0, F.col("id") * 2).alias("v"))
    out = CH.interpolate(df, "k", "t", "v", "y", chunks=16)
    tasks = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(tasks) > 3 and max(tasks) < n / 2
    assert out.filter(F.abs(F.col("y") - F.col("t") * 2) > 1e-3).isEmpty()
    lagged = CH.lag_by(df.select("k", "t", "t").toDF("k", "t", "c"), "k", "t", ["c"], 7, chunks=16, rows_per_chunk=400_000)
    assert lagged.filter(F.col("lag_7_c") != F.greatest(F.col("t") - 7, F.lit(0))).isEmpty() and lagged.count() == n
