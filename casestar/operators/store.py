"""A fact store parted by month, for filters that need few of its days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH = "month"


def write_fact_store(facts: DataFrame, date_col: str, path: str, keys: Sequence[str] = ()) -> None:
    """Write facts parted by month of ``date_col``, sorted by date and ``keys`` inside.

    Rows are dealt by range of (month, date, keys), so a busy month is written by
    several tasks and a quiet one makes one file; sorted files have narrow value
    ranges, by which a reader skips row groups. NULL dates have a part of their own.
    """
    n = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [MONTH, date_col, *keys]
    (facts.withColumn(MONTH, F.date_format(date_col, "yyyy-MM")).repartitionByRange(n, *order)
     .sortWithinPartitions(*order).write.mode("overwrite").partitionBy(MONTH).parquet(path))


def read_fact_store(spark: SparkSession, path: str, date_col: str | None = None, lo=None, hi=None) -> DataFrame:
    """The store's rows, or those of the days from ``lo`` to ``hi`` (dates, either may be
    None): only the parts of their months are listed for reading."""
    df = spark.read.schema(_schema(spark, path)).parquet(path)
    if lo is not None:
        df = df.filter((F.col(MONTH) >= f"{lo:%Y-%m}") & (F.col(date_col) >= F.lit(lo)))
    if hi is not None:
        df = df.filter((F.col(MONTH) <= f"{hi:%Y-%m}") & (F.col(date_col) <= F.lit(hi)))
    return df.drop(MONTH)


def last_month(spark: SparkSession, path: str) -> str | None:
    """The latest month in the store, from the names of its folders; no file is read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    months = [x.split("=", 1)[1] for x in names if x.startswith(f"{MONTH}=") and not x.endswith("__")]
    return max(months, default=None)


def latest_of_store(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    """Rows of the latest date (O30), reading the latest month only: its name prunes the
    scan, and the date within it is a scalar subquery over the same files."""
    df = spark.read.schema(_schema(spark, path)).parquet(path)
    df = df.filter(F.col(MONTH) == F.lit(last_month(spark, path)))
    return df.filter(F.col(date_col) == df.agg(F.max(date_col)).scalar()).drop(MONTH)


def _schema(spark: SparkSession, path: str) -> T.StructType:
    """The store's schema with the month as text, whatever it looks like."""
    fields = [f for f in spark.read.parquet(path).schema.fields if f.name != MONTH]
    return T.StructType([*fields, T.StructField(MONTH, T.StringType())])
