"""Data-quality checks and table profile.

Each check returns the violations as a ``DataFrame``; the caller decides to
raise (``assert_empty``). All of them are distributed aggregates or joins.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Export type names per column type, as the BI tool spells them.
TYPE_TEXT = "type text"
TYPE_INTEGER = "Int64.Type"
TYPE_NUMBER = "type number"
TYPE_DATE = "type date"
TYPE_UNKNOWN = "ERROR"


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once (O55); NULL keys count as equal."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
            .filter(F.col("count") > 1))


def unique_by(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` unchanged, but the job fails if two rows agree on ``keys`` (O55, T13,
    T31; NULL keys count as equal). For dimensions and lookups, before a join."""
    twice = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    fail = F.raise_error(F.lit(f"{what}: more than one row for the same {', '.join(keys)}"))
    checked = df.withColumn("__twice", twice)
    return checked.withColumn(keys[0], F.when(F.col("__twice"), fail).otherwise(F.col(keys[0]))).drop("__twice")


def key_set_diff(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key rows present on one side only, with multiplicity."""
    ka, kb = a.select(*keys), b.select(*keys)
    left = ka.exceptAll(kb).withColumn("side", F.lit("left_only"))
    right = kb.exceptAll(ka).withColumn("side", F.lit("right_only"))
    return left.unionByName(right)


def key_fingerprints(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(side, rows, sum1, sum2): per side the number of key rows and the sums of two
    64-bit hashes of each (O56). The sums do not depend on the order, are exact
    (decimal), and tell NULLs from each other's column; sides with equal rows agree in
    all, other sides differ but for a chance of about 2**-128. One aggregate, combined
    map-side: two rows are shuffled per task."""
    marked = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    both = a.select(F.lit("left").alias("side"), *keys).unionByName(b.select(F.lit("right").alias("side"), *keys))
    return both.groupBy("side").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*marked).cast("decimal(20, 0)")).alias("sum1"),
        F.sum(F.xxhash64(F.lit("second"), *marked).cast("decimal(20, 0)")).alias("sum2"))


def assert_same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise unless both sides have the same key rows, with multiplicity (O56). Equal
    sides cost one aggregate; only different ones are compared row by row, so that the
    error can name some keys."""
    prints = [tuple(r)[1:] for r in key_fingerprints(a, b, keys).collect()]
    if not prints or (len(prints) == 2 and prints[0] == prints[1]):
        return
    some = key_set_diff(a, b, keys).take(3)
    raise AssertionError(f"check failed: {what}; for instance {some}")


def uncovered_keys(df: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``df`` without a lookup row (O57): a left anti join."""
    return df.select(*keys).distinct().join(lookup.select(*keys), list(keys), "left_anti")


def expect_count(df: DataFrame, pred: Column, expected: int) -> DataFrame:
    """One row: how many rows ``pred`` selects, the expectation, and ``ok``."""
    return (df.filter(pred).agg(F.count(F.lit(1)).alias("actual"))
            .withColumn("expected", F.lit(expected).cast("bigint"))
            .withColumn("ok", F.col("actual") == F.col("expected")))


def assert_empty(violations: DataFrame, what: str) -> None:
    """Raise if a check returned rows (looks at one row only)."""
    if violations.take(1):
        raise AssertionError(f"check failed: {what}")


def export_type(dt: T.DataType) -> str:
    if isinstance(dt, (T.StringType, T.BooleanType)):
        return TYPE_TEXT
    if isinstance(dt, (T.IntegerType, T.LongType)):
        return TYPE_INTEGER
    if isinstance(dt, T.DoubleType):
        return TYPE_NUMBER
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return TYPE_DATE
    return TYPE_UNKNOWN


def profile(df: DataFrame, name: str) -> DataFrame:
    """Per column: position, export type, row count, non-NULL count.

    One aggregate pass over ``df`` (partially aggregated per task); the
    schema part is metadata and is attached as literals.
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count(F.col(f"`{f.name}`")).alias(f"__nn{i}") for i, f in enumerate(fields)]
    entries = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(i).cast("bigint").alias("position"),
                 F.lit(export_type(f.dataType)).alias("export_type"),
                 F.col(f"__nn{i}").alias("non_null"))
        for i, f in enumerate(fields)])
    return (df.agg(*aggs)
            .select(F.lit(name).alias("table"), F.inline(entries),
                    F.col("__rows").alias("row_count")))


def observed_profile(df: DataFrame, name: str, schema: T.StructType | None = None,
                     row: Column | None = None) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``df`` with the counts of ``profile`` attached to its next action.

    Write the returned table, then call the function: it gives the profile of what was
    written, without a second scan. The counts travel with the tasks' results. Attach
    them above any range shuffle (``orderBy``, ``repartitionByRange``): its sampling
    would count the rows below it twice. ``schema`` restricts the columns, ``row`` is
    NULL for rows that do not count.
    """
    seen, fields = Observation(), (schema or df.schema).fields
    counts = [F.count(F.lit(1) if row is None else row).alias("rows")] + [
        F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)]

    def result() -> DataFrame:
        got = seen.get
        rows = [(name, f.name, i, export_type(f.dataType), got[f"c{i}"], got["rows"]) for i, f in enumerate(fields)]
        return df.sparkSession.createDataFrame(
            rows, "table string, column string, position long, export_type string, non_null long, row_count long")

    return df.observe(seen, *counts), result
