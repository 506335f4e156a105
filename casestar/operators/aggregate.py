"""Aggregations, distinct and ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum measures per key (O41, O43) with the reference's NULL rules.

    Rows with a NULL in any key are dropped (pandas ``groupby`` default) and
    an all-NULL group sums to 0, not NULL. Spark combines map-side before the
    shuffle, so a hot key costs one partial row per input partition.
    """
    keys = list(keys)
    return (df.na.drop(subset=keys)
            .groupBy(*keys)
            .agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]))


def groupby_count_desc(df: DataFrame, cols: Sequence[str], ascending: bool = False,
                       name: str = "count") -> DataFrame:
    """Row count per group, NULL groups kept, ordered by the count."""
    out = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.col(name).asc() if ascending else F.col(name).desc())


def distinct_of(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct combinations of the chosen columns."""
    return df.select(*cols).distinct()


def date_bounds(df: DataFrame, col: str) -> DataFrame:
    """One row with the smallest and largest date."""
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def max_date_table(df: DataFrame, col: str) -> DataFrame:
    """The one-row ``max_date`` export."""
    return df.agg(F.max(col).alias("max_date"))


def bounds_scalar(df: DataFrame, col: str) -> tuple[Column, Column]:
    """(min, max) of ``col`` as lazily evaluated scalar-subquery columns."""
    s = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    return s["lo"], s["hi"]


def rollup_status(facts: DataFrame, by: str = "Altersgruppe") -> DataFrame:
    """Long facts summed by category and status; zero sums kept."""
    return (facts.groupBy(by, "Status")
            .agg(F.coalesce(F.sum("Anzahl"), F.lit(0)).alias("Anzahl"))
            .select(by, "Anzahl", "Status"))


def order_by(df: DataFrame, cols: Sequence[str], ascending: bool = True) -> DataFrame:
    """Global order by the given columns (O78); a range-partitioned sort."""
    return df.orderBy(*[F.col(c).asc() if ascending else F.col(c).desc() for c in cols])
