"""Projections, defaults and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep a named column list, in order."""
    return df.select(*cols)


def drop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop named columns."""
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename through a dictionary (O11); unknown names are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """Add a literal column."""
    return df.withColumn(name, F.lit(value))


def fill(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs per column.

    A value may be a literal (0, '', 'missing', -1) or a ``Column`` (fill
    from another column, e.g. ``F.col('country_region')``).
    """
    out = {c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v))
           for c, v in defaults.items()}
    return df.withColumns(out)


def exclude_value(df: DataFrame, col: str, value) -> DataFrame:
    """Drop one category (O24); NULLs are dropped too, as SQL ``<>`` does."""
    return df.filter(F.col(col) != F.lit(value))


def keep_present(df: DataFrame, col: str, present: bool = True) -> DataFrame:
    """Keep rows whose ``col`` is non-NULL (or, with ``present=False``, NULL)."""
    c = F.col(col)
    return df.filter(c.isNotNull() if present else c.isNull())


def nonzero(df: DataFrame, col: str = "Anzahl") -> DataFrame:
    """Keep non-zero measures; negatives stay."""
    return df.filter(F.col(col) != 0)


def point_lookup(df: DataFrame, conditions: Mapping[str, object]) -> DataFrame:
    """AND-ed equality lookup (O27); pushed down to the Parquet scan."""
    cond = F.lit(True)
    for c, v in conditions.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.filter(cond)


def in_set(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Membership in a fixed set."""
    return df.filter(F.col(col).isin(list(values)))


def negative_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows with a negative measure."""
    return df.filter(F.col(col) < 0)


def latest_snapshot(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the latest date only.

    The maximum is a scalar subquery (one small aggregate job, its value
    inlined into the filter), so no join and no shuffle of the rows.
    """
    top = df.agg(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) == top)
