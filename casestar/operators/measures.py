"""Report measures of the BI model, as Spark aggregates.

``by`` is ``[]`` for the latest-date snapshot, an entity for a per-entity
snapshot, or the date for the history. Division by zero is NULL, as the
report language's DIVIDE gives a blank (T28).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def growth_expr(m: str, days: int = 1) -> Column:
    """``coalesce(sum(m)/sum(lag_m), 1) ^ (1/days) - 1`` as an aggregate column.

    A negative ratio has no real root; it yields NULL instead of NaN.
    """
    ratio = F.coalesce(_ratio(F.sum(m), F.sum(f"lag_{days}_{m}")), F.lit(1.0))
    if days == 1:
        return ratio - 1
    return F.when(ratio < 0, F.lit(None).cast("double")) \
        .otherwise(F.pow(ratio, 1.0 / days)) - 1


def growth(df: DataFrame, by: Sequence[str], measures: Sequence[str], days: int = 1) -> DataFrame:
    """Daily growth vs. the previous day (O70) or week, as 7th root."""
    cols = [growth_expr(m, days).alias(f"growth_{m}_{days}d") for m in measures]
    return df.groupBy(*by).agg(*cols)


def ratio(df: DataFrame, by: Sequence[str], a: str, b: str, name: str = "ratio") -> DataFrame:
    """``sum(a) / sum(b)``, NULL when the denominator is 0."""
    return df.groupBy(*by).agg(_ratio(F.sum(a), F.sum(b)).alias(name))


def ratio_delta_expr(a: str, b: str, n: int = 1) -> Column:
    num = F.sum(a) - F.sum(f"lag_{n}_{a}")
    den = F.sum(b) - F.sum(f"lag_{n}_{b}")
    return _ratio(num, den)


def ratio_delta(df: DataFrame, by: Sequence[str], a: str, b: str,
                ns: Sequence[int] = (1, 7)) -> DataFrame:
    """Ratio of the day (n=1) and/or week (n=7) increments."""
    return df.groupBy(*by).agg(
        *[ratio_delta_expr(a, b, n).alias(f"ratio_delta_{n}d") for n in ns])
