"""Daily per-entity series: test estimates, active cases, lags.

All steps share ``partitionBy(lu_id).orderBy(date)``; Spark plans one
shuffle and one sort for the whole chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casestar.functions.columns import zero_as_null
from casestar.operators import series as S

KEY, DATE = "lu_id", "date"
LAGGED = ["confirmed", "recovered", "deaths", "tested", "active"]


def tests_clean(daily: DataFrame) -> DataFrame:
    """Reported tests and the same with zeros as missing."""
    return daily.select(KEY, DATE, F.col("tested").alias("tested_reported"),
                        zero_as_null("tested").alias("tested_reported_or_nan"))


def tests_estimated(daily: DataFrame) -> DataFrame:
    """Announced (forward-filled) and estimated (interpolated) tests."""
    te = S.ffill(tests_clean(daily), KEY, DATE, "tested_reported_or_nan", "tested_announced")
    return S.interpolate(te, KEY, DATE, "tested_reported_or_nan", "tested")


def tests_decomposed(daily: DataFrame) -> DataFrame:
    """Reported vs. estimated tests, rounded half-to-even."""
    out = S.decompose_estimate(tests_estimated(daily))
    return out.select(KEY, DATE, "tested_reported", "tested_announced", "tested_extrapolated",
                      "tested", "tested_is_extrapolated")


def series_active(daily: DataFrame) -> DataFrame:
    """Lag-21 confirmed, probably recovered and active cases."""
    return S.estimate_active(S.lag_by(daily, KEY, DATE, ["confirmed"], 21))


def series_lags(daily: DataFrame, lags=(1, 7)) -> DataFrame:
    """``series_active`` plus the day and week lags of the five measures."""
    out = series_active(daily)
    for n in lags:
        out = S.lag_by(out, KEY, DATE, LAGGED, n)
    return out
