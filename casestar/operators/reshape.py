"""Wide <-> long reshapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casestar.functions.columns import parse_date


def measures_to_status(df: DataFrame, ids: Sequence[str], measures: Sequence[str],
                       drop_measure: str | None = "AnzahlFall", token: str = "Anzahl",
                       var_name: str = "Status", value_name: str = "Anzahl") -> DataFrame:
    """Measure columns -> (``Status``, ``Anzahl``) rows.

    The dropped measure is never unpivoted and the prefix is stripped from
    the column names up front, so the ``Expand`` emits the final labels.
    """
    keep = [m for m in measures if m != drop_measure]
    renamed = {m: m.replace(token, "") for m in keep}
    base = df.select(*ids, *[F.col(m).alias(renamed[m]) for m in keep])
    return base.unpivot(list(ids), list(renamed.values()), var_name, value_name)


def wide_dates_to_long(df: DataFrame, ids: Sequence[str], group_col: str,
                       sub_col: str, collapse: Sequence[str],
                       layout: str = "m/d/y", value_name: str = "number") -> DataFrame:
    """One column per date -> (entity, date, number), summed.

    Every column not in ``ids`` is a date label in ``layout``; the list comes
    from the schema. Rows whose ``group_col`` is in ``collapse`` lose their
    sub-region (``sub_col`` becomes ''), others get '' for NULL, then the
    numbers are summed per (group, sub-region, date) with NULL sums as 0.
    """
    date_cols = [c for c in df.columns if c not in set(ids)]
    long = df.unpivot(list(ids), date_cols, "date_label", value_name)
    sub = F.when(F.col(group_col).isin(list(collapse)), F.lit("")).otherwise(
        F.coalesce(F.col(sub_col).cast("string"), F.lit("")))
    long = long.select(
        F.col(group_col).alias("country_region"),
        sub.alias("province_state"),
        parse_date("date_label", layout).alias("date"),
        F.col(value_name))
    return (long.groupBy("country_region", "province_state", "date")
            .agg(F.coalesce(F.sum(value_name), F.lit(0)).alias(value_name)))
