"""Per-entity time-series operators.

All operators share one window order, ``partitionBy(entity).orderBy(date)``,
so a chain of them costs one shuffle (by entity) and one sort; Spark stacks
the window operators on the already sorted partitions. An entity's series is
one window partition: a hot entity is bounded by its number of days, never by
the raw event volume (series are per-day sums).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

U_PRE, U_FOL, CUR = Window.unboundedPreceding, Window.unboundedFollowing, Window.currentRow


def _w(k: str | Sequence[str], t: str):
    keys = [k] if isinstance(k, str) else list(k)
    return Window.partitionBy(*keys).orderBy(t)


def series_position(df: DataFrame, k, t: str, name: str = "counter") -> DataFrame:
    """0-based row position per entity by date."""
    return df.withColumn(name, (F.row_number().over(_w(k, t)) - 1).cast("bigint"))


def ffill(df: DataFrame, k, t: str, v: str, name: str | None = None) -> DataFrame:
    """Carry the last known value forward; a leading gap stays NULL."""
    w = _w(k, t).rowsBetween(U_PRE, CUR)
    return df.withColumn(name or v, F.last(v, ignorenulls=True).over(w))


def interpolate(df: DataFrame, k, t: str, v: str, name: str = "interpolated",
                floor: float | None = 0.0) -> DataFrame:
    """Piecewise-linear fill over row position, extrapolated, floored.

    x is the row position (T25). Each known point that has a predecessor
    carries its segment (x0, y0, x1, y1), covering x in (x0, x1]; a row uses
    the first segment at or after it, else the last one, which extends the
    first and last segments outward. Series with fewer than two known points
    fall back to the forward fill. Windows only, no UDF.
    """
    w = _w(k, t)
    xs = "__x"
    df = df.withColumn(xs, (F.row_number().over(w) - 1).cast("double"))
    y = F.col(v).cast("double")
    known = F.when(F.col(v).isNotNull(), F.struct(F.col(xs).alias("x"), y.alias("y")))
    df = df.withColumns({
        "__prev": F.last(known, ignorenulls=True).over(w.rowsBetween(U_PRE, -1)),
        "__n": F.count(v).over(w.rowsBetween(U_PRE, U_FOL)),
        "__ff": F.last(v, ignorenulls=True).over(w.rowsBetween(U_PRE, CUR)),
    })
    seg = F.when(F.col(v).isNotNull() & F.col("__prev").isNotNull(),
                 F.struct(F.col("__prev.x").alias("x0"), F.col("__prev.y").alias("y0"),
                          F.col(xs).alias("x1"), y.alias("y1")))
    df = df.withColumn("__seg", seg)
    # The first segment at or after a row is the last one in descending order;
    # that frame grows row by row, so a series costs linear time.
    keys = [k] if isinstance(k, str) else list(k)
    back = Window.partitionBy(*keys).orderBy(F.desc(xs)).rowsBetween(U_PRE, CUR)
    s = F.coalesce(F.last("__seg", ignorenulls=True).over(back),
                   F.last("__seg", ignorenulls=True).over(w.rowsBetween(U_PRE, U_FOL)))
    df = df.withColumn("__s", s)
    slope = (F.col("__s.y1") - F.col("__s.y0")) / (F.col("__s.x1") - F.col("__s.x0"))
    line = slope * (F.col(xs) - F.col("__s.x0")) + F.col("__s.y0")
    if floor is not None:
        line = F.greatest(line, F.lit(float(floor)))
    out = F.when(F.col("__n") >= 2, line).otherwise(F.col("__ff").cast("double"))
    return df.withColumn(name, out).drop(xs, "__prev", "__n", "__ff", "__seg", "__s")


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Append per-entity results into one table by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def decompose_estimate(df: DataFrame, reported_or_null: str = "tested_reported_or_nan",
                       announced: str = "tested_announced", estimated: str = "tested",
                       prefix: str = "tested") -> DataFrame:
    """Announced, estimated total, their difference and an is-estimated flag.

    Half-to-even rounding (T26); the difference uses the already rounded
    inputs.
    """
    z = F.lit(0.0)
    df = df.withColumns({
        announced: F.bround(F.coalesce(F.col(announced).cast("double"), z), 0),
        estimated: F.bround(F.coalesce(F.col(estimated).cast("double"), z), 0),
    })
    return df.withColumns({
        f"{prefix}_extrapolated": F.bround(F.coalesce(F.col(estimated) - F.col(announced), z), 0),
        f"{prefix}_is_extrapolated": F.when(F.col(reported_or_null).isNull(), F.lit(1))
        .otherwise(F.lit(0)).cast("bigint"),
    })


def lag_by(df: DataFrame, k, t: str, cols: Sequence[str], n: int,
           prefix: str | None = None) -> DataFrame:
    """Value ``n`` rows earlier per entity, 0 if none (O68, T24: rows, not days)."""
    w = _w(k, t)
    p = prefix if prefix is not None else f"lag_{n}_"
    return df.withColumns({f"{p}{c}": F.coalesce(F.lag(c, n).over(w), F.lit(0)) for c in cols})


def estimate_active(df: DataFrame, confirmed: str = "confirmed", recovered: str = "recovered",
                    deaths: str = "deaths", lag21: str = "lag_21_confirmed") -> DataFrame:
    """Probably recovered and remaining active cases.

    ``greatest(least(lag21, confirmed) - recovered - deaths, 0)``; inputs are
    zero-filled first, so ``least``/``greatest`` skipping NULLs cannot differ
    from NaN propagation (T27).
    """
    c, r, d = F.col(confirmed), F.col(recovered), F.col(deaths)
    df = df.withColumn("probably_recovered",
                       F.greatest(F.least(F.col(lag21), c) - r - d, F.lit(0)))
    return df.withColumn("active",
                         F.coalesce(c - d - r - F.col("probably_recovered"), F.lit(0)))
