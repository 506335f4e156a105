"""Series operators for entities too long for one task.

The operators of ``series`` put an entity's rows in one window partition. Here the
rows are dealt by range of (entity, time) and written, so that a long entity lies in
many chunks, one per range. Each chunk is scanned by itself; what it passes on to its
neighbours (its number of rows, its first and last known points) is one row per
(entity, chunk). These rows are carried across chunks, and joined back. Results equal
those of the window form; equal times of an entity lie in one chunk, in any order.

NULL entities and times are a series and a time like any other (NULL times first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casestar.session import materialize

PART = "__part"
LAG_ROWS = 1 << 20      # rows of an entity in a lag's chunk


def in_ranges(df: DataFrame, k: str, t: str, chunks: int | None = None) -> DataFrame:
    """``df`` written by range of (entity, time), with the range's number."""
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, k, t).withColumn(PART, F.spark_partition_id()), "chunks")


def _inside(k: str, t: str):
    return Window.partitionBy(k, PART).orderBy(t)


def _across(k: str):
    return Window.partitionBy(k).orderBy(PART)


def _attached(rows: DataFrame, carried: DataFrame, k: str) -> DataFrame:
    """Join each chunk's carried values to its rows; a NULL entity finds its own."""
    c = carried.select(F.col(k).alias("__k"), F.col(PART).alias("__p"), *[x for x in carried.columns if x not in (k, PART)])
    return rows.join(c, rows[k].eqNullSafe(c["__k"]) & (rows[PART] == c["__p"])).drop("__k", "__p")


def position(df: DataFrame, k: str, t: str, name: str = "counter", chunks: int | None = None) -> DataFrame:
    """0-based row position per entity by time."""
    rows = in_ranges(df, k, t, chunks).withColumn("__x", F.row_number().over(_inside(k, t)) - 1)
    sizes = rows.groupBy(k, PART).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__off", F.coalesce(F.sum("__n").over(
        _across(k).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    return _attached(rows, before, k).withColumn(name, (F.col("__off") + F.col("__x")).cast("bigint")).select(*df.columns, name)


def ffill(df: DataFrame, k: str, t: str, v: str, name: str | None = None, chunks: int | None = None) -> DataFrame:
    """Carry the last known value forward; a leading gap stays NULL."""
    name = name or v
    rows = in_ranges(df, k, t, chunks).withColumn("__f", F.last(v, ignorenulls=True).over(
        _inside(k, t).rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn(
        "__x", F.row_number().over(_inside(k, t)))
    ends = rows.groupBy(k, PART).agg(F.max_by("__f", "__x").alias("__end"))
    carried = ends.withColumn("__in", F.last("__end", ignorenulls=True).over(
        _across(k).rowsBetween(Window.unboundedPreceding, -1))).drop("__end")
    out = _attached(rows, carried, k).withColumn("__f", F.coalesce("__f", "__in"))
    return out.select(*[F.col("__f").alias(c) if c == name else F.col(c) for c in df.columns],
                      *([] if name in df.columns else [F.col("__f").alias(name)]))


def _segment(a: Column, b: Column) -> Column:
    """The straight line from one known point to the next; NULL if either is missing."""
    return F.when(a.isNotNull() & b.isNotNull(), F.struct(
        a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")))


def interpolate(df: DataFrame, k: str, t: str, v: str, name: str = "interpolated", floor: float | None = 0.0,
                chunks: int | None = None) -> DataFrame:
    """Piecewise-linear fill over row position, extrapolated, floored (O65); the rules of
    ``series.interpolate``.

    A chunk passes on its size, its known points' first and last, and its first and last
    inner segment. From these rows alone every chunk learns its offset, the known point
    before it, the first segment that ends after it, and the entity's last segment.
    """
    x = F.col("__x").cast("double")
    w = _inside(k, t)
    back = Window.partitionBy(k, PART).orderBy(F.desc("__x")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = in_ranges(df, k, t, chunks).withColumn("__x", F.row_number().over(w) - 1)
    known = F.when(F.col(v).isNotNull(), F.struct(x.alias("x"), F.col(v).cast("double").alias("y")))
    upto = Window.partitionBy(k, PART).orderBy("__x")
    rows = rows.withColumn("__pt", known).withColumns({
        "__prev": F.last("__pt", ignorenulls=True).over(upto.rowsBetween(Window.unboundedPreceding, -1)),
        "__ff": F.last(v, ignorenulls=True).over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    rows = rows.withColumn("__seg", _segment(F.col("__prev"), F.col("__pt"))).withColumn(
        "__next", F.last("__seg", ignorenulls=True).over(back)).withColumn(
        "__first", F.last("__pt", ignorenulls=True).over(back))
    rows = materialize(rows.drop("__prev"), "chunk_rows")

    def least(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.col("__x")))

    def most(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__x")))

    ends = rows.groupBy(k, PART).agg(
        F.count(F.lit(1)).alias("__n"), F.count(v).alias("__known"), least("__pt").alias("__pt0"), most("__pt").alias("__pt1"),
        least("__seg").alias("__seg0"), most("__seg").alias("__seg1"), most("__ff").alias("__end"))
    before = _across(k).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(k).orderBy(F.desc(PART)).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(k)

    def moved(p: str, *fields: str) -> Column:
        return F.when(F.col(p).isNotNull(), F.struct(*[
            (F.col(p)[f] + F.col("__off") if f.startswith("x") else F.col(p)[f]).alias(f) for f in fields]))

    ends = ends.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    ends = ends.withColumns({p: moved(p, "x", "y") for p in ("__pt0", "__pt1")} | {
        p: moved(p, "x0", "y0", "x1", "y1") for p in ("__seg0", "__seg1")})
    ends = ends.withColumn("__prev", F.last("__pt1", ignorenulls=True).over(before))
    # the segment that leads into the chunk comes before all inner ones
    ends = ends.withColumn("__seg_in", _segment(F.col("__prev"), F.col("__pt0")))
    ends = ends.withColumns({
        "__head": F.coalesce("__seg_in", "__seg0"), "__tail": F.coalesce("__seg1", "__seg_in")})
    carried = ends.select(
        k, PART, "__off", F.col("__seg_in").alias("__in"), F.last("__head", ignorenulls=True).over(after).alias("__later"),
        F.max_by("__tail", F.when(F.col("__tail").isNotNull(), F.col(PART))).over(whole).alias("__last"),
        F.sum("__known").over(whole).alias("__all"),
        F.last("__end", ignorenulls=True).over(before).alias("__ff_in"))
    out = _attached(rows, carried, k).withColumn("__g", x + F.col("__off"))
    # at or before the chunk's first known point the segment that leads in applies
    first = F.col("__first")["x"].eqNullSafe(F.col("__in")["x1"] - F.col("__off")) & F.col("__in").isNotNull()
    s = F.coalesce(F.when(first, F.col("__in")), moved("__next", "x0", "y0", "x1", "y1"), "__later", "__last")
    out = out.withColumn("__s", s)
    line = (F.col("__s.y1") - F.col("__s.y0")) / (F.col("__s.x1") - F.col("__s.x0")) * (
        F.col("__g") - F.col("__s.x0")) + F.col("__s.y0")
    if floor is not None:
        line = F.greatest(line, F.lit(float(floor)))
    value = F.when(F.col("__all") >= 2, line).otherwise(F.coalesce("__ff", "__ff_in").cast("double"))
    return out.withColumn("__v", value).select(*[c for c in df.columns if c != name], F.col("__v").alias(name))


def lag_by(df: DataFrame, k: str, t: str, cols: Sequence[str], n: int, prefix: str | None = None,
           chunks: int | None = None, rows_per_chunk: int = LAG_ROWS) -> DataFrame:
    """Value ``n`` rows earlier per entity, 0 if none.

    With the position known, an entity is cut into chunks of ``rows_per_chunk`` rows;
    the last ``n`` rows of a chunk also go to the next one, where they only serve as the
    past of its first rows.
    """
    size = max(n, rows_per_chunk)
    at = F.col("__pos")
    rows = position(df, k, t, "__pos", chunks).withColumn("__chunk", F.floor(at / size).cast("bigint"))
    rows = rows.withColumn("__to", F.explode(F.when(at % size >= size - n, F.array(
        F.col("__chunk"), F.col("__chunk") + 1)).otherwise(F.array("__chunk"))))
    w = Window.partitionBy(k, "__to").orderBy("__pos")
    p = prefix if prefix is not None else f"lag_{n}_"
    out = rows.withColumns({f"{p}{c}": F.coalesce(F.lag(c, n).over(w), F.lit(0)) for c in cols})
    return out.filter("__to = __chunk").drop("__pos", "__chunk", "__to")
