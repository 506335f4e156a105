"""Date and geography dimensions, the dense key span and surrogate ids
(SURVEY O49-O54, O62).

Surrogate ids are positions in an ordered product. They are computed by
formula from small per-dimension ranks instead of a global ``row_number``
over a large table (which would pull every row into one task):

* ``id_time``    = days since the first date;
* ``id_lk_time`` = ``geo_rank * n_days + id_time``;
* ``id_bl_time`` = ``state_rank * n_days + id_time``;
* ``index``      = ``state_first * n_days + id_time`` (the first geo-time row
  of that state and day).

The only ordered windows run over the geography dimension, whose size is
the number of districts, not the number of facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casestar.functions.columns import PERIOD_BOUNDS, PERIOD_LAST_LABEL, period_bucket
from casestar.operators.aggregate import bounds_scalar
from casestar.operators.checks import unique_by
from casestar.operators.joins import outer_join
from casestar.session import materialize

GEO_KEYS = ["IdBundesland", "Bundesland", "IdLandkreis", "Landkreis"]
STATE_KEYS = ["IdBundesland", "Bundesland"]
GEO_TIME_COLS = GEO_KEYS + ["ones", "Datum", "id_time", "time_cat", "id_lk_time"]
STATE_TIME_COLS = ["index"] + STATE_KEYS + ["Datum", "id_time", "id_bl_time"]
BRIDGE_COLS = GEO_TIME_COLS + ["index", "id_bl_time"]
BRIDGE_KEYS = ["IdBundesland", "IdLandkreis", "Datum"]
SPAN_VALUES = ["Altersgruppe", "Geschlecht", "Status"]


def date_dim(facts: DataFrame, col: str = "Meldedatum", bounds=PERIOD_BOUNDS,
             last_label: str = PERIOD_LAST_LABEL) -> DataFrame:
    """Every day from the first to the last fact date.

    ``id_time`` is the 0-based day offset, ``ones`` the constant the BI
    model expects, ``time_cat`` the period bucket (relative buckets count
    back from the last date). The spine has one row per calendar day, so its
    size is bounded by the date range, not by the data volume.
    """
    b = facts.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    days = b.select(F.explode(F.sequence("lo", "hi")).alias("Datum"), "lo", "hi")
    return days.select(
        "Datum",
        F.datediff("Datum", "lo").cast("bigint").alias("id_time"),
        F.lit(1).cast("bigint").alias("ones"),
        period_bucket("Datum", F.col("hi"), bounds, last_label).alias("time_cat"))


def geo_dim(facts: DataFrame, districts: DataFrame | None = None,
            categories: DataFrame | None = None) -> DataFrame:
    """Distinct geography of the facts with population and categories.

    Written as the reference's two full outer joins plus a not-NULL filter on
    the fact side; Catalyst turns both into left outer joins (T14). Only
    geographies that have facts survive.
    """
    geo = unique_by(facts.select(*GEO_KEYS).distinct(), ["IdLandkreis"], "geography")
    drop = []
    if districts is not None:
        geo = outer_join(geo, unique_by(districts.select("rs", "population"), ["rs"], "district lookup"),
                         left_on=["IdLandkreis"], right_on=["rs"])
        drop.append("rs")
    if categories is not None:
        geo = outer_join(geo, unique_by(categories, ["kreis_id"], "category lookup"), left_on=["IdLandkreis"], right_on=["kreis_id"])
        drop += ["kreis_id", "krs17"]
    return (geo.withColumn("ones", F.lit(1).cast("bigint"))
            .drop(*drop)
            .filter(F.col("IdLandkreis").isNotNull()))


def geo_ranked(geo: DataFrame) -> DataFrame:
    """Add ``geo_rank``, ``state_first`` and ``state_rank`` to a geo dimension.

    Geographies are ordered by (state id, district code); a state is ranked
    by its first geography. These windows see only the dimension rows, one per
    district: a district with two names fails the job.
    """
    geo = unique_by(geo, ["IdLandkreis"], "geography")
    order = Window.orderBy("IdBundesland", "IdLandkreis", "Bundesland", "Landkreis")
    g = geo.withColumn("geo_rank", (F.row_number().over(order) - 1).cast("bigint"))
    g = g.withColumn("state_first", F.min("geo_rank").over(Window.partitionBy(*STATE_KEYS)))
    return g.withColumn(
        "state_rank", (F.dense_rank().over(Window.orderBy("state_first")) - 1).cast("bigint"))


def _days(time: DataFrame) -> tuple[Column, Column, Column]:
    lo, hi = bounds_scalar(time, "Datum")
    return lo, hi, (F.datediff(hi, lo) + 1).cast("bigint")


def geo_time_dim(geo: DataFrame, time: DataFrame) -> DataFrame:
    """Geography x day with ``id_lk_time``.

    The product is generated, not joined: each geography row explodes the
    day sequence; the time attributes come from an equi-join on ``Datum``
    with the (calendar-bounded) date dimension.
    """
    lo, hi, n_days = _days(time)
    g = geo_ranked(geo).select(*GEO_KEYS, "ones", "geo_rank",
                               F.explode(F.sequence(lo, hi)).alias("Datum"))
    g = g.join(time.select("Datum", "id_time", "time_cat"), "Datum")
    return g.withColumn("id_lk_time", F.col("geo_rank") * n_days + F.col("id_time")) \
        .select(*GEO_TIME_COLS)


def state_time_dim(geo: DataFrame, time: DataFrame) -> DataFrame:
    """Distinct (state, day) with ``id_bl_time`` and the first-row ``index``."""
    lo, hi, n_days = _days(time)
    states = geo_ranked(geo).groupBy(*STATE_KEYS).agg(
        F.min("state_first").alias("state_first"), F.min("state_rank").alias("state_rank"))
    st = states.select(*STATE_KEYS, "state_first", "state_rank",
                       F.explode(F.sequence(lo, hi)).alias("Datum"))
    st = st.join(time.select("Datum", "id_time"), "Datum")
    return st.withColumns({
        "index": F.col("state_first") * n_days + F.col("id_time"),
        "id_bl_time": F.col("state_rank") * n_days + F.col("id_time"),
    }).select(*STATE_TIME_COLS)


def geo_time_bridge(geo_time: DataFrame, state_time: DataFrame) -> DataFrame:
    """The exported geo-time table: geo-time joined to state-time (O35 form)."""
    return geo_time.join(state_time, STATE_KEYS + ["Datum", "id_time"], "inner") \
        .select(*BRIDGE_COLS)


def geo_time_keys(geo: DataFrame, time: DataFrame) -> DataFrame:
    """The exported geo-time bridge with both ids, in one pass.

    Same rows as ``geo_time_bridge(geo_time_dim(…), state_time_dim(…))``,
    but every id comes from the ranks carried on the geography row, so the
    state-time join disappears.
    """
    lo, hi, n_days = _days(time)
    g = geo_ranked(geo).select(*GEO_KEYS, "ones", "geo_rank", "state_first", "state_rank",
                               F.explode(F.sequence(lo, hi)).alias("Datum"))
    g = g.join(time.select("Datum", "id_time", "time_cat"), "Datum")
    t = F.col("id_time")
    return g.withColumns({
        "id_lk_time": F.col("geo_rank") * n_days + t,
        "index": F.col("state_first") * n_days + t,
        "id_bl_time": F.col("state_rank") * n_days + t,
    }).select(*BRIDGE_COLS)


def spread(bridge: DataFrame, keys: Sequence[str] = BRIDGE_KEYS) -> DataFrame:
    """The bridge dealt over as many tasks as there are shuffle partitions, whatever
    its size: what is generated from its rows is many times as large. AQE does not
    coalesce a repartition with a given number."""
    by = [k for k in keys if k in bridge.columns] or bridge.columns
    return bridge.repartition(int(bridge.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def value_sets(facts: DataFrame, value_cols: Sequence[str] = SPAN_VALUES) -> Column:
    """The distinct values of each column, sorted, as one struct of arrays (a scalar
    subquery: one row, of the size of the category sets)."""
    return facts.agg(F.struct(*[F.array_sort(F.collect_set(c)).alias(c) for c in value_cols])).scalar()


def dense_span(bridge: DataFrame, facts: DataFrame, value_cols: Sequence[str] = SPAN_VALUES) -> DataFrame:
    """Geo-time x every age x sex x status seen in the facts.

    The bridge is dealt over the tasks first; each of its rows then explodes the
    value sets, one column after the other. The span itself is never shuffled,
    joined or gathered.
    """
    sets = value_sets(facts, value_cols)
    out = spread(bridge)
    for c in value_cols:
        out = out.withColumn(c, F.explode(sets[c]))
    return out


def with_row_id(df: DataFrame, order_cols: Sequence[str], name: str = "row_id",
                partitions: int | None = None) -> DataFrame:
    """0..n-1 id in an explicit, unique order (O62), computed in parallel.

    Rows are range-partitioned on the order columns and written with their
    partition's number; from that one copy they are numbered inside each
    partition and shifted by the row count of all earlier partitions (a table
    with one row per partition). No task sees more than its own partition,
    unlike a global ``row_number``, and no partitioning is worked out twice.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *order_cols).withColumn("__pid", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    local = F.row_number().over(Window.partitionBy("__pid").orderBy(*order_cols))
    return ranged.withColumn("__local", local).join(offsets, "__pid").withColumn(
        name, (F.col("__off") + F.col("__local") - 1).cast("bigint")).select(*df.columns, name)


def with_file_order_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """0..n-1 id in the order of the rows in their files, files by path.

    ``df`` is what a file reader returned, or a projection or filter of it. Each row
    keeps the file and block it was read from and its number within that block's task;
    the rows are written with them once. A task reads a block from its first row to its
    last, so a row's place in its block is its number less the block's first one; it is
    shifted by the rows of all earlier blocks (a table with one row per block). The
    order needs no column of the data; the rows are neither shuffled nor sorted. Only
    where a task has read one file more than once are they counted block by block.
    """
    at = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
                   F.monotonically_increasing_id().alias("__seq"))
    task = F.shiftright("__seq", 33).alias("__task")    # the upper bits are the task's number
    rows = materialize(at, "file_order").withColumn("__task", task)
    block = ["__file", "__block", "__task"]
    blocks = rows.groupBy(*block).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__seq").alias("__first"), F.max("__seq").alias("__last"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that its size is known when the join is planned (as in ``star_facts``).
    blocks = materialize(blocks.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))), "file_blocks")
    place = F.col("__seq") - F.col("__first")
    if not blocks.filter(F.col("__last") - F.col("__first") >= F.col("__n")).isEmpty():
        rows = rows.withColumn("__local", F.row_number().over(Window.partitionBy(*block).orderBy("__seq")))
        place = F.col("__local") - 1
    return rows.join(blocks, block).withColumn(name, (F.col("__off") + place).cast("bigint")).select(*df.columns, name)
