"""Joins.

Physical strategy is left to Catalyst and AQE: a side whose runtime size is
under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` is broadcast, any
larger side is shuffled (sort-merge or shuffled-hash), and skewed partitions
are split by the AQE skew-join rule. No join here forces a broadcast of data
whose size is not known.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.session import materialize

HOT_ROWS = 1_000_000    # rows of a key that one task should still take


def _cond(a: DataFrame, b: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
          null_safe: bool = False):
    parts = [a[lk].eqNullSafe(b[rk]) if null_safe else a[lk] == b[rk]
             for lk, rk in zip(left_on, right_on)]
    return reduce(lambda x, y: x & y, parts)


def attach_facts(span: DataFrame, facts: DataFrame, left_on: Sequence[str],
                 right_on: Sequence[str], value_cols: Sequence[str] = ("Anzahl",)) -> DataFrame:
    """Left equi-join with differing key names, many-to-one.

    Only the value columns of ``facts`` are carried over, so name columns the
    two sides share cannot become ambiguous (T33).
    """
    f = facts.select(*right_on, *value_cols)
    f = f.select(*[F.col(r).alias(f"__k{i}") for i, r in enumerate(right_on)], *value_cols)
    cond = reduce(lambda x, y: x & y,
                  [span[lk] == f[f"__k{i}"] for i, lk in enumerate(left_on)])
    return span.join(f, cond, "left").drop(*[f"__k{i}" for i in range(len(right_on))])


def attach_series(df: DataFrame, series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join a derived series back to its source on its keys."""
    return df.join(series, list(keys), "left")


def outer_join(a: DataFrame, b: DataFrame, on: Sequence[str] | None = None,
               left_on: Sequence[str] | None = None, right_on: Sequence[str] | None = None,
               null_safe: bool = False) -> DataFrame:
    """Full outer equi-join keeping unmatched rows of both sides.

    With ``on`` the key columns are merged into one (as a pandas merge does);
    with ``left_on``/``right_on`` both sides keep theirs. ``null_safe`` makes
    NULL keys match each other (T12).
    """
    if on is not None:
        on = list(on)
        if not null_safe:
            return a.join(b, on, "full")
        cond = _cond(a, b, on, on, null_safe=True)
        rest_a = [a[c] for c in a.columns if c not in on]
        rest_b = [b[c] for c in b.columns if c not in on]
        keys = [F.coalesce(a[k], b[k]).alias(k) for k in on]
        return a.join(b, cond, "full").select(*keys, *rest_a, *rest_b)
    return a.join(b, _cond(a, b, left_on, right_on, null_safe), "full")


def cross(a: DataFrame, b: DataFrame, block_rows: int = 5_000) -> DataFrame:
    """Every row of ``a`` with every row of the dimension ``b`` (O34), any size.

    ``b`` is written, measured and packed into blocks of about ``block_rows`` rows;
    each row of ``a`` meets each block by an equality join on the block number and
    unpacks it. Blocks that are small in all are broadcast (their size as text is
    checked against a quarter of the broadcast threshold). Larger ones are copied once per salt, and the rows of
    ``a`` are dealt over the salts, so that a block's number is no hot key. Columns of
    ``b`` that ``a`` already has are the constant join key of the reference (``ones``)
    and are not repeated.
    """
    spark = a.sparkSession
    cols = [c for c in b.columns if c not in set(a.columns)]
    rows = materialize(b.select(F.struct(*cols).alias("__row")), "cross_rows")
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(F.to_json("__row"))), F.lit(0))).first()
    blocks = max(1, -(-n // block_rows))
    number = F.pmod(F.xxhash64("__row"), F.lit(blocks)).cast("int")
    packed = materialize(rows.groupBy(number.alias("__block")).agg(
        F.collect_list("__row").alias("__rows")), "cross_blocks")
    each = a.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    if width <= broadcast_limit(spark) // 4:
        return each.join(F.broadcast(packed), "__block").select(*a.columns, F.inline("__rows"))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = each.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    packed = packed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # a given number of partitions is not coalesced by the size of what goes in
    keys = ["__block", "__salt"]
    return each.repartition(salts, *keys).join(packed.repartition(salts, *keys).hint("shuffle_hash"), keys).select(
        *a.columns, F.inline("__rows"))


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes; 0 if broadcasts are off."""
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return 0 if size.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def inner_join(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on several shared keys."""
    return a.join(b, list(keys), "inner")


def attach_lookup(df: DataFrame, lookup: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner join to a many-to-one lookup."""
    return df.join(lookup, [key] if isinstance(key, str) else list(key), "inner")


def join_all(dfs: Sequence[DataFrame], keys: Sequence[Sequence[str]]) -> DataFrame:
    """Chain of inner joins; ``keys[i]`` joins ``dfs[i+1]`` onto the result."""
    out = dfs[0]
    for nxt, k in zip(dfs[1:], keys):
        out = out.join(nxt, list(k), "inner")
    return out


def merge_series(dfs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inner join of several series on one key list, in one shuffle.

    The series are appended with their number and merged by one aggregation, which
    combines map-side; a chain of joins shuffles once per series. Each series must have
    a key once, else the job fails; rows with a NULL key match nothing and go. The
    columns are the keys, then each series' other columns in order.
    """
    keys = list(keys)
    values = [[c for c in df.columns if c not in keys] for df in dfs]
    every = None
    for i, df in enumerate(dfs):
        rows = df.na.drop(subset=keys).select(*keys, *[
            (F.struct(F.lit(True).alias("__is"), *values[i]) if j == i else F.lit(None)).alias(f"__s{j}")
            for j in range(len(dfs))])
        every = rows if every is None else every.union(rows)
    merged = every.groupBy(*keys).agg(*[x for i in range(len(dfs)) for x in (
        F.count(f"__s{i}").alias(f"__n{i}"), F.first(f"__s{i}", ignorenulls=True).alias(f"__s{i}"))])
    most = F.greatest(*[F.col(f"__n{i}") for i in range(len(dfs))]) if len(dfs) > 1 else F.col("__n0")
    fail = F.raise_error(F.lit(f"merge_series: a series has two rows for the same {', '.join(keys)}"))
    whole = reduce(lambda x, y: x & y, [F.col(f"__n{i}") > 0 for i in range(len(dfs))])
    return merged.filter(F.when(most > 1, fail.cast("boolean")).otherwise(whole)).select(
        *keys, *[F.col(f"__s{i}")[c].alias(c) for i, cs in enumerate(values) for c in cs])


def natural_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join on every column name the two sides share."""
    shared = [c for c in a.columns if c in set(b.columns)]
    return a.join(b, shared, "inner")


def split_outer_join(a: DataFrame, b: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """Full outer equi-join of written tables that hot keys cannot pile up in one task.

    Spark splits skewed partitions of inner and left joins, not of full outer ones. Keys
    with more than ``hot_rows`` rows on a side (at most rows / hot_rows of them) are
    counted first and taken out of the plain join. A hot key that the other side lacks
    needs no join: its rows are unmatched. A hot key on both sides is an inner join,
    dealt over a grid: its left rows are dealt over as many rows of the grid as they
    fill, its right rows over the columns, each is copied along the other direction, and
    every pair meets in one cell. Rows with a NULL key match nothing and are not joined
    either. ``a`` and ``b`` are read several times, and their rows are dealt by position:
    pass tables that are written (``materialize``).
    """
    if set(a.columns) & set(b.columns):
        raise ValueError(f"rename the columns on both sides: {sorted(set(a.columns) & set(b.columns))}")
    names = [f"__k{i}" for i in range(len(left_on))]

    def counts(df: DataFrame, on: Sequence[str], n: str) -> DataFrame:
        return df.groupBy(*[F.col(c).alias(k) for c, k in zip(on, names)]).agg(F.count(F.lit(1)).alias(n)).na.drop(
            subset=names)

    hot = materialize(counts(a, left_on, "__na").join(counts(b, right_on, "__nb"), names, "full").filter(
        (F.col("__na") > hot_rows) | (F.col("__nb") > hot_rows)), "hot_keys")
    both = hot.filter("__na is not null and __nb is not null").select(
        *names, F.ceil(F.col("__na") / hot_rows).cast("int").alias("__i"),
        F.ceil(F.col("__nb") / hot_rows).cast("int").alias("__j"))

    def side(df: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Rows of plain keys, of keys hot on both sides, and of no partner."""
        known = reduce(lambda x, y: x & y, [df[c].isNotNull() for c in on])

        def joined(keys: DataFrame, how: str) -> DataFrame:
            return df.filter(known).join(keys, reduce(lambda x, y: x & y, [df[c] == keys[k] for c, k in zip(on, names)]), how)

        lonely = joined(hot.filter("__na is null or __nb is null").select(*names), "left_semi")
        return joined(hot.select(*names), "left_anti"), joined(both, "inner"), lonely.unionByName(df.filter(~known))

    a_plain, a_hot, a_alone = side(a, left_on)
    b_plain, b_hot, b_alone = side(b, right_on)
    deal = F.monotonically_increasing_id()
    grid = [*names, "__x", "__y"]
    a_hot = a_hot.withColumns({"__x": F.pmod(deal, F.col("__i")).cast("int"),
                               "__y": F.explode(F.sequence(F.lit(0), F.col("__j") - 1))}).drop("__i", "__j")
    b_hot = b_hot.withColumn("__y", F.pmod(deal, F.col("__j")).cast("int")).withColumn(
        "__x", F.explode(F.sequence(F.lit(0), F.col("__i") - 1))).drop("__i", "__j")
    n = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))     # not coalesced: more comes out than goes in
    cells = a_hot.repartition(n, *grid).join(b_hot.repartition(n, *grid), grid).select(*a.columns, *b.columns)
    plain = a_plain.join(b_plain, _cond(a_plain, b_plain, left_on, right_on), "full")
    nulls_a = [F.lit(None).cast(t).alias(c) for c, t in a.dtypes]
    nulls_b = [F.lit(None).cast(t).alias(c) for c, t in b.dtypes]
    return plain.union(cells).union(a_alone.select(*a.columns, *nulls_b)).union(b_alone.select(*nulls_a, *b.columns))


def match_audit(a: DataFrame, b: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                fill_cols: Sequence[str], label: str = "missing", hot_rows: int | None = None) -> DataFrame:
    """Full outer join with ``label`` on the side that did not match.

    Returns all joined rows; ``unmatched(…)`` lists the rows where any
    labelled column carries ``label``. With ``hot_rows`` the join is split for keys of
    more rows than that (``split_outer_join``; pass written tables).
    """
    if hot_rows is None:
        joined = a.join(b, _cond(a, b, left_on, right_on), "full")
    else:
        joined = split_outer_join(a, b, left_on, right_on, hot_rows)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(label)) for c in fill_cols})


def unmatched(audited: DataFrame, fill_cols: Sequence[str], label: str = "missing") -> DataFrame:
    """Rows of a ``match_audit`` result with ``label`` in any checked column."""
    cond = reduce(lambda x, y: x | y, [F.col(c) == F.lit(label) for c in fill_cols])
    return audited.filter(cond)
