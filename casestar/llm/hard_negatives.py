"""Hard-negative mining by threshold joins with an L2AP-style index.

An anchor's positives are the rows of its label with the highest inner products; the
hard negatives of a positive are the rows of other labels with the highest products in
a window below the positive's own. Both are found by threshold joins: all rows whose
product with the anchor reaches the anchor's threshold. A join that leaves one of an
anchor's windows short is repeated for that anchor with a lower threshold, down to one
that excludes nothing of the window.

The join's index is by dimension over a block of anchors. Each anchor's dimensions are
ordered by size; those at the end whose remaining norm times the largest row norm stays
below the anchor's threshold are not indexed, as no row can reach the threshold by them
alone. A row accumulates its partial products over the indexed dimensions, is pruned
where partial product plus the norms that remain on both sides falls short, and the
survivors get their full product. The vectors are dense, so nearly every posting list
holds every anchor: the lists are the columns of a matrix, and accumulation is a matrix
product for a tile of rows.

Scale: the anchors go through in blocks of bounded size, broadcast one at a time, against
all rows in place; rows are not shuffled. A task passes on the best few rows of an
anchor's window only, so results are whole whatever the label sizes. First thresholds come
from a bounded sample of rows (``SAMPLE`` components): they decide how many joins it takes,
not the result. Products are exact integers.

Edge cases: a row with a null label, a null vector or a null, NaN or infinite component
takes no part, nor does one whose squared norm is 2**62 or more, since its products may
not be long integers. A shorter vector counts as filled up with zeros. Rows alike in
id, label and vector count once; rows that share only the id are different rows. A null
id is no anchor and comes after all others among ties (as does 2**63 - 1, which is
returned as null). A positive with a negative score has no negatives. An empty table, or
one without anchors, gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casestar.session import materialize, scratch_path

POSITIVES = 5
NEGATIVES = 3
ANCHORS = 4096          # anchors in a block, about, of short vectors
COMPONENTS = 1 << 19    # components in a block, about
SAMPLE = 1 << 19        # components of the rows that first thresholds are guessed from
GUESS = 10              # rows a first threshold should let through
LOWER = 8               # times as many let through the next
TILE = 512              # rows accumulated at once
SPARSE = 0.02           # share of survivors up to which they are finished one by one
JOBS = 8                # blocks of anchors in a Spark job
HELD = 1 << 20          # found rows a task holds before it keeps the best only
LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Block:
    """Anchors of a join. ``least``: thresholds, ``lo`` and ``hi``: windows of a product
    (anchors by windows), ``same``: whether rows must have the anchor's label or another."""
    number: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    comps: np.ndarray
    least: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    same: bool
    keep: int
    norm: float         # the largest norm of a row


def matrix(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    """Integer vectors as rows, filled up with zeros."""
    out = np.zeros((len(vectors), dims), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[:len(v)] = v
    return out


def indexed(comps: np.ndarray, least: np.ndarray, norm: float) -> np.ndarray:
    """Which dimensions of each anchor are in the index: all but the smallest ones that
    together cannot reach the threshold."""
    order = np.argsort(-np.abs(comps), axis=1, kind="stable")
    squares = np.take_along_axis(comps.astype(float) ** 2, order, axis=1)
    rest = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
    out = np.empty(comps.shape, bool)
    np.put_along_axis(out, order, rest * norm * (1 + 1e-9) + 1 >= least[:, None], axis=1)
    return out


def best(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Positions of the first ``keep`` of each key by score downwards, then id."""
    order = np.lexsort((ids, -scores, keys))
    k = keys[order]
    starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else order
    rank = np.arange(len(k)) - np.repeat(starts, np.diff(np.r_[starts, len(k)]))
    return order[rank < keep]


class Join:
    """The index of a block, and the rows found so far."""

    def __init__(self, block: Block) -> None:
        self.b = block
        largest = block.norm * np.sqrt((block.comps.astype(float) ** 2).sum(axis=1)).max(initial=0)
        self.kind = float if largest < 2 ** 52 else np.int64     # exact in either
        mask = indexed(block.comps, block.least, block.norm)
        self.index = np.where(mask, block.comps, 0).T.astype(self.kind)
        self.rest = np.where(mask, 0, block.comps).astype(self.kind)
        self.rest_norm = np.sqrt((self.rest.astype(float) ** 2).sum(axis=1))
        self.omitted = (~mask).T.astype(float)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def probe(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        """Accumulate, prune and finish a tile of rows."""
        b, x = self.b, rows.astype(self.kind)
        partial = x @ self.index
        bound = partial + np.sqrt(x.astype(float) ** 2 @ self.omitted) * self.rest_norm
        alive = bound + 1 + 1e-9 * np.abs(bound) >= b.least
        alive &= (labels[:, None] == b.label) == b.same
        if np.count_nonzero(alive) > SPARSE * alive.size:
            partial += x @ self.rest.T
            r, a = np.nonzero(alive & (partial >= b.least))
            s = partial[r, a].astype(np.int64)
        else:
            r, a = np.nonzero(alive)
            s = (partial[r, a] + np.einsum("ij,ij->i", x[r], self.rest[a])).astype(np.int64)
        other = s >= b.least[a]
        if b.same:
            twin = np.flatnonzero(ids[r] == b.vec_id[a])
            other[twin[(rows[r[twin]] == b.comps[a[twin]]).all(axis=1)]] = False
        r, a, s = r[other], a[other], s[other]
        for k in range(b.lo.shape[1]):
            inside = (s >= b.lo[a, k]) & (s <= b.hi[a, k])
            self.found.append((a[inside] * b.lo.shape[1] + k, s[inside], ids[r[inside]]))
            self.held += int(inside.sum())
        if self.held > HELD:
            self.compress()

    def compress(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keep the best of each anchor and window."""
        parts = [np.concatenate(c) for c in zip(*self.found)] if self.found else [np.empty(0, np.int64)] * 3
        at = best(*parts, self.b.keep)
        self.found = [tuple(c[at] for c in parts)]
        self.held = len(at)
        return self.found[0]


def integer_rows(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                 scale: float = 256.0, shift: int = 7) -> DataFrame:
    """(vec_id, label, c): the rows that take part, each once, components as integers."""
    value = F.col(vector)
    whole = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(value, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    size = F.aggregate(value, F.lit(0.0), lambda a, x: a + F.pow(F.floor(F.lit(scale) * x.cast("double")).cast("double"), F.lit(2.0)))
    kind = F.col(label).cast("long")
    rows = df.filter(F.col(label).isNotNull() & value.isNotNull() & whole & (size < 2.0 ** 62)).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.when(F.col(vec_id) % shift == 0, (kind + 1) % 10).otherwise(kind).alias("label"), scaled.alias("c"))
    rows = materialize(rows, "neg_rows")
    if rows.groupBy("vec_id").count().filter("count > 1").isEmpty():
        return rows
    return materialize(rows.distinct(), "neg_distinct")


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    if len(column) and (np.diff(offsets) == dims).all():
        return values[offsets[0]:offsets[-1]].reshape(len(column), dims)
    return matrix([values[offsets[i]:offsets[i + 1]] for i in range(len(column))], dims)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(LAST).to_numpy(zero_copy_only=False)


def threshold_join(rows: DataFrame, block: Block) -> DataFrame:
    """(a, k, vec_id, score): of each task, the best rows of each anchor's windows."""
    dims, k = block.comps.shape[1], block.lo.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = None
        for batch in batches:
            join = join or Join(shared.value)
            ids, labels = _ids(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            vectors = _vectors(batch.column(2), dims)
            for at in range(0, len(ids), TILE):
                join.probe(ids[at:at + TILE], labels[at:at + TILE], vectors[at:at + TILE])
        if join:
            key, score, ids = join.compress()
            yield pa.RecordBatch.from_arrays(
                [pa.array(join.b.number[key // k]), pa.array((key % k).astype(np.int32)),
                 pa.array(ids, mask=ids == LAST), pa.array(score)], names=["a", "k", "vec_id", "score"])

    return rows.select("vec_id", "label", "c").mapInArrow(run, "a long, k int, vec_id long, score long")


def _guessed(anchors: DataFrame, sample: list, dims: int, first: int, same: bool) -> DataFrame:
    """``anchors`` plus ``levels``, thresholds downwards: of the sample's rows that could
    count, the ``first`` th best product, then the ``first * LOWER`` th, and so on."""
    shared = anchors.sparkSession.sparkContext.broadcast(
        (np.array([r["label"] for r in sample], np.int64), matrix([np.array(r["c"], np.int64) for r in sample], dims).astype(float)))
    names = anchors.columns
    kind = ", ".join(f"{c} {t}" for c, t in anchors.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, comps = shared.value
        for batch in batches:
            mine = batch.column(names.index("label")).to_numpy(zero_copy_only=False)
            vectors = _vectors(batch.column(names.index("c")), dims).astype(float)
            tops = batch.column(names.index("top")).to_numpy(zero_copy_only=False)
            levels = []
            for label, v, top in zip(mine, vectors, tops, strict=True):
                s = (comps @ v)[(labels == label) == same]
                s = np.sort(s[s <= top])[::-1]
                at = first
                levels.append([])
                while at <= len(s):
                    levels[-1].append(int(s[at - 1]))
                    at *= LOWER
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(levels, pa.list_(pa.int64()))], names=[*names, "levels"])

    return anchors.mapInArrow(run, f"{kind}, levels array<long>")


def _joined(rows: DataFrame, anchors: DataFrame, turn: int, dims: int, norm: float, same: bool, keep: int,
            blocks: int, left: DataFrame) -> DataFrame:
    """One threshold join for the anchors that are ``left``, written block by block:
    the best ``keep`` rows of each anchor and window."""
    spark = rows.sparkSession
    path = scratch_path(spark, "neg_found")
    todo = materialize(anchors.join(left, "a", "left_semi").withColumns({
        "least": F.greatest(F.try_element_at("levels", F.lit(turn + 1)), "bottom"),
        "block": F.pmod(F.xxhash64("a"), F.lit(blocks))}), "neg_todo")
    for at in range(0, blocks, JOBS):
        found, used = None, []
        for n in range(at, min(blocks, at + JOBS)):
            part = todo.filter(F.col("block") == n).select("a", "vec_id", "label", "c", "least", "lo", "hi").collect()
            if part:
                block = Block(*[np.array([r[c] for r in part], np.int64) for c in ("a", "vec_id", "label")],
                              matrix([np.array(r["c"], np.int64) for r in part], dims),
                              np.array([r["least"] for r in part], np.int64), np.array([r["lo"] for r in part], np.int64),
                              np.array([r["hi"] for r in part], np.int64), same, keep, norm)
                one = threshold_join(rows, block)
                found = one if found is None else found.union(one)
                used.append(block)
        if found is not None:
            found.write.mode("append").parquet(path)
    schema = "a long, k int, vec_id long, score long"
    every = spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)
    rank = F.row_number().over(Window.partitionBy("a", "k").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return materialize(every.withColumn("rank", rank).filter(F.col("rank") <= keep), "neg_best")


def _exists(spark, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _search(rows: DataFrame, anchors: DataFrame, sample: list, n_rows: int, dims: int, norm: float,
            same: bool, keep: int) -> DataFrame:
    """(a, k, vec_id, score, rank): for each anchor and window (columns ``lo`` and ``hi``, and
    ``bottom``, the least product that any window admits) the first ``keep`` rows. Joins
    with ever lower thresholds, until no window is short that a lower one could fill."""
    first = max(1, -(-GUESS * len(sample) // max(1, n_rows)))
    anchors = materialize(_guessed(anchors, sample, dims, first, same), "neg_anchors")
    blocks = max(1, -(-anchors.count() // max(1, min(ANCHORS, COMPONENTS // dims))))
    left, out, turn = anchors.select("a"), None, 0
    while True:
        found = _joined(rows, anchors, turn, dims, norm, same, keep, blocks, left)
        counts = found.groupBy("a", "k").agg(F.count("*").alias("n"))
        windows = anchors.join(left, "a", "left_semi").select(
            "a", F.greatest(F.try_element_at("levels", F.lit(turn + 1)), "bottom").alias("least"),
            F.posexplode("lo").alias("k", "low"))
        short = materialize(windows.join(counts, ["a", "k"], "left").filter(
            (F.coalesce("n", F.lit(0)) < keep) & (F.col("least") > F.col("low"))).select("a").distinct(), "neg_short")
        done = found.join(short, "a", "left_anti")
        out = done if out is None else out.unionByName(done)
        if short.isEmpty():
            return out
        left, turn = short, turn + 1


def _share(score: Column, percent: int, up: bool) -> Column:
    """ceil or floor of ``percent`` percent of a whole number, exactly."""
    whole = score.cast("decimal(19, 0)") * percent
    return (F.ceil(whole / 100) if up else F.floor(whole / 100)).cast("long")


def hard_negatives(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                   every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = 50, high: int = 95) -> DataFrame:
    """For each anchor (id divisible by ``every``) and each of its ``positives`` the
    ``negatives`` best rows of other labels from ``low`` to ``high`` percent of its score."""
    rows = integer_rows(df, vec_id, vector, label)
    about = rows.agg(F.count("*").alias("n"), F.max(F.size("c")).alias("dims"), F.max(F.aggregate(
        "c", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("norm")).first()
    dims, norm = max(1, about["dims"] or 0), float(np.sqrt(about["norm"] or 0.0))
    sample = rows.orderBy(F.xxhash64("vec_id", "c")).limit(max(64, SAMPLE // dims)).collect()
    anchors = materialize(rows.filter(F.col("vec_id") % every == 0).withColumn(
        "a", F.monotonically_increasing_id()), "neg_queries")
    bottom, top = F.lit(-(1 << 62)), F.lit(1 << 62)
    open_ended = anchors.withColumns({"bottom": bottom, "top": top, "lo": F.array(bottom), "hi": F.array(top)})
    found = _search(rows, open_ended, sample, about["n"], dims, norm, True, positives).select(
        "a", (F.col("rank") - 1).alias("k"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = materialize(found, "neg_positives")
    per_anchor = found.filter("positive_score >= 0").groupBy("a").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "positive_score"))), lambda x: x["positive_score"]).alias("ps"))
    windows = anchors.join(per_anchor, "a").withColumns({
        "lo": F.transform("ps", lambda p: _share(p, low, True)), "hi": F.transform("ps", lambda p: _share(p, high, False))})
    # rows below the last window's upper end fill every window that lies above them
    width = F.array_repeat(F.lit(LAST), F.lit(positives) - F.size("ps"))
    windows = windows.withColumns({"bottom": F.array_min("lo"), "top": F.array_min("hi")}).withColumns({
        "lo": F.concat("lo", width), "hi": F.concat("hi", F.transform(width, lambda x: -x))}).drop("ps")
    met = _search(rows, windows, sample, about["n"], dims, norm, False, negatives)
    return met.withColumnRenamed("rank", "r").join(found, ["a", "k"]).join(
        anchors.select("a", F.col("vec_id").alias("anchor_id")), "a").select(
        "anchor_id", "positive_id", F.col("r").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
