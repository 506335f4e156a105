"""Mixing sources to target weights (native DataFrame functions only).

The words of a source, document after document, are packed into blocks of
``BLOCK_WORDS`` words. Every output shard has a fixed number of slots; each slot
draws a source by a pseudorandom number, so a shard's counts per source are
multinomial with the targets as weights. What a source was drawn over its quota
is handed, slot by slot, to the sources drawn too little, so that the totals
meet the targets. The k-th slot of a source takes the block at place k of a
pseudorandom permutation of the source's block indices (the second pass over a
source starts the permutation again), and blocks and documents are joined by
that index. Full blocks are permuted; the short last block ends each pass, and
the last slot takes only what is left to the target.

Sources by code point, null last, weigh 3, 1, 2, repeating. They share
``VOLUME`` times all words by weight; a target stops at ``PASSES`` times its
source's words and the excess goes to the others by weight.

No step gathers a source in one task: positions within a source come from sums
per chunk of documents plus windows within chunks, ranks of slots from windows
within one shard, and joins go by (source, block).

Edge cases: a null or blank text has no words and takes none; a null source is
a source of its own, after all others; repeated rows and null ids are separate
rows with separate shares; an empty table gives an empty mix. Texts count in whole,
however long: a long one spans many blocks. Other columns pass through
``mixed_documents`` whatever their names. All numbers come from hashes of the rows, so
reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casestar.llm.common import fresh, let, words
from casestar.session import materialize

WEIGHTS = (3, 1, 2)
VOLUME = 1.5
PASSES = 2
BLOCK_WORDS = 256
SLOTS_PER_SHARD = 4096
MAX_SHARDS = 10_000         # beyond, shards get more slots instead
CHUNK_ROWS = 2_000          # documents in a chunk; with very many, about as many as there are chunks
ROUNDS = 16
SEED = 20_240


@dataclass(frozen=True)
class Mix:
    """``docs``: the input with its place in its source; ``sources``: a row per
    source; ``slots``: the output, a row per slot; ``pieces``: which part of a
    document lies in which block."""

    docs: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, volume: float = VOLUME) -> DataFrame:
    """(source, size) -> also ``rank``, ``weight`` and ``target``.

    Water filling: in the order of limit / weight, the sources below the common
    level stop at their limit. One row per source; only those rows meet.
    """
    whole = Window.partitionBy(F.lit(0))
    by_level = whole.orderBy(F.col("size") / F.col("weight"), "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    limit = F.col("size") * float(PASSES)
    ranked = sizes.withColumn("rank", F.row_number().over(whole.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("rank") % len(weights)))
    left = F.sum("size").over(whole) * volume - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ranked.withColumn("level", left / open_weight).withColumn("limit", limit)
    found = F.max(F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.col("level"))).over(whole)
    return level.withColumn("level", found).select(
        "source", "size", "rank", "weight",
        F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0))).alias("target"))


def permuted(x: Column, n: Column, seed: Column) -> Column:
    """Image of ``x`` under a pseudorandom permutation of 0..n-1: in each round
    x and its mirror image about a random point change places or not, as a hash
    of the larger of both says; every round is a bijection for any n."""
    def one(at: Column, r: Column) -> Column:
        mirror = F.pmod(F.xxhash64(F.lit(SEED), r, seed), n) - at
        pair = F.when(mirror < 0, mirror + n).otherwise(mirror)
        return let(F.struct(at.alias("a"), pair.alias("b")), lambda p: F.when(
            F.xxhash64(F.greatest(p["a"], p["b"]), r, seed) % 2 == 0, p["a"]).otherwise(p["b"]))

    return F.when(n > 1, F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, one)).otherwise(x)


def _starts(df: DataFrame, keys: list[str], order: list, size: str) -> Column:
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long")


def place_documents(sized: DataFrame, chunks: int) -> DataFrame:
    """Add ``chunk`` and ``n`` (a unique place) and ``start``, the words of the
    source before the document. Chunks bound every window's rows."""
    df = sized.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(chunks)).cast("int"))
    sums = df.groupBy("rank", "chunk").agg(F.sum("size").alias("chunk_size"))
    sums = sums.withColumn("chunk_start", _starts(sums, ["rank"], ["chunk"], "chunk_size")).drop("chunk_size")
    order = [F.col("rank"), F.col("mark"), F.col("doc_id")]
    within = df.withColumn("n", F.row_number().over(Window.partitionBy("chunk").orderBy(*order))).withColumn(
        "in_chunk", F.coalesce(F.sum("size").over(Window.partitionBy("chunk", "rank").orderBy("n").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    return within.join(sums, ["rank", "chunk"]).withColumn("start", F.col("chunk_start") + F.col("in_chunk")).drop(
        "chunk_start", "in_chunk")


def pieces_of(docs: DataFrame, block_words: int) -> DataFrame:
    """A row per document and block: the document's words ``at`` .. ``at + n_words``
    lie in the block from ``in_block`` on. A document without words has one, empty."""
    first = F.floor(F.col("start") / block_words)
    last = F.floor((F.col("start") + F.greatest(F.col("size"), F.lit(1)) - 1) / block_words)
    df = docs.select("rank", "chunk", "n", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return df.select("rank", "chunk", "n", "block", (begin - F.col("start")).alias("at"),
                     (begin - F.col("block") * block_words).alias("in_block"), (end - begin).alias("n_words"))


def _into_intervals(points: DataFrame, x: str, intervals: DataFrame, width: int) -> DataFrame:
    """Join each point to the interval [lo, hi) that holds it. Both sides are cut
    into cells of ``width``, so this is an equality join on the cell."""
    cells = intervals.filter("hi > lo").withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))))
    return points.withColumn("cell", F.floor(F.col(x) / width)).join(cells, "cell").filter(
        (F.col(x) >= F.col("lo")) & (F.col(x) < F.col("hi"))).drop("cell", "lo", "hi")


def draw_slots(sources: DataFrame, block_words: int, slots_per_shard: int) -> DataFrame:
    """(shard, slot, rank, block, pass, take): the block that each slot of the
    mix takes ``take`` words of, from its start."""
    spark = sources.sparkSession
    whole = Window.partitionBy(F.lit(0)).orderBy("rank")
    running = whole.rowsBetween(Window.unboundedPreceding, -1)
    target = F.round("target").cast("long")
    full = F.floor(F.col("size") / block_words)
    rest = F.col("words") % F.greatest(F.col("size"), F.lit(1))
    blocks = F.ceil(F.col("size") / block_words)
    sources = (sources.withColumn("words", target).withColumn("full", full).withColumn("blocks", blocks)
               .withColumn("quota", F.floor(F.col("words") / F.greatest(F.col("size"), F.lit(1))) * blocks
                           + F.ceil(rest / block_words))
               .withColumn("lo", F.coalesce(F.sum("quota").over(running), F.lit(0)))
               .withColumn("hi", F.col("lo") + F.col("quota")))
    sources = materialize(sources, "mix_sources")
    row = sources.agg(F.sum("quota").alias("slots"), F.count("*").alias("n")).first()
    n_slots, n = row["slots"] or 0, row["n"]
    per_shard = max(slots_per_shard, -(-n_slots // MAX_SHARDS))
    width = max(1, n_slots // max(1, 4 * n))

    drawn = spark.range(n_slots).select(
        F.col("id").alias("slot"), F.floor(F.col("id") / per_shard).alias("shard"),
        F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(max(1, n_slots))).alias("x"))
    drawn = _into_intervals(drawn, "x", sources.select("rank", "lo", "hi"), width).drop("x")
    counts = drawn.groupBy("rank", "shard").agg(F.count("*").alias("drawn"))
    counts = materialize(counts, "mix_counts")  # the multinomial draw: a row per shard and source
    first = counts.withColumn("first", _starts(counts, ["rank"], ["shard"], "drawn")).drop("drawn")
    in_shard = Window.partitionBy("shard", "rank").orderBy("slot")
    numbered = drawn.withColumn("k", F.row_number().over(in_shard) - 1).join(first, ["rank", "shard"]).withColumn(
        "k", F.col("k") + F.col("first")).drop("first")

    got = counts.groupBy("rank").agg(F.sum("drawn").alias("drawn"))
    balance = sources.select("rank", "quota").join(got, "rank", "left").withColumn(
        "drawn", F.coalesce("drawn", F.lit(0)))
    balance = balance.select("rank", "quota", "drawn", *[
        F.coalesce(F.sum(F.greatest(d, F.lit(0))).over(running), F.lit(0)).alias(name) for name, d in (
            ("over_from", F.col("drawn") - F.col("quota")), ("lo", F.col("quota") - F.col("drawn")))])
    balance = materialize(balance, "mix_balance")
    short = balance.filter("quota > drawn").select(
        F.col("rank").alias("to"), F.col("drawn").alias("to_first"), "lo",
        (F.col("lo") + F.col("quota") - F.col("drawn")).alias("hi"), F.col("lo").alias("to_lo"))
    numbered = numbered.join(balance.select("rank", "quota", "over_from"), "rank")
    kept = numbered.filter("k < quota").select("shard", "slot", "rank", "k")
    over = numbered.filter("k >= quota").select(
        "shard", "slot", (F.col("over_from") + F.col("k") - F.col("quota")).alias("e"))
    moved = _into_intervals(over, "e", short, width).select(
        "shard", "slot", F.col("to").alias("rank"), (F.col("to_first") + F.col("e") - F.col("to_lo")).alias("k"))

    slots = kept.unionByName(moved).join(sources.select("rank", "size", "words", "full", "blocks"), "rank")
    place = F.col("k") % F.col("blocks")
    slots = slots.withColumn("pass", F.floor(F.col("k") / F.col("blocks"))).withColumn("place", place).withColumn(
        "block", F.when(F.col("place") < F.col("full"), permuted(F.col("place"), F.col("full"), F.col("rank")))
        .otherwise(F.col("place")))
    taken = F.col("pass") * F.col("size") + F.col("place") * block_words
    long = F.least(F.lit(block_words), F.col("size") - F.col("block") * block_words)
    return slots.select("shard", "slot", "rank", "block", "pass",
                        F.greatest(F.least(long, F.col("words") - taken), F.lit(0)).cast("long").alias("take"))


def mix(df: DataFrame, block_words: int = BLOCK_WORDS, slots_per_shard: int = SLOTS_PER_SHARD,
        volume: float = VOLUME) -> Mix:
    """Plan the mix of documents (columns doc_id, text, source). Only numbers are
    shuffled and written; ``mark``, the hash of a row's columns, leads back to it."""
    size = F.size(words(F.col("text"))).cast("long")
    sized = df.select("doc_id", "source", size.alias("size"), mark_of(df).alias("mark"))
    sized = materialize(sized, "mix_sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
    sources = materialize(source_targets(per_source.select("source", "size"), volume=volume), "mix_targets")
    rows = sized.count()
    ranks = sources.select(F.col("source").alias("s"), "rank", F.col("size").alias("source_size"), "target")
    ranked = sized.join(F.broadcast(ranks) if _few(sources) else ranks, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    docs = place_documents(ranked, max(1, -(-rows // max(CHUNK_ROWS, isqrt(rows)))))
    docs = materialize(docs, "mix_docs")
    return Mix(docs, sources, draw_slots(sources, block_words, slots_per_shard), pieces_of(docs, block_words))


def mark_of(df: DataFrame) -> Column:
    """Hash of all columns; rows with the same mark are the same row."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _few(sources: DataFrame, bound: int = 100_000) -> bool:
    """Whether the table of sources is proven small enough to broadcast."""
    return sources.count() <= bound


def taken_spans(m: Mix) -> DataFrame:
    """(rank, chunk, n, pass, at, taken): words of a document that a pass takes."""
    spans = m.pieces.join(m.slots.select("rank", "block", "pass", "take"), ["rank", "block"])
    taken = F.greatest(F.least(F.col("n_words"), F.col("take") - F.col("in_block")), F.lit(0))
    return spans.select("rank", "chunk", "n", "pass", "at", taken.alias("taken")).filter("taken > 0")


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words taken."""
    m = mix(docs.select("doc_id", "text", "source"))
    per_doc = taken_spans(m).groupBy("rank", "chunk", "n").agg(F.sum("taken").alias("taken"))
    return m.docs.join(per_doc, ["rank", "chunk", "n"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(df: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents, columns of ``df`` unchanged: a row per document and
    pass that takes words of it. A document taken whole keeps its text; of one
    taken in part the text holds the taken words, a blank between words and a
    line break where some are left out. ``n_chars``, if there, is recomputed."""
    columns, mark = df.columns, fresh(df, "mark")
    m = mix(df, block_words)
    spans = taken_spans(m).groupBy("rank", "chunk", "n", "pass").agg(
        F.array_sort(F.collect_list(F.struct("at", "taken"))).alias("spans"), F.sum("taken").alias("taken"))
    takes = m.docs.select("rank", "chunk", "n", "size", "mark").join(spans, ["rank", "chunk", "n"]).select(
        F.col("mark").alias(mark), F.struct("spans", "taken", "size").alias(f"{mark}take"))
    texts = df.withColumn(mark, mark_of(df))
    if m.docs.select("mark").distinct().count() < m.docs.count():   # a repeated row has a take of its own for each
        texts = texts.dropDuplicates([mark])
    joined = texts.join(takes, mark)
    take = F.col(f"{mark}take")

    def cut(ws: Column) -> Column:
        parts = F.transform(take["spans"], lambda s: F.array_join(
            F.slice(ws, (s["at"] + 1).cast("int"), s["taken"].cast("int")), " "))
        glue = F.transform(take["spans"], lambda s, i: F.when(i == 0, "").when(
            F.get(take["spans"], i - 1)["at"] + F.get(take["spans"], i - 1)["taken"] == s["at"], " ").otherwise("\n"))
        return F.array_join(F.zip_with(glue, parts, lambda g, p: F.concat(g, p)), "")

    text = F.when(take["taken"] == take["size"], F.col("text")).otherwise(let(words(F.col("text")), cut))
    out = joined.withColumn(f"{mark}text", text)
    shown = {"text": F.col(f"{mark}text"), "n_chars": F.length(f"{mark}text").cast("long")}
    return out.select(*[shown.get(c, F.col(f"`{c}`")).alias(c) for c in columns])
