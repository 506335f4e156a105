"""Source divergence audit by Gustavson's row accumulation.

Every (lang, source) group has a smoothed share p of each term that its language
keeps. The audit gives each group its divergence from every other group of the
language, and the terms that set it apart from the whole language.

The sum over all kept terms of two groups is a product of the group-by-term table
with its transpose. It is worked out row by row as in Gustavson's sparse matrix
product: a group walks its own terms, and each term's row of the term-major index
scatters into a dense accumulator with one slot per peer. No (group, group, term)
row is emitted. Terms that a group lacks do not count as nothing, since smoothing
gives them a share as well: the accumulator starts with the value that two absent
terms have, and is corrected for terms of the one, of the other and of both.

Scale: documents are counted into (lang, source, term) inside the tasks and again
map-side; only such counts are shuffled. The index is written once and cut into
blocks of about ``BLOCK_POSTINGS`` postings by a hash of the term, so neither a
frequent term nor a large source lands in one task; a block's groups are cut into
slices of ``ROWS`` accumulators. The blocks' accumulators are added up by Spark. A
task holds a block of the index and accumulators for a slice: memory grows with the
number of sources of a language (as does a row of the result), not with its texts.

Exactness: shares are integers (parts of ``UNIT``), computed in decimals; sums are
64-bit integers. A sum below 2**63 is right even if a step on the way wraps.

Edge cases: null lang, source and text count as ''. A group without a term still
has its pairs; a language without a kept term has pairs of value 0. A language
with a single source has no pairs. Repeated rows are documents of their own. Very
long texts are read whole. An empty table gives an empty result. Other columns are
not read, whatever they are called.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casestar.session import materialize

UNIT = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
BLOCK_POSTINGS = 1_000_000   # postings in a block of the index, about
LEAST_POSTINGS = 50_000      # below that a block is not worth a task
ROWS = 256                   # accumulators of a task
FLUSH = 400_000              # distinct terms a task counts before it passes them on
PAIRS = 1 << 20              # postings scattered at once

#: Letters A-Z in lower case; whatever is not part of a term becomes a blank. The
#: bytes of characters beyond ASCII all belong to terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, d): occurrences of a term in a group, and documents with it."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in
                         [(lang, "lang"), (source, "source"), (text, "text")]])

    def flushed(counts: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (one, two), (tf, df) in counts.items():
            if not tf:
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array([one] * len(tf), pa.string()), pa.array([two] * len(tf), pa.string()),
                 pa.array(list(tf), pa.binary()).view(pa.string()), pa.array(list(tf.values()), pa.int64()),
                 pa.array([df[t] for t in tf], pa.int64())], names=["lang", "source", "term", "n", "d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for b in batches:
            for one, two, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                      b.column(2).cast(pa.binary()), strict=True):
                terms = body.as_py().translate(_TERM_BYTES).split()
                tf, df = counts.setdefault((one, two), (Counter(), Counter()))
                size -= len(tf)
                tf.update(terms)
                df.update(set(terms))
                size += len(tf)
                if size > FLUSH:
                    yield from flushed(counts)
                    counts, size = {}, 0
        yield from flushed(counts)

    part = rows.mapInArrow(run, "lang string, source string, term string, n long, d long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def term_index(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, n, postings of (source, n)): a row per kept term."""
    return counts.groupBy("lang", "term").agg(
        F.sum("d").alias("d"), F.sum("n").alias("n"),
        F.collect_list(F.struct("source", "n")).alias("postings")).filter(F.col("d") >= min_docs).drop("d")


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + terms)), exactly; null without terms."""
    return F.expr(f"1 + cast({UNIT} as decimal(10, 0)) * cast({count} + 1 as decimal(19, 0)) "
                  f"div nullif(cast({total} + {terms} as decimal(19, 0)), 0)")


def group_table(docs: DataFrame, index: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """A row per occurring group: its number in the language, the number of groups, the
    group's and the language's counts over kept terms, p0 the share of an absent term,
    and into how many blocks and slices the language is cut."""
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).distinct()
    own = index.select("lang", F.explode("postings").alias("x")).groupBy("lang", F.col("x.source").alias("source")).agg(
        F.sum("x.n").alias("total"), F.count("*").alias("size"))
    whole = index.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("terms"))
    mine = Window.partitionBy("lang")
    rows = names.join(own, ["lang", "source"], "left").join(whole, "lang", "left").fillna(
        0, ["total", "size", "lang_total", "terms"])
    rows = rows.withColumns({
        "gid": (F.row_number().over(mine.orderBy("source")) - 1).cast("int"),
        "groups": F.count("*").over(mine), "postings": F.sum("size").over(mine)})
    most = F.floor(F.col("postings") / F.greatest(F.lit(LEAST_POSTINGS), F.col("groups") * F.col("groups")))
    return rows.withColumns({
        "p0": share("0", "total", "terms"),
        "blocks": F.greatest(F.lit(1), F.ceil(F.col("postings") / BLOCK_POSTINGS),
                             F.least(F.lit(spread), most)).cast("int"),
        "slices": F.ceil(F.col("groups") / ROWS).cast("int")})


def postings(index: DataFrame, groups: DataFrame) -> DataFrame:
    """The index as rows, with each group's share p and the language's share q."""
    rows = index.select("lang", "term", F.col("n").alias("lang_n"), F.explode("postings").alias("x")).select(
        "lang", "term", "lang_n", F.col("x.source").alias("source"), F.col("x.n").alias("n"))
    return rows.join(groups, ["lang", "source"]).withColumns({
        "p": share("n", "total", "terms"), "q": share("lang_n", "lang_total", "terms")})


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def accumulate(term: np.ndarray, gid: np.ndarray, p: np.ndarray, p0: np.ndarray, rows: range) -> np.ndarray:
    """Sums of f over the terms of a block, a row per group of ``rows``, a column per peer.
    ``term`` numbers the block's terms from 0; p0 is each group's share of an absent term."""
    n_terms = int(term.max()) + 1 if len(term) else 0
    order = np.argsort(term, kind="stable")                # the term-major index
    i_gid, i_p = gid[order], p[order]
    starts = np.searchsorted(term[order], np.arange(n_terms + 1))
    by_group = np.argsort(gid, kind="stable")              # each group's own terms
    g_term, g_p = term[by_group], p[by_group]
    g_starts = np.searchsorted(gid[by_group], np.arange(len(p0) + 1))
    # distinct (group, share) pairs with their numbers
    at = np.lexsort((p, gid))
    s_gid, s_p = gid[at], p[at]
    first = np.flatnonzero(np.r_[True, (s_gid[1:] != s_gid[:-1]) | (s_p[1:] != s_p[:-1])]) if len(at) else at
    h_gid, h_p, h_n = s_gid[first], s_p[first], np.diff(np.r_[first, len(at)])
    h_starts = np.searchsorted(h_gid, np.arange(len(p0) + 1))
    out = np.zeros((len(rows), len(p0)), np.int64)
    for row, i in enumerate(rows):
        acc, mine0 = out[row], p0[i]
        both0 = _f(mine0, p0)
        acc += (n_terms - (g_starts[i + 1] - g_starts[i])) * both0
        for x in range(h_starts[i], h_starts[i + 1]):      # terms of this group, absent in peers
            acc += h_n[x] * _f(h_p[x], p0)
        np.add.at(acc, h_gid, h_n * (_f(mine0, h_p) - both0[h_gid]))     # terms of peers, absent here
        a, b = g_starts[i], g_starts[i + 1]
        lengths = starts[g_term[a:b] + 1] - starts[g_term[a:b]]
        ends = np.cumsum(lengths)
        while a < b:                                       # terms of both, a bounded number at a time
            done = ends[a - g_starts[i]] - lengths[a - g_starts[i]]
            c = max(a + 1, g_starts[i] + int(np.searchsorted(ends, done + PAIRS, side="right")))
            t, n = g_term[a:c], lengths[a - g_starts[i]:c - g_starts[i]]
            flat = np.repeat(starts[t] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            peer, theirs, own = i_gid[flat], i_p[flat], np.repeat(g_p[a:c], n)
            np.add.at(acc, peer, _f(own, theirs) - _f(own, p0[peer]) - _f(mine0, theirs) + both0[peer])
            a = c
    return out


def pair_values(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, i, j, value) for every ordered pair of two groups of a language."""
    keys = ["lang", "block", "slice"]
    part = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    left = rows.select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), part,
                       "term", "gid", "p")
    right = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "slices",
                          F.col("gid").alias("peer"), F.coalesce("p0", F.lit(1)).cast("long").alias("absent")).select(
        F.col("lang").alias("lang"), "block", part, "peer", "absent")

    def run(key: tuple, index: pa.Table, peers: pa.Table) -> pa.Table:
        g = peers["peer"].to_numpy()
        p0 = np.empty(len(g), np.int64)
        p0[g] = peers["absent"].to_numpy()
        lo = key[2].as_py() * ROWS
        mine = range(lo, min(len(g), lo + ROWS))
        term = index["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        acc = accumulate(term, index["gid"].to_numpy(), index["p"].to_numpy(), p0, mine)
        i, j = np.repeat(np.array(mine, np.int32), len(g)), np.tile(np.arange(len(g), dtype=np.int32), len(mine))
        other = i != j
        return pa.table({"lang": pa.array([key[0].as_py()] * int(other.sum()), pa.string()), "i": i[other],
                         "j": j[other], "value": acc.reshape(-1)[other]})

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "lang string, i int, j int, value long").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def divergence_report(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
                      min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has a row per other source of
    the language, part ``term`` the ``top`` terms more frequent in the group than in the language."""
    index = materialize(term_index(term_counts(docs, lang, source, text), min_docs), "divergence_index")
    groups = materialize(group_table(docs, index, lang, source), "divergence_groups")
    rows = postings(index, groups)
    names = groups.select("lang", "gid", "source")
    pairs = pair_values(rows, groups).join(names.withColumnRenamed("gid", "i"), ["lang", "i"]).join(
        names.select("lang", F.col("gid").alias("j"), F.col("source").alias("item")), ["lang", "j"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = rows.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        F.expr("(p - q) * (p - q) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).filter(F.col("rank") <= top))
