"""Near-duplicate groups by Order MinHash with banded alignment.

A text's k-mers are its runs of k words, each labelled with its occurrence number, so
all labelled k-mers of a text differ. A sketch takes the ``PICKS`` smallest labelled
k-mers under one hash function and hashes them in text order; texts alike under edits
agree on many of the ``SKETCHES`` sketches. k is five words (``SHINGLE``); short texts,
of whose long k-mers one changed word leaves none, have sketches of shorter ones
(``TIERS``). Two texts that share a sketch are candidates. A candidate pair is linked if
the words that an alignment inside the band matches in order make up ``SIMILARITY`` of
the words of both: 2 * matches / (words of one + words of the other). The band is as wide
as that share allows, so that it excludes no such pair. Linked texts and exact copies
form a group (connected components); its smallest doc_id names it and stays.

Scale: exact copies are one node before anything is compared. First each round has
one pivot per bucket of equal sketches, and each node is compared with ``NEAR`` of its
buckets' pivots, of other components, those with most buckets in common (with one in the
first round). The first pivot is the smallest node, the second the most linked one (the
centre of a star); from then on each component in a bucket sends one member, drawn
anew each round, and one of them is the pivot, until a round adds few links. So a
large group collapses by pairs linear in bucket sizes, and buckets of one component,
with the texts that are in no other, leave the later rounds. Then every pair of a bucket
whose two components still differ is tried, in blocks of bounded size: bit signatures
of the words rule out most of the pairs that cannot reach the threshold (and no
other), the rest are aligned. No pair is aligned twice. Each round's links and
components are written to shared storage.

Edge cases: null, empty and blank texts have no words and stay by themselves
(``keep_one`` keeps one row per id of them); a null id comes after all others, and a
group of null ids has a null name; repeated rows are one group; an empty table gives an
empty result. Whole texts are used, however long. Extra columns pass through ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casestar.llm.common import fresh, let, words
from casestar.session import materialize

SHINGLE = 5
SIMILARITY = 0.8    # share of words that align
PICKS = 2           # k-mers in a sketch
SKETCHES = 48       # of pairs at the threshold with evenly spread edits 14 % share none, at 0.85 under 2 %
TIERS = ((SHINGLE, 64, None), (3, 32, 96), (2, 8, 48), (1, 1, 12))   # k, for texts of so many words at least, at most
LONG = 1 << 16      # k-mers whose hashes are held at once, times SKETCHES
NEAR = 4            # pivots that a node is compared with in a round after the first
FEW = 0.01          # share of new links at which the rounds of pivots end
BLOCK = 512         # members of a bucket on either side of a block of pairs
SIGNATURE = 16      # 64-bit words of a signature
FINEST = 256        # 64-bit words of a long text's fine signature, at most
BITMAPS = 2048      # bitmaps of 32,768 bits in a filter of nodes, 8 MiB in all

_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _seeds(n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * _MUL) | np.uint64(1)


def labelled_kmers(word_hashes: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hash of each k-mer with its occurrence number, in text order, all distinct."""
    h = word_hashes.astype(np.int64).view(np.uint64)
    n = max(1, len(h) - k + 1) if len(h) else 0
    x = np.zeros(n, np.uint64)
    for j in range(min(k, len(h))):
        x = _mixed(x * np.uint64(31) + h[j:j + n] + _MUL)
    order = np.argsort(x, kind="stable")
    s = x[order]
    same = np.flatnonzero(s[1:] == s[:-1]) + 1
    if len(same):
        first = np.ones(n, bool)
        first[same] = False
        starts = np.flatnonzero(first)
        occurrence = np.arange(n) - starts[np.cumsum(first) - 1]
        again = occurrence > 0
        at = order[again]
        x[at] = _mixed(x[at] + occurrence[again].astype(np.uint64) * _MUL)
    return x


def sketch(kmers: np.ndarray, seeds: np.ndarray, picks: int = PICKS) -> np.ndarray:
    """One hash per seed of the ``picks`` smallest k-mers, kept in text order."""
    n = len(kmers)
    if n <= picks:
        chosen = np.broadcast_to(kmers, (len(seeds), n))
    else:
        at = np.empty((len(seeds), picks), np.int64)
        step = max(1, LONG * SKETCHES // n)
        for i in range(0, len(seeds), step):
            h = kmers[None, :] * seeds[i:i + step, None]
            rows = np.arange(len(h))
            for j in range(picks):
                at[i:i + step, j] = low = h.argmin(axis=1)
                h[rows, low] = np.iinfo(np.uint64).max
        chosen = kmers[np.sort(at, axis=1)]
    out = seeds.copy()
    for j in range(chosen.shape[1]):
        out = _mixed(out * np.uint64(31) + chosen[:, j])
    return out


def keys_of(hashes: np.ndarray, seeds: np.ndarray, picks: int = PICKS, tiers: Sequence[tuple] = TIERS) -> np.ndarray:
    """What candidates share: the sketches of every tier that a text of these words has."""
    n, out = len(hashes), [np.empty(0, np.uint64)]
    for k, least, most in tiers:
        if least <= n and (most is None or n <= most):
            out.append(_mixed(sketch(labelled_kmers(hashes, k), seeds, picks) + np.uint64(k)))
    return np.unique(np.concatenate(out))


def banded_matches(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence of matches (i, j) with |i - j| <= band,
    by bit-parallel rows: bit i of ``v`` is 0 where row j gains a match at a[i]. ``v``
    holds the bits of the band only; those that leave it are counted."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << i)
    lo, hi, found = 0, min(len(a), band + 1), 0
    v = (1 << hi) - 1
    for j, x in enumerate(b):
        if j > band and lo < hi:
            found += 1 - (v & 1)
            v >>= 1
            lo += 1
        if j and hi < len(a) and hi < j + band + 1:
            v |= 1 << (hi - lo)
            hi += 1
        u = v & (masks.get(x, 0) >> lo)
        if u:
            v = ((v + u) | (v - u)) & ((1 << (hi - lo)) - 1)
    return found + (hi - lo) - v.bit_count()


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> float:
    """Share of the words of two texts (as hashes) that match in order within the band.
    Below the threshold it may come out as 0."""
    na, nb = len(a), len(b)
    need = ceil(threshold * (na + nb) / 2 - 1e-9)
    if not na or not nb or min(na, nb) < need:
        return 0.0
    n = min(na, nb)
    unlike = np.flatnonzero(a[:n] != b[:n])
    head = int(unlike[0]) if len(unlike) else n
    unlike = np.flatnonzero(a[na - n + head:][::-1] != b[nb - n + head:][::-1])
    tail = int(unlike[0]) if len(unlike) else n - head
    x, y = a[head:na - tail], b[head:nb - tail]
    if len(x) and len(y):
        both = len(np.intersect1d(labelled_kmers(x, 1), labelled_kmers(y, 1), assume_unique=True))
        if head + tail + both < need:
            return 0.0
        m = head + tail + banded_matches(x.tolist(), y.tolist(), na + nb - 2 * need)
    else:
        m = head + tail
    return 2 * m / (na + nb)


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The lists of an Arrow column as views of its values."""
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for i in range(len(column)):
        yield values[offsets[i]:offsets[i + 1]]


def word_hashes(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.hash(w))


def node_of(ws: Column) -> Column:
    """Number of a sequence of words (64 bits); null for an empty one."""
    return F.when(F.size(ws) > 0, F.xxhash64(ws))


def sketches(df: DataFrame, id_col: str, text: str, n_sketches: int, picks: int) -> DataFrame:
    """(doc_id, node, n, sketches): a row per document, n its number of words,
    sketches the keys of ``keys_of``."""
    prepared = df.select(F.col(id_col).alias("doc_id"), words(F.col(text)).alias("w")).select(
        "doc_id", node_of(F.col("w")).alias("node"), word_hashes(F.col("w")).alias("w"))
    id_type = dict(prepared.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = _seeds(n_sketches)
        for b in batches:
            n, made = [], []
            for h in _lists(b.column(2)):
                n.append(len(h))
                made.append(keys_of(h, seeds, picks))
            offsets = np.cumsum([0, *map(len, made)]).astype(np.int32)
            flat = np.concatenate(made).view(np.int64) if made else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "node", "n", "sketches"])

    return prepared.mapInArrow(run, f"doc_id {id_type}, node long, n int, sketches array<long>")


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose alignment reaches the threshold."""
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("w").alias("wa")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("w").alias("wb")), "b").select("a", "b", "wa", "wb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [aligned(x, y, threshold) >= threshold - 1e-9
                    for x, y in zip(_lists(batch.column(2)), _lists(batch.column(3)), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): every node of the links with the smallest node it reaches.
    Each turn takes the smallest label around and then the label's own label."""
    edges = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "cc_edges")
    labels = materialize(edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("a"), F.min("b")).alias("comp")), "cc_labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("a"), "comp"), "a").groupBy(
            F.col("b").alias("node")).agg(F.min("comp").alias("near"))
        low = labels.join(near, "node").select("node", F.least("comp", "near").alias("low"), "comp")
        up = labels.select(F.col("node").alias("low"), F.col("comp").alias("up"))
        new = materialize(low.join(up, "low").select(
            "node", F.least("low", "up").alias("comp"), F.col("comp").alias("old")), "cc_labels")
        if new.filter("comp <> old").limit(1).count() == 0:
            return new.select("node", "comp")
        labels = new.select("node", "comp")


def _unfinished(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The buckets that hold more than one component, with the present ones. As
    components only grow, the others have no pair left to try."""
    rows = buckets.drop("comp").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter(
        "lo <> hi").select("key")
    return materialize(rows.join(mixed, "key").select(*buckets.columns), "omh_buckets")


def _round(buckets: DataFrame, links: DataFrame | None, turn: int, threshold: float) -> DataFrame:
    """(a, b, node, c): the pivots of a node's buckets that lie in other components, with the
    number of buckets they share. ``buckets``: (key, node, n, comp), more than one node each."""
    order = F.xxhash64("node", "key", F.lit(turn))
    rows = buckets
    if links is None:
        order = F.col("node")
    elif turn == 1:
        rows = rows.join(degrees(links), "node", "left")
        order = F.struct(-F.coalesce("links", F.lit(0)), "node")
    else:
        rows = rows.groupBy("key", "comp").agg(F.min_by(F.struct("node", "n"), order).alias("m")).select(
            "key", "comp", "m.node", "m.n")
    pivots = rows.groupBy("key").agg(
        F.min_by(F.struct("node", "comp", "n"), order).alias("pivot"), F.min("comp").alias("lo"),
        F.max("comp").alias("hi")).filter("lo <> hi").select(
        "key", F.col("pivot.node").alias("p"), F.col("pivot.comp").alias("p_comp"), F.col("pivot.n").alias("p_n"))
    met = rows.join(pivots, "key").filter("comp <> p_comp").filter(
        F.least("n", "p_n") >= threshold / (2 - threshold) * F.greatest("n", "p_n") - 1e-6)
    return met.groupBy("node", "p").agg(F.count("*").alias("c")).select(
        F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b"), "node", "c")


def _parities(hashes: np.ndarray, length: int) -> np.ndarray:
    """``length`` 64-bit words: for each bit, whether an odd number of the hashes falls on it."""
    at = (hashes % np.uint64(64 * length)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=64 * length) & 1).astype(np.uint8)).view(np.int64)


def signatures(texts: DataFrame) -> DataFrame:
    """(node, n, s0, s1, ..., fine): n the number of words; for each bit, whether an odd number of words, labelled with
    their occurrence, falls on it. Two texts differ in no more bits than there are such
    words in only one of them, and those cannot be aligned. On the s of a long text so
    many words fall that they tell little; ``fine`` is the same over eight bits a word or
    more (a power of two, ``FINEST`` at most), null where the s have as many."""
    names = [f"s{i}" for i in range(SIGNATURE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, fine = np.zeros((batch.num_rows, SIGNATURE), np.int64), []
            for i, w in enumerate(_lists(batch.column(1))):
                hashes, length = _mixed(labelled_kmers(w, 1)), SIGNATURE
                made[i] = _parities(hashes, length)
                while length < FINEST and 8 * length < len(w):
                    length *= 2
                fine.append(_parities(hashes, length) if length > SIGNATURE else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *[pa.array(made[:, j]) for j in range(SIGNATURE)],
                 pa.array(fine, pa.list_(pa.int64()))], names=["node", "n", *names, "fine"])

    return texts.select("node", "w", F.size("w").alias("n")).mapInArrow(
        run, ", ".join(["node long", "n int", *[f"{c} long" for c in names], "fine array<long>"]))


def _alike(a: str, b: str, threshold: float, fine: bool = True) -> Column:
    """Whether sizes and signatures, under names that begin so, allow a link. Where one
    fine signature is twice as long, its halves are laid over each other: sizes that
    allow a link are never further apart."""
    n, differ = F.col(f"{a}n") + F.col(f"{b}n"), F.lit(0)
    for i in range(SIGNATURE):
        differ += F.bit_count(F.col(f"{a}s{i}").bitwiseXOR(F.col(f"{b}s{i}")))
    size = F.least(f"{a}n", f"{b}n") >= threshold / (2 - threshold) * F.greatest(f"{a}n", f"{b}n") - 1e-6
    most = n * (1 - threshold) + 1e-6
    if not fine:
        return size & (differ <= most)
    x, y = F.col(f"{a}fine"), F.col(f"{b}fine")
    length = F.least(F.size(x), F.size(y))

    def folded(z: Column, i: Column) -> Column:
        return F.get(z, i).bitwiseXOR(F.coalesce(F.get(z, i + length), F.lit(0).cast("long")))

    finer = F.aggregate(F.sequence(F.lit(0), length - 1), F.lit(0), lambda d, i: d + F.bit_count(
        folded(x, i).bitwiseXOR(folded(y, i))))
    return size & (differ <= most) & F.when(x.isNotNull() & y.isNotNull(), finer <= most).otherwise(True)


def _likely(pairs: DataFrame, bits: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` that sizes and signatures (not the fine ones, which would
    be shuffled with every pair) do not rule out."""
    bits = bits.drop("fine")
    a, b = (bits.select(*[F.col(c).alias(x if c == "node" else f"{x}_{c}") for c in bits.columns]) for x in "ab")
    return pairs.join(a, "a").join(b, "b").filter(_alike("a_", "b_", threshold, fine=False)).select("a", "b")


def _rest(buckets: DataFrame, bits: DataFrame, threshold: float) -> DataFrame:
    """All pairs, each once, that share a bucket but no component, less those whose
    sizes or signatures exclude a link. In a bucket the members outside its largest
    component meet all members, block by block."""
    mixed = buckets.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("top"), F.max("c").alias("most"), F.sum("c").alias("all"),
        F.count("*").alias("comps")).filter("comps > 1").select(
        "key", "top", F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("g"),
        F.ceil(F.col("all") / BLOCK).cast("int").alias("h"))
    live = buckets.join(mixed, "key").join(bits.drop("n"), "node")

    def side(rows: DataFrame, mine: str, own: str, other: str, theirs: str, mark: str) -> DataFrame:
        return rows.select(
            "key", "top", F.pmod(F.xxhash64("node", F.lit(mark)), F.col(own)).cast("int").alias(mine),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(theirs),
            *[F.col(c).alias(f"{mark}_{c}") for c in ["node", "comp", "n", *bits.columns[2:]]])

    a = side(live.filter("comp <> top"), "i", "g", "h", "j", "a")
    b = side(live, "j", "h", "g", "i", "b").drop("top")
    met = a.join(b, ["key", "i", "j"]).filter(
        (F.col("a_comp") != F.col("b_comp")) & ((F.col("b_comp") == F.col("top")) | (F.col("a_node") < F.col("b_node")))
        & _alike("a_", "b_", threshold))
    return met.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def _relabelled(labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """The components after the new links are added."""
    if labels is None:
        return components(found)
    comp = labels.select(F.col("node").alias("x"), F.col("comp").alias("c"))
    joined = found.join(comp.withColumnRenamed("x", "a").withColumnRenamed("c", "ca"), "a", "left").join(
        comp.withColumnRenamed("x", "b").withColumnRenamed("c", "cb"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    over = components(joined).select(F.col("node").alias("comp"), F.col("comp").alias("top"))
    old = labels.join(over, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp"))
    alone = over.join(labels, over["comp"] == labels["node"], "left_anti").select(
        F.col("comp").alias("node"), F.col("top").alias("comp"))
    return materialize(old.union(alone), "omh_labels")


def _maybe_in(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The rows whose node is a member, and some others. The filter of the members has a
    fixed size, whatever their number: with very many it lets more others pass."""
    slot = F.pmod(F.xxhash64("node"), F.lit(BITMAPS << 15))
    part, at = F.shiftright(slot, 15).alias("part"), slot.bitwiseAND(F.lit((1 << 15) - 1)).alias("at")
    bitmaps = members.select(part, at).groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.shiftright("at", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.select("*", part, at).join(F.broadcast(bitmaps), "part").filter(
        F.getbit(byte, F.col("at").bitwiseAND(F.lit(7)).cast("int")) == 1).select(*rows.columns)


def degrees(links: DataFrame) -> DataFrame:
    return links.select("a").union(links.select("b")).groupBy(F.col("a").alias("node")).agg(
        F.count("*").alias("links"))


def group(df: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = SIMILARITY,
          n_sketches: int = SKETCHES, picks: int = PICKS) -> tuple[DataFrame, DataFrame]:
    """((doc_id, node) per row, (node, class_id, links) per node). ``class_id`` is
    the group's smallest doc_id, ``links`` the node's found links to other texts."""
    rows = materialize(sketches(df, id_col, text, n_sketches, picks), "omh_sketches")
    nodes = rows.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("sketches").alias("sketches"))
    sketched = nodes.select("node", "n", F.explode("sketches").alias("key"))
    # n is read on both sides of the join, so that the nodes are shuffled once
    shared = sketched.groupBy("key").agg(F.count("*").alias("c"), F.min("n").alias("least")).filter(
        "c > 1 AND least > 0").select("key")
    buckets = materialize(sketched.join(shared, "key").select(
        "key", "node", "n", F.col("node").alias("comp")), "omh_buckets")
    members = materialize(buckets.select("node").distinct(), "omh_members")
    ws = df.select(words(F.col(text)).alias("w"))
    ws = _maybe_in(ws.select(node_of(F.col("w")).alias("node"), word_hashes(F.col("w")).alias("w")), members)
    texts = materialize(ws.groupBy("node").agg(F.first("w").alias("w")).join(members, "node", "left_semi"), "omh_texts")
    bits = materialize(signatures(texts), "omh_signatures")

    links = labels = tried = None
    turn, n_links, rest = 0, 0, False
    while True:
        pairs = _rest(buckets, bits, threshold) if rest else _round(buckets, links, turn, threshold)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        if not rest:    # of a node's pivots, those with most buckets in common
            near = Window.partitionBy("node").orderBy(F.desc("c"), "a", "b")
            pairs = pairs.withColumn("near", F.row_number().over(near)).filter(
                F.col("near") <= (NEAR if turn else 1)).select(
                "a", "b").distinct()
            pairs = _likely(pairs, bits, threshold)
        pairs = materialize(pairs, "omh_pairs")
        tried = pairs if tried is None else tried.union(pairs)
        found = materialize(verify(pairs, texts, threshold), "omh_links")
        n_found = found.count()
        if n_found:
            links = found if links is None else links.union(found)
            labels = _relabelled(labels, found)
        if rest:        # no bucket has an untried pair of two components left
            break
        if n_found:
            buckets = _unfinished(buckets, labels)
            if not turn:    # most texts are done
                texts = materialize(texts.join(buckets.select("node").distinct(), "node", "left_semi"), "omh_texts")
        n_links += n_found
        turn, rest = turn + 1, n_found <= n_links * FEW
    ids = nodes.select("node", "first_id")
    if labels is None:
        return rows.select("doc_id", "node"), ids.select(
            "node", F.col("node").alias("comp"), "first_id", F.col("first_id").alias("class_id"),
            F.lit(0).cast("long").alias("links"))
    named = ids.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    classes = named.groupBy("comp").agg(F.min("first_id").alias("class_id"))
    named = named.join(classes, "comp").join(degrees(links), "node", "left").select(
        "node", "comp", "first_id", "class_id", F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    return rows.select("doc_id", "node"), materialize(named, "omh_classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: the group's name, the links of its text, and whether it stays."""
    rows, classes = group(docs.select("doc_id", "text"))
    alone = rows.filter("node is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    grouped = rows.filter("node is not null").join(classes, "node").select(
        "doc_id", "class_id", F.col("links").alias("n_links"))
    return grouped.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, that with the smallest id; columns unchanged. Of
    rows alike in id and words, any one stays."""
    rows, classes = group(df, id_col, text)
    mark = fresh(df, "mark")
    best = classes.groupBy("comp").agg(F.min_by(F.struct("first_id", "node"), F.struct(
        F.col("first_id").isNull(), "first_id", "node")).alias("best")).select(
        F.xxhash64("best.first_id", "best.node").alias(mark))
    blank = rows.filter("node is null").select(F.xxhash64("doc_id", "node").alias(mark)).distinct()
    marked = df.withColumn(mark, F.xxhash64(id_col, let(words(F.col(text)), node_of)))
    kept = marked.join(best.union(blank), mark, "left_semi")
    if not rows.groupBy("doc_id", "node").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates([mark])
    return kept.select(*df.columns)
