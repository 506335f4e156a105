"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A benchmark item's windows of 13 words (an item with fewer words is one window)
are the patterns. Patterns of one length share a table: for each block of two
words, how far the search may jump because no pattern ends there sooner; for
the blocks that end a pattern, the patterns by their first word; a direct
comparison confirms. Most positions of a text are never looked at.

The benchmark is the stated query set: it is cut into blocks of at most
``BLOCK_BYTES`` of text, each block's tables are broadcast, and the documents go
through one scan per block without a shuffle. A document's hits are kept as
merged runs of word positions, so blocks add up exactly. After every ``PASSES`` blocks
the documents are written with their hits so far and the blocks' tables are released:
a task holds that many tables at most, however large the benchmark is.

Edge cases: whole texts are scanned, however long; a null text has no words, is never hit and never contaminated; an
item without words matches nothing; an item without an id counts as hit but is
not listed; equal ids are listed once; repeated documents and null ids are
scanned each on their own; with an empty benchmark nothing is hit. Extra columns
pass through ``find_items`` untouched, but for one named like its output, which it replaces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casestar.llm.common import fresh
from casestar.session import materialize

WINDOW = 13
BLOCK_BYTES = 8 << 20   # benchmark text in one broadcast
PASSES = 4              # broadcasts that a task holds at most
# Fixed by the contract, over UTF-8 after lower-casing A-Z: every byte of a
# multi-byte character belongs to a word.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

FOUND = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("runs", T.ArrayType(T.LongType(), False), False),     # start, end, start, end, ...
    T.StructField("items", T.ArrayType(T.StringType(), False), False)])
FOUND_ARROW = pa.struct([pa.field("n_words", pa.int64(), False),
                         pa.field("runs", pa.list_(pa.field("element", pa.int64(), False)), False),
                         pa.field("items", pa.list_(pa.field("element", pa.string(), False)), False)])


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def windows_of(words: list[bytes], size: int = WINDOW) -> set[tuple[bytes, ...]]:
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


class Table:
    """Wu-Manber tables for patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set[str]]):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], dict[bytes, list]] = {}
        for p, items in patterns.items():
            for end in range(self.block, length + 1):
                b = p[end - self.block:end]
                self.shift[b] = min(self.shift.get(b, self.default), length - end)
            self.bucket.setdefault(p[-self.block:], {}).setdefault(p[0], []).append((p, tuple(items)))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple[str, ...]]]:
        """(start, items) of every occurrence of a pattern."""
        length, block, default, shift = self.length, self.block, self.default, self.shift
        end, n = length, len(words)
        while end <= n:
            b = tuple(words[end - block:end])
            jump = shift.get(b, default)
            if jump:
                end += jump
                continue
            start = end - length
            for p, items in self.bucket[b].get(words[start], ()):
                if tuple(words[start:end]) == p:
                    yield start, items
            end += 1


def build_tables(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> list[Table]:
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, text in items:
        for w in windows_of(words_of(text), window):
            by_length.setdefault(len(w), {}).setdefault(w, set()).update([] if item is None else [item])
    return [Table(n, p) for n, p in sorted(by_length.items())]


def merge_runs(runs: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(runs):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _scan(text: str | None, tables: list[Table], before: dict | None) -> dict:
    words = words_of(text)
    runs = list(zip(before["runs"][::2], before["runs"][1::2], strict=True)) if before else []
    items = set(before["items"]) if before else set()
    for t in tables:
        for start, found in t.search(words):
            runs.append((start, start + t.length))
            items.update(found)
    return {"n_words": len(words), "runs": merge_runs(runs), "items": sorted(items)}


def _pass(df: DataFrame, tables, text: str, out: str) -> DataFrame:
    """One scan of the documents with one broadcast block of the benchmark."""
    again = out in df.columns
    schema = df.schema if again else T.StructType([*df.schema.fields, T.StructField(out, FOUND, False)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = tables.value
        for b in batches:
            at = b.schema.get_field_index(text)
            old = b.column(b.schema.get_field_index(out)).to_pylist() if again else [None] * b.num_rows
            new = [_scan(t.as_py(), found, o) for t, o in zip(b.column(at), old, strict=True)]
            keep = [i for i, n in enumerate(b.schema.names) if n != out]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in keep), pa.array(new, FOUND_ARROW)],
                schema=pa.schema([*(b.schema.field(i) for i in keep), pa.field(out, FOUND_ARROW, False)]))

    return df.mapInArrow(scan, schema)


def find_items(df: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "found",
               window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` plus struct ``out``: its number of words, the runs of hit words and
    the ids (as strings, sorted) of the benchmark items that have a window in it."""
    df = df.drop(out)
    items = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t"))
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    part = F.pmod(F.xxhash64("i", "t"), F.lit(blocks))
    sent = []
    for k in range(blocks):
        block = [(r["i"], r["t"]) for r in items.filter(part == k).toLocalIterator()]
        sent.append(df.sparkSession.sparkContext.broadcast(build_tables(block, window)))
        df = _pass(df, sent[-1], text, out)
        if len(sent) == PASSES and k + 1 < blocks:
            df = materialize(df, "decontamination")
            while sent:
                sent.pop().unpersist()
    return df


def n_hit(found: Column) -> Column:
    """Hit words: the lengths of the runs."""
    return F.aggregate(F.transform(found["runs"], lambda r, i: F.when(i % 2 == 0, -r).otherwise(r)),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def is_contaminated(hit: Column, n_words: Column) -> Column:
    return (hit > 0) & (20 * hit >= n_words)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, hit words, items and the verdict."""
    f = F.col("__found")
    found = find_items(docs.select("doc_id", "text"), benchmark, out="__found").select(
        "doc_id", f["n_words"].alias("n_words"), n_hit(f).alias("n_hit"), f["items"].alias("items"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Only the documents that are not contaminated, columns unchanged."""
    out = fresh(df, "found")
    f = F.col(out)
    return find_items(df, benchmark, text, out).filter(
        ~is_contaminated(n_hit(f), f["n_words"])).select(*df.columns)
