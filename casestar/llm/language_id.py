"""Language identification with a blended-spectrum string kernel.

A text is the set of its n-grams of one to ``LONGEST`` bytes, taken from its lower-cased
letters with one blank for all else. The kernel of two texts is the number of n-grams
present in both, over the geometric mean of the two set sizes. Kernel columns against a
few landmark texts are mapped by the inverse root of the landmarks' own kernel
(Nyström), and one ridge regression per language, that language against the rest, is
solved in those coordinates; both maps fold into one matrix of dual weights. A batch of
texts is scored by products of matrices: presence of n-grams in texts, n-grams in
landmarks, landmarks by languages. The last two are multiplied once, as there are
mostly fewer languages than landmarks.

The languages' outputs become probabilities by a softmax of ``SHARPNESS`` times them;
the highest gives the prediction, its probability the score.

Bounds: n-grams are numbered by a hash of ``BITS`` bits, so a landmark is at most
2**BITS bits, whatever its length. The model is fitted on about ``PER_LANGUAGE`` rows at
most of each of the ``LANGUAGES`` most frequent languages (picked by a hash of id and
text) and ``LANDMARKS`` of them in all; scoring reads every row, and whole
texts. The regression's moments are summed in the tasks: what reaches the driver are
landmarks and matrices of their number.

Edge cases: a text that is null or has no letter is ``und`` with score 0, and so is
every text if nothing can be learned; with one learned language all others are that
language with score 1. A null id is not held out and not learned from; a null lang is
not learned from, an empty one is a language. Ties go to the language first in code
point order. Repeated rows are learned from once. An empty table gives an empty result.
``predict`` keeps other columns, and replaces those named like its outputs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casestar.llm.common import fold_of
from casestar.session import materialize

LONGEST = 4             # bytes, at most 4: an n-gram is a 32-bit number
BITS = 18
LANDMARKS = 128
PER_LANGUAGE = 2000
LANGUAGES = 200
RIDGE = 1e-3
SHARPNESS = 8.0
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
STEP = 1 << 16          # n-grams whose presence is multiplied at once

_MUL = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """The lower-cased letters of a text, runs of anything else as one blank; '' without letters."""
    plain = _OTHER.sub(" ", (text or "").lower()).strip()
    return plain if any(map(str.isalpha, plain)) else ""


def grams(plain: str) -> np.ndarray:
    """Numbers of the n-grams of ``letters(text)``, repeats included."""
    b = np.frombuffer(f" {plain} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    shift = np.uint32(32 - BITS)
    code, out = b, [(b + np.uint32(1)) * _MUL[0] >> shift]
    for n in range(2, min(LONGEST, len(b)) + 1):
        code = (code[:-1] << np.uint32(8)) | b[n - 1:]
        out.append((code ^ (code >> np.uint32(15))) * _MUL[n - 1] >> shift)
    return np.concatenate(out).astype(np.intp)


class Presence:
    """Sets of n-grams, by a table that is cleared after each text."""

    def __init__(self) -> None:
        self.seen = np.zeros(1 << BITS, bool)

    def of(self, plain: str) -> np.ndarray:
        """The distinct n-grams of a text, ascending."""
        found = grams(plain)
        self.seen[found] = True
        out = np.flatnonzero(self.seen) if len(found) > 512 else np.unique(found)
        self.seen[found] = False
        return out


@dataclass(frozen=True)
class Landmarks:
    """``numbers``: row of ``present`` of each n-gram, the last row (all 0) if in no
    landmark; ``present``: n-grams by landmarks; ``sizes``: set sizes; ``inverse``: the
    inverse root of the landmarks' kernel."""
    numbers: np.ndarray
    present: np.ndarray
    sizes: np.ndarray
    inverse: np.ndarray


def landmarks_of(sets: list[np.ndarray]) -> Landmarks:
    used = np.unique(np.concatenate(sets))
    numbers = np.full(1 << BITS, len(used), np.int32)
    numbers[used] = np.arange(len(used), dtype=np.int32)
    present = np.zeros((len(used) + 1, len(sets)), np.float32)
    for j, s in enumerate(sets):
        present[numbers[s], j] = 1
    sizes = np.array([len(s) for s in sets], float)
    kernel = (present.T @ present).astype(float) / np.sqrt(np.outer(sizes, sizes))
    values, vectors = np.linalg.eigh(kernel)
    good = values > 1e-6 * values[-1]
    return Landmarks(numbers, present, sizes, vectors[:, good] / np.sqrt(values[good]))


def product(texts: list[str], numbers: np.ndarray, table: np.ndarray, presence: Presence) -> tuple[np.ndarray, np.ndarray]:
    """The sparse presence matrix of texts (none empty) times ``table``, whose row
    ``numbers[g]`` belongs to n-gram g (the last one, zeros, to n-grams without a row),
    and the texts' set sizes. The rows of the n-grams present are added up."""
    out = np.zeros((len(texts), table.shape[1]))
    sizes = np.ones(len(texts))
    rows: list[np.ndarray] = []
    owners: list[int] = []

    def flush() -> None:
        if rows:
            starts = np.cumsum([0, *map(len, rows[:-1])])
            np.add.at(out, owners, np.add.reduceat(table[np.concatenate(rows)], starts, axis=0))
            rows.clear()
            owners.clear()

    held = 0
    for i, plain in enumerate(texts):
        found = presence.of(plain)
        sizes[i] = len(found)
        known = numbers[found]
        known = known[known < len(table) - 1]
        for at in range(0, len(known), STEP):
            rows.append(known[at:at + STEP])
            owners.append(i)
            held += len(rows[-1])
            if held >= STEP:
                flush()
                held = 0
    flush()
    return out, sizes


def kernel(texts: list[str], marks: Landmarks, presence: Presence) -> np.ndarray:
    """Texts (none empty) by landmarks."""
    shared, sizes = product(texts, marks.numbers, marks.present, presence)
    return shared / np.sqrt(np.outer(sizes, marks.sizes))


@dataclass(frozen=True)
class Model:
    """``weights``: landmarks by languages, ``offset``: a constant per language, ``table``:
    n-grams by languages, the product of landmarks and weights."""
    languages: tuple[str, ...]
    marks: Landmarks | None = None
    weights: np.ndarray | None = None
    offset: np.ndarray | None = None
    table: np.ndarray | None = None

    def outputs(self, texts: list[str], presence: Presence) -> np.ndarray:
        """Kernel times weights plus offset, for texts of which none is empty."""
        got, sizes = product(texts, self.marks.numbers, self.table, presence)
        return got / np.sqrt(sizes)[:, None] + self.offset


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> DataFrame:
    """(lang, text, rank): the bounded sample of ``docs`` (doc_id, text, lang). A language of
    n rows gives those whose hash falls into the first per_language / n of its range."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("order"))
    kept = materialize(rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).select(
        "lang", (F.lit(float(per_language << 30)) / F.col("n")).alias("upto")), "lang_kept")
    sample = rows.join(F.broadcast(kept), "lang").filter(
        F.pmod("order", F.lit(1 << 30)) < F.col("upto")).groupBy("lang", "order").agg(F.first("text").alias("text"))
    mine = Window.partitionBy("lang").orderBy("order")
    return materialize(sample, "lang_sample").withColumn("rank", F.row_number().over(mine))


def fit(docs: DataFrame, landmarks: int = LANDMARKS, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from all of ``docs`` (doc_id, text, lang)."""
    rows = training_rows(docs, per_language)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = tuple(sorted(counts))
    if len(names) < 2:
        return Model(names)
    each = max(1, landmarks // len(names))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence()
        for b in batches:
            plain = [letters(t) for t in b.column(0).to_pylist()]
            bits = np.zeros((len(plain), 1 << BITS), bool)
            for i, p in enumerate(plain):
                bits[i, presence.of(p)] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.packbits(x).tobytes() for x in bits], pa.binary())], names=["grams"])

    chosen = rows.filter(F.col("rank") <= each).orderBy("rank", "lang").select("text").limit(landmarks).mapInArrow(
        sets, "grams binary").collect()
    marks = landmarks_of([np.flatnonzero(np.unpackbits(np.frombuffer(r["grams"], np.uint8))) for r in chosen])
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    index = {name: i for i, name in enumerate(names)}
    k = marks.inverse.shape[1] + 1

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, presence = shared.value, Presence()
        second, first = np.zeros((k, k)), np.zeros((k, len(index)))
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                plain = [letters(t) for t in part.column(1).to_pylist()]
                keep = [i for i, p in enumerate(plain) if p]
                langs = [part.column(0)[i].as_py() for i in keep]
                if not keep:
                    continue
                x = np.c_[kernel([plain[i] for i in keep], marks, presence) @ marks.inverse, np.ones(len(keep))]
                y = -np.ones((len(keep), len(index)))
                y[np.arange(len(keep)), [index[name] for name in langs]] = 1
                weight = np.array([1 / counts[name] for name in langs])[:, None]    # languages count alike
                second += x.T @ (x * weight)
                first += x.T @ (y * weight)
        yield pa.RecordBatch.from_arrays([pa.array([np.c_[second, first].tobytes()], pa.binary())], names=["m"])

    parts = rows.select("lang", "text").coalesce(8).mapInArrow(moments, "m binary").collect()
    total = sum((np.frombuffer(r["m"]).reshape(k, k + len(names)) for r in parts), np.zeros((k, k + len(names))))
    shared.unpersist()
    solved = np.linalg.solve(total[:, :k] + RIDGE * len(names) * np.eye(k), total[:, k:])
    weights = marks.inverse @ solved[:-1]
    return Model(names, marks, weights, solved[-1], marks.present @ (weights / np.sqrt(marks.sizes)[:, None]))


def predict(df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` plus the predicted language and its probability."""
    df = df.drop(lang, score)
    kinds = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    shared = df.sparkSession.sparkContext.broadcast(replace(model, marks=model.marks and replace(
        model.marks, present=np.empty((0, 0)))))        # scoring needs the product only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, presence = shared.value, Presence()
        names = model.languages
        for b in batches:
            out_lang, out_score = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows)
            texts = b.column(b.schema.get_field_index(text))
            for at in range(0, b.num_rows, 256):
                plain = [letters(t.as_py()) for t in texts[at:at + 256]]
                keep = [i for i, p in enumerate(plain) if p]
                if not keep or not names:
                    continue
                if model.marks is None:
                    best, sure = np.zeros(len(keep), int), np.ones(len(keep))
                else:
                    z = SHARPNESS * model.outputs([plain[i] for i in keep], presence)
                    z = np.exp(z - z.max(axis=1, keepdims=True))
                    best = z.argmax(axis=1)
                    sure = z.max(axis=1) / z.sum(axis=1)
                for i, c, s in zip(keep, best, sure, strict=True):
                    out_lang[at + i], out_score[at + i] = names[c], s
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(out_lang, pa.string()), pa.array(out_score, pa.float64())],
                names=[*b.schema.names, lang, score])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *kinds]))


def language_report(docs: DataFrame) -> DataFrame:
    """Per document: whether it is held out, the predicted language and the score."""
    fold = fold_of(F.col("doc_id"), FOLDS)
    model = fit(docs.select("doc_id", "text", "lang").filter(fold != HELD_OUT))
    rows = docs.select("doc_id", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")
