"""Toxicity scores from gradient-boosted trees over dense text features.

Two lexicons are learned from labelled texts: words, and word beginnings of
``STEM`` letters, that occur almost only in toxic ones. A text is described by
how dense and how many the lexicon's entries are, how many lie close to a word
of address ("you"), its shares of capitals and punctuation, and how often words
are obfuscated (digits or symbols among the letters). Boosted trees score the
features; an isotonic regression fitted on rows the trees have not seen turns
their output into a probability.

Lexicons, trees and calibration are fitted on at most ``MAX_TRAINING`` labelled
rows, picked by a hash of the id; scores cover every row and the whole text.

Edge cases: null, empty and blank texts have all-zero features and are scored by
them; a row without label or id is never used to learn; several labels for an id
are averaged and rounded; repeated rows are scored one by one; without labels of
both classes the score is the share of toxic labels (0 with none); an empty
table gives an empty result. Extra columns pass through ``score`` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casestar.llm.common import fold_of, fresh
from casestar.session import materialize

MAX_TRAINING = 20_000   # labelled rows that the models are fitted on
FOLDS, HELD_OUT = 3, 1
STEM = 4
LEXICON = 2_000         # entries of a lexicon
PURITY = 0.8            # least share of toxic texts among those with the entry
SUPPORT = 0.02          # least share of the toxic texts that hold the entry
MIN_SUPPORT = 3
NEAR = 5                # words between an entry and a word of address
TREES, DEPTH = 12, 3
THRESHOLD = 0.7

#: Words of address in the languages of the corpus.
ADDRESS = frozenset(("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr",
                     "euch", "tu", "te", "toi", "ton", "ta", "vous", "votre", "vos", "ti", "tus", "usted", "vosotros"))
FEATURES = ("word_density", "stem_density", "word_hits", "stem_hits", "near_address", "address_density",
            "capitals", "capital_words", "exclamations", "punctuation", "obfuscated", "elongated")
LETTERS = r"\p{L}+"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_OBFUSCATED = re.compile(r"[^\W\d_][0-9@$*!#]+[^\W\d_]")
_ELONGATED = re.compile(r"([^\W\d_])\1\1")
_PUNCTUATION = re.compile(r"[!-/:-@\[-`{-~]")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def features(text: str | None, lexicon: frozenset[str], stems: frozenset[str]) -> list[float]:
    """The values of ``FEATURES`` for one whole text."""
    words = _WORD.findall(text or "")
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    hits = stem_hits = address = near = 0
    last_hit = last_address = -NEAR - 1
    for i, w in enumerate(map(str.lower, words)):
        w = w.strip(_EDGES)
        hit = w in lexicon
        stem = w[:STEM] in stems
        if w in ADDRESS:
            address += 1
            near += i - last_hit <= NEAR
            last_address = i
        if hit or stem:
            hits += hit
            stem_hits += stem
            near += i - last_address <= NEAR
            last_hit = i
    chars = max(1, sum(map(len, words)))
    return [hits / n, stem_hits / n, float(min(hits, 50)), float(min(stem_hits, 50)), near / n, address / n,
            len(_CAPITALS.findall(text)) / chars, sum(w.isupper() for w in words) / n, text.count("!") / n,
            len(_PUNCTUATION.findall(text)) / chars, len(_OBFUSCATED.findall(text)) / n,
            len(_ELONGATED.findall(text)) / n]


@dataclass(frozen=True)
class Model:
    """What ``fit`` learns; without trees, every score is ``share``."""

    share: float
    lexicon: frozenset[str] = frozenset()
    stems: frozenset[str] = frozenset()
    trees: GBTClassificationModel | None = None
    isotonic: IsotonicRegressionModel | None = field(default=None, repr=False)


def with_features(df: DataFrame, text: str, out: str, lexicon: frozenset[str], stems: frozenset[str]) -> DataFrame:
    """``df`` plus an array ``out`` of the features of its text."""
    df = df.drop(out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType(), False), False)])
    kind = pa.list_(pa.field("element", pa.float64(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text))
            made = pa.array([features(t.as_py(), lexicon, stems) for t in texts], kind)
            yield pa.RecordBatch.from_arrays([*b.columns, made], schema=pa.schema(
                [*b.schema, pa.field(out, kind, False)]))

    return df.mapInArrow(run, schema)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, allowed: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, text, y): at most about ``MAX_TRAINING`` labelled documents."""
    y = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & allowed(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.round(F.avg(label)).cast("int").alias("y"))
    share = min(1.0, MAX_TRAINING / max(1, y.count()))
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    return docs.select("doc_id", "text").join(y.filter(picked), "doc_id")


def learn_lexicon(rows: DataFrame, token: Column, toxic: int) -> frozenset[str]:
    """Tokens of an array column that occur almost only in toxic texts."""
    counts = rows.select("y", F.explode(F.array_distinct(token)).alias("t")).groupBy("t").agg(
        F.count("*").alias("n"), F.sum("y").alias("bad"))
    least = max(MIN_SUPPORT, SUPPORT * toxic)
    found = counts.filter((F.col("bad") >= least) & (F.col("bad") >= PURITY * F.col("n"))).orderBy(
        F.desc("bad"), "t").limit(LEXICON)
    return frozenset(r["t"] for r in found.collect())


def fit(docs: DataFrame, labels: DataFrame, label: str, allowed: Callable[[Column], Column]) -> Model:
    """Learn from the labelled documents whose id ``allowed`` admits."""
    rows = materialize(training_rows(docs, labels, label, allowed), "tox_rows").coalesce(8)
    n = rows.agg(F.count("*").alias("n"), F.sum("y").alias("bad")).first()
    total, bad = n["n"], n["bad"] or 0
    if not 0 < bad < total:
        return Model(bad / total if total else 0.0)
    low = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(LETTERS), F.lit(0))
    lexicon = learn_lexicon(rows, low, bad)
    stems = learn_lexicon(rows, F.transform(F.filter(low, lambda w: F.length(w) >= STEM),
                                            lambda w: F.substring(w, 1, STEM)), bad)
    table = materialize(with_features(rows, "text", "x", lexicon, stems).select(
        "doc_id", F.col("y").cast("double").alias("y"), "x"), "tox_features").coalesce(8)
    table = table.withColumn("v", array_to_vector("x"))
    calibrates = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(4)) == 0
    parts = {r["c"]: r["k"] for r in table.groupBy(calibrates.alias("c")).agg(F.countDistinct("y").alias("k")).collect()}
    whole = parts.get(True, 0) < 2 or parts.get(False, 0) < 2   # too few rows to part
    train, held = (table, table) if whole else (table.filter(~calibrates), table.filter(calibrates))
    trees = GBTClassifier(featuresCol="v", labelCol="y", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=11,
                          checkpointInterval=-1).fit(train)
    isotonic = IsotonicRegression(featuresCol="p", labelCol="y").fit(
        trees.transform(held).select("y", vector_to_array("probability")[1].alias("p")))
    return Model(bad / total, lexicon, stems, trees, isotonic)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` plus the probability ``out`` that its text is toxic."""
    df = df.drop(out)
    if model.trees is None:
        return df.withColumn(out, F.lit(float(model.share)))
    x, v, p = fresh(df, "x"), fresh(df, "v"), fresh(df, "p")
    scored = with_features(df, text, x, model.lexicon, model.stems).withColumn(v, array_to_vector(x))
    names = {k: fresh(df, k) for k in ("raw", "prob", "pred")}
    trees = model.trees.copy().setFeaturesCol(v).setRawPredictionCol(names["raw"]).setProbabilityCol(
        names["prob"]).setPredictionCol(names["pred"])
    scored = trees.transform(scored).withColumn(p, vector_to_array(names["prob"])[1])
    scored = model.isotonic.copy().setFeaturesCol(p).setPredictionCol(out).transform(scored)
    return scored.withColumn(out, F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))).select(*df.columns, out)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it is held out, its score and the prediction."""
    docs = docs.select("doc_id", "text")
    model = fit(docs, labels, "toxic", lambda doc_id: fold_of(doc_id, FOLDS) != HELD_OUT)
    held_out = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return score(docs, model, out="score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
