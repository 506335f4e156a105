"""Quality scores from a regularised quadratic discriminant.

Statistics of a whole text are transformed towards a bell shape (logarithms of
counts and of shares). Each class has a mean and a covariance of its own; the
covariances are shrunk towards the pooled one and that towards a diagonal, so
that few labels or nearly collinear statistics do no harm. A text's score is
the posterior from the difference of the classes' log densities, i.e. of their
Mahalanobis distances and log determinants. The inverted Cholesky factors are
worked out once and are constants of the scoring expression.

Counts, sums and sums of products of all labelled training rows are gathered in
one aggregate of fixed width; scoring is one expression per row, no shuffle.

Edge cases: null, empty and blank texts have zero counts and are scored by them;
a row without label or id is not learned from; several labels for an id are
averaged and rounded; repeated rows are scored one by one; without labels of
both classes the score is the share of good labels (0 with none); an empty table
gives an empty result. Statistics are of whole texts, however long. Extra columns pass
through ``score`` untouched, but for one named like its output, which it replaces.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casestar.llm.common import fold_of, fresh
from casestar.llm.quality_rules import statistics
from casestar.session import materialize

FOLDS, HELD_OUT = 4, 2
SHRINK = 0.1        # weight of the pooled covariance
RIDGE = 0.05        # weight of its diagonal, of what is pooled
THRESHOLD = 0.7
FEATURES = ("words", "word_length", "symbols", "symbol_runs", "duplicate_lines", "repetition", "vocabulary",
            "capitals", "exclamations", "sentences", "function_words")


def transformed(s: Column) -> list[Column]:
    """The transformed statistics, in the order of ``FEATURES``. Shares are
    smoothed by two words' worth, so that short texts are not extremes."""
    n = s["n_words"]

    def share(x: Column, whole: Column = n) -> Column:
        return F.log((x + 0.05 * F.sqrt(whole + 1) + 0.1) / (whole + 2))

    return [F.log1p(n), F.log((s["word_chars"] + 10) / (n + 2)), share(s["n_symbols"]), share(s["n_symbol_runs"]),
            share(s["lines"]["dup"], s["lines"]["n"]), share(s["n_repeat_words"]),
            F.log((s["n_distinct"] + 2) / (n + 2)) / (1 + F.log1p(n)), share(s["n_capitals"], s["word_chars"]),
            share(s["n_exclaims"]), share(s["n_stops"]), share(s["n_function"])]


@dataclass(frozen=True)
class Model:
    """Per class (bad, good): log prior minus half the log determinant, mean, and
    the inverse of the covariance's Cholesky factor. None: every score is ``share``."""

    share: float
    classes: tuple[tuple[float, np.ndarray, np.ndarray], ...] | None = None

    def score(self, x: list[Column]) -> Column:
        if self.classes is None:
            return F.lit(float(self.share))

        def log_density(offset: float, mean: np.ndarray, factor: np.ndarray) -> Column:
            squares = F.lit(0.0)
            for i in range(len(x)):
                z = F.lit(float(-(factor[i] @ mean)))
                for j in range(i + 1):
                    z = z + x[j] * float(factor[i, j])
                squares = squares + z * z
            return F.lit(float(offset)) - squares / 2

        bad, good = (log_density(*c) for c in self.classes)
        return 1 / (1 + F.exp(F.least(F.greatest(bad - good, F.lit(-500.0)), F.lit(500.0))))


def from_moments(counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Model:
    """The model from each class's row count, sums and sums of products."""
    n = counts.sum()
    if not counts.all():
        return Model(float(counts[1] / n) if n else 0.0)
    means = sums / counts[:, None]
    scatter = [p - c * np.outer(m, m) for p, c, m in zip(products, counts, means, strict=True)]
    pooled = sum(scatter) / n
    pooled = (1 - RIDGE) * pooled + RIDGE * np.diag(np.maximum(np.diag(pooled), 1e-6))
    classes = []
    for c, m, s in zip(counts, means, scatter, strict=True):
        weight = SHRINK + (1 - SHRINK) * len(m) / (len(m) + c)     # few rows lean on the pool
        lower = np.linalg.cholesky((1 - weight) * s / c + weight * pooled)
        classes.append((float(np.log(c / n) - np.log(np.diag(lower)).sum()), m,
                        np.linalg.solve(lower, np.eye(len(m)))))
    return Model(float(counts[1] / n), tuple(classes))


def fit(stats: DataFrame, column: str, labels: DataFrame, label: str,
        allowed: Callable[[Column], Column]) -> Model:
    """Learn from the rows (doc_id, statistics) whose id ``allowed`` admits."""
    y = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & allowed(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.round(F.avg(label)).cast("int").alias("y"))
    k = len(FEATURES)
    x = stats.join(y, "doc_id").select("y", F.array(*transformed(F.col(column))).alias("x")).select(
        "y", *[F.col("x")[i].alias(f"x{i}") for i in range(k)])
    rows = x.groupBy("y").agg(
        F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(k)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i in range(k) for j in range(i + 1)]).collect()
    counts, sums, products = np.zeros(2), np.zeros((2, k)), np.zeros((2, k, k))
    for r in rows:
        c = int(r["y"] > 0)
        counts[c] += r["n"]
        sums[c] += [r[f"s{i}"] for i in range(k)]
        products[c] += [[r[f"p{max(i, j)}_{min(i, j)}"] for j in range(k)] for i in range(k)]
    return from_moments(counts, sums, products)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` plus the probability ``out`` that its text is good."""
    df = df.drop(out)
    stats, x = fresh(df, "stats"), fresh(df, "x")
    scored = df.withColumn(stats, statistics(F.col(text))).withColumn(x, F.array(*transformed(F.col(stats))))
    return scored.withColumn(out, model.score([F.col(x)[i] for i in range(len(FEATURES))])).select(*df.columns, out)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it is held out, its score and the prediction. The
    statistics are written once and serve both the fit and the scores."""
    stats = materialize(docs.select("doc_id", statistics(F.col("text")).alias("s")), "qda_stats")
    model = fit(stats, "s", labels, "quality", lambda doc_id: fold_of(doc_id, FOLDS) != HELD_OUT)
    held_out = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    x = stats.select("doc_id", F.array(*transformed(F.col("s"))).alias("x"))
    scored = x.select("doc_id", held_out.alias("held_out"),
                      model.score([F.col("x")[i] for i in range(len(FEATURES))]).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
