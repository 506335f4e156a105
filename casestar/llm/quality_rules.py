"""Quality rules by weak supervision (native DataFrame functions only).

Each rule looks at cheap statistics of a whole text and votes good (+1), bad
(-1) or abstains (0). Expectation-maximisation over the distinct vote patterns
estimates how accurate each rule is and how common good documents are; a
document's posterior probability of being good decides, instead of the demand
that all rules pass. There are at most 3**len(RULES) vote patterns whatever the
corpus, so the pattern counts are one map-side combined aggregate and the whole
estimation is one fold over a single row.

Edge cases: a null or blank text has no words, fails the base rule and is not
kept. Repeated rows and null ids are judged one by one like any other row. Statistics
are of the whole text, however long. An empty table gives an empty result (the model is then the prior). Extra columns
pass through ``with_quality`` untouched whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casestar.llm.common import BLANKS, fresh, let, total, words
from casestar.session import materialize

WINDOW = 5
SYMBOLS = "#*$%&|<>"
CAPITALS = "[A-ZÀ-ÖØ-Þ]"
#: Names of the voting rules, in vote order.
RULES = ("length", "word_length", "symbols", "symbol_runs", "duplicate_lines", "repetition",
         "vocabulary", "capitals", "exclamations", "sentences", "function_words")
#: Frequent function words of the four languages of the corpus.
FUNCTION_WORDS = ("the", "of", "and", "to", "in", "a", "is", "that", "for",
                  "der", "die", "und", "den", "das", "zu", "mit",
                  "de", "la", "le", "et", "les", "des", "en", "un", "une",
                  "que", "el", "y", "los", "del", "con", "por")
ITERATIONS = 25
#: Starting values: share of good documents, and how often a rule that votes is
#: right on good and on bad documents. A rule rarely calls a good text bad, but
#: each rule knows only one kind of bad text, hence the two accuracies.
START_GOOD, START_ON_GOOD, START_ON_BAD = 0.8, 0.995, 0.3
PRIOR_WEIGHT = 2.0      # pseudo-documents behind each starting value
THRESHOLD = 0.5


def repeated_words(ws: Column) -> Column:
    """Words that lie in a 5-word window found twice or more in the array."""
    n = F.size(ws)
    hashes = F.transform(F.slice(ws, F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0))),
                         lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, WINDOW)]))

    def covered(starts: Column) -> Column:
        return total(F.transform(starts, lambda p, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW)))), F.lit(0))

    def repeats(hs: Column) -> Column:
        ordered = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(ordered, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)))
                     | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])))
        return let(starts, covered)

    return let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0))
               .otherwise(repeats(hs)))


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def statistics(text: Column) -> Column:
    """Struct of the statistics the rules look at. The words are bound once, so
    a filter on them does not extract them again for every statistic."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: _without(x, BLANKS) != "")
    return let(words(text), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"),
        F.length(_without(t, BLANKS)).cast("long").alias("word_chars"),
        (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long").alias("n_symbols"),
        let(lines, lambda ls: F.struct(
            F.size(ls).cast("long").alias("n"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"))).alias("lines"),
        repeated_words(ws).cast("long").alias("n_repeat_words"),
        F.regexp_count(t, F.lit(f"[{SYMBOLS}]+")).cast("long").alias("n_symbol_runs"),
        F.size(F.array_distinct(ws)).cast("long").alias("n_distinct"),
        F.size(F.filter(ws, lambda w: w.isin(*FUNCTION_WORDS))).cast("long").alias("n_function"),
        (F.length(t) - F.length(F.regexp_replace(t, CAPITALS, ""))).cast("long").alias("n_capitals"),
        (F.length(t) - F.length(_without(t, "!"))).cast("long").alias("n_exclaims"),
        (F.length(t) - F.length(_without(t, ".!?"))).cast("long").alias("n_stops")))


def base_failed(s: Column) -> Column:
    """The hard floor: under 10 words, or over 20 % of the words repeated."""
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


def votes(s: Column) -> Column:
    """The vote of every rule, as an array in the order of ``RULES``."""
    n = s["n_words"]

    def rule(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return F.array(
        rule(n < 10, n >= 20),
        rule((s["word_chars"] < 2 * n) | (s["word_chars"] > 15 * n), (s["word_chars"] >= 3 * n) & (s["word_chars"] <= 12 * n)),
        rule(10 * s["n_symbols"] > n, 50 * s["n_symbols"] <= n),
        rule(10 * s["n_symbol_runs"] > n, 50 * s["n_symbol_runs"] <= n),
        rule(10 * s["lines"]["dup"] > 3 * s["lines"]["n"], 20 * s["lines"]["dup"] <= s["lines"]["n"]),
        rule(100 * s["n_repeat_words"] > 20 * n, 100 * s["n_repeat_words"] <= 5 * n),
        rule((8 * s["n_distinct"] < n) & (n >= 20), 4 * s["n_distinct"] >= n),
        rule(10 * s["n_capitals"] > 3 * s["word_chars"], 100 * s["n_capitals"] <= 15 * s["word_chars"]),
        rule(10 * s["n_exclaims"] > n, 50 * s["n_exclaims"] <= n),
        rule((s["n_stops"] == 0) & (n >= 20), 40 * s["n_stops"] >= n),
        rule((50 * s["n_function"] < n) & (n >= 20), 16 * s["n_function"] >= n))


@dataclass(frozen=True)
class LabelModel:
    """Estimated share of good documents and accuracies of each rule."""

    good: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def posterior(self, vote: Column) -> Column:
        rates = F.array(*[F.struct(F.lit(float(g)).alias("g"), F.lit(float(b)).alias("b"))
                          for g, b in zip(self.on_good, self.on_bad, strict=True)])
        return _posterior(vote, F.lit(float(self.good)), rates)


def _posterior(vote: Column, good: Column, rates: Column) -> Column:
    """An abstention says nothing; a vote counts by the odds of the two classes."""
    evidence = total(F.zip_with(vote, rates, lambda v, r: F.when(v == 1, F.log(r["g"] / (1 - r["b"]))).when(
        v == -1, F.log((1 - r["g"]) / r["b"])).otherwise(0.0)), F.lit(0.0))
    return 1 / (1 + F.exp(-(F.log(good / (1 - good)) + evidence)))


def pattern_counts(df: DataFrame, vote: str) -> DataFrame:
    """Distinct vote patterns with their counts (3**len(RULES) rows at most)."""
    return df.groupBy(F.col(vote).alias("v")).agg(F.count(F.lit(1)).alias("c"))


def fit(df: DataFrame, vote: str) -> LabelModel:
    """Expectation-maximisation as one fold over the gathered vote patterns."""
    gathered = pattern_counts(df, vote).agg(
        F.array_sort(F.collect_list(F.struct("v", "c"))).alias("pats"))

    def step(pats: Column, m: Column) -> Column:
        scored = F.transform(pats, lambda p: F.struct(
            p["v"].alias("v"), p["c"].cast("double").alias("c"),
            _posterior(p["v"], m["good"], m["rates"]).alias("g")))

        def update(ps: Column) -> Column:
            def mass(weight) -> Column:
                return total(F.transform(ps, weight), F.lit(0.0))

            def share(part: Column, whole: Column, start: float, low: float, high: float) -> Column:
                s = (part + PRIOR_WEIGHT * start) / (whole + PRIOR_WEIGHT)
                return F.least(F.greatest(s, F.lit(low)), F.lit(high))

            def rates(j: Column) -> Column:
                def when(value: int, of) -> Column:
                    return mass(lambda p: F.when(F.get(p["v"], j) == value, of(p)).otherwise(0.0))

                good = lambda p: p["c"] * p["g"]        # noqa: E731
                bad = lambda p: p["c"] * (1 - p["g"])
                return F.struct(
                    share(when(1, good), when(1, good) + when(-1, good), START_ON_GOOD, 0.7, 0.999).alias("g"),
                    share(when(-1, bad), when(1, bad) + when(-1, bad), START_ON_BAD, 0.1, 0.99).alias("b"))

            return F.struct(share(mass(lambda p: p["c"] * p["g"]), mass(lambda p: p["c"]), START_GOOD, 0.05,
                                  0.95).alias("good"),
                            F.transform(F.sequence(F.lit(0), F.lit(len(RULES) - 1)), rates).alias("rates"))

        return let(scored, update)

    start = F.struct(F.lit(START_GOOD).alias("good"), F.array_repeat(F.struct(
        F.lit(START_ON_GOOD).alias("g"), F.lit(START_ON_BAD).alias("b")), len(RULES)).alias("rates"))
    m = gathered.select(let(F.col("pats"), lambda pats: F.aggregate(
        F.sequence(F.lit(1), F.lit(ITERATIONS)), start, lambda m, _: step(pats, m))).alias("m")).first()["m"]
    return LabelModel(m["good"], tuple(r["g"] for r in m["rates"]), tuple(r["b"] for r in m["rates"]))


def with_quality(df: DataFrame, text: str = "text", out: str = "quality",
                 model: LabelModel | None = None) -> DataFrame:
    """All columns of ``df`` plus a struct ``out``: the statistics, the votes,
    ``base_failed``, the ``posterior`` of being good and ``kept``. Without a given
    model, one pass over the texts counts the vote patterns it is fitted on; the
    texts are not written."""
    stats, vote = statistics(F.col(text)), fresh(df, "votes")
    model = model or fit(df.select(let(stats, votes).alias(vote)), vote)
    return df.withColumn(out, let(stats, lambda s: let(votes(s), lambda v: judged(s, v, model))))


def judged(s: Column, vote: Column, model: LabelModel) -> Column:
    """Struct of statistics, votes, base verdict, posterior and verdict."""
    post = model.posterior(vote)
    return let(F.struct(base_failed(s).alias("failed"), post.alias("post")), lambda j: F.struct(
        s.alias("stats"), vote.alias("votes"), j["failed"].alias("base_failed"), j["post"].alias("posterior"),
        (~j["failed"] & (j["post"] >= THRESHOLD)).alias("kept")))


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """Only the documents that the label model keeps, columns unchanged. The documents
    are written once with their votes, which serve the estimation and the verdict."""
    out, stats = fresh(df, "votes"), statistics(F.col(text))
    voted = let(stats, lambda s: F.struct(base_failed(s).alias("failed"), votes(s).alias("v")))
    marked = materialize(df.withColumn(out, voted), "quality_documents")
    model = fit(marked.select(F.col(out)["v"].alias("v")), "v")
    return marked.filter(~F.col(out)["failed"] & (model.posterior(F.col(out)["v"]) >= THRESHOLD)).select(*df.columns)


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document: the base statistics, the verdict and the posterior. The
    statistics are written once and serve both the estimation and the verdict."""
    stats = docs.select("doc_id", statistics(F.col("text")).alias("s"))
    stats = materialize(stats.withColumn("v", let(F.col("s"), votes)), "quality_votes")
    scored = stats.select("doc_id", judged(F.col("s"), F.col("v"), fit(stats, "v")).alias("q"))
    q = F.col("q")
    s = q["stats"]
    return scored.select(
        "doc_id", s["n_words"].alias("n_words"), s["word_chars"].alias("word_chars"),
        s["n_symbols"].alias("n_symbols"), s["lines"]["dup"].alias("n_dup_lines"),
        s["n_repeat_words"].alias("n_repeat_words"), q["base_failed"].alias("base_failed"),
        q["kept"].alias("kept"), F.round(q["posterior"], 6).alias("posterior"))
