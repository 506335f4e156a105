import numpy as np
import pytest

from casestar.llm import quality_qda as Q
from casestar.llm import toxicity as T

HERE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{HERE}/documents.parquet"), spark.read.parquet(f"{HERE}/labels.parquet")


def auc(rows, label):
    pos = [r.score for r in rows if r[label] == 1]
    neg = [r.score for r in rows if r[label] == 0]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def test_quality_on_held_out_rows(labelled):
    docs, labels = labelled
    out = Q.quality_scores(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    assert auc(rows, "quality") > 0.97
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def test_scores_of_a_table_are_those_of_the_report(labelled):
    docs, labels = labelled
    docs = docs.filter("doc_id < 200")
    stats = docs.select("doc_id", Q.statistics(Q.F.col("text")).alias("s"))
    model = Q.fit(stats, "s", labels, "quality", lambda doc_id: Q.fold_of(doc_id, Q.FOLDS) != Q.HELD_OUT)
    got = {r.doc_id: r.score for r in Q.score(docs, model).collect()}
    want = {r.doc_id: r.score for r in Q.quality_scores(docs, labels).collect()}
    assert len(set(want.values())) > 2 and got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 1e-6 for i in want)


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    out = T.toxicity_report(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    assert auc(rows, "toxic") > 0.85
    assert all(r.predicted == 0 for r in rows if r.toxic == 0)
    assert all(0 <= r.score <= 1 for r in rows)


def test_discriminant_matches_densities(spark):
    rng = np.random.default_rng(1)
    k = len(Q.FEATURES)
    data = [rng.normal(size=(400, k)) @ rng.normal(size=(k, k)), rng.normal(size=(300, k)) + 0.3]
    counts = np.array([400.0, 300.0])
    model = Q.from_moments(counts, np.array([d.sum(0) for d in data]), np.array([d.T @ d for d in data]))
    x = data[1][:5]
    dens = []
    for offset, mean, factor in model.classes:
        cov = np.linalg.inv(factor.T @ factor)
        dens.append(np.log(counts[len(dens)] / 700) - np.linalg.slogdet(cov)[1] / 2
                    - np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov), x - mean) / 2)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i int, x array<double>")
    got = [r.s for r in df.select("i", model.score([df.x[j] for j in range(k)]).alias("s")).orderBy("i").collect()]
    assert np.allclose(got, 1 / (1 + np.exp(dens[0] - dens[1])), atol=1e-9)


def test_odd_rows_and_missing_classes(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bad = spark.createDataFrame([(1, None, None), (None, 1, 1), (4, 1, 0), (4, 1, 0), (7, 1, 0)],
                                "doc_id long, quality int, toxic int")
    for report in (Q.quality_scores, T.toxicity_report):
        out = report(odd_docs, none).collect()
        assert len(out) == odd_docs.count() and {r.score for r in out} == {0.0}
        assert len(report(odd_docs, bad).collect()) == odd_docs.count()
        assert report(no_docs, bad).collect() == []


def test_scored_columns_pass_through(spark, odd_docs):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 10)], "doc_id long, quality int, toxic int")
    model = T.fit(odd_docs, labels, "toxic", lambda c: c.isNotNull())
    out = T.score(odd_docs, model)
    assert out.columns == [*(c for c in odd_docs.columns if c != "score"), "score"]
    assert out.count() == odd_docs.count()
    assert Q.score(odd_docs, Q.Model(0.25)).select("score").distinct().collect()[0][0] == 0.25


def test_features_by_hand():
    f = dict(zip(T.FEATURES, T.features("You STUPID m0ron! soooo", frozenset(["stupid"]), frozenset()), strict=True))
    assert f["word_density"] == 0.25 and f["near_address"] == 0.25 and f["obfuscated"] == 0.25
    assert f["elongated"] == 0.25 and f["exclamations"] == 0.25 and f["capital_words"] == 0.25
    assert T.features(None, frozenset(), frozenset()) == [0.0] * len(T.FEATURES)
