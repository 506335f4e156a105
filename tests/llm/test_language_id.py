import numpy as np
import pytest

from casestar.llm import language_id as L

HERE = "/root/testdata/sf0.01"


def plain_grams(text):
    b = f" {L.letters(text)} ".encode()
    return {b[i:i + n] for n in range(1, L.LONGEST + 1) for i in range(len(b) - n + 1)}


def test_kernel_counts_shared_grams():
    texts = ["Hello, world", "wor 12 ld!", "été à la plage", "a"]
    marks = L.landmarks_of([L.Presence().of(L.letters(t)) for t in texts[:3]])
    got = L.kernel([L.letters(t) for t in texts], marks, L.Presence())
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:3]):
            x, y = plain_grams(a), plain_grams(b)
            assert got[i, j] == pytest.approx(len(x & y) / (len(x) * len(y)) ** 0.5)


def test_long_texts_are_multiplied_in_parts(monkeypatch):
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abcdefgh "), 5000)).strip() for _ in range(5)]
    marks = L.landmarks_of([L.Presence().of(t) for t in texts[:2]])
    whole = L.kernel(texts, marks, L.Presence())
    monkeypatch.setattr(L, "STEP", 100)
    assert np.allclose(whole, L.kernel(texts, marks, L.Presence()))


def test_ridge_in_landmark_coordinates(spark):
    """The fitted weights against a regression on all rows at once."""
    docs = spark.createDataFrame([(i, " ".join([w] * (1 + i % 4)), lang) for i, (w, lang) in enumerate(
        [("the cat", "en"), ("die katze", "de"), ("and dog", "en"), ("der hund", "de"), ("le chat", "fr")] * 6)],
        "doc_id long, text string, lang string")
    model = L.fit(docs, landmarks=6)
    rows = docs.collect()
    k = L.kernel([L.letters(r.text) for r in rows], model.marks, L.Presence())
    x = np.c_[k @ model.marks.inverse, np.ones(len(rows))]
    counts = {lang: sum(r.lang == lang for r in rows) for lang in model.languages}
    w = np.sqrt([1 / counts[r.lang] for r in rows])[:, None]
    y = np.array([[1 if r.lang == lang else -1 for lang in model.languages] for r in rows])
    a = np.vstack([x * w, np.sqrt(L.RIDGE * len(counts)) * np.eye(x.shape[1])])
    want = np.linalg.lstsq(a, np.vstack([y * w, np.zeros((x.shape[1], y.shape[1]))]), rcond=None)[0]
    assert np.allclose(k @ model.weights + model.offset, x @ want, atol=1e-6)
    assert np.allclose(model.outputs([L.letters(r.text) for r in rows], L.Presence()), x @ want, atol=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{HERE}/documents.parquet")
    out = L.language_report(docs)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 300
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    got = L.language_report(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got)      # lang is null everywhere
    assert L.language_report(no_docs).collect() == []
    model = L.fit(spark.createDataFrame([(1, "the cat", "en"), (2, "12", "xx"), (3, None, "yy")],
                                        "doc_id long, text string, lang string"))
    got = {(r.doc_id, r.text): r for r in L.predict(odd_docs, model, score="n_chars").collect()}
    assert len(got) < odd_docs.count()
    for (_, text), r in got.items():
        has = any(map(str.isalpha, text or ""))
        assert (r.lang_pred, r.n_chars) == (("en", 1.0) if has else ("und", 0.0))
        assert r["__q"] == 1 and r["score"] == "x"


def test_sample_is_bounded_and_learns_repeats_once(spark):
    docs = spark.createDataFrame([(1, "same text", "en")] * 40 + [(i, f"word {'x' * i}", "de") for i in range(2, 30)],
                                 "doc_id long, text string, lang string")
    counts = [{r["lang"]: r["count"] for r in L.training_rows(docs, per_language=n).groupBy("lang").count().collect()}
              for n in (100, 9)]
    assert counts[0] == {"en": 1, "de": 28}
    assert 0 < counts[1]["de"] < 20
