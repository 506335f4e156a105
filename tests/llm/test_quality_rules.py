import re
from collections import Counter

from casestar.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    ws = WORD.findall(text or "")
    wins = Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    hit = {i + k for i in range(len(ws) - 4) if wins[tuple(ws[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit))


def test_base_statistics_match_brute_force(spark):
    texts = ["a b c d e a b c d e", "a a a a a a a", "x y\nx y\n\n x y\nz", "# * $% a|b <>", None, "",
             "a b c d e f a b c d e g a b c d e", "é 😀 ü " * 9, "1 2 3 4 5 1 2 3 4 5 1 2 3 4 5 6"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in Q.quality_report(df).collect():
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_odd_rows(odd_docs, no_docs):
    out = Q.quality_report(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert all(not r.kept and r.base_failed and r.n_words == 0 for r in out if r.doc_id in (1, 2, 3))
    assert [r.kept for r in out if r.doc_id == 4] == [False]     # says everything three times
    assert Q.quality_report(no_docs).collect() == []


def test_keep_good_keeps_columns_and_rows(odd_docs):
    kept = Q.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} <= {None, 6, 8}


def test_model_agrees_with_labels(spark, small_dir):
    docs, labels = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.quality_report(docs).join(labels, "doc_id").filter("not base_failed").collect()
    right = sum(r.kept == bool(r.quality) for r in got)
    assert right >= 0.95 * len(got)
