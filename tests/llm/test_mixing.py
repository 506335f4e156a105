from collections import defaultdict

import pytest

from casestar.llm import mixing as X


def fill(sizes, volume=1.5):
    """Targets by repeated sharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: X.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, volume * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10}, {"a": 10, "b": 1000, "c": 50, None: 7}, {"b": 5, "ä": 5, "a": 5, "Z": 5000}, {"a": 0, "b": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in X.source_targets(df).collect()}
    want = fill(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257])
def test_permutation(spark, n):
    from pyspark.sql import functions as F
    got = [r[0] for r in spark.range(n).select(X.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5))).collect()]
    assert sorted(got) == list(range(n)) and (n < 10 or got != list(range(n)))




@pytest.mark.parametrize("block,per_shard", [(7, 16), (64, 4096)])
def test_mix_meets_targets(spark, small_dir, block, per_shard):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "source")
    m = X.mix(docs, block, per_shard)
    taken = defaultdict(int)
    for r in X.taken_spans(m).collect():
        taken[r["rank"], r["chunk"], r["n"]] += r["taken"]
    sums, target = defaultdict(int), {}
    for r in m.docs.collect():
        t = taken[r["rank"], r["chunk"], r["n"]]
        assert t <= 2 * r["size"]
        sums[r["source"]] += t
        target[r["source"]] = r["target"]
    assert all(abs(sums[s] - target[s]) <= 1 for s in target)
    per = m.slots.groupBy("shard").count().collect()
    assert all(r["count"] == per_shard for r in per if r["shard"] < len(per) - 1)
    assert len({r["count"] for r in m.slots.filter("shard = 0").groupBy("rank").count().collect()}) > 1
    assert m.slots.groupBy("rank", "block", "pass").count().filter("count > 1").isEmpty()


def test_report_reruns_agree(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    a, b = (sorted(map(tuple, X.mix_report(d).collect())) for d in (docs, docs.repartition(5)))
    assert a == b and len(a) == docs.count()


def test_odd_rows(odd_docs, no_docs):
    rows = X.mix_report(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.size == r.taken == 0 for r in rows if r.doc_id in (1, 2, 3))
    long = next(r for r in rows if r.doc_id == 6)
    assert long.size == 60_000 and abs(long.source_size - 60_004) <= 0 and long.taken <= 2 * long.size
    assert X.mix_report(no_docs).collect() == []
    assert X.mixed_documents(no_docs).collect() == []


def test_mixed_documents_hold_the_taken_words(odd_docs):
    out = X.mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    taken = {(r.doc_id, r.size): r.taken for r in X.mix_report(odd_docs).filter("doc_id in (4, 6, 7)").collect()}
    words = defaultdict(int)
    whole = {r.doc_id: r.text for r in odd_docs.collect()}
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
        if r.doc_id in (4, 6, 7, 9):
            assert all(" ".join(p.split()) in " ".join(whole[r.doc_id].split()) for p in r.text.split("\n"))
    assert all(words[i] == t for (i, _), t in taken.items())
