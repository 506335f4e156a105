import hashlib
import random

from casestar.llm import decontaminate as D



def brute(text, items):
    ws = D.words_of(text)
    hit, ids = set(), set()
    for item, other in items:
        for w in D.windows_of(D.words_of(other)):
            for i in range(len(ws) - len(w) + 1):
                if tuple(ws[i:i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    if item is not None:
                        ids.add(str(item))
    return len(ws), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def case(seed):
    rng = random.Random(seed)
    vocab = ["a", "b", "C", "é", "d9"]
    items = [(i if i else None, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 5, 12, 13, 14, 30]))))
             for i in range(25)] + [(7, "Ä, ö!"), (11, "x-y z")]
    docs = [" ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 8, 40, 120]))) for _ in range(30)]
    docs += [f"{docs[-1]}; {t.upper()}. {docs[-2]}" for _, t in items] + [None, "", "X Y\tz", "ä ö Ä ö"]
    return docs, items


def test_against_brute_force(spark):
    docs, items = case(4)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for r in D.contamination_report(df, bench).collect():
        want = brute(docs[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == want
        assert r.contaminated == (want[1] > 0 and 20 * want[1] >= want[0])


def test_blocks_add_up(spark):
    docs, items = case(9)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(map(str, D.find_items(df, bench, block_bytes=b).collect())) for b in (1 << 20, 100))
    assert one == many


def test_many_blocks_are_released(spark, monkeypatch):
    """A benchmark of 40 blocks: tasks hold a few tables at a time, results are the same."""
    docs, items = case(9)
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    size = sum(len((t or "").encode()) for _, t in items)
    made = []
    one = D._pass
    monkeypatch.setattr(D, "_pass", lambda df, tables, *a: made.append(tables) or one(df, tables, *a))
    found = D.find_items(rows, bench, block_bytes=-(-size // 40))
    assert len(made) == 40
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") <= D.PASSES
    got = {r.doc_id: (r.found.n_words, r.h, len(r.found["items"])) for r in found.withColumn("h", D.n_hit(D.F.col("found"))).collect()}
    assert got == {i: brute(t, items)[:3] for i, t in enumerate(docs)}


def test_search_jumps():
    class Counting(list):
        looked = 0

        def __getitem__(self, i):
            Counting.looked += isinstance(i, slice)
            return super().__getitem__(i)

    table, = D.build_tables([("i", " ".join(f"p{i}" for i in range(13)))])
    assert list(table.search(Counting([b"q"] * 1200))) == [] and Counting.looked <= 101


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "one two three four"), (2, None)], "item_id long, text string")
    kept = D.decontaminate(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    assert D.decontaminate(odd_docs, bench.limit(0)).count() == odd_docs.count()
    assert D.decontaminate(no_docs, bench).collect() == []
    assert D.contamination_report(no_docs, bench).collect() == []
