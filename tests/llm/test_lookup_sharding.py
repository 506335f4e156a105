import hashlib
from collections import Counter

import pytest

from casestar.llm import lookup_sharding as L


def naive(names, size):
    """Each shard's whole permutation, claimed in turns."""
    def num(name, salt, below):
        return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:16], 16) % below

    order = [[(num(n, "offset", size) + j * (num(n, "stride", size - 1) + 1)) % size for j in range(size)] for n in names]
    slots, at = [None] * size, [0] * len(names)
    while None in slots:
        for s in range(len(names)):
            if None not in slots:
                break
            while slots[order[s][at[s]]] is not None:
                at[s] += 1
            slots[order[s][at[s]]] = s
    return slots


@pytest.mark.parametrize("n,size", [(1, 2), (1, 13), (3, 13), (7, 101), (16, 251)])
def test_table_matches_naive_filling(n, size):
    assert L.fill_table(L.shard_names(n), size) == naive(L.shard_names(n), size)


def test_table_is_even_and_stable():
    names = L.shard_names(20)
    full = L.fill_table(names, 4099)
    count = Counter(full)
    assert max(count.values()) - min(count.values()) <= 1
    less = L.fill_table(names[:-1], 4099)
    moved = sum(a != b for a, b in zip(full, less, strict=True) if a != 19)
    assert moved < 0.2 * len(full)
    for bad in (4100, 13):
        with pytest.raises(ValueError):
            L.fill_table(names, bad)


def test_rows(spark, odd_docs, no_docs):
    slots = L.fill_table(L.shard_names())
    out = L.assign_shards(odd_docs.withColumnRenamed("found", "shard"))
    assert out.columns == [c for c in odd_docs.columns if c != "found"] + ["shard"]
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        key = str(r.doc_id) if r.doc_id is not None else hashlib.md5((r.text or "").encode()).hexdigest()
        assert r.shard == slots[int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % L.TABLE_SIZE]
    assert L.assign_shards(no_docs).collect() == []


def test_shares_are_even(spark):
    n = [r["count"] for r in L.assign_shards(spark.range(20_000).selectExpr("id AS doc_id", "'' AS text")).groupBy(
        "shard").count().collect()]
    assert len(n) == L.SHARDS and max(n) < 1.5 * min(n)
