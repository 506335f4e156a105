"""The pipeline's rows against a plain version of every stage."""

import hashlib
from collections import Counter, defaultdict

import duckdb

import corpus_pipeline as P
from casestar.llm import lookup_sharding as L
from casestar.llm.oracle import SQL
from casestar.llm.order_minhash import SIMILARITY
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_mixing import fill
from tests.llm.test_order_minhash import WORD, similarity


def near_groups(texts):
    """doc_id -> smallest doc_id of its group; only pairs that share enough words are aligned."""
    seqs = {i: WORD.findall(t or "") for i, t in texts.items()}
    bags, parent = {i: Counter(s) for i, s in seqs.items()}, {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and seqs[a] and seqs[b]:
                shared = sum((bags[a] & bags[b]).values())
                if 2 * shared >= SIMILARITY * (len(seqs[a]) + len(seqs[b])) and (
                        seqs[a] == seqs[b] or similarity(seqs[a], seqs[b]) >= SIMILARITY - 1e-9):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_rows(spark, small_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small_dir}/documents.parquet')")
    good = {r[0] for r in con.sql(f"SELECT doc_id FROM ({SQL['op1_quality_rules']}) WHERE kept").fetchall()}
    docs = {r[0]: r for r in con.sql("SELECT doc_id, text, lang, source, n_chars FROM documents").fetchall()}
    groups = near_groups({i: docs[i][1] for i in good})
    items = con.sql(f"SELECT item_id, text FROM read_parquet('{small_dir}/benchmark.parquet')").fetchall()
    kept = set()
    for i in {g for i, g in groups.items()}:
        n, hit, _, _ = contamination(docs[i][1], items)
        if not (hit and 20 * hit >= n):
            kept.add(i)

    out = P.run(spark, small_dir)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"]
    rows = out.collect()
    assert {r.doc_id for r in rows} <= kept
    sizes, taken = defaultdict(int), defaultdict(int)
    for i in kept:
        sizes[docs[i][3]] += len(docs[i][1].split())
    per_doc = defaultdict(int)
    slots = L.fill_table(L.shard_names())
    for r in rows:
        n = len(r.text.split())
        taken[r.source] += n
        per_doc[r.doc_id] += n
        assert (r.lang, r.source, r.n_chars) == (docs[r.doc_id][2], docs[r.doc_id][3], len(r.text))
        assert r.shard == slots[int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % L.TABLE_SIZE]
        whole = " ".join(docs[r.doc_id][1].split())
        assert all(" ".join(p.split()) in whole for p in (r.text.split("\n") if r.text != docs[r.doc_id][1] else []))
    target = fill(dict(sizes))
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert all(n <= 2 * len(docs[i][1].split()) for i, n in per_doc.items())


def test_stages():
    assert [name for name, _ in P.STAGES] == ["quality_rules", "near_dedup", "decontamination", "mixing", "sharding"]


def test_odd_rows_go_through_every_stage(spark, small_dir, odd_docs, no_docs):
    """Each stage alone, on rows with nulls, blanks and repeats, and on none."""
    for name, stage in P.STAGES:
        for docs in (odd_docs, no_docs):
            out = stage(spark, docs, small_dir)
            assert out.columns == docs.columns + ["shard"] * (name == "sharding")
            out.collect()
