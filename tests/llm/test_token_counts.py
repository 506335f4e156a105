import math

from casestar.llm import token_counts as C

VOCAB = {b"a": -3, b"b": -3, b"ab": -5, b"ba": -5, b"aba": -7, b" a": -4, b" ": -8, b"\xc3": -9, b"\xa9": -9, b"\xc3\xa9": -6}


def brute(token, scores):
    best = [(0, 0)] + [None] * len(token)
    for end in range(1, len(token) + 1):
        best[end] = max((best[s][0] + scores[token[s:end]], best[s][1] - 1)
                        for s in range(end) if best[s] is not None and token[s:end] in scores)
    return -best[-1][1]


def test_trie_matches_plain_dynamic_programming():
    trie = C.Trie(VOCAB)
    tokens = [b"a", b"ab", b"aba", b"abab", b"babab" * 9, b" abba", b"\xc3\xa9a", b"ab" * 200, b"a" * 300]
    for t in [*tokens, *reversed(tokens)]:
        assert trie.count(t) == brute(t, VOCAB)


def test_prefixes_are_worked_out_once():
    trie = C.Trie(VOCAB)
    trie.count(b"abab")
    before = len(trie.best)
    trie.count(b"ababa")
    trie.count(b"aba")
    assert len(trie.best) == before + 1


def test_trie_is_bounded(monkeypatch):
    monkeypatch.setattr(C, "MAX_NODES", 10)
    trie = C.Trie(VOCAB)
    for n in range(1, 40):
        assert trie.count(b"ab" * n) == brute(b"ab" * n, VOCAB)
        assert len(trie.best) <= 10 + C.LONG + 1


def test_documents_against_brute_force(spark, small_dir):
    scores = C.load_vocabulary()
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").limit(40).collect()
    df = spark.createDataFrame([(r.doc_id, r.text) for r in docs], "doc_id long, text string")
    got = {r.doc_id: r for r in C.token_report(df).collect()}
    longest = max(map(len, scores))
    memo = {}
    for r in docs[:15]:
        n = 0
        for p in C.pre_tokens(r.text):
            raw = p.encode()
            if raw not in memo:
                best = [(0, 0)]
                for end in range(1, len(raw) + 1):
                    best.append(max((best[s][0] + scores[raw[s:end]], best[s][1] - 1)
                                    for s in range(max(0, end - longest), end) if raw[s:end] in scores))
                memo[raw] = -best[-1][1]
            n += memo[raw]
        assert got[r.doc_id].n_tokens == n and got[r.doc_id].n_bytes == len(r.text.encode())


def test_scores_follow_the_rank():
    v = C.read_vocabulary(["YQ== 0", "YWI= 1"])
    assert len(v) == 257 and v[b"a"] > v[b"ab"] > v[b"z"]
    assert math.isclose(v[b"a"] - v[b"ab"], C.SCALE * math.log(1.5), abs_tol=1)


def test_odd_rows(odd_docs, no_docs):
    out = C.token_report(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert all(r.n_tokens == 0 for r in out if r.doc_id in (1, 2))
    assert C.token_report(no_docs).collect() == []
