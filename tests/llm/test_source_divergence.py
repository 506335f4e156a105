from collections import Counter
from random import Random

import numpy as np
import pytest

from casestar.llm import source_divergence as S

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def terms_of(text):
    out, word = [], ""
    for ch in (text or "") + " ":
        if "A" <= ch <= "Z" or "a" <= ch <= "z" or ord(ch) >= 0x80:
            word += ch.lower() if ch < "\x80" else ch
        elif word:
            out.append(word)
            word = ""
    return out


def plain(rows, top=S.TOP_TERMS):
    """The contract word by word, with whole numbers of any size."""
    docs = [(lang or "", source or "", terms_of(text)) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= 3)
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= 3) for s in {d[1] for d in mine}}
        whole = sum(counts.values(), Counter())

        def p(c, t):
            return 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        def f(a, b):
            return (a - b) ** 2 // b

        for s, c in counts.items():
            pairs = [(o, sum(f(p(c, t), p(counts[o], t)) for t in kept)) for o in counts if o != s]
            terms = [(t, f(p(c, t), p(whole, t))) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                order = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, r) for r, (i, v) in enumerate(order, 1) if part == "pair" or r <= top}
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_definition(spark, seed):
    rng = Random(seed)
    words = [f"{a}{b}" for a in "aBéz" for b in "xyZü"] + ["the"] * 20
    rows = [(rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None, "é"]),
             rng.choice([None, ""] + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) + "!7_"] * 6))
            for _ in range(150)]
    rows += [("xx", "only", "lonely words"), ("yy", "p", "q"), ("yy", "r", None)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert rows_of(S.divergence_report(df)) == plain(rows)
    assert rows_of(S.divergence_report(df, top=2)) == plain(rows, 2)


def test_many_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_POSTINGS", 40)
    monkeypatch.setattr(S, "ROWS", 2)
    monkeypatch.setattr(S, "FLUSH", 10)
    monkeypatch.setattr(S, "PAIRS", 5)
    rng = Random(5)
    rows = [("en", f"s{rng.randint(0, 6)}", " ".join(f"w{chr(97 + rng.randint(0, 25))}" for _ in range(12))) for _ in range(120)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert rows_of(S.divergence_report(df)) == plain(rows)


def test_accumulator_equals_the_full_table():
    rng = np.random.default_rng(3)
    groups, terms = 5, 30
    full = rng.integers(0, 2, (groups, terms)) * rng.integers(1, 9, (groups, terms)) * 10 ** 6
    p0 = rng.integers(1, 1000, groups)
    p = np.where(full > 0, full, p0[:, None])
    g, t = np.nonzero(full)
    term = np.unique(t, return_inverse=True)[1]
    want = [[sum((int(p[i, x]) - int(p[j, x])) ** 2 // int(p[j, x]) for x in set(t)) for j in range(groups)] for i in range(groups)]
    assert S.accumulate(term, g, full[g, t], p0, range(groups)).tolist() == want


def test_counts_beyond_a_long_product(spark):
    """10**9 times a count of 10**11 does not fit a long."""
    df = spark.createDataFrame([(10 ** 11, 10 ** 12, 5)], "n long, total long, terms long")
    got = df.select(S.share("n", "total", "terms").alias("p")).first().p
    assert got == 1 + 10 ** 9 * (10 ** 11 + 1) // (10 ** 12 + 5)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = [(r.lang, r.source, r.text) for r in odd_docs.collect()]
    assert rows_of(S.divergence_report(odd_docs)) == plain(rows)
    assert S.divergence_report(no_docs).collect() == []
