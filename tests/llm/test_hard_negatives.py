import math
from random import Random

import numpy as np
import pytest
from pyspark.sql import Row

from casestar.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def plain(rows, positives=5, negatives=3):
    """Every anchor against every row."""
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        c = tuple(math.floor(256 * float(np.float32(x))) for x in vector)
        row = (vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label, c)
        if row not in kept:
            kept.append(row)
    out = []

    def first(row):
        return -row[0], row[1] is None, row[1] or 0

    for a in kept:
        if a[0] is None or a[0] % 50:
            continue
        scored = [(sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in kept if r is not a]
        for ps, positive, _ in sorted((s for s in scored if s[2] == a[1]), key=first)[:positives]:
            window = sorted((s for s in scored if s[2] != a[1] and 50 * ps <= 100 * s[0] <= 95 * ps), key=first)
            out += [(a[0], positive, k, n, ps, ns) for k, (ns, n, _) in enumerate(window[:negatives], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, H.hard_negatives(df).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([Row(*r, "x") for r in rows], SCHEMA)


@pytest.mark.parametrize("seed, sample", [(1, H.SAMPLE), (2, 64 * 8)])
def test_equals_all_pairs(spark, monkeypatch, seed, sample):
    monkeypatch.setattr(H, "SAMPLE", sample)
    monkeypatch.setattr(H, "COMPONENTS", 8 * 4)       # several blocks of anchors
    monkeypatch.setattr(H, "HELD", 50)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(700):
        v = centres[i % 6] + rng.normal(size=8) * 0.6
        rows.append((i * 5, [float(x) for x in v / np.linalg.norm(v)], int(rng.choice([0, 0, 0, 1, 2, 9]))))
    assert found(table(spark, rows)) == plain(rows)


def test_odd_rows(spark):
    rng = Random(3)
    rows = [(i, [rng.choice([0.0, 0.5, 1.0, -0.25]) for _ in range(3)], i % 2) for i in range(120)]     # many ties
    rows += [(150, [1.0, 0.5, 0.5], None), (200, None, 1), (250, [1.0, None, 1.0], 1), (300, [float("nan")] * 3, 1),
             (350, [float("inf"), 0.0, 0.0], 1), (None, [1.0, 1.0, 1.0], 0), (400, [], 1), (450, [0.5], 1),
             (100, [1.0, 0.25, 0.0], 1), (100, [1.0, 0.25, 0.0], 1), (50, [0.5, 0.0, 1.0], 4), (500, [-1.0] * 3, 3)]
    assert found(table(spark, rows)) == plain(rows)


def test_large_components_stay_exact(spark):
    rng = Random(4)
    rows = [(i * 10, [rng.uniform(0.5, 1) * 2 ** 20 for _ in range(4)], i % 3) for i in range(60)]
    assert found(table(spark, rows)) == plain(rows)


def test_empty(spark):
    df = table(spark, [(1, [1.0], 1)])
    assert H.hard_negatives(df).collect() == []
    assert H.hard_negatives(df.limit(0)).collect() == []


def test_index_omits_what_cannot_reach_the_threshold():
    rng = np.random.default_rng(6)
    comps = rng.integers(-200, 200, (20, 16))
    norm, least = 300.0, rng.integers(1, 100_000, 20)
    mask = H.indexed(comps, least, norm)
    assert not mask.all() and mask.any()
    rest = np.sqrt((np.where(mask, 0, comps) ** 2).sum(axis=1)) * norm
    assert (rest < least).all()
