"""Window-only interpolation vs. a direct per-series computation."""

import bisect
import datetime as dt
import random

from casestar.operators import series as S


def brute(ys):
    """Piecewise-linear in row position; outer segments extended; floor 0."""
    known = [(float(i), float(y)) for i, y in enumerate(ys) if y is not None]
    if len(known) < 2:
        out, last = [], None
        for y in ys:
            last = float(y) if y is not None else last
            out.append(last)
        return out
    xs = [k[0] for k in known]
    res = []
    for i in range(len(ys)):
        j = min(max(bisect.bisect_left(xs, float(i)), 1), len(xs) - 1)
        (x0, y0), (x1, y1) = known[j - 1], known[j]
        res.append(max((y1 - y0) / (x1 - x0) * (i - x0) + y0, 0.0))
    return res


def test_interpolation_matches_bruteforce(spark):
    rnd = random.Random(11)
    rows, expected = [], {}
    for k in range(80):
        n = rnd.randint(1, 25)
        p = rnd.choice([0.1, 0.4, 0.8])
        ys = [rnd.randint(0, 500) if rnd.random() < p else None for _ in range(n)]
        expected[k] = brute(ys)
        rows += [(k, dt.date(2021, 1, 1) + dt.timedelta(days=3 * i), y) for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "k int, d date, y bigint")
    got = {}
    for r in S.interpolate(df, "k", "d", "y", "z").orderBy("k", "d").collect():
        got.setdefault(r.k, []).append(r.z)
    assert got == expected
