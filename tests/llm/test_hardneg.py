import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import hardneg
from postlake.llm.queries import QUERIES, table


def slow(rows, asks, positives=5, k=5, low=80, high=100, scale=256):
    """Every pair, in plain Python integers."""
    ok = [(i, y, [math.floor(scale * x) for x in v]) for i, y, v in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, y, av in ok:
        if asks(a):
            all_ = sorted((-sum(p * q for p, q in zip(av, v)), i, z) for i, z, v in ok if i != a and len(v) == len(av))
            for s, p, _ in [x for x in all_ if x[2] == y][:positives]:
                band = [(-n, i) for n, i, z in all_ if z != y and low * -s <= 100 * -n <= high * -s][:k]
                out += [(a, p, r, i, -s, n) for r, (n, i) in enumerate(band, 1)]
    return sorted(out, key=repr)


def fast(spark, rows, asks=None, **kw):
    asks = F.col("vec_id") % 3 == 0 if asks is None else asks
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    return sorted((tuple(r) for r in hardneg.mine(df, asks, F.col("label"), **kw).collect()), key=repr)


def vectors(seed, n, d, spread=0.3, labels=4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(labels, d))
    kinds = r.integers(0, labels, n)
    x = centres[kinds] * 0.5 + r.normal(size=(n, d)) * spread
    return [(int(i), int(y), [float(c) for c in v]) for i, y, v in zip(r.permutation(n), kinds, x)]


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_and_tighten(seed):
    r = np.random.default_rng(seed)
    a, v = (hardneg.Summary(np.floor(256 * r.normal(size=(n, 40)))) for n in (20, 50))
    exact, before = a.rows @ v.rows.T, None
    for level in range(len(a.levels)):
        low, high = hardneg.bounds(a, v, level)
        assert (low <= exact).all() and (exact <= high).all()
        if before is not None:
            assert (high - low <= before + 1e-3).all()
        before = high - low
    assert len(a.levels) == 3


def test_bounds_drop_pairs_before_they_are_scored(monkeypatch):
    r = np.random.default_rng(2)
    steps = np.repeat(r.normal(size=(400, 4)), 16, axis=1) * 200  # constant within segments
    a, v = hardneg.Summary(np.floor(steps[:20])), hardneg.Summary(np.floor(steps))
    alive = []
    real = hardneg.scores
    monkeypatch.setattr(hardneg, "scores", lambda a, v, on: alive.append(on.mean()) or real(a, v, on))
    found = hardneg.find_positives(a, np.arange(20), v, np.arange(400), 5)
    exact = (a.rows @ v.rows.T)
    for i, at, s in found:
        order = [j for j in np.lexsort((np.arange(400), -exact[i])) if j != i][:5]
        assert at.tolist() == order and s.tolist() == exact[i, order].tolist()
    given = np.array([s for _, _, s in found])
    hardneg.find_negatives(a, given, v, np.arange(400), np.ones((20, 400), bool), 5, 80, 100)
    assert alive[0] < 0.1 and alive[1] < 0.25


@pytest.mark.parametrize("seed,d", [(1, 16), (2, 3), (3, 24)])
def test_equals_brute_force(spark, seed, d):
    rows = vectors(seed, 150, d)
    want = slow(rows, lambda i: i % 3 == 0)
    assert want and fast(spark, rows) == want
    assert fast(spark, rows, block_rows=20, anchor_rows=7, together=2) == want


def test_ties_copies_and_repeated_ids(spark):
    v = [0.5, 0.25, 0.125, 0.5]
    rows = [(i, i % 2, v) for i in range(30)] + [(3, 0, v), (4, 1, v), (60, 0, [0.4, 0.25, 0.125, 0.5]), (60, 0, [0.4, 0.25, 0.125, 0.5])]
    got = fast(spark, rows, F.col("vec_id").isin(0, 60), block_rows=8)
    assert got == slow(rows, lambda i: i in (0, 60))


def test_nulls_widths_and_large_components(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(7, 40, 8) + [(None, 1, [0.1] * 8), (900, None, [0.1] * 8), (901, 1, None), (902, 1, [0.1] * 7 + [None]), (903, 1, [nan] * 8), (904, 1, [inf] * 8)]
    rows += [(905, 1, []), (906, 1, []), (907, 2, []), (909, 1, [0.2] * 3), (910, 2, [0.2] * 3), (912, 1, [0.2] * 3)]
    rows += [(1000 + i, i % 2, [3e4 + i / 3, -2e4, 1e3 + 7 * i]) for i in range(10)]
    want = slow(rows, lambda i: i % 3 == 0)
    assert fast(spark, rows) == want and {909, 912} & {r[0] for r in want}
    huge = fast(spark, [(i, i % 2, [1e12, 1e13 + i]) for i in range(6)]) + fast(spark, [(i, i % 2, [1e100 * (1 + i)]) for i in range(6)])
    assert huge and any(r[-1] is None for r in huge)


def test_extra_columns_and_empty_tables(spark):
    df = spark.createDataFrame(vectors(8, 30, 4), "vec_id long, label int, embedding array<double>").selectExpr("*", "1 as block", "'x' as asker", "2 as row", "3 as place", "4 as width")
    got = hardneg.mine(df, F.col("vec_id") < 5, F.col("label"))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and got.count()
    assert hardneg.mine(df, F.lit(False), F.col("label")).count() == 0
    assert hardneg.mine(df.limit(0), F.col("vec_id") < 5, F.col("label")).count() == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    assert sorted((tuple(r) for r in QUERIES["op12_hard_negatives"](spark, sf).collect()), key=repr) == slow(rows, lambda i: i % 100 == 0)
