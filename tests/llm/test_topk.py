import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import topk


def slow(rows, asks, k, scale=None):
    """Every pair, in plain Python."""
    ok = [(i, [math.floor(x * scale) if scale else x for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in ok:
        if asks(q):
            best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(25))
def test_threshold_search_equals_brute_force(seed):
    r = np.random.default_rng(seed)
    for _ in range(12):
        n, d, k = int(r.integers(1, 60)), int(r.integers(1, 6)), int(r.integers(1, 6))
        rows = r.integers(-2, 3, (n, d)).astype(float) if seed % 2 else r.normal(size=(n, d))
        ids, q = r.permutation(n), r.integers(-2, 3, d).astype(float) if seed % 2 else r.normal(size=d)
        got_i, got_s = topk.threshold_search(topk.Lists(rows), ids, q, 0, k, step=1)
        s, ok = rows @ q, ids != 0
        order = np.lexsort((ids[ok], -s[ok]))[:k]
        assert got_i.tolist() == ids[ok][order].tolist() and np.allclose(got_s, s[ok][order])


def test_it_stops_before_the_lists_end():
    r = np.random.default_rng(3)
    rows = r.normal(0, 0.01, (5_000, 4))
    rows[:5] = 10 - np.arange(5)[:, None]
    lists = topk.Lists(rows)
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple) and isinstance(key[1], slice):
                read.append(key[1].stop)
            return super().__getitem__(key)

    lists.order = lists.order.view(Watched)
    ids, _ = topk.threshold_search(lists, np.arange(5_000), np.ones(4), -1, 3)
    assert ids.tolist() == [0, 1, 2] and len(read) <= 2


def test_large_whole_numbers_stay_exact():
    rows = np.array([[2.0**26, 1.0], [2.0**26, 0.0], [1.0, 1.0]])
    ids, s = topk.threshold_search(topk.Lists(rows), np.arange(3), np.array([1.0, 1.0]), -1, 3)
    assert ids.tolist() == [0, 1, 2] and s.tolist() == [2.0**26 + 1, 2.0**26, 2.0]


def edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (8, []),
            (7, [1.0]), (None, [1.0, 1.0]), (10, [0.0, 0.0]), (12, [-0.1, 0.9]), (14, [1e-9, -1e-9]), (50, [0.3, 0.3])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "'r' as row", "'b' as block", "0 as asks", "5 as width", "'s' as score")


@pytest.mark.parametrize("block_rows,query_rows", [(100, 100), (2, 1)])
@pytest.mark.parametrize("scale", [256, None])
def test_edge_cases(spark, block_rows, query_rows, scale):
    rows, frame = edge_vectors(spark)
    got = topk.top_k(frame, F.col("vec_id") % 2 == 0, k=3, scale=scale, block_rows=block_rows, query_rows=query_rows)
    f32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = slow(f32, lambda q: q % 2 == 0, 3, scale)
    rows = sorted(tuple(r) for r in got.collect())
    assert [r[:3] for r in rows] == [w[:3] for w in want]
    assert [r[3] for r in rows] == pytest.approx([w[3] for w in want], abs=1e-15)


def test_empty_table_and_no_queries(spark):
    _, frame = edge_vectors(spark)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    assert topk.top_k(frame, F.lit(False)).count() == 0
