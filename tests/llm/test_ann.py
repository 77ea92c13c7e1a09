from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_topk import edge_vectors, slow

from postlake.llm import ann
from postlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def usable(rows):
    width = 2  # the most frequent
    return [(i, v) for i, v in rows if i is not None and v and len(v) == width and all(x is not None and np.isfinite(x) for x in v) and any(v)]


def test_edge_cases(spark):
    rows, frame = edge_vectors(spark)
    got = ann.search(frame, F.col("vec_id") % 2 == 0, k=20).collect()
    f32 = [(i, [float(np.float32(x)) for x in v]) for i, v in usable(rows)]
    want = slow(f32, lambda q: q % 2 == 0, 20)
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(got)] == [w[:3] for w in want]  # all candidates, being few
    assert [r.score for r in sorted(got)] == pytest.approx([w[3] for w in want])


def test_empty_table_and_no_queries(spark):
    _, frame = edge_vectors(spark)
    assert ann.search(frame.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    assert ann.search(frame, F.lit(False)).count() == 0


def test_every_row_descends_to_the_leaf_of_its_nearest_centres():
    r = np.random.default_rng(0)
    x = r.normal(size=(600, 5))
    tree = ann.grow(x, float(np.linalg.norm(x, axis=1).max()), leaf_rows=20)
    lifted = tree.lift(x)
    for i, leaf in enumerate(tree.assign(x)):
        node = 0
        while tree.leaf[node] < 0:
            kids = np.arange(tree.first[node], tree.first[node] + tree.count[node])
            node = kids[((tree.centre[kids] - lifted[i]) ** 2).sum(axis=1).argmin()]
        assert tree.leaf[node] == leaf


def test_visits_open_the_nearest_node_first_and_reach_every_leaf():
    r = np.random.default_rng(1)
    x = r.normal(size=(500, 4))
    tree = ann.grow(x, 5.0, leaf_rows=20)
    q = r.normal(size=4)
    order = tree.visits(q, tree.leaves)
    assert sorted(order) == list(range(tree.leaves))
    gap = lambda node: ((tree.centre[node] - np.append(q, 0)) ** 2).sum()
    queue, want = [0], []
    while queue:
        node = min(queue, key=gap) if queue != [0] else 0
        queue.remove(node)
        if tree.leaf[node] >= 0:
            want.append(tree.leaf[node])
        else:
            queue += range(tree.first[node], tree.first[node] + tree.count[node])
    assert order.tolist() == want


def test_copies_of_one_point_make_one_leaf():
    tree = ann.grow(np.ones((300, 3)), 3**0.5, leaf_rows=10)
    assert tree.leaves == 1 and set(tree.assign(np.ones((5, 3)))) == {0}


def test_lifting_turns_inner_products_into_distances():
    r = np.random.default_rng(2)
    x = r.normal(size=(50, 3)) * r.random((50, 1)) * 4
    tree = ann.grow(x, float(np.linalg.norm(x, axis=1).max()))
    q = r.normal(size=3)
    d = ((tree.lift(x) - np.append(q, 0)) ** 2).sum(axis=1)
    assert (np.argsort(d) == np.argsort(-(x @ q))).all()


def test_recall_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows])
    got = {}
    for r in QUERIES["op5_nearest"](spark, SF).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    assert set(got) == set(ids[ids % 20 == 0])
    for q, found in got.items():
        found.sort()
        s = x @ x[ids == q][0]
        assert [f[0] for f in found] == list(range(1, 21))
        assert [f[2] for f in found] == pytest.approx([float(s[ids == f[1]][0]) for f in found], abs=1e-12)
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        s[ids == q] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -s))[:20]]) & {f[1] for f in found})
        total += 20
    assert hits / total >= 0.9


LARGE = "/root/testdata/check_l/embeddings.parquet"


@pytest.mark.skipif(not Path(LARGE).exists(), reason="the check tool's tables are not here")
def test_recall_on_a_large_table_for_queries_not_calibrated_on(spark):
    """Over 50,000 rows: the tree is fitted on a sample, the visits on other queries."""
    frame = spark.read.parquet(LARGE)
    rows = frame.select("vec_id", "embedding").toPandas()
    ids = rows["vec_id"].to_numpy()
    x = np.array(rows["embedding"].tolist(), float)
    report = {}
    found = ann.search(frame, F.col("vec_id") % 20 == 0, report=report).toPandas().groupby("query_id")["vec_id"].agg(set)
    asked = np.array(sorted(set(found.index) - set(report["calibrated_on"])))
    at = {i: n for n, i in enumerate(ids)}
    hits = 0
    for part in np.array_split(asked, 20):
        scores = x[[at[i] for i in part]] @ x.T
        for q, s in zip(part, scores):
            s[ids == q] = -np.inf
            near = np.argpartition(-s, 60)[:60]
            hits += len(set(ids[near[np.lexsort((ids[near], -s[near].round(12)))][:20]]) & found[q])
    assert len(ids) > 50_000 and len(asked) > 2_000
    assert hits / (20 * len(asked)) >= 0.9


def test_copies_score_alike_wherever_they_stand():
    r = np.random.default_rng(6)
    x, q = r.normal(size=(997, 64)), r.normal(size=64)
    same = r.choice(997, 400, replace=False)
    x[same] = q  # the best of all, in many places
    ids = r.permutation(997)
    score, found = ann.best_exact(q, x, ann._dot(q[None], x)[0], ids, -1, 20, 1e-10)
    assert len(set(score.tolist())) == 1
    assert found.tolist() == sorted(ids[same].tolist())[:20]


def test_widening_reaches_the_recall_asked_for(spark):
    report = {}
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    ann.search(frame, F.col("vec_id") % 20 == 0, target=0.95, report=report)
    assert report["recall"] >= 0.95 and report["rows"] == 2000


def test_small_leaves_give_way_to_more_until_k_are_found(spark, monkeypatch):
    """Where calibration, having seen copies only, has one leaf visited."""
    r = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate(r.normal(size=(300, 8)))] + [(1_000, v) for v in r.normal(size=(25, 8))] + [(1_020, r.normal(size=8))] * 25
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    grow = ann.grow
    monkeypatch.setattr(ann, "grow", lambda sample, longest: grow(sample, longest, leaf_rows=10))
    monkeypatch.setattr(ann, "calibrate", lambda index, *_: ann.Index(index.tree, np.empty(0), np.array([1]), 1.0))
    found = ann.search(frame, F.col("vec_id") % 20 == 0, k=20).groupBy("query_id").count().collect()
    assert {x["query_id"]: x["count"] for x in found} == {i: 20 * (25 if i >= 1_000 else 1) for i, _ in rows if i % 20 == 0}
