import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_data import EDGE_ROWS, SF, edge_docs, no_docs, prose
from pyspark.sql import functions as F

from postlake.llm import simhash
from postlake.llm.components import star_components
from postlake.llm.queries import QUERIES


def slow_print(text, words=3):
    """The fingerprint by its definition."""
    lower = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    w = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def slow_components(rows, distance=3):
    """{row number: smallest key reachable} over all pairs of rows."""
    prints = [slow_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    low = {g: min((k for k in keys if k is not None), default=None) for g, keys in groups.items()}
    return [(rows[i][0], prints[i], low[find(i)]) for i in range(len(rows))]


@pytest.mark.parametrize("text", [None, "", " \t", "a", "A b", "A b C", "a b c d e", "é \x85 Ü\x0bX y", "Q " * 400 + "r", prose(5, 300)])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == slow_print(text)


def test_word_blocks_cut_at_white_space():
    data = prose(6, 500).encode()
    blocks = list(simhash._word_blocks(data, most=50))
    assert len(blocks) > 10 and [w for b in blocks for w in b] == data.split()


def near_prints(seed, centres, most):
    r = np.random.default_rng(seed)
    out = []
    for c in r.integers(0, 1 << 63, centres, dtype=np.uint64):
        for _ in range(r.integers(1, most)):
            x = int(c)
            for k in r.integers(0, 64, r.integers(0, 4)):
                x ^= 1 << int(k)
            out.append(x)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
def test_forest_finds_what_brute_force_finds(radius):
    p = near_prints(1, 60, 12)
    g = np.random.default_rng(2).integers(0, 4, len(p))
    q, m = simhash.Forest(g, p).search(g, p, radius)
    want = (np.bitwise_count(p[:, None] ^ p[None]) <= radius) & (g[:, None] == g[None])
    got = np.zeros_like(want)
    got[q, m] = True
    assert (got == want).all() and len(q) == want.sum()


@pytest.mark.parametrize("tree_rows,task_rows", [(8192, 50_000), (5, 40), (1, 10)])
@pytest.mark.parametrize("distance", [2, 3])
def test_links_connect_like_all_pairs(spark, tree_rows, task_rows, distance):
    """Also where trees are refined and split: one block of all prints is equal."""
    p = near_prints(3, 25, 10)
    p = np.unique(p & ~np.uint64(0xFFFFF) if tree_rows < 100 else p)
    frame = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "fp long")
    stars = star_components(simhash.link(frame, distance, tree_rows, task_rows)).collect()
    low = {int(x): int(x) for x in p.view(np.int64)} | {r.u: r.v for r in stars}
    u, v = np.nonzero(np.bitwise_count(p[:, None] ^ p[None]) <= distance)
    label = simhash.join_labels(np.arange(len(p)), u, v)
    classes = {}
    for x, c in zip(p.view(np.int64).tolist(), label.tolist()):
        classes.setdefault(c, set()).add(x)
    got = {}
    for x, r in low.items():
        got.setdefault(r, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, classes.values()))


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(500, 500)]
    got = {r.u: r.v for r in star_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}


def test_edge_cases(spark):
    got = simhash.near_duplicates(edge_docs(spark)).collect()
    want = slow_components([(k, t) for k, t, _ in EDGE_ROWS])
    as_rows = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str)
    assert as_rows == sorted(want, key=str)


def test_empty_table(spark):
    assert simhash.near_duplicates(no_docs(spark)).count() == 0
    assert simhash.keep_one(no_docs(spark)).count() == 0


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in QUERIES["op10_simhash"](spark, SF).collect())
    assert got == sorted(slow_components(docs))


def test_keep_one_keeps_columns_and_smallest_keys(spark):
    docs = edge_docs(spark)
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    keys = [r.doc_id for r in got.collect()]
    want = {low for _, _, low in slow_components([(k, t) for k, t, _ in EDGE_ROWS]) if low is not None}
    assert sorted(k for k in keys if k is not None) == sorted(want)
    assert keys.count(None) == 2  # rows without a key stay


def test_keep_one_keeps_a_row_of_each_component(spark):
    """Also where a key is on many texts that link to nothing, or is null."""
    rows = [(3, prose(20, 60)), (7, prose(21, 60)), (7, prose(20, 60)), (7, prose(21, 60))]
    rows += [(9, prose(s, 60)) for s in range(30, 50)]
    rows += [(None, prose(21, 60)), (None, prose(22, 60)), (None, prose(22, 60)), (None, prose(23, 60))]
    found = slow_components(rows)
    assert len({fp for _, fp, _ in found}) == 24
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = [rows[0], rows[1], *rows[4:24], rows[25], rows[27]]
    got = [tuple(r) for r in simhash.keep_one(frame, keyless_stay=False).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    got = [tuple(r) for r in simhash.keep_one(frame).collect()]
    assert sorted(got, key=str) == sorted([*want[:22], *rows[24:]], key=str)


def test_stars_do_not_grow_with_pairs():
    n = 400
    p = np.unique(np.array([1 << i | 1 << j for i in range(40) for j in range(i)][:n], np.uint64))
    t = pa.table({"tree": np.zeros(len(p), np.int64), "a": np.zeros(len(p), np.int32), "b": np.zeros(len(p), np.int32), "part": np.zeros(len(p), np.int32), "fp": p.view(np.int64)})
    assert simhash._links(4)(t).num_rows == len(p) - 1


def test_distance_is_bounded(spark):
    with pytest.raises(ValueError):
        simhash.link(spark.range(1).select(F.col("id").alias("fp")), 16)
