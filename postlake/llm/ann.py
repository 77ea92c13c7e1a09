"""Approximate nearest neighbours: a hierarchical k-means tree, best bin first.

The tree is fitted in numpy on a bounded sample and every row is indexed by the
leaf it descends to. A query walks the tree with a priority queue of the nodes
not yet opened, nearest centre first, and so ranks the leaves it would visit.
How many it visits is calibrated: a bounded sample of queries is answered by
brute force over all rows, and the visits are widened, separately for queries
that lie near their first leaf and far from it, until the recall asked for is
reached. A query whose leaves hold fewer than ``k`` candidates goes on until they
do. Neighbouring leaves lie together in blocks of bounded size; queries
travel to the blocks of the leaves they visit and are scored there, leaf by
leaf, against those leaves' rows. A block gives a query's best ``k`` at most.

The largest inner product is the smallest distance once each row gets one more
component that brings its length to that of the longest row (and a query a
zero), which is how the tree measures.

Edge cases: vectors that are null, zero or hold a null or non-finite component,
those not of the most frequent length, and rows with a null id, take no part. A
query's own row (same id) is no candidate. Rows that repeat an id are candidates
each, and queries each. Copies of a vector score alike to the last digit. With fewer rows than ``k`` + 1 all are returned. An empty table, or one
without queries, gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_hash, drop, materialise
from .topk import usable


@dataclass
class Tree:
    """Nodes in arrays; children of node i are ``first[i]`` to ``first[i] + count[i] - 1``."""

    centre: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray  # number of the leaf, -1 for inner nodes
    longest: float  # length of the longest row of the table

    def __post_init__(self):
        self.nodes = np.argsort(np.where(self.leaf < 0, len(self.leaf), self.leaf), kind="stable")  # leaves first

    def node_of(self, leaf: int) -> int:
        return int(self.nodes[leaf])

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def lift(self, rows: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (rows**2).sum(axis=1), 0)
        return np.hstack([rows, np.sqrt(rest)[:, None]])

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """Leaf that each row descends to, nearest centre by nearest centre."""
        x, out = self.lift(rows), np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, who = todo.pop()
            if self.leaf[node] >= 0:
                out[who] = self.leaf[node]
                continue
            a, n = self.first[node], self.count[node]
            near = _nearest(x[who], self.centre[a : a + n])
            todo += [(a + c, part) for c in range(n) if len(part := who[near == c])]
        return out

    def visits(self, query: np.ndarray, most: int, held: np.ndarray | None = None, k: int = 0) -> np.ndarray:
        """The first ``most`` leaves, best bin first, and more until those
        visited hold ``k`` by ``held``, the number of each leaf."""
        q = np.append(query, 0.0)
        queue, out = [(0.0, 0)], []
        while queue and (len(out) < most or k > 0):
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(int(self.leaf[node]))
                k -= 0 if held is None else int(held[out[-1]])
                continue
            a, n = int(self.first[node]), int(self.count[node])
            gap = ((self.centre[a : a + n] - q) ** 2).sum(axis=1)
            for c, d in enumerate(gap.tolist()):
                heapq.heappush(queue, (d, a + c))
        return np.array(out, np.int64)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = _nearest(x, centres)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres, _nearest(x, centres)


def grow(sample: np.ndarray, longest: float, branching: int = 8, leaf_rows: int = 128, seed: int = 3) -> Tree:
    """Split the sample by k-means until a node holds at most ``leaf_rows`` of it."""
    rng = np.random.default_rng(seed)
    tree = Tree(np.zeros((1, sample.shape[1] + 1)), np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, -1), longest)
    x = tree.lift(sample)
    centre, first, count, leaf = [x.mean(axis=0) if len(x) else tree.centre[0]], [0], [0], [-1]
    todo, leaves = [(0, np.arange(len(x)))], 0
    while todo:
        node, who = todo.pop()  # depth first: neighbouring leaves get neighbouring numbers
        centres = near = None
        if len(who) > leaf_rows:
            centres, near = _kmeans(x[who], min(branching, len(who)), rng)
        if near is None or len(np.unique(near)) < 2:  # small enough, or copies of one point
            leaf[node] = leaves
            leaves += 1
            continue
        live = np.unique(near)
        first[node], count[node] = len(centre), len(live)
        for c in live:
            todo.append((len(centre), who[near == c]))
            centre.append(centres[c])
            first.append(0)
            count.append(0)
            leaf.append(-1)
    return Tree(np.stack(centre), *(np.array(v, np.int64) for v in (first, count, leaf)), longest)


def best_of(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest scores but of id ``own``, ties to smaller ids."""
    ok = ids != own
    scores, ids = scores[ok], ids[ok]
    if len(scores) > k:
        kth = -np.partition(-scores, k - 1)[k - 1]
        at = scores >= kth
        scores, ids = scores[at], ids[at]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _dot(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return queries @ rows.T


def best_exact(query: np.ndarray, rows: np.ndarray, about: np.ndarray, ids: np.ndarray, own: int, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """``best_of`` with each product summed in the same order, so that copies score
    alike. ``about`` has the scores to within ``slack``, and picks the rows to sum:
    the last digits of a matrix product depend on where in it a row stands."""
    ok = np.flatnonzero(ids != own)
    if len(ok) > k:
        kth = -np.partition(-about[ok], k - 1)[k - 1]
        ok = ok[about[ok] >= kth - slack]
    return best_of((rows[ok] * query).sum(axis=1), ids[ok], own, k)


@dataclass
class Index:
    tree: Tree
    bounds: np.ndarray  # of the first leaf's gap, between classes of queries
    visits: np.ndarray  # leaves to visit, for each class
    recall: float  # on the calibration queries
    held: np.ndarray | None = None  # candidates that each leaf has for any query, at least
    k: int = 0  # candidates that a query's leaves have to hold, if there are as many

    def leaves_of(self, query: np.ndarray) -> np.ndarray:
        first = self.tree.visits(query, 1)
        return self.tree.visits(query, int(self.visits[self._class(query, first)]), self.held, self.k)

    def _class(self, query: np.ndarray, first: np.ndarray) -> int:
        return int(np.searchsorted(self.bounds, self.gap(query, int(first[0]))))

    def gap(self, query: np.ndarray, leaf: int) -> float:
        """Squared distance of a query to the centre of a leaf, over the longest row's."""
        node = self.tree.node_of(leaf)
        q = np.append(query, 0.0)
        return float(((self.tree.centre[node] - q) ** 2).sum() / max(self.tree.longest**2, 1e-300))


def calibrate(index: Index, queries: np.ndarray, leaves_of_best: list[np.ndarray], target: float, classes: int = 4) -> Index:
    """Widen each class's visits until ``target`` of its queries' true neighbours
    lie in leaves visited. ``leaves_of_best`` has a leaf for each true neighbour."""
    if not len(queries):
        return Index(index.tree, np.empty(0), np.array([index.tree.leaves]), 1.0)
    order = [index.tree.visits(q, index.tree.leaves) for q in queries]
    gaps = np.array([index.gap(q, int(o[0])) for q, o in zip(queries, order)])
    bounds = np.unique(np.quantile(gaps, np.arange(1, classes) / classes))
    kind = np.searchsorted(bounds, gaps)
    visits, hit, total = [], 0, 0
    for c in range(len(bounds) + 1):
        # the place of the leaf of each true neighbour in its query's order
        need = [np.argsort(order[i])[leaves_of_best[i]] for i in np.flatnonzero(kind == c)]
        place = np.sort(np.concatenate(need)) if need else np.empty(0, np.int64)
        v = int(place[min(len(place) - 1, int(np.ceil(target * len(place))) - 1)]) + 1 if len(place) else index.tree.leaves
        visits.append(v)
        hit += int((place < v).sum())
        total += len(place)
    return Index(index.tree, bounds, np.array(visits), hit / max(total, 1))


def _best_of_each(parts: list[list[np.ndarray]], k: int) -> list[np.ndarray]:
    """Of rows (asker, id, score) the ``k`` best for each asker, ties to smaller ids."""
    query, other, score = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((other, -score, query))
    query, other, score = query[order], other[order], score[order]
    new = np.concatenate(([True], query[1:] != query[:-1])) if len(query) else np.empty(0, bool)
    begin = np.maximum.accumulate(np.where(new, np.arange(len(query)), 0)) if len(query) else np.empty(0, np.int64)
    first = np.arange(len(query)) - begin < k
    return [query[first], other[first], score[first]]


def _packed(t: pa.Table, names: list[str], more: dict[str, str]) -> pa.Table:
    """A group of rows as one row: ``names`` of the first, the vectors, and the
    columns ``more`` (name: numpy type), as bytes."""
    flat = t["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return pa.table({
        **{n: t[n][:1] for n in names},
        **{n: pa.array([t[n].to_numpy().astype(kind).tobytes()]) for n, kind in more.items()},
        "matrix": pa.array([flat.astype("<f8").tobytes()]),
    })


def _vectors(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(-1, width)


def search(vectors: DataFrame, queries: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding", target: float = 0.96,
           sample_rows: int = 16_000, most_sample_rows: int = 128_000, calibration: int = 200, block_rows: int = 16_384, query_rows: int = 512, together: int = 2, report: dict | None = None) -> DataFrame:
    """(query_id, rank, id, score): for each row that ``queries`` admits, the ``k``
    nearest found. The tree is fitted on ``sample_rows`` rows or, if that is more, 64
    times the root of the table's, up to ``most_sample_rows``: the leaves grow in
    number with the table and not only in size. The visits are fitted on about
    ``calibration`` queries; ``report`` gets the recall reached on those."""
    spark = vectors.sparkSession
    part = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    part = part.where(F.col("id").isNotNull() & usable(F.col("vector")))
    part = part.where(F.exists("vector", lambda x: x != 0))
    paths: list[str] = []
    rows = materialise(part.select("id", F.transform("vector", lambda x: x.cast("double")).alias("vector"), "asks", F.monotonically_increasing_id().alias("row")), "ann-rows", paths)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    widths = rows.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("longest"), F.sum(F.col("asks").cast("int")).alias("asked"))
    top = widths.orderBy(F.desc("n"), "width").limit(1).collect()
    if not top:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(id), F.lit(0.0).alias("score")).limit(0)
    width, n, longest, asked = top[0]
    rows = rows.where(F.size("vector") == width)

    def some(df: DataFrame, most: int, of: int, seed: str) -> tuple[np.ndarray, np.ndarray]:
        got = by_hash(df.select("id", "row", "vector"), [F.col("row")], most, of, seed).toPandas().sort_values(["id", "row"])
        return got["id"].to_numpy(np.int64), np.array(got["vector"].tolist(), float).reshape(len(got), width)

    _, sample = some(rows, max(sample_rows, min(most_sample_rows, int(64 * n**0.5))), n, "tree")
    tree = grow(sample, float(longest))
    shared = spark.sparkContext.broadcast(tree)  # at most 2 centres for each row of the sample

    @F.arrow_udf("int")
    def leaf_of(batch: pa.Array) -> pa.Array:
        flat = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
        return pa.array(shared.value.assign(flat).astype(np.int32))

    indexed = materialise(rows.withColumn("leaf", leaf_of("vector")), "ann-index")
    drop(spark, paths)

    # brute force for the calibration queries: each task keeps its own best
    probe_ids, probes = some(indexed.where("asks"), calibration, asked or 0, "calibration")
    asks = spark.sparkContext.broadcast((probe_ids, probes))  # calibration x width doubles

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, q = asks.value
        best = [(np.empty(0), np.empty(0, np.int64)) for _ in who]  # the "id" here is row number and leaf
        for b in batches:
            x = b.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            ids, code = b.column("id").to_numpy(), np.arange(b.num_rows)
            leaf = b.column("leaf").to_numpy()
            s = _dot(q, x)
            for i, own in enumerate(who):
                ok = np.flatnonzero(ids != own)
                top_s, top_i = best_of(s[i][ok], code[ok], -1, k)
                score, leafs = np.concatenate((best[i][0], top_s)), np.concatenate((best[i][1], leaf[top_i]))
                o = np.argsort(-score, kind="stable")[:k]
                best[i] = score[o], leafs[o]
        sizes = [len(s) for s, _ in best]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(who)), sizes).astype(np.int32)), pa.array(np.concatenate([s for s, _ in best])), pa.array(np.concatenate([x for _, x in best]).astype(np.int32))], names=["q", "score", "leaf"])

    truth: list[np.ndarray] = [np.empty(0, np.int64) for _ in probe_ids]
    if len(probe_ids):
        found = indexed.select("id", "vector", "leaf").mapInArrow(brute, "q int, score double, leaf int")
        w = Window.partitionBy("q").orderBy(F.desc("score"), "leaf")
        got = found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).select("q", "leaf").toPandas()  # calibration x k rows
        for q, g in got.groupby("q"):
            truth[q] = g["leaf"].to_numpy(np.int64)
    index = calibrate(Index(tree, np.empty(0), np.empty(0), 0.0), probes, truth, target)
    if report is not None:
        report.update(recall=index.recall, visits=index.visits.tolist(), leaves=tree.leaves, rows=n, calibrated_on=probe_ids.tolist())
    # a query's own id is no candidate: a leaf has its rows but those of its most frequent id for any query
    of_id = indexed.groupBy("leaf", "id").agg(F.count(F.lit(1)).alias("n"))
    counts = of_id.groupBy("leaf").agg((F.sum("n") - F.max("n")).alias("held")).toPandas()  # at most one row for each leaf
    held = np.zeros(tree.leaves, np.int64)
    held[counts["leaf"]] = counts["held"]
    guide = spark.sparkContext.broadcast(replace(index, held=held, k=k))

    # neighbouring leaves share a group of about block_rows rows; a larger leaf is a group of several blocks
    span = max(1, round(tree.leaves * block_rows / max(n, 1)))
    grouped = indexed.withColumn("group", (F.col("leaf") / span).cast("int"))
    sizes = grouped.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))  # at most one row for each leaf
    in_blocks = grouped.join(F.broadcast(sizes), "group").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    stored = in_blocks.select("group", "block", "id", "leaf", "vector").groupBy("group", "block").applyInArrow(
        lambda t: _packed(t.sort_by("leaf"), ["group", "block"], {"id": "<i8", "leaf": "<i4"}), "group int, block int, id binary, leaf binary, matrix binary")

    @F.arrow_udf("array<struct<group:int,leaves:array<int>>>")
    def visits(batch: pa.Array) -> pa.Array:
        flat = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
        out = []
        for q in flat:
            by: dict[int, list[int]] = {}
            for leaf in guide.value.leaves_of(q).tolist():
                by.setdefault(leaf // span, []).append(leaf)
            out.append([{"group": g, "leaves": v} for g, v in by.items()])
        return pa.array(out, pa.list_(pa.struct([("group", pa.int32()), ("leaves", pa.list_(pa.int32()))])))

    def gather(t: pa.Table) -> pa.Table:
        leaves = t["leaves"].combine_chunks()
        out = _packed(t, ["group", "part"], {"id": "<i8", "row": "<i8"})
        lens = np.diff(leaves.offsets.to_numpy()).astype("<i4")
        return out.append_column("lens", pa.array([lens.tobytes()])).append_column("leaves", pa.array([leaves.flatten().to_numpy().astype("<i4").tobytes()]))

    parts = max(1, -(-int(asked or 0) // query_rows))
    sent = grouped.where("asks").select("id", "row", "vector", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part"), F.inline(visits("vector")))
    asking = sent.groupBy("group", "part").applyInArrow(gather, "group int, part int, id binary, row binary, matrix binary, lens binary, leaves binary")
    asking = asking.select("group", "part", *(F.col(c).alias(f"q_{c}") for c in ("id", "row", "matrix", "lens", "leaves")))
    # a task's key has one group of leaves and ``together`` parts of the queries, however many there are
    turns = max(1, -(-parts // together))
    tasks = min(10_000, max(1, -(-n // block_rows)) * turns)
    asking = asking.withColumn("turn", (F.col("part") / together).cast("int")).repartition(tasks, "group", "turn")
    stored = stored.drop("block").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))).repartition(tasks, "group", "turn")
    pairs = asking.join(stored, ["group", "turn"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, leaf, x = np.frombuffer(r["id"], "<i8"), np.frombuffer(r["leaf"], "<i4"), _vectors(r["matrix"], width)
                who, asker, q = np.frombuffer(r["q_id"], "<i8"), np.frombuffer(r["q_row"], "<i8"), _vectors(r["q_matrix"], width)
                wanted, visitor = np.frombuffer(r["q_leaves"], "<i4"), np.repeat(np.arange(len(q)), np.frombuffer(r["q_lens"], "<i4"))
                slack = 4 * width * np.finfo(float).eps * float(longest) * np.sqrt((q**2).sum(axis=1))
                by_leaf = np.argsort(wanted, kind="stable")
                found: list[list[np.ndarray]] = [[] for _ in q]
                for v in np.unique(leaf):  # a leaf's rows against the queries that visit it
                    rows = slice(np.searchsorted(leaf, v), np.searchsorted(leaf, v, side="right"))
                    there = visitor[by_leaf[np.searchsorted(wanted[by_leaf], v) : np.searchsorted(wanted[by_leaf], v, side="right")]]
                    for i, s in zip(there, _dot(q[there], x[rows])):
                        score, other = best_exact(q[i], x[rows], s, ids[rows], who[i], k, slack[i])
                        found[i].append([np.full(len(score), asker[i]), other, score])
                flat = [f for fs in found for f in fs]
                if flat:
                    best = _best_of_each(flat, k)
                    own = dict(zip(asker.tolist(), who.tolist()))
                    yield pa.RecordBatch.from_arrays([pa.array(best[0]), pa.array(np.array([own[a] for a in best[0].tolist()], np.int64)), pa.array(best[1]), pa.array(best[2])], names=["asker", "query_id", "other", "score"])

    scored = pairs.mapInArrow(answer, "asker long, query_id long, other long, score double")
    first = Window.partitionBy("asker").orderBy(F.desc("score"), "other")
    ranked = scored.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("other").alias(id), "score")
