"""Exact top-k by inner product: Fagin's threshold algorithm, block by block.

Vectors lie in blocks of bounded size; a block keeps, for each dimension, its
rows in order of that component. A query reads the lists of its non-zero
components from the end that adds most, scores each row it meets for the first
time in full, and stops when the score that an unmet row could have at most
(every list at the depth reached) cannot beat its k-th best. A block's best k
of each query are then merged; both sides travel in blocks, and a query block
meets each vector block once.

The integer form takes floor(scale * x) of each component.

Edge cases: vectors that are null or hold a null or non-finite component, and
rows with a null id, take no part. An empty vector scores 0 against others of
its length; only vectors of the query's length are its candidates. A query's
own row (same id) is no candidate. Rows that repeat an id are candidates each.
An empty table, or one without queries, gives no rows. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise


def usable(vector: Column) -> Column:
    """Whether a vector has no null and no non-finite component (false for null)."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


class Lists:
    """The rows of a block in order of each component."""

    def __init__(self, rows: np.ndarray):
        self.rows = np.asarray(rows, np.float64)
        self.whole = bool((self.rows == np.floor(self.rows)).all())
        self.reach = float(np.abs(self.rows).max(initial=0)) * rows.shape[1]
        self.short = self.rows.astype(np.float32) if self.whole else None
        self.order = np.argsort(rows, axis=0, kind="stable").T.astype(np.int32)  # dimension x position, ascending
        self.value = np.take_along_axis(self.rows.T, self.order, axis=1)


def threshold_search(lists: Lists, ids: np.ndarray, query: np.ndarray, own: int, k: int, step: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows but those of id ``own``, ties to smaller ids."""
    n, d = lists.rows.shape
    dims = np.flatnonzero(query)
    # sums of whole numbers stay exact in single precision up to 2 ** 24
    single = lists.whole and (query == np.floor(query)).all() and lists.reach * np.abs(query).max(initial=0) < 1 << 24
    rows, q = (lists.short, query.astype(np.float32)) if single else (lists.rows, query)
    margin = 0.0 if lists.whole else 1e-9  # of sums in another order
    down = query[dims] > 0  # read from the largest component
    met = np.zeros(n, bool)
    best_score, best_id = np.empty(0), np.empty(0, np.int64)
    depth = 0
    while depth < n:
        end = min(n, depth + step)
        if len(dims):
            up_part = lists.order[dims[~down], depth:end]
            down_part = lists.order[dims[down], n - end : n - depth]
            mark = np.zeros(n, bool)
            mark[up_part.ravel()] = True
            mark[down_part.ravel()] = True
            new = np.flatnonzero(mark & ~met)
        else:  # a query of zeros reads no list: every score is 0
            new, end = np.arange(n), n
        met[new] = True
        depth = end
        step = max(step, depth // 2)
        new = new[ids[new] != own]
        score = (rows[new] @ q).astype(np.float64)
        if len(best_score) >= k:
            can = score >= best_score[-1]
            new, score = new[can], score[can]
        if len(new):
            score, who = np.concatenate((best_score, score)), np.concatenate((best_id, ids[new]))
            if len(score) > 4 * k:  # keep those that can still be among the k best, ties included
                kth = -np.partition(-score, k - 1)[k - 1]
                score, who = score[score >= kth], who[score >= kth]
            order = np.lexsort((who, -score))[:k]
            best_score, best_id = score[order], who[order]
        if depth < n and len(best_score) >= k:
            at = np.where(down, lists.value[dims, n - depth], lists.value[dims, depth - 1])
            bound = float(at @ query[dims])
            if bound + margin * abs(bound) < best_score[-1]:
                break
    return best_id, best_score


def blocks(rows: DataFrame, block_rows: int, n: int, name: str) -> DataFrame:
    """Rows (``id`` long, ``vector`` of doubles, ``row`` number) dealt by hash to blocks of
    about ``block_rows`` rows of one length: (name, width, ids, row_ids, matrix), as bytes."""
    count = max(1, -(-n // block_rows))
    dealt = rows.withColumn("width", F.size("vector")).withColumn(name, F.pmod(F.xxhash64("row"), F.lit(count)).cast("int"))

    def gather(t: pa.Table) -> pa.Table:
        ids = t["id"].to_numpy()
        width = t["width"][0].as_py()
        flat = t["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        matrix = flat.astype("<f8").reshape(len(ids), width)[order]
        return pa.table({name: t[name][:1], "width": t["width"][:1], "ids": pa.array([ids[order].astype("<i8").tobytes()]), "row_ids": pa.array([t["row"].to_numpy()[order].astype("<i8").tobytes()]), "matrix": pa.array([matrix.tobytes()])})

    return dealt.groupBy(name, "width").applyInArrow(gather, f"{name} int, width int, ids binary, row_ids binary, matrix binary")


def _matrix(ids: bytes, matrix: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    who = np.frombuffer(ids, "<i8")
    return who, np.frombuffer(matrix, "<f8").reshape(len(who), width)


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: int | None = None, block_rows: int = 16_384, query_rows: int = 256, together: int = 2) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` best rows of each row that
    ``queries`` (a condition on ``id``) admits; with ``scale`` on integers."""
    part = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    part = part.where(F.col("id").isNotNull() & usable(F.col("vector")))
    component = (lambda x: F.floor(x.cast("double") * scale).cast("double")) if scale else (lambda x: x.cast("double"))
    rows = materialise(part.select("id", F.transform("vector", component).alias("vector"), "asks", F.monotonically_increasing_id().alias("row")), "topk-rows")
    n, asked = rows.select(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asks").cast("int")), F.lit(0))).first()
    stored = materialise(blocks(rows.select("id", "vector", "row"), block_rows, n, "block"), "topk-blocks")
    asking = blocks(rows.where("asks").select("id", "vector", "row"), query_rows, asked, "qblock")
    per_block = max(1, -(-n // block_rows))
    asking = asking.select("width", "qblock", F.col("ids").alias("qids"), F.col("row_ids").alias("qrows"), F.col("matrix").alias("queries"), F.explode(F.sequence(F.lit(0), F.lit(per_block - 1))).alias("block"))
    # a task's key has one block and ``together`` blocks of queries, however many queries there are
    turns = max(1, -(-asked // (query_rows * together)))
    on, tasks = ["block", "turn", "width"], min(10_000, per_block * turns)
    asking = asking.withColumn("turn", (F.col("qblock") / together).cast("int")).repartition(tasks, *on)
    stored = stored.drop("row_ids").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))).repartition(tasks, *on)
    pairs = asking.join(stored, on)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lists, ids = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if held != (row["block"], row["width"]):
                    ids, matrix = _matrix(row["ids"], row["matrix"], row["width"])
                    held, lists = (row["block"], row["width"]), Lists(matrix)
                out = [(q, *threshold_search(lists, ids, v, q, k)) for q, v in zip(*_matrix(row["qids"], row["queries"], row["width"]))]
                found = [len(i) for _, i, _ in out]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.frombuffer(row["qrows"], "<i8"), found)),
                    pa.array(np.repeat(np.array([q for q, _, _ in out], np.int64), found)),
                    pa.array(np.concatenate([i for _, i, _ in out]).astype(np.int64)),
                    pa.array(np.concatenate([s for _, _, s in out]).astype(np.float64)),
                ], names=["asker", "query_id", "other", "score"])

    found = pairs.mapInArrow(search, "asker long, query_id long, other long, score double")
    first = Window.partitionBy("asker").orderBy(F.desc("score"), "other")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    score = F.col("score").cast("long") if scale else F.col("score")
    return ranked.select("query_id", "rank", F.col("other").alias(id), score.alias("score"))
