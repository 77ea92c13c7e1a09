"""Hard-negative mining: segment summaries bound the scores, level by level.

Vectors lie in blocks of bounded size, sorted by label. For each of a few levels
a vector is cut into segments (1, 2, 4, ... of them), of which the block keeps
the mean and the deviation, the length of the segment less its mean. The inner
product of two segments is the product of the means, times the segment's length,
give or take the product of the deviations; the sum over segments bounds the
score from both sides, and the bounds of a finer level lie inside those of the
coarser one. A pair is dropped as soon as its bounds rule it out:

* as a positive, if ``positives`` others of the label have lower bounds above
  its upper bound;
* as a negative, if it cannot lie in the band of scores of any positive, or if
  for each positive ``k`` others surely lie in its band and surely score more.

What is left is scored in full. Anchors travel in blocks; a block of anchors
meets each block of vectors in a task that has one of the latter and a bounded
number of the former. The best of all blocks are merged.

The band of a positive score p has the scores n with
``low * p <= 100 * n <= high * p``. Components are floor(scale * x), so scores
are whole numbers, exact while the product of two rows' lengths stays below
2 ** 53. Beyond that they are rounded, and null where they don't fit a long.

Edge cases: rows with a null id, a null label, a null vector or one that holds a
null or non-finite component take no part. An empty vector scores 0; only
vectors of the anchor's length are its candidates. Rows with the anchor's id are
no candidates; rows that repeat another id are candidates each, and anchors that
repeat an id are mined each. Ties go to smaller ids. An anchor without a positive,
and a positive without a negative in its band, give no rows; so do an empty table
and one without anchors. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialise
from .topk import usable

SAFE = 1e-9  # of the product of the lengths, for sums in another order


class Summary:
    """Rows with the segment means and deviations of each level."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.length = np.sqrt((rows**2).sum(axis=1))
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        width, parts = rows.shape[1], 1
        while parts <= max(1, width // 8) and width:
            cuts = np.linspace(0, width, parts + 1).astype(int)
            size = np.diff(cuts)
            mean = np.add.reduceat(rows, cuts[:-1], axis=1) / size
            rest = rows - np.repeat(mean, size, axis=1)
            self.levels.append((size, mean, np.sqrt(np.add.reduceat(rest**2, cuts[:-1], axis=1))))
            parts *= 2

    def part(self, which) -> Summary:
        out = object.__new__(Summary)
        out.rows, out.length = self.rows[which], self.length[which]
        out.levels = [(size, mean[which], dev[which]) for size, mean, dev in self.levels]
        return out


def bounds(a: Summary, v: Summary, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores of ``a`` by ``v``."""
    size, mean, dev = a.levels[level]
    _, other, spread = v.levels[level]
    middle = (mean * size) @ other.T
    reach = dev @ spread.T + SAFE * np.outer(a.length, v.length)
    return middle - reach, middle + reach


def scores(a: Summary, v: Summary, alive: np.ndarray) -> np.ndarray:
    """The scores of the pairs alive, -inf for the others."""
    out = np.full(alive.shape, -np.inf)
    if alive.sum() > 0.05 * alive.size:  # many: one matrix product is cheaper than pair by pair
        out = np.where(alive, a.rows @ v.rows.T, -np.inf)
    else:
        i, j = np.nonzero(alive)
        for at in range(0, len(i), 1 << 16):
            s = slice(at, at + (1 << 16))
            out[i[s], j[s]] = np.einsum("nd,nd->n", a.rows[i[s]], v.rows[j[s]])
    return out


def kth_largest(x: np.ndarray, k: int) -> np.ndarray:
    """Of each row; -inf where it has fewer."""
    n = x.shape[1]
    return np.partition(x, n - k, axis=1)[:, n - k] if n >= k else np.full(len(x), -np.inf)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest finite scores, ties to smaller ids."""
    at = np.flatnonzero(score > -np.inf)
    if len(at) > k:
        at = at[score[at] >= -np.partition(-score[at], k - 1)[k - 1]]
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def find_positives(a: Summary, who: np.ndarray, v: Summary, ids: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor's place, places in ``v``, scores) of each anchor's ``k`` best rows."""
    alive = ids[None, :] != who[:, None]
    for level in range(len(a.levels)):
        low, high = bounds(a, v, level)
        alive &= high >= kth_largest(np.where(alive, low, -np.inf), k)[:, None]
    exact = scores(a, v, alive)
    return [(i, at := best(s, ids, k), s[at]) for i, s in enumerate(exact)]


def find_negatives(a: Summary, given: np.ndarray, v: Summary, ids: np.ndarray, alive: np.ndarray, k: int, low: int, high: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor's place, positive's place, places in ``v``, scores) of the ``k`` best rows
    in the band of each positive score ``given`` (anchors x positives, NaN for none)."""
    least, most = low * given / 100, high * given / 100
    alive = alive.copy()
    for level in range(len(a.levels)):
        under, over = bounds(a, v, level)
        left = np.zeros_like(alive)
        for p in range(given.shape[1]):
            floor, roof = least[:, p, None], most[:, p, None]
            can = alive & (over >= floor) & (under <= roof)
            sure = np.where(can & (under >= floor) & (over <= roof), under, -np.inf)
            left |= can & (over >= kth_largest(sure, k)[:, None])
        alive = left
    exact, out = scores(a, v, alive), []
    for i, s in enumerate(exact):
        for p, score in enumerate(given[i]):
            if score == score:
                at = best(np.where((100 * s >= low * score) & (100 * s <= high * score), s, -np.inf), ids, k)
                out.append((i, p, at, s[at]))
    return out


def _gathered(rows: DataFrame, block: str, more: str | None = None) -> DataFrame:
    """One row for each (``block``, width): ids, rows, labels and vectors as bytes, by label and id."""
    cols = ["id", "row", "label", *([more] if more else [])]

    def gather(t: pa.Table) -> pa.Table:
        t = t.sort_by([("label", "ascending"), ("id", "ascending"), ("row", "ascending")])

        def flat(name: str) -> np.ndarray:
            return t[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<f8")

        own = {c: pa.array([flat(c).tobytes() if c == more else t[c].to_numpy().astype("<i8").tobytes()]) for c in cols}
        return pa.table({block: t[block][:1], "width": t["width"][:1], **own, "matrix": pa.array([flat("vector").tobytes()])})

    fields = ", ".join(f"{c} binary" for c in [*cols, "matrix"])
    return rows.select(block, "width", *cols, "vector").groupBy(block, "width").applyInArrow(gather, f"{block} int, width int, {fields}")


def _meeting(stored: DataFrame, blocks: int, asking: DataFrame, ablocks: int, together: int) -> DataFrame:
    """Each block of vectors beside each block of anchors of its width. A task's
    key has one of the former and ``together`` of the latter."""
    turns, on = max(1, -(-ablocks // together)), ["block", "turn", "width"]
    tasks = min(10_000, blocks * turns)
    asking = asking.select(*(F.col(c).alias(f"a_{c}") if c not in ("width", "ablock") else F.col(c) for c in asking.columns))
    left = asking.withColumn("turn", (F.col("ablock") / together).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = stored.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    return left.repartition(tasks, *on).join(right.repartition(tasks, *on), on)


class _Unit:
    """A row of ``_meeting`` as arrays."""

    def __init__(self, row: dict):
        def ints(c: str) -> np.ndarray:
            return np.frombuffer(row[c], "<i8")

        self.ids, self.labels = ints("id"), ints("label")
        self.who, self.asker, self.kinds = ints("a_id"), ints("a_row"), ints("a_label")
        self.anchors = Summary(np.frombuffer(row["a_matrix"], "<f8").reshape(len(self.who), row["width"]))
        self.vectors = Summary(np.frombuffer(row["matrix"], "<f8").reshape(len(self.ids), row["width"]))
        self.given = np.frombuffer(row["a_given"], "<f8").reshape(len(self.who), -1) if "a_given" in row else None


def _floor(x: Column) -> Column:
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)  # doubles beyond are whole


def mine(vectors: DataFrame, anchors: Column, label: Column, positives: int = 5, k: int = 5, low: int = 80, high: int = 100, scale: int = 256,
         id: str = "vec_id", vector: str = "embedding", block_rows: int = 4_096, anchor_rows: int = 128, together: int = 4) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for
    each row that ``anchors`` admits, its ``positives`` best rows of the same
    ``label`` and, for each, the ``k`` best rows of other labels in its band."""
    part = vectors.select(F.col(id).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    part = part.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    whole = F.transform("vector", lambda x: _floor(x.cast("double") * scale))
    paths: list[str] = []
    rows = materialise(part.select("id", "label", whole.alias("vector"), F.size("vector").alias("width"), "asks", F.monotonically_increasing_id().alias("row")), "hardneg-rows", paths)
    n, asked = rows.select(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks, ablocks = max(1, -(-n // block_rows)), max(1, -(-asked // anchor_rows))

    def dealt(df: DataFrame, name: str, count: int) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64("row"), F.lit(count)).cast("int"))

    stored = materialise(_gathered(dealt(rows, "block", blocks), "block"), "hardneg-blocks")
    asking = dealt(rows.where("asks"), "ablock", ablocks)

    def of_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            u, out = _Unit(row), []
            for kind in np.unique(u.kinds):
                a = np.flatnonzero(u.kinds == kind)
                first, end = np.searchsorted(u.labels, [kind, kind + 1])
                if end > first:
                    found = find_positives(u.anchors.part(a), u.who[a], u.vectors.part(slice(first, end)), u.ids[first:end], positives)
                    out += [(u.asker[a[i]], u.ids[first + at], s) for i, at, s in found]
            if out:
                yield _batch([(asker, 0, ids, s) for asker, ids, s in out])

    def of_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            u, out = _Unit(row), []
            for at in range(0, len(u.who), 32):
                a = slice(at, at + 32)
                alive = (u.labels[None, :] != u.kinds[a, None]) & (u.ids[None, :] != u.who[a, None])
                found = find_negatives(u.anchors.part(a), u.given[a], u.vectors, u.ids, alive, k, low, high)
                out += [(u.asker[at + i], p, u.ids[where], s) for i, p, where, s in found]
            if out:
                yield _batch(out)

    schema = "asker long, place int, other long, score double"
    near = _meeting(stored, blocks, _gathered(asking, "ablock"), ablocks, together).mapInArrow(of_label, schema)
    first = Window.partitionBy("asker").orderBy(F.desc("score"), "other")
    near = near.withColumn("place", F.row_number().over(first) - 1).where(F.col("place") < positives)
    # at most ``positives`` entries in an anchor's array
    own = near.groupBy("asker").agg(F.sort_array(F.collect_list(F.struct("place", "other", "score"))).alias("best"))
    paired = materialise(asking.join(own, asking["row"] == own["asker"]).drop("asker"), "hardneg-positives")
    nan = F.lit(float("nan"))
    given = F.array(*(F.coalesce(F.get("best", i)["score"], nan) for i in range(positives)))
    far = _meeting(stored, blocks, _gathered(paired.withColumn("given", given), "ablock", "given"), ablocks, together).mapInArrow(of_others, schema)
    ranked = far.withColumn("rank", F.row_number().over(Window.partitionBy("asker", "place").orderBy(F.desc("score"), "other"))).where(F.col("rank") <= k)
    anchor = paired.select(F.col("row").alias("asker"), F.col("id").alias("anchor_id"), F.inline("best").alias("place", "positive_id", "positive_score"))
    drop(vectors.sparkSession, paths)
    return ranked.join(anchor, ["asker", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), F.col("positive_score").try_cast("long").alias("positive_score"), F.col("score").try_cast("long").alias("negative_score"))


def _batch(found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    sizes = [len(ids) for _, _, ids, _ in found]
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(np.array([a for a, _, _, _ in found], np.int64), sizes)),
        pa.array(np.repeat(np.array([p for _, p, _, _ in found], np.int32), sizes)),
        pa.array(np.concatenate([ids for _, _, ids, _ in found]).astype(np.int64)),
        pa.array(np.concatenate([s for _, _, _, s in found]).astype(np.float64)),
    ], names=["asker", "place", "other", "score"])
