"""A linear student trained step by step, from weights it already has.

The student is a softmax over hashed words. Rows are packed once into blocks of
bounded size (one row of bytes each). A step is one pass over the blocks: each
block starts from the step's weights, goes through its rows in mini-batches in
an order of its own (AdaGrad), and returns what it changed; changes are averaged
over the blocks that met the word, in a tree, so the driver holds one model and
never a row. Nothing depends on how blocks fall to tasks, so a step that runs
again after a lost executor gives the same weights.

``Student`` carries weights from step to step and from round to round; the
optimizer's state starts anew with each call of ``train_steps``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import ID_TO_LABEL, MAX_TOKENS, SEED, TRAIN_BATCH_SIZE, TRAIN_EPOCHS
from ..functions.text import model_text
from .scoring import LOGITS, Scorer

BUCKETS = 1 << 16
TOKENS = "__words"
WORD_BREAK = r"[^\p{L}\p{N}_]+"
ROWS_PER_BLOCK, TOKENS_PER_BLOCK = 50_000, 1_000_000


def hashed_words(text: Column, buckets: int = BUCKETS) -> Column:
    """The words of a text as hash buckets, repeats included."""
    words = F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))


@dataclass
class Student:
    """``weights`` has a row for each class, a column for each bucket and one for the bias."""

    weights: np.ndarray
    max_tokens: int | None = MAX_TOKENS

    @classmethod
    def new(cls, n_classes: int = len(ID_TO_LABEL), buckets: int = BUCKETS, max_tokens: int | None = MAX_TOKENS) -> Student:
        return cls(np.zeros((n_classes, buckets + 1)), max_tokens)

    @property
    def n_classes(self) -> int:
        return len(self.weights)

    @property
    def buckets(self) -> int:
        return self.weights.shape[1] - 1

    def save(self, spark: SparkSession, path: str) -> None:
        """K5: a Parquet table of the buckets with weights, and a row of the sizes."""
        used = np.flatnonzero(self.weights.any(axis=0))
        rows = [(-1, [float(self.n_classes), float(self.buckets), float(self.max_tokens or 0)])]
        rows += [(int(i), self.weights[:, i].tolist()) for i in used]
        spark.createDataFrame(rows, "bucket int, weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Student:
        rows = {r["bucket"]: r["weights"] for r in spark.read.parquet(path).collect()}  # buckets + 2 rows at most
        classes, buckets, most = (int(x) for x in rows.pop(-1))
        out = cls.new(classes, buckets, most or None)
        for i, w in rows.items():
            out.weights[:, i] = w
        return out


class Rows:
    """Rows of hashed words, one after another; each gets the bias as a last word.
    A word counts one over the root of its row's words."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, bias: int):
        n = len(sizes)
        ends = np.cumsum(sizes + 1) - 1
        self.words = np.empty(len(words) + n, np.int64)
        at = np.ones(len(self.words), bool)
        at[ends] = False
        self.words[at], self.words[ends] = words, bias
        self.sizes = sizes + 1
        self.starts = ends - sizes
        self.scale = 1 / np.sqrt(self.sizes)

    def logits(self, weights: np.ndarray) -> np.ndarray:
        """One row for each class."""
        if not len(self.sizes):
            return np.empty((len(weights), 0))
        return np.add.reduceat(weights[:, self.words], self.starts, axis=1) * self.scale

    def take(self, which: np.ndarray) -> Rows:
        out = object.__new__(Rows)
        out.sizes, out.scale = self.sizes[which], self.scale[which]
        out.starts = np.cumsum(out.sizes) - out.sizes
        out.words = self.words[np.repeat(self.starts[which] - out.starts, out.sizes) + np.arange(out.sizes.sum())]
        return out

    def span(self, first: int, end: int) -> Rows:
        out = object.__new__(Rows)
        out.sizes, out.scale = self.sizes[first:end], self.scale[first:end]
        out.starts = self.starts[first:end] - self.starts[first]
        out.words = self.words[self.starts[first] : self.starts[first] + out.sizes.sum()]
        return out


def losses(logits: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cross-entropy of each row, chances of each class)."""
    e = np.exp(logits - logits.max(axis=0))
    p = e / e.sum(axis=0)
    return -np.log(np.maximum(p[labels, np.arange(len(labels))], 1e-300)), p


def pass_over(rows: Rows, labels: np.ndarray, weights: np.ndarray, power: np.ndarray, order: np.ndarray, batch_size: int, rate: float) -> tuple[float, int]:
    """Mini-batches in ``order``; changes ``weights`` and ``power`` (sums of squared
    gradients). Returns (sum of the batches' mean losses, rows told right), as they trained."""
    dealt, y = rows.take(order), labels[order]
    means, right = 0.0, 0
    for first in range(0, len(y), batch_size):
        batch, own = dealt.span(first, min(len(y), first + batch_size)), y[first : first + batch_size]
        logits = batch.logits(weights)
        loss, p = losses(logits, own)
        means += float(loss.mean())
        right += int((logits.argmax(axis=0) == own).sum())
        p[own, np.arange(len(own))] -= 1
        slope = p * (batch.scale / len(own))
        for w, s, g in zip(weights, power, slope):
            each = np.repeat(g, batch.sizes)
            np.add.at(s, batch.words, each * each)
            np.add.at(w, batch.words, -rate * each / np.sqrt(s[batch.words] + 1e-6))
    return means, right


BLOCK = "block int, rows long, sizes binary, words binary, labels binary"
CHANGE = "grp int, block int, rows long, start double, means double, batches long, right long, touched binary, weights binary, power binary"


_KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
CHANGE_ARROW = pa.schema([(n, _KINDS[kind]) for n, kind in (c.split() for c in CHANGE.split(", "))])


def pack(df: DataFrame, n_rows: int, n_tokens: int, ids: Sequence[str] = (), seed: int = SEED) -> tuple[DataFrame, int]:
    """(blocks, their number) of rows (``label_id``, ``TOKENS``), dealt by a hash of
    ``ids`` and row. Equal rows share a block, unless they are half a block or
    more: those (there can be few such kinds) are dealt out one by one."""
    blocks = max(1, -(-n_rows // ROWS_PER_BLOCK), -(-n_tokens // TOKENS_PER_BLOCK))

    def block(t: pa.Table) -> pa.Table:
        words = t[TOKENS].combine_chunks()
        ends, labels = words.offsets.to_numpy(), t["label_id"].to_numpy()
        sizes = np.diff(ends)
        order = np.lexsort((labels, sizes, t["spread"].to_numpy()))  # no matter how a shuffle brought them
        moved = sizes[order]
        at = np.repeat(ends[:-1][order] - ends[0] - (np.cumsum(moved) - moved), moved) + np.arange(moved.sum())
        found = words.flatten().to_numpy()[at].astype("<i4").tobytes()
        return pa.table({"block": t["block"][:1], "rows": pa.array([len(labels)], pa.int64()), "sizes": pa.array([moved.astype("<i4").tobytes()]),
                         "words": pa.array([found]), "labels": pa.array([labels[order].astype("<i4").tobytes()])})

    spread = F.xxhash64(F.lit(seed), *(F.col(c) for c in ids), TOKENS, "label_id")
    dealt = df.select(F.col("label_id").cast("int").alias("label_id"), TOKENS, spread.alias("spread"))
    many = ROWS_PER_BLOCK // 2
    if blocks > 1 and n_rows >= many:
        hot = dealt.groupBy("spread").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= many).select("spread", F.lit(True).alias("hot"))
        dealt = dealt.join(F.broadcast(hot), "spread", "left")  # at most n_rows / many
        dealt = dealt.withColumn("spread", F.when(F.col("hot"), F.xxhash64("spread", F.monotonically_increasing_id())).otherwise(F.col("spread"))).drop("hot")
    dealt = dealt.withColumn("block", F.pmod("spread", F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(block, BLOCK), blocks


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(row[c], "<i4").astype(np.int64) for c in ("words", "sizes", "labels"))


def one_step(blocks: DataFrame, student: Student, power: np.ndarray, step: int, batch_size: int, rate: float, groups: int, seed: int) -> tuple[Student, np.ndarray, dict]:
    """One pass: (student after it, squared gradients after it, its losses)."""
    shared = blocks.sparkSession.sparkContext.broadcast((student.weights, power))  # classes x buckets doubles, twice
    shape = student.weights.shape

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            words, sizes, labels = _arrays(row)
            rows, (w0, s0) = Rows(words, sizes, shape[1] - 1), shared.value
            w, s = w0.copy(), s0.copy()
            start = float(losses(rows.logits(w0), labels)[0].sum())
            order = np.random.default_rng([seed, step, row["block"]]).permutation(len(labels))
            means, right = pass_over(rows, labels, w, s, order, batch_size, rate)
            met = np.flatnonzero(np.bincount(rows.words, minlength=shape[1]))
            out = {"grp": row["block"] % groups, "block": row["block"], "rows": len(labels), "start": start, "means": means, "batches": -(-len(labels) // batch_size), "right": right,
                   "touched": met.astype("<i4").tobytes(), "weights": (w - w0)[:, met].tobytes(), "power": (s - s0)[:, met].tobytes()}
            yield pa.RecordBatch.from_pylist([out], schema=CHANGE_ARROW)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for row in (r for b in batches for r in b.to_pylist()):
            if out is not None and out["grp"] != row["grp"]:
                yield _summed(out)
                out = None
            if out is None:
                out = {"grp": row["grp"], "block": row["block"], **dict.fromkeys(("rows", "start", "means", "batches", "right"), 0), "n": np.zeros(shape[1]), "w": np.zeros(shape), "s": np.zeros(shape)}
            for c in ("rows", "start", "means", "batches", "right"):
                out[c] += row[c]
            met = np.frombuffer(row["touched"], "<i4")
            out["n"][met] += row["rows"]
            out["w"][:, met] += row["rows"] * np.frombuffer(row["weights"]).reshape(shape[0], -1)
            out["s"][:, met] += row["rows"] * np.frombuffer(row["power"]).reshape(shape[0], -1)
        if out is not None:
            yield _summed(out)

    changed = blocks.mapInArrow(train, CHANGE)
    summed = changed.repartition(groups, "grp").sortWithinPartitions("grp", "block").mapInArrow(add, CHANGE)
    n, w, s = np.zeros(shape[1]), np.zeros(shape), np.zeros(shape)
    total = dict.fromkeys(("rows", "start", "means", "batches", "right"), 0)
    for row in sorted(summed.collect(), key=lambda r: r["grp"]) if groups <= 16 else summed.toLocalIterator():  # a model for each group
        for c in total:
            total[c] += row[c]
        n += np.frombuffer(row["touched"])
        w += np.frombuffer(row["weights"]).reshape(shape)
        s += np.frombuffer(row["power"]).reshape(shape)
    n = np.maximum(n, 1)
    rows = max(1, total["rows"])
    report = {"rows": total["rows"], "start_loss": total["start"] / rows, "train_loss": total["means"] / max(1, total["batches"]), "train_accuracy": total["right"] / rows}
    return replace(student, weights=student.weights + w / n), power + s / n, report


def _summed(out: dict) -> pa.RecordBatch:
    n, w, s = out.pop("n"), out.pop("w"), out.pop("s")
    return pa.RecordBatch.from_pylist([{**out, "start": float(out["start"]), "means": float(out["means"]), "touched": n.tobytes(), "weights": w.tobytes(), "power": s.tobytes()}], schema=CHANGE_ARROW)


@dataclass
class Trained:
    """``last`` after all steps, ``best`` after the step of least validation loss
    (the earliest of equals), and a record for each step."""

    last: Student
    best: Student
    best_step: int
    steps: list[dict] = field(default_factory=list)


def train_steps(blocks: DataFrame, n_blocks: int, start: Student, validate: Callable[[Student], dict] | None = None, steps: int = TRAIN_EPOCHS,
                batch_size: int = TRAIN_BATCH_SIZE, rate: float = 0.1, seed: int = SEED) -> Trained:
    """``steps`` passes over ``pack``ed (and written) blocks from the weights of
    ``start``. A step's record has ``start_loss`` (row mean under the weights it
    began with), ``train_loss`` (mean of batch means as it trained, A6) and what
    ``validate`` gives for the weights after it; ``loss_batch_mean`` of the latter,
    or ``loss``, chooses the best step (A7)."""
    student, power = start, np.zeros_like(start.weights)
    groups = max(1, int(np.ceil(np.sqrt(n_blocks))))
    out = Trained(start, start, 0)
    least = float("inf")
    for step in range(1, steps + 1):
        student, power, report = one_step(blocks, student, power, step, batch_size, rate, groups, seed)
        found = validate(student) if validate else {}
        report = {"step": step, **report, **{f"val_{k}": v for k, v in found.items()}}
        loss = found.get("loss_batch_mean", found.get("loss", float("inf")))
        if loss < least:
            least, out.best, out.best_step = loss, student, step
        out.steps.append(report)
    if not out.best_step:  # nothing to choose by
        out.best, out.best_step = student, steps
    out.last = student
    return out


class StudentScorer(Scorer):
    """Logits of a ``Student``; on rows that carry ``TOKENS`` where ``featurized``."""

    def __init__(self, student: Student, featurized: bool = False):
        self.student, self.featurized = student, featurized
        self.n_classes, self.max_tokens = student.n_classes, student.max_tokens

    def add_logits(self, df: DataFrame, text_col: str, out_col: str = LOGITS) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.student.weights)

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def logits(words: pa.Array) -> pa.Array:
            sizes = np.diff(words.offsets.to_numpy())
            rows = Rows(words.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes.astype(np.int64), shared.value.shape[1] - 1)
            flat = rows.logits(shared.value).T
            return pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel()))

        words = F.col(TOKENS) if self.featurized else hashed_words(self.clip(model_text(text_col)), self.student.buckets)
        return df.withColumn(out_col, logits(words))
