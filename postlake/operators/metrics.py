"""Aggregate metrics (A1-A7): one partially aggregated pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.probs import log_softmax_at
from ..functions.text import is_blank


def label_distribution(df: DataFrame, col: str = "sentiment") -> DataFrame:
    """A2 + A3: count and percent per label, nulls excluded, descending count.

    The per-label counts are combined map-side; the percent is a window over
    the handful of aggregated rows (not over the data).
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("percent", F.col("count") * F.lit(100.0) / total).orderBy(
        F.desc("count"), F.asc(col)
    )


def acceptance(df: DataFrame, thresholds: Sequence[float], conf_col: str = "confidence") -> DataFrame:
    """A4 for one or several thresholds in a single pass: accepted rows
    (``confidence >= t``), total and percent (0 when there are no rows)."""
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(F.col(conf_col) >= F.lit(float(t))).alias(f"a{i}") for i, t in enumerate(thresholds)]
    row = df.agg(*aggs)
    parts = [
        F.struct(
            F.lit(i + 1).alias("step"),
            F.lit(float(t)).alias("threshold"),
            F.col(f"a{i}").alias("accepted"),
        )
        for i, t in enumerate(thresholds)
    ]
    out = row.select("total", F.explode(F.array(*parts)).alias("s")).select("s.*", "total")
    pct = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.col("accepted") * F.lit(100.0) / F.col("total"))
    return out.withColumn("percent", pct)


def cross_entropy(logits: Column, label: Column) -> Column:
    """Per-row cross-entropy from logits: logsumexp(l) - l[label]."""
    return -log_softmax_at(logits, label)


TAIL_SALTS = 64


def tail_cut(df: DataFrame, order_key: Column, batch_size: int) -> DataFrame:
    """One row, ``cut``: the least of the last ``batch_size - 1`` keys (null without
    keys). Rows of a short last batch lie at or behind it. Only keys are read: each
    task passes on that many for each of a fixed number of salts, as the aggregate
    of those does."""
    keys = df.select(order_key.alias("ord")).where(F.col("ord").isNotNull())
    last = Window.partitionBy(F.pmod(F.xxhash64("ord"), F.lit(TAIL_SALTS))).orderBy(F.desc("ord"))
    keys = keys.withColumn("place", F.row_number().over(last)).where(F.col("place") < batch_size)
    return keys.agg(F.array_min(F.slice(F.sort_array(F.collect_list("ord"), asc=False), 1, batch_size - 1)).alias("cut"))


def eval_report(
    df: DataFrame,
    logits_col: str,
    label_col: str,
    order_key: Column | None = None,
    batch_size: int | None = None,
    cut: Column | None = None,
) -> DataFrame:
    """A5 + A6 as one row: ``n, loss, loss_batch_mean, accuracy, null_losses``.

    ``loss`` is the row mean of the cross-entropy. ``loss_batch_mean`` is the
    mean of batch means for batches of ``batch_size`` in ``order_key`` order
    (null keys first): full batches weigh equally, so only the rows of a short
    last batch matter one by one. It begins at one of the last ``batch_size - 1``
    keys, the least of which is ``cut`` (``tail_cut``; found here unless given, by
    a scan more). Rows before them are one group, so no row is shuffled. Of rows
    that share the key it begins at, each counts with their mean. Both losses are
    null when some row has none (``null_losses`` of them).
    """
    ce = cross_entropy(F.col(logits_col), F.col(label_col))
    l = F.col(logits_col)
    pred = (F.array_position(l, F.array_max(l)) - 1).cast("int")
    size = int(batch_size) if batch_size and order_key is not None else 1
    late = F.lit(None).cast("string")
    if size > 1:
        late = F.when(order_key >= (tail_cut(df, order_key, size).scalar() if cut is None else cut), order_key)
    x = df.select(ce.alias("ce"), (pred == F.col(label_col)).cast("int").alias("ok"), late.alias("ord"))
    groups = x.groupBy("ord").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("ce").alias("s"),
        F.sum("ok").alias("right"),
        F.count("ok").alias("told"),
        F.count_if(F.col("ce").isNull()).alias("nulls"),
    )
    r = groups.agg(  # of at most batch_size groups
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n"),
        F.sum("s").alias("s"),
        F.try_divide(F.sum("right"), F.sum("told")).alias("accuracy"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_losses"),
        F.sort_array(F.collect_list(F.struct("ord", "rows", "s")), asc=False).alias("late"),
    )
    whole = F.col("null_losses") == 0
    rem = F.col("n") % size

    def take(a: Column, group: Column) -> Column:
        taken = F.least(a["left"], group["rows"])
        return F.struct((a["left"] - taken).alias("left"), (a["sum"] + group["s"] * taken / group["rows"]).alias("sum"))

    tail = F.aggregate("late", F.struct(rem.alias("left"), F.lit(0.0).alias("sum")), take, lambda a: a["sum"])
    batches = F.ceil(F.col("n") / size)
    loss = F.try_divide(F.col("s"), F.col("n"))
    means = F.when(rem == 0, loss).otherwise(((F.col("s") - tail) / size + F.try_divide(tail, rem)) / batches)
    return r.select("n", F.when(whole, loss).alias("loss"), F.when(whole, means).alias("loss_batch_mean"), "accuracy", "null_losses")


def eval_metrics(
    df: DataFrame,
    logits_col: str,
    label_col: str,
    order_key: Column | None = None,
    batch_size: int | None = None,
    cut: Column | None = None,
) -> dict:
    """``eval_report`` on the driver. A row without a loss (null logits, or a
    label that no logit belongs to) is an error, never a small loss."""
    r = eval_report(df, logits_col, label_col, order_key, batch_size, cut).first()
    if r["null_losses"]:
        raise ValueError(f"{r['null_losses']} of {r['n']} rows have no loss: null logits, or labels beyond the classes")
    nan = float("nan")
    out = {"n": int(r["n"]), "loss": nan if r["loss"] is None else float(r["loss"]), "accuracy": nan if r["accuracy"] is None else float(r["accuracy"])}
    if batch_size and order_key is not None and out["n"]:
        out["loss_batch_mean"] = float(r["loss_batch_mean"])
    return out


def best_step(metrics: DataFrame, step_col: str = "step", loss_col: str = "val_loss") -> DataFrame:
    """The step with the lowest loss; the earliest step wins ties."""
    return metrics.agg(
        F.min_by(F.col(step_col), F.struct(F.col(loss_col), F.col(step_col))).alias("best_step"),
        F.min(loss_col).alias("best_loss"),
    )


def stage_counts(df: DataFrame, text_col: str = "text", label_col: str = "sentiment") -> DataFrame:
    """A1: the pipeline's row counts in one pass instead of several counts."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~is_blank(text_col)).alias("valid_text"),
        F.count_if(F.col(label_col).isNotNull()).alias("labelled"),
        F.count_if(F.col(label_col).isNull()).alias("unlabelled"),
        F.count_if(F.col(label_col).isNull() & ~is_blank(text_col)).alias("unlabelled_valid"),
    )
