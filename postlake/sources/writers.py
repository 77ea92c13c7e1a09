"""Sinks (K1-K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import SCORED_SUFFIX


def write_clean(df: DataFrame, path: str, partition_col: str = "tweet_date", layout: str = "rebalance") -> None:
    """K1: Parquet, overwrite, partitioned by ``partition_col`` when present.

    ``layout='rebalance'`` adds a REBALANCE on the partition column: rows of a
    date are gathered so each date gets few, large files, and AQE splits a
    date that is much larger than the advisory partition size across several
    tasks (a hot day does not end up in one task). ``layout='none'`` writes
    from the incoming partitions (one file per task and date, the reference's
    layout).
    """
    has_part = partition_col in df.columns
    out = df
    if has_part and layout == "rebalance":
        out = df.hint("rebalance", partition_col)
    w = out.write.mode("overwrite")
    if has_part:
        w = w.partitionBy(partition_col)
    w.parquet(path)


def scored_path(src: str) -> str:
    """Default scored output: input path with ``.csv`` -> ``_roberta_sentiment.csv``."""
    return src.replace(".csv", SCORED_SUFFIX)


def write_scored(df: DataFrame, path: str | None = None, src: str | None = None) -> str:
    """K2: CSV with header. Leading/trailing spaces are kept (Spark's writer
    trims them by default) and ``"`` is escaped by doubling, so the scan of S1
    reads back exactly what was written. Arrays are written as JSON text."""
    target = path or scored_path(src or "")
    if not target:
        raise ValueError("an output path or a source path is required")
    cols = [
        F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct") else F.col(f.name)
        for f in df.schema.fields
    ]
    (
        df.select(*cols)
        .write.mode("overwrite")
        .option("header", "true")
        .option("escape", '"')
        .option("quote", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(target)
    )
    return target


def write_json(df: DataFrame, path: str) -> None:
    """K4 sink: JSON lines under a run key (see ``functions.uri.run_path``)."""
    df.write.mode("overwrite").json(path)
