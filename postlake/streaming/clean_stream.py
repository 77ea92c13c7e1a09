"""Incremental clean job: the J1 operators over newly landed raw files.

The reference has no streaming; its pipeline lands CSV files in ``raw/`` and
cleans them in batch. This is the same clean stage run with Structured
Streaming over the landing folder, so each new file is cleaned once:

* the parse, cast, text and hashtag expressions are the batch ones
  (stateless, they run unchanged on a streaming DataFrame);
* the global dedup is a streaming ``dropDuplicates`` on the same keys (the
  first arriving row survives), exact across all batches: one state entry per
  key is kept (use the RocksDB state store for large tables);
* the caller names the checkpoint folder. It holds what has been read and
  which keys were seen; a run with another folder would not know the files
  that the sink has already committed;
* the sink is the date-partitioned Parquet table, written by the file sink
  with its own commit log under the checkpoint folder (exactly-once across
  restarts and lost executors).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.constants import CLEAN_COLUMNS, DEDUP_KEYS
from ..operators.clean import nonnegative_counts, typed_posts, valid_posts
from ..sources.readers import csv_options


def clean_stream_frame(
    spark: SparkSession,
    input_dir: str,
    columns: Sequence[str],
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of clean posts from CSV files landing in ``input_dir``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.readStream.schema(schema).options(**csv_options())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(input_dir)
    typed = nonnegative_counts(valid_posts(typed_posts(raw)))
    out_cols = [c for c in CLEAN_COLUMNS if c in typed.columns]
    keys = [c for c in DEDUP_KEYS if c in typed.columns]
    x = typed.select(*out_cols)
    if len(keys) >= 2:
        x = x.dropDuplicates(keys)
    return x


def start_clean_stream(
    spark: SparkSession,
    input_dir: str,
    output_path: str,
    columns: Sequence[str],
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the incremental clean job. ``available_now`` processes what has
    landed and stops (a scheduled run); otherwise it keeps running with
    ``processing_time`` triggers."""
    if not checkpoint:
        raise ValueError("a stream needs the same checkpoint folder on every run")
    df = clean_stream_frame(spark, input_dir, columns)
    w = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("tweet_date")
        .outputMode("append")
    )
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(output_path)


def run_once(spark: SparkSession, input_dir: str, output_path: str, columns: Sequence[str], checkpoint: str, **kw) -> None:
    """One scheduled increment: process every new file, then stop."""
    q = start_clean_stream(spark, input_dir, output_path, columns, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
