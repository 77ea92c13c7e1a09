"""Incremental clean job over landed files (Structured Streaming)."""

import pytest
from pyspark.sql import functions as F

from locations import SF_MID
from postlake.operators.clean import clean_posts
from postlake.plans.fixtures import RAW_COLUMNS, raw_posts_strings
from postlake.session import scratch_path
from postlake.sources.writers import write_scored
from postlake.streaming.clean_stream import run_once, start_clean_stream


def test_incremental_clean_matches_batch(spark):
    raw = raw_posts_strings(spark, SF_MID)
    land = scratch_path(spark, "landing")
    out = scratch_path(spark, "stream_out")
    ckpt = scratch_path(spark, "stream_ckpt")
    originals = raw.filter(F.col("post_id").cast("long") < 1000000)
    reposts = raw.filter(F.col("post_id").cast("long") >= 1000000)
    write_scored(originals, f"{land}/part1")
    run_once(spark, f"{land}/*", out, RAW_COLUMNS, ckpt)
    first = spark.read.parquet(out).count()
    write_scored(reposts, f"{land}/part2")  # duplicates of earlier posts after URL removal
    run_once(spark, f"{land}/*", out, RAW_COLUMNS, ckpt)
    total = spark.read.parquet(out)
    batch = clean_posts(raw)
    assert total.count() == batch.count() == 760
    assert first == total.count()  # every repost was a duplicate of a post from the first batch
    keys = ["user_name", "tweet_ts", "text_clean"]
    assert total.select(*keys).exceptAll(batch.select(*keys)).count() == 0


def test_a_stream_without_its_checkpoint_is_refused(spark):
    with pytest.raises(ValueError):
        start_clean_stream(spark, "/nowhere", "/nowhere/out", RAW_COLUMNS, "")
    with pytest.raises(TypeError):
        start_clean_stream(spark, "/nowhere", "/nowhere/out", RAW_COLUMNS)
