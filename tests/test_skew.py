"""Hot keys: a third of the rows on one dedup key, most rows on one date."""

import os

from pyspark.sql import functions as F

from postlake.operators.clean import dedup_posts
from postlake.session import scratch_path
from postlake.sources.writers import write_clean


def hot_frame(spark, n=30000):
    # one key (user0, same ts, same text) holds a third of the rows
    return spark.range(n, numPartitions=8).select(
        F.col("id").alias("post_id"),
        F.when(F.col("id") % 3 == 0, F.lit("user0")).otherwise(F.concat(F.lit("u"), F.col("id").cast("string"))).alias("user_name"),
        F.when(F.col("id") % 3 == 0, F.lit("2021-01-01 00:00:00").cast("timestamp"))
        .otherwise((F.lit(1609459200) + F.col("id")).cast("timestamp"))
        .alias("tweet_ts"),
        F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text_clean"),
        (F.col("id") * 7 % 1000).alias("user_followers"),
    )


def test_hot_key_dedup_is_partial_and_correct(spark):
    df = hot_frame(spark)
    out = dedup_posts(df, order_by=["post_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(struct" in plan  # combined map-side before the exchange
    rows = out.filter(F.col("user_name") == "user0").collect()
    assert len(rows) == 1 and rows[0].post_id == 0
    assert out.count() == 20000 + 1


def test_hot_date_is_split_across_files(spark):
    df = hot_frame(spark, 60000).withColumn(
        "tweet_date", F.when(F.col("post_id") % 10 != 0, F.lit("2021-01-01")).otherwise(F.lit("2021-01-02")).cast("date")
    ).withColumn("pad", F.repeat(F.lit("x"), 200))
    out = scratch_path(spark, "hot_date")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        write_clean(df, out)
    finally:
        spark.conf.set(key, old)
    hot = os.path.join(out.replace("file:", ""), "tweet_date=2021-01-01")
    files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
    assert len(files) > 1  # the hot day was split over several tasks
    assert spark.read.parquet(out).count() == 60000


def hot_copies(spark, n=30000):
    # a third of the rows are copies of one id (7); label in 0..2
    return spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
        (F.col("id") % 5).alias("v"),
        (F.col("id") % 2).cast("int").alias("label_id"),
    )


def _md5_order(ids, seed=42):
    import hashlib

    return sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{len(str(i))}:{i}".encode()).hexdigest())


def _no_single_task(df):
    """Only aggregates of one row meet in one task."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "Aggregate" in lines[i + 1], line


def test_sample_exact_hot_copies_stays_distributed(spark):
    from postlake.operators.sampling import sample_exact

    df = hot_copies(spark)
    ids = [r.doc_id for r in df.select("doc_id").collect()]
    for n in (12000, 3000, 25000):
        out = sample_exact(df, n, ["doc_id"])
        _no_single_task(out)
        got = sorted(r.doc_id for r in out.select("doc_id").collect())
        assert got == sorted(_md5_order(ids)[:n])  # brute force: first n in hash order


def test_stratified_split_hot_copies_quotas(spark):
    from postlake.operators.sampling import split_quotas, stratified_split

    df = hot_copies(spark)
    out = stratified_split(df, "label_id", ["doc_id"])
    _no_single_task(out)
    assert out.count() == 30000
    counts = {r.label_id: r["count"] for r in df.groupBy("label_id").count().collect()}
    quotas = split_quotas(counts)
    got = {r.label_id: r["n"] for r in out.filter("is_train").groupBy("label_id").agg(F.count("*").alias("n")).collect()}
    assert got == quotas
    # within each class the train rows are the first in hash order (brute force)
    rows = df.collect()
    for lab, q in quotas.items():
        ids = [r.doc_id for r in rows if r.label_id == lab]
        want = sorted(_md5_order(ids)[:q])
        have = sorted(r.doc_id for r in out.filter(F.col("is_train") & (F.col("label_id") == lab)).collect())
        assert have == want
