"""Inputs derived by Spark from the given tables (see FIXTURES.md).

``raw_posts`` turns every ``documents`` row into a raw social post (plus a
repost for one document in ten), covering the edge cases of the clean job.
The labelled / unlabelled sets come from ``labels`` and ``documents``.
The SQL strings are the oracle forms run by DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import read_table

# Select list shared by the Spark and DuckDB forms; `d` is documents and
# `k.off` is 0 for the original post and 1000000 for its repost.
RAW_POSTS_SELECT = """
  d.doc_id + k.off as post_id,
  case when doc_id % 23 = 0 then null else concat('user', cast(doc_id % 40 as string)) end as user_name,
  case when doc_id % 21 = 0 then null else concat('  ', upper(lang), '   Region ', cast(doc_id % 7 as string), ' ') end as user_location,
  concat('bio ', source) as user_description,
  concat(lpad(cast(1 + doc_id % 28 as string), 2, '0'), '-01-2015 08:30') as user_created,
  case when doc_id % 13 = 0 then '-5' when doc_id % 11 = 0 then '834.0' when doc_id % 29 = 0 then 'abc'
       when doc_id % 31 = 0 then null else cast(doc_id * 37 % 10007 as string) end as user_followers,
  cast(doc_id % 900 as string) as user_friends,
  case when doc_id % 41 = 0 then '-1' else cast(doc_id % 3000 as string) end as user_favourites,
  case doc_id % 7 when 0 then 'True' when 1 then 'false' when 2 then '1' when 3 then 'NO'
       when 4 then 'y' when 5 then 'maybe' else null end as user_verified,
  case when doc_id % 17 = 0 then '2020-08-18 12:55:00' when doc_id % 19 = 0 then null
       else concat(lpad(cast(1 + doc_id % 28 as string), 2, '0'), '-', lpad(cast(1 + doc_id % 12 as string), 2, '0'),
                   '-2021 ', lpad(cast(doc_id % 24 as string), 2, '0'), ':', lpad(cast(doc_id % 60 as string), 2, '0'))
       end as date,
  case when doc_id % 43 = 0 then null
       when doc_id % 37 = 0 then concat('@user', cast(doc_id % 40 as string), '  https://t.co/', cast(doc_id as string))
       else concat('RT @user', cast(doc_id % 40 as string), ':   ', chr(34), text, chr(34), ', via www.example.com/',
                   cast(k.off as string), ' https://t.co/', cast(doc_id as string)) end as text,
  case when doc_id % 5 = 0 then null when doc_id % 5 = 1 then '[]'
       else concat('[', chr(39), upper(lang), chr(39), ' , ', chr(39), 'Tag', cast(doc_id % 9 as string), chr(39), ',', chr(39), chr(39), ']')
       end as hashtags,
  source,
  case doc_id % 4 when 0 then 'False' when 1 then 'true' when 2 then '0' else null end as is_retweet
"""

# DuckDB form: the two copies come from a join with a two-row table.
RAW_POSTS_SQL = f"""
select {RAW_POSTS_SELECT}
from documents d join (select 0 as off union all select 1000000 as off) k
  on k.off = 0 or d.doc_id % 10 = 3
"""

RAW_COLUMNS = [
    "post_id",
    "user_name",
    "user_location",
    "user_description",
    "user_created",
    "user_followers",
    "user_friends",
    "user_favourites",
    "user_verified",
    "date",
    "text",
    "hashtags",
    "source",
    "is_retweet",
]

LABELLED_SQL = """
select l.doc_id, d.text,
  case when l.toxic = 1 then 'negative' when l.quality = 1 then 'positive' else 'neutral' end as sentiment
from labels l join documents d on l.doc_id = d.doc_id
"""

UNLABELLED_SQL = """
select d.doc_id, d.text from documents d
where not exists (select 1 from labels l where l.doc_id = d.doc_id)
"""


def table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", partitions)


def raw_posts(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """All-string raw posts, one scan of ``documents``.

    The repost copy is produced by ``explode`` on a per-row array instead of a
    join with a two-row table, so the plan is a single narrow stage.
    """
    docs = table(spark, sf_dir, "documents", partitions)
    return spark.sql(
        f"""
        select {RAW_POSTS_SELECT}
        from {{docs}} d
        lateral view explode(case when doc_id % 10 = 3 then array(0, 1000000) else array(0) end) k as off
        """,
        docs=docs,
    )


def raw_posts_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_posts`` with ``post_id`` as text too: the exact shape of a raw CSV."""
    return raw_posts(spark, sf_dir).withColumn("post_id", F.col("post_id").cast("string"))


def labelled(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """``doc_id, text, sentiment`` for every labelled document.

    A shuffle join on ``doc_id`` at scale; Catalyst/AQE broadcasts ``labels``
    only when its measured size is under the broadcast threshold.
    """
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents", partitions).select("doc_id", "text")
    sentiment = (
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    )
    return lab.join(docs, "doc_id").select("doc_id", "text", sentiment.alias("sentiment"))


def unlabelled(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """``doc_id, text`` of documents without a label (left anti join)."""
    lab = table(spark, sf_dir, "labels").select("doc_id")
    docs = table(spark, sf_dir, "documents", partitions).select("doc_id", "text")
    return docs.join(lab, "doc_id", "left_anti")
