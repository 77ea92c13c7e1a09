"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next stage
gets it written as Parquet and read again. All but the last keep the columns of
their input, whatever their names; only ``text`` and ``doc_id`` are read. Texts
are judged whole, very long ones too. An empty table passes every stage empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import langid, packing, quality, simhash
from postlake.llm.common import crc_fold, drop, fresh, materialise, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go; so do null and empty texts and
    those without a letter. Repeated rows fare alike. Passages of very long texts
    are learned from. Without a labelled row no language is known, and all go."""
    model = langid.fit(docs, crc_fold(F.col("doc_id"), 3) != 1)
    found = fresh(docs, "found")
    return docs.withColumn(found, langid.identify(docs, model)).where(~F.col(f"{found}.rejected")).drop(found)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer calls bad go; so do null texts and those without a
    word. Repeated rows fare alike and count each in the labellers' statistics."""
    found = fresh(docs, "found")
    return docs.withColumn(found, quality.judge(docs, quality.fit(docs))).where(F.col(f"{found}.keep")).drop(found)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, the one with the smallest doc_id stays,
    or one of them where none has a doc_id; of rows that share both, the first
    written. Null and empty texts and those without a word are copies of one another."""
    return simhash.keep_one(docs, words=3, distance=3, keyless_stay=False)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids, each with its place in a sequence. A null
    or empty text is the end id alone; a very long one is cut into many pieces. A
    null doc_id is carried along."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("packing", sequence_packing),
]

#: Trained models and tokenizers are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over what the one before kept; each but the last is written
    below ``spark.checkpoint.dir``, and deleted once its successor is."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        written: list[str] = []
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}", written)
        drop(spark, before)
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
