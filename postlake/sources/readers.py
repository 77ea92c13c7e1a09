"""Scans (S1-S7). Every path is a Hadoop-FS URI (``s3a://``, ``hdfs://``,
``file:``), so the reference's download/upload steps become plain reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import PANDAS_NA_VALUES
from ..functions.text import is_blank


def csv_options(multiline: bool = True) -> dict[str, str]:
    """Options of the raw posts scan: header, ``"`` as quote and escape,
    embedded commas/quotes/newlines, PERMISSIVE (short rows null-padded, long
    rows truncated)."""
    return {
        "header": "true",
        "multiLine": "true" if multiline else "false",
        "escape": '"',
        "quote": '"',
        "mode": "PERMISSIVE",
    }


def read_posts_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    multiline: bool = True,
    rebalance: bool = True,
) -> DataFrame:
    """Every column as a string, no type inference.

    A multi-line CSV file cannot be split, so the scan has one task per file
    whatever its size. ``rebalance`` deals its rows out again in partitions of
    the advisory size (adaptive execution sizes them by the data), so that the
    per-row work that follows does not stay in those tasks.
    """
    reader = spark.read.options(**csv_options(multiline))
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = reader.csv(path if isinstance(path, str) else list(path))
    return df.hint("rebalance") if rebalance and multiline else df


def read_table(spark: SparkSession, path: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """Parquet input table, in its file splits. ``partitions`` deals the rows
    out to so many, for a table of few row groups and much work per row."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else list(path)))
    return df.repartition(partitions) if partitions else df


def na_to_null(df: DataFrame, na_values: Sequence[str] = PANDAS_NA_VALUES, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing-value tokens -> null, as the pandas CSV reader does."""
    cols = set(columns or df.columns)
    na = list(na_values)
    return df.select(
        *[
            F.when(F.col(c).isin(*na), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
            if c in cols and isinstance(df.schema[c].dataType, T.StringType)
            else F.col(c)
            for c in df.columns
        ]
    )


def read_text_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    na_values: Sequence[str] | None = PANDAS_NA_VALUES,
    multiline: bool = True,
) -> DataFrame:
    """Scan for the scoring / training inputs; NA tokens become null."""
    df = read_posts_csv(spark, path, multiline=multiline)
    return na_to_null(df, na_values) if na_values else df


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """S3: fail before any action when a required column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{', '.join(repr(m) for m in missing)} column not found in input")
    return df


def nonblank_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """text not null and not blank (Unicode whitespace, as ``str.strip``)."""
    return df.filter(~is_blank(text_col))


def read_raw(spark: SparkSession, uri: str, fmt: str = "csv", **kw) -> DataFrame:
    """One URI into ``spark.read``; ``csv`` uses the posts scan,
    ``parquet`` the table scan (a landed raw zone: splittable, parsed once),
    anything else the named Spark source."""
    if fmt == "csv":
        return read_posts_csv(spark, uri, **kw)
    if fmt == "parquet":
        return read_table(spark, uri, **kw)
    return spark.read.format(fmt).load(uri)


def read_whole_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per file with its whole UTF-8 content (``path, value``)."""
    df = spark.read.text(path if isinstance(path, str) else list(path), wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value"))


def read_clean(spark: SparkSession, path: str, dates: Sequence[str] | None = None, start=None, end=None) -> DataFrame:
    """The date-partitioned clean table; date predicates become partition
    filters, so only the named ``tweet_date=...`` folders are listed/read."""
    df = spark.read.parquet(path)
    if dates:
        df = df.filter(F.col("tweet_date").isin(*[F.lit(d).cast("date") for d in dates]))
    if start is not None:
        df = df.filter(F.col("tweet_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("tweet_date") <= F.lit(end).cast("date"))
    return df
