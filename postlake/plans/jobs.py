"""End-to-end jobs (J1-J4) and their command-line entry points.

Run with ``python -m postlake <job> ...`` locally, or on a cluster with
``spark-submit --py-files postlake.zip scripts/run_job.py <job> ...``.
"""

from __future__ import annotations

import argparse
import importlib
import json
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import (
    CLI_ITERATIONS,
    CONFIDENCE_THRESHOLD,
    LABEL_TO_ID,
    SEED,
    TRAIN_BATCH_SIZE,
    TRAIN_EPOCHS,
)
from ..functions.text import is_blank
from ..operators.clean import StageCounts, clean_posts
from ..operators.metrics import label_distribution
from ..operators.sampling import sample_exact
from ..operators.scoring import Scorer, score_posts
from ..operators.training import SelfTrainResult, load_model, self_train
from ..session import drop_path, is_folder, scratch_path
from ..sources.ingest import ingest_manifest, land_raw, list_files, pick_input_file, route_source
from ..sources.readers import nonblank_text, read_raw, read_text_csv, require_columns
from ..sources.writers import write_clean, write_scored


def clean_job(
    spark: SparkSession,
    input_path: str | None = None,
    output_path: str | None = None,
    order_by: Sequence[str] | None = None,
    layout: str = "rebalance",
    input_format: str = "csv",
) -> dict:
    """Raw CSV -> typed, cleaned, filtered, deduplicated Parquet
    partitioned by ``tweet_date``. Paths come from the arguments or from
    ``spark.etl.input`` / ``spark.etl.output``.

    ``input_format='parquet'`` reads a raw zone landed by ``land_raw``
    instead: the same all-string rows, parsed once at landing and splittable
    by row group, where a multi-line CSV is one task per file on every run.

    The result has the paths, the seconds, and the rows read (``total``), valid and
    written, counted as they are written."""
    paths = {
        "input": input_path or spark.conf.get("spark.etl.input", None),
        "output": output_path or spark.conf.get("spark.etl.output", None),
    }
    if unknown := [name for name, path in paths.items() if not path]:
        raise ValueError("; ".join(f"no {n} path: give --{n} or set spark.etl.{n}" for n in unknown))
    t0 = time.time()
    raw = read_raw(spark, paths["input"], input_format)
    counts = StageCounts()
    out = clean_posts(raw, order_by=order_by, counts=counts)
    write_clean(out, paths["output"], layout=layout)
    return {**paths, "seconds": time.time() - t0, **counts.read()}


def read_texts(spark: SparkSession, path: str, input_format: str = "csv") -> DataFrame:
    """The input of the model jobs: a text CSV, or a Parquet table such as the clean one."""
    return read_text_csv(spark, path) if input_format == "csv" else read_raw(spark, path, input_format)


def named_scorer(spec: str) -> Scorer:
    """A scorer by import path: ``package.module:name``, where the name is a
    scorer or makes one when called."""
    module, _, name = spec.partition(":")
    if not name:
        raise ValueError(f"{spec!r} does not name a scorer; write package.module:name")
    found = getattr(importlib.import_module(module), name)
    made = found if isinstance(found, Scorer) else found()
    if not isinstance(made, Scorer):
        raise TypeError(f"{spec!r} gave a {type(made).__name__}, not a scorer")
    return made


def sentiment_job(
    spark: SparkSession,
    csv_path: str | None,
    scorer: Scorer,
    output_path: str | None = None,
    sample_size: int | None = None,
    text_col: str = "text",
    id_cols: Sequence[str] | None = None,
    source: DataFrame | None = None,
    seed: int = SEED,
    id2label: dict[int, str] | None = None,
    input_format: str = "csv",
    report: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scan -> sample -> non-blank -> score -> distribution -> CSV sink.

    Sampling happens before the blank filter (so the result can hold fewer
    than ``sample_size`` rows), as in the reference. ``source`` lets a caller
    pass an already-read table (e.g. the clean table with ``text_clean``).
    Returns (scored rows, label distribution), both of a table that the job
    writes once below the shared folder; nothing is cached. ``report`` gets the rows
    taken (``total``), those with a text (``valid``) and those that got a label
    (``labelled``), counted by that write.
    """
    df = source if source is not None else read_texts(spark, csv_path, input_format)
    require_columns(df, text_col)
    landed = None
    if sample_size:
        if source is None and input_format == "csv":
            # the sample reads the ids several times: parse the CSV once
            landed = scratch_path(spark, "sentiment-input")
            df.write.parquet(landed)
            df = spark.read.parquet(landed)
        df = sample_exact(df, sample_size, list(id_cols or df.columns), seed)
    kept = scratch_path(spark, "sentiment-scored")
    counts = StageCounts()
    taken = counts.mark(df, total=F.lit(True), valid=~is_blank(text_col))
    named = score_posts(nonblank_text(taken, text_col), scorer, text_col, id2label)
    counts.mark(named, labelled=F.col("sentiment").isNotNull()).write.parquet(kept)
    if report is not None:
        report.update(counts.read())
    if landed:
        drop_path(spark, landed)
    scored = spark.read.parquet(kept)
    if output_path is not None or csv_path:
        write_scored(scored, output_path, src=csv_path)
    return scored, label_distribution(scored, "sentiment")


def self_train_job(
    spark: SparkSession,
    labeled: str,
    unlabeled: str,
    labeled_size: int | None = None,
    unlabeled_size: int | None = None,
    confidence: float = CONFIDENCE_THRESHOLD,
    iterations: int = CLI_ITERATIONS,
    output_dir: str | None = None,
    batch_size: int = TRAIN_BATCH_SIZE,
    teacher: Scorer | None = None,
    text_col: str = "text",
    id_cols: Sequence[str] | None = None,
    input_format: str = "csv",
    **kw,
) -> SelfTrainResult:
    """Text inputs -> self-training -> saved model + metrics.

    All rows are used unless a size is given. The model goes to ``output_dir``,
    below the shared folder without one. A missing input path fails in
    ``spark.read`` itself. Without an id column the rows are identified by
    their text; copies of a text are told apart by the whole row. The result's
    ``counts`` have the rows read and valid of both inputs, those used, and those
    accepted in each round, counted by the writes that the job does anyway.
    """
    ids = list(id_cols or [text_col])
    lab = read_texts(spark, labeled, input_format)
    require_columns(lab, "sentiment", text_col, *ids)
    unl = read_texts(spark, unlabeled, input_format)
    require_columns(unl, text_col, *ids)
    used = list(dict.fromkeys([*ids, text_col]))
    # sampling reads each input several times: keep the columns used, parsed once
    held, counts = [], StageCounts()
    some = F.col("sentiment").isin(list(LABEL_TO_ID))
    taken = (
        counts.mark(lab.select(*used, "sentiment"), labelled_total=F.lit(True), labelled_valid=some),
        counts.mark(unl.select(*used), unlabelled_total=F.lit(True), unlabelled_valid=~is_blank(text_col)),
    )
    for df in taken:
        held.append(scratch_path(spark, "self-train-input"))
        df.write.parquet(held[-1])
    try:
        done = self_train(
            spark.read.parquet(held[0]),
            spark.read.parquet(held[1]),
            text_col=text_col,
            id_cols=ids,
            labelled_size=labeled_size,
            unlabelled_size=unlabeled_size,
            threshold=confidence,
            iterations=iterations,
            teacher=teacher,
            output_dir=output_dir or scratch_path(spark, "best_model"),
            batch_size=batch_size,
            **kw,
        )
        done.counts = {**counts.read(), **done.counts}
        return done
    finally:
        for path in held:
            drop_path(spark, path)


def ingest_job(spark: SparkSession, event: dict, raw_root: str, base: str | None = None) -> DataFrame:
    """Route the event's source, land the chosen CSV in ``raw/`` and return
    its manifest row (with the landed record count). A CSV may be a folder of part
    files, as Spark writes it: it lands as one table, with their sizes added up."""
    uri, tag, dataset, source_uri = route_source(event, base)
    if tag == "kaggle":
        picked = pick_input_file(spark, uri, event.get("kaggle_file"))
        uri = picked["path"]
    name = uri.rstrip("/").rsplit("/", 1)
    if is_folder(spark, uri):
        parts = list_files(spark, uri)
        files = parts.agg(F.sum("length").alias("length")).select(F.lit(uri).alias("path"), F.lit(name[1]).alias("file_name"), "length")
    else:
        files = list_files(spark, name[0], glob=name[1])
    landed = land_raw(spark, uri, raw_root)
    n = spark.read.parquet(landed).count()
    return ingest_manifest(files, tag, raw_root, dataset, source_uri).withColumn("record_count", F.lit(n))


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="postlake")
    sub = ap.add_subparsers(dest="job", required=True)
    c = sub.add_parser("clean", help="raw CSV -> clean partitioned Parquet")
    c.add_argument("--input")
    c.add_argument("--output")
    c.add_argument("--input-format", default="csv", choices=["csv", "parquet"],
                   help="parquet: a raw zone landed by the ingest job")
    g = sub.add_parser("ingest", help="land a raw CSV and show its manifest")
    g.add_argument("--source", default="test", choices=["test", "kaggle", "production"])
    g.add_argument("--location", help="CSV path or s3:// location (source test)")
    g.add_argument("--dataset", help="dataset name (source kaggle)")
    g.add_argument("--path", help="folder that the dataset's files are in (source kaggle)")
    g.add_argument("--file", help="the file to take from it (source kaggle)")
    g.add_argument("--raw-root", required=True, help="the raw zone; the file lands in its raw/ folder")
    sc = sub.add_parser("score", help="score texts; write scored CSV + distribution")
    sc.add_argument("--input", required=True)
    model = sc.add_mutually_exclusive_group(required=True)
    model.add_argument("--model", help="model saved by self-train (--output-dir)")
    model.add_argument("--scorer", help="scorer by import path, package.module:name")
    sc.add_argument("--output", default=None, help="default: input with .csv -> _roberta_sentiment.csv")
    sc.add_argument("--sample-size", type=int, default=None)
    sc.add_argument("--text-col", default="text")
    sc.add_argument("--input-format", default="csv", choices=["csv", "parquet"])
    sc.add_argument("--labels", default=None, help="class names by id, as JSON: {\"0\": \"negative\", ...}")
    s = sub.add_parser("self-train", help="self-training with labelled + pseudo-labelled data")
    s.add_argument("--labeled", "-l", required=True)
    s.add_argument("--unlabeled", "-u", required=True)
    s.add_argument("--labeled-size", type=int, default=None)
    s.add_argument("--unlabeled-size", type=int, default=None, help="default: all rows")
    s.add_argument("--confidence", "-c", type=float, default=CONFIDENCE_THRESHOLD)
    s.add_argument("--iterations", "-i", type=int, default=CLI_ITERATIONS)
    s.add_argument("--output-dir", "-o", default=None, help="default: below spark.checkpoint.dir")
    s.add_argument("--batch-size", "-b", type=int, default=TRAIN_BATCH_SIZE)
    s.add_argument("--epochs", type=int, default=TRAIN_EPOCHS, help="steps in each round")
    s.add_argument("--teacher", default=None, help="first scorer by import path, package.module:name")
    s.add_argument("--text-col", default="text")
    s.add_argument("--input-format", default="csv", choices=["csv", "parquet"])
    return ap


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    # spark-submit supplies the master; a plain `python -m` run gets local[*]
    spark = SparkSession.builder.appName(f"postlake-{args.job}").getOrCreate()
    if args.job == "clean":
        print(clean_job(spark, args.input, args.output, input_format=args.input_format))
    elif args.job == "ingest":
        event = {"source": args.source, "kaggle_dataset": args.dataset, "kaggle_path": args.path, "kaggle_file": args.file}
        if args.location:
            event["test_data_location"] = args.location
        ingest_job(spark, event, args.raw_root).show(truncate=False)
    elif args.job == "score":
        scorer = named_scorer(args.scorer) if args.scorer else load_model(args.model)
        names = {int(k): v for k, v in json.loads(args.labels).items()} if args.labels else None
        _, dist = sentiment_job(
            spark, args.input, scorer, args.output, args.sample_size, args.text_col, id2label=names, input_format=args.input_format
        )
        dist.show(truncate=False)
    else:
        res = self_train_job(
            spark,
            args.labeled,
            args.unlabeled,
            args.labeled_size,
            args.unlabeled_size,
            args.confidence,
            args.iterations,
            args.output_dir,
            args.batch_size,
            named_scorer(args.teacher) if args.teacher else None,
            args.text_col,
            input_format=args.input_format,
            epochs=args.epochs,
        )
        print("rows:", res.counts)
        print("labelled rows by class:", res.label_counts)
        res.metrics.show(truncate=False)


if __name__ == "__main__":
    main()
