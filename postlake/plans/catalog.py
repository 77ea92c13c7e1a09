"""

Each takes ``(spark, sf_dir)`` and returns a DataFrame computed from the given
tables over their whole contents. For the value comparison with DuckDB,
timestamps are emitted as ``timestamp_ntz``, arrays as ``'|'``-joined text
plus their size, and doubles rounded to 6 decimals; ``oracle.py`` holds the
matching SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import (
    argmax,
    clean_location,
    clean_text,
    confidence,
    derive_date,
    hashtags_str,
    label_id,
    model_text,
    parse_hashtags,
    parse_ts,
    run_key,
    softmax,
    split_s3_uri,
    strip_mentions,
    strip_urls,
    to_bool,
    to_long,
    truncate_tokens,
)
from ..functions.constants import CLEAN_COLUMNS, COUNT_COLUMNS, ID_TO_LABEL, LABEL_TO_ID, MAX_TOKENS, SEED, TRAIN_BATCH_SIZE, TRAIN_EPOCHS
from ..functions.subwords import truncate_subwords
from ..operators.clean import clean_posts, dedup_posts, nonnegative_counts, typed_posts, valid_posts
from ..operators.metrics import acceptance, best_step, eval_report, label_distribution, stage_counts
from ..operators.sampling import order_key, sample_exact, stratified_split
from ..operators.scoring import (
    LOGITS,
    LetterShareScorer,
    letter_share_factory,
    pseudo_label,
    score_batches,
    score_posts,
)
from ..operators.training import (
    StepTrainer,
    combine_train,
    evaluation_rows,
    load_model,
    prepare_labelled,
    prepare_unlabelled,
    self_train,
    threshold_schedule,
    without_labelled,
)
from ..session import scratch_path
from ..sources.ingest import (
    RAW_FILE_SIZE,
    RAW_RECORD,
    envelope,
    ingest_manifest,
    land_raw,
    select_input_file,
    write_envelope_json,
)
from ..sources.readers import nonblank_text, read_clean, read_posts_csv, read_text_csv, read_whole_text
from ..sources.writers import write_clean, write_scored
from .fixtures import RAW_COLUMNS, labelled, raw_posts, raw_posts_strings, table, unlabelled
from .jobs import clean_job, ingest_job, self_train_job, sentiment_job

R6 = 6
SAMPLE_N = 500
THRESHOLD = 0.9
ROUNDS = 3
DATE_FROM, DATE_TO = "2021-03-01", "2021-06-30"
PICK_NAME = "960"


def _ntz(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def _r(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, R6)


def _comparable(df: DataFrame) -> DataFrame:
    """Timestamps -> ntz, arrays -> joined text + size, doubles -> 6 decimals."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t == "timestamp":
            out.append(_ntz(f.name).alias(f.name))
        elif t == "array":
            out += [F.array_join(f.name, "|").alias(f.name), F.size(f.name).alias(f"n_{f.name}")]
        elif t in ("double", "float"):
            out.append(_r(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# --- clean stage ---------------------------------------------------------------


def q_clean_posts(spark, sf):
    return _comparable(clean_posts(raw_posts(spark, sf), order_by=["post_id"]))


def q_parse_timestamps(spark, sf):
    r = raw_posts(spark, sf)
    return r.select("post_id", _ntz(parse_ts("date")).alias("tweet_ts"), _ntz(parse_ts("user_created")).alias("user_created_ts"))


def q_cast_counts(spark, sf):
    r = raw_posts(spark, sf)
    return r.select("post_id", *[to_long(c).alias(c) for c in COUNT_COLUMNS])


def q_parse_booleans(spark, sf):
    r = raw_posts(spark, sf)
    return r.select("post_id", to_bool("user_verified").alias("user_verified"), to_bool("is_retweet").alias("is_retweet"))


def q_strip_urls(spark, sf):
    return raw_posts(spark, sf).select("post_id", strip_urls("text").alias("text_no_urls"))


def q_strip_mentions(spark, sf):
    return raw_posts(spark, sf).select("post_id", strip_mentions("text").alias("text_no_mentions"))


def q_clean_text(spark, sf):
    return raw_posts(spark, sf).select("post_id", F.col("text").alias("text_raw"), clean_text("text").alias("text_clean"))


def q_parse_hashtags(spark, sf):
    r = raw_posts(spark, sf)
    arr = parse_hashtags("hashtags")
    return r.select(
        "post_id",
        hashtags_str("hashtags").alias("hashtags_str"),
        F.array_join(arr, "|").alias("hashtags_arr"),
        F.size(arr).alias("n_hashtags_arr"),
    )


def q_clean_location(spark, sf):
    return raw_posts(spark, sf).select("post_id", clean_location("user_location").alias("user_location_clean"))


def q_derive_date(spark, sf):
    return raw_posts(spark, sf).select("post_id", derive_date(parse_ts("date")).alias("tweet_date"))


def q_valid_posts(spark, sf):
    v = valid_posts(typed_posts(raw_posts(spark, sf)))
    return v.select("post_id", _ntz("tweet_ts").alias("tweet_ts"), "text_clean")


def q_nonnegative_counts(spark, sf):
    v = nonnegative_counts(typed_posts(raw_posts(spark, sf)))
    return v.select("post_id", *COUNT_COLUMNS)


def q_dedup_posts(spark, sf):
    v = nonnegative_counts(valid_posts(typed_posts(raw_posts(spark, sf))))
    d = dedup_posts(v.select("post_id", "user_name", "tweet_ts", "text_clean"), order_by=["post_id"])
    return d.select("post_id", "user_name", _ntz("tweet_ts").alias("tweet_ts"), "text_clean")


# --- sources and sinks (round trips through the shared folder) ------------------


def _raw_csv(spark, sf) -> str:
    """raw_posts written as a CSV with the lossless writer options."""
    path = scratch_path(spark, "raw_posts_csv")
    write_scored(raw_posts_strings(spark, sf), path)
    return path


def q_csv_scan_multiline(spark, sf):
    return read_posts_csv(spark, _raw_csv(spark, sf)).select(*RAW_COLUMNS)


def q_csv_scan_na_tokens(spark, sf):
    path = scratch_path(spark, "labelled_csv")
    write_scored(labelled(spark, sf).withColumn("doc_id", F.col("doc_id").cast("string")), path)
    return read_text_csv(spark, path).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "sentiment")


def _ragged_csv(spark, sf) -> str:
    """Posts as ``post_id,source`` lines, a third each with two fields too many,
    with one too few, and as the header has them. Written line by line."""
    path = scratch_path(spark, "ragged_csv")
    r = raw_posts(spark, sf)
    post = F.col("post_id").cast("string")
    line = F.when(F.col("post_id") % 3 == 0, F.concat_ws(",", post, "source", "user_name", F.lit("more"))).when(
        F.col("post_id") % 3 == 1, post).otherwise(F.concat_ws(",", post, "source"))
    writer = r.select(line.alias("post_id,source")).write.option("header", "true").option("sep", chr(1)).option("quote", "")
    writer.csv(path)
    return path


def q_land_raw_rows(spark, sf):
    """All rows of two landed files: one that fits its header, one that doesn't."""
    zone = scratch_path(spark, "raw_zone")
    posts = spark.read.parquet(land_raw(spark, _raw_csv(spark, sf), zone))
    ragged = spark.read.parquet(land_raw(spark, _ragged_csv(spark, sf), zone))
    absent = {c: F.lit(None).cast("string") for c in RAW_COLUMNS if c not in ragged.columns}
    rows = posts.unionByName(ragged.withColumns(absent))
    return rows.select(*RAW_COLUMNS, F.col(RAW_RECORD).alias("raw_record"), (F.col(RAW_FILE_SIZE) > 0).alias("has_file_size"))


def _clean_table(spark, sf) -> str:
    path = scratch_path(spark, "clean")
    write_clean(clean_posts(raw_posts(spark, sf), order_by=["post_id"]), path)
    return path


def q_write_partitioned_roundtrip(spark, sf):
    return _comparable(read_clean(spark, _clean_table(spark, sf)).select(*CLEAN_COLUMNS))


def q_partition_pruned_read(spark, sf):
    df = read_clean(spark, _clean_table(spark, sf), start=DATE_FROM, end=DATE_TO)
    return _comparable(df.select(*CLEAN_COLUMNS))


def q_write_scored_roundtrip(spark, sf):
    scored = _scored_documents(spark, sf)
    path = scratch_path(spark, "scored_csv")
    write_scored(scored.select("doc_id", "sentiment", "sentiment_id", "confidence", "negative_prob", "neutral_prob", "positive_prob"), path)
    back = read_posts_csv(spark, path)
    return back.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "sentiment",
        F.col("sentiment_id").cast("int").alias("sentiment_id"),
        *[_r(F.col(c).cast("double")).alias(c) for c in ("confidence", "negative_prob", "neutral_prob", "positive_prob")],
    )


def q_whole_text_read(spark, sf):
    """Texts written as lines of files by language, and each file read whole:
    its characters are those of its texts and one line end each."""
    path = scratch_path(spark, "texts_by_lang")
    docs = table(spark, sf, "documents")
    docs.select("text", "lang").write.partitionBy("lang").text(path)
    whole = read_whole_text(spark, path + "/*/*.txt")
    lang = F.regexp_extract("path", "/lang=([^/]+)/", 1)
    return whole.groupBy(lang.alias("lang")).agg(F.sum(F.length("value")).alias("n_chars"))


def _listed_pages(spark, sf) -> DataFrame:
    """``pages`` as a file listing: a page's URL is its path, its HTML its bytes."""
    pages = table(spark, sf, "pages")
    name = F.element_at(F.split("url", "/"), -1)
    return pages.select(F.col("url").alias("path"), name.alias("file_name"), F.octet_length("html").cast("bigint").alias("length"))


def q_ingest_manifest(spark, sf):
    m = ingest_manifest(_listed_pages(spark, sf), "test_local", raw_root="raw-zone")
    return m.withColumn("file_size_mb", _r("file_size_mb"))


def q_pick_csv_file(spark, sf):
    """Two picks from one listing: by a name that is listed, and by one that is not."""
    files = _listed_pages(spark, sf)
    named = select_input_file(files, PICK_NAME).select(F.lit("named").alias("pick"), "*")
    return named.unionByName(select_input_file(files, "no such file").select(F.lit("first").alias("pick"), "*"))


def q_record_envelope(spark, sf):
    conv = table(spark, sf, "conversations")
    return envelope(conv, "conversations", "conv_id", more=[F.sum(F.length("text")).alias("total_chars")]).drop("timestamp")


def q_enveloped_records(spark, sf):
    """Every record with its header fields, through the JSON sink; a seventh of
    the conversations have no key."""
    conv = table(spark, sf, "conversations")
    keyed = conv.withColumn("batch", F.when(F.col("conv_id") % 7 != 0, F.col("conv_id")))
    path = write_envelope_json(keyed.select("batch", "conv_id", "turn", "text"), scratch_path(spark, "json_zone"), "conversations", "batch", metadata={"dataset": "chats"})
    back = spark.read.schema("batch bigint, conv_id bigint, turn bigint, text string, source string, record_count bigint, dataset string").json(path)
    return back.select("batch", "conv_id", "turn", F.length("text").alias("n_chars"), "source", "record_count", "dataset")


def q_split_s3_uri(spark, sf):
    pages = table(spark, sf, "pages")
    s3 = F.concat(F.lit("s3://"), F.regexp_replace("url", r"^https?://", ""))
    parts = split_s3_uri(s3)
    return pages.select(
        "page_id",
        parts["bucket"].alias("bucket"),
        parts["key"].alias("key"),
        split_s3_uri("url").isNull().alias("rejected"),
    )


def q_run_key_format(spark, sf):
    r = raw_posts(spark, sf)
    ts = parse_ts("date")
    return r.filter(ts.isNotNull()).select("post_id", run_key(ts).alias("run_key"))


# --- labels, sampling, splitting ---------------------------------------------------


def q_map_labels(spark, sf):
    lab = labelled(spark, sf)
    return lab.select("doc_id", "sentiment", label_id("sentiment").alias("label_id")).filter(F.col("label_id").isNotNull())


def q_model_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", model_text("text").alias("model_text"))


def q_truncate_tokens(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", truncate_tokens("text", 512).alias("model_input"))


def q_nonblank_text(spark, sf):
    return nonblank_text(table(spark, sf, "documents")).select("doc_id", "n_chars")


def q_sample_exact(spark, sf):
    return sample_exact(table(spark, sf, "documents"), SAMPLE_N, ["doc_id"]).select("doc_id", "lang", "source")


def _split(spark, sf) -> DataFrame:
    lab = prepare_labelled(labelled(spark, sf))
    return stratified_split(lab.select("doc_id", "text", "sentiment", "label_id"), "label_id", ["doc_id"])


def q_stratified_split(spark, sf):
    s = _split(spark, sf)
    return s.select("doc_id", "sentiment", F.when(F.col("is_train"), "train").otherwise("val").alias("split"))


def q_stage_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    lab = table(spark, sf, "labels").select("doc_id", F.lit("known").alias("sentiment"))
    return stage_counts(docs.join(lab, "doc_id", "left"))


# --- scoring ------------------------------------------------------------------------


def _scored_documents(spark, sf, scorer=None) -> DataFrame:
    docs = nonblank_text(table(spark, sf, "documents").select("doc_id", "text"))
    return score_posts(docs, scorer or LetterShareScorer(), "text")


def _score_cols(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        "sentiment",
        "sentiment_id",
        *[_r(c).alias(c) for c in ("confidence", "negative_prob", "neutral_prob", "positive_prob")],
    )


def q_score_posts(spark, sf):
    return _score_cols(_scored_documents(spark, sf))


def q_score_posts_truncated(spark, sf):
    """Texts of more than the model's tokens, scored on the first of them."""
    docs = nonblank_text(table(spark, sf, "documents").select("doc_id", "text"))
    long = docs.where(F.size(F.split("text", r"\s+")) > MAX_TOKENS)
    return _score_cols(score_posts(long, LetterShareScorer(max_tokens=MAX_TOKENS), "text"))


def q_score_batches(spark, sf):
    docs = nonblank_text(table(spark, sf, "documents").select("doc_id", "text"))
    x = score_batches(docs, letter_share_factory(), batch_size=32, max_tokens=None)
    return x.select("doc_id", *[_r(F.get(F.col(LOGITS), i)).alias(f"l{i}") for i in range(3)])


def q_softmax_probs(spark, sf):
    e = table(spark, sf, "embeddings")
    p = softmax("embedding")
    x = e.select("vec_id", p.alias("p"))
    return x.select(
        "vec_id",
        argmax("p").alias("argmax"),
        _r(confidence("p")).alias("confidence"),
        _r(F.aggregate("p", F.lit(0.0), lambda a, v: a + v)).alias("prob_sum"),
    )


def q_label_distribution(spark, sf):
    d = label_distribution(_scored_documents(spark, sf), "sentiment")
    return d.select("sentiment", "count", _r("percent").alias("percent"))


def q_sentiment_report(spark, sf):
    """The sentiment job, and the distribution of the labels in the file it wrote."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    path = scratch_path(spark, "sentiment_report")
    sentiment_job(spark, None, LetterShareScorer(), path, SAMPLE_N, id_cols=["doc_id"], source=docs)
    d = label_distribution(read_posts_csv(spark, path), "sentiment")
    return d.select("sentiment", "count", _r("percent").alias("percent"))


def _unlabelled_ready(spark, sf) -> DataFrame:
    return prepare_unlabelled(unlabelled(spark, sf))


def q_pseudo_label_filter(spark, sf):
    p = pseudo_label(_unlabelled_ready(spark, sf), LetterShareScorer(), THRESHOLD)
    return p.select("doc_id", "label_id", _r("confidence").alias("confidence"))


def q_pseudo_acceptance(spark, sf):
    scored = score_posts(
        _unlabelled_ready(spark, sf).withColumn("__m", model_text("text")), LetterShareScorer(), "__m"
    )
    a = acceptance(scored, threshold_schedule(THRESHOLD, ROUNDS))
    return a.select("step", _r("threshold").alias("threshold"), "accepted", "total", _r("percent").alias("percent"))


def q_combine_train(spark, sf):
    train = _split(spark, sf).where("is_train").withColumn("origin", F.lit("train"))
    pseudo = pseudo_label(_unlabelled_ready(spark, sf), LetterShareScorer(), THRESHOLD).withColumn("origin", F.lit("pseudo"))
    return combine_train(train, pseudo, None, ["doc_id", "origin"]).select("doc_id", "label_id", "origin")


def _val_report(spark, sf, batch_size: int = TRAIN_BATCH_SIZE) -> DataFrame:
    val = _split(spark, sf).where(~F.col("is_train"))
    return eval_report(evaluation_rows(LetterShareScorer(), val), LOGITS, "label_id", order_key(["doc_id"]), batch_size)


def q_eval_accuracy(spark, sf):
    return _val_report(spark, sf).select("n", _r("accuracy").alias("accuracy"))


def q_eval_cross_entropy(spark, sf):
    return _val_report(spark, sf).select("n", _r("loss").alias("loss"), _r("loss_batch_mean").alias("loss_batch_mean"))


def q_self_train_round(spark, sf):
    """One round's counts (A1 + A4 + U1): the unlabelled rows scored once and
    flagged, the split once, and one aggregate over both."""
    split = _split(spark, sf).select(F.col("is_train"), F.lit(None).cast("boolean").alias("accepted"))
    model_input = _unlabelled_ready(spark, sf).withColumn("__m", model_text("text"))
    scored = score_posts(model_input, LetterShareScorer(), "__m")
    flagged = scored.select(F.lit(None).cast("boolean").alias("is_train"), (F.col("confidence") >= THRESHOLD).alias("accepted"))
    c = split.unionByName(flagged).agg(
        F.count("accepted").alias("unlabelled"),
        F.count_if("accepted").alias("pseudo"),
        F.count_if("is_train").alias("train"),
        F.count_if(F.coalesce("is_train", "accepted") & (F.col("is_train").isNotNull() | F.col("accepted"))).alias("combined"),
        F.count_if(~F.col("is_train")).alias("validation"),
    )
    pct = F.coalesce(F.try_divide(F.col("pseudo") * F.lit(100.0), F.col("unlabelled")), F.lit(0.0))
    return c.select(
        F.lit(1).alias("step"),
        F.lit(THRESHOLD).cast("double").alias("threshold"),
        "unlabelled",
        "pseudo",
        _r(pct).alias("pseudo_percent"),
        "train",
        "combined",
        "validation",
    )


def _trained(spark, sf):
    """(scorer of the student after its steps, validation rows): steps and weights
    come from the train split alone."""
    s = _split(spark, sf)
    path = scratch_path(spark, "split")
    s.select("doc_id", "text", "sentiment", "label_id", "is_train").write.parquet(path)
    s = spark.read.parquet(path)
    trainer = StepTrainer(spark, TRAIN_EPOCHS, TRAIN_BATCH_SIZE, SEED, len(ID_TO_LABEL), MAX_TOKENS, ["doc_id"])
    rows = trainer.featurize(s.where("is_train"), "text", ["doc_id", "label_id"])
    return trainer.fit(rows, None, lambda scorer: {})[0], s.where(~F.col("is_train"))


def q_train_predict(spark, sf):
    """G7 + G8: the student's label and chances for each validation document, and
    whether the evaluator's loss and accuracy are those of these rows."""
    scorer, val = _trained(spark, sf)
    path = scratch_path(spark, "predictions")
    scored = score_posts(val.withColumn("__m", model_text("text")), scorer, "__m")
    scored.select("doc_id", "label_id", "sentiment_id", *(f"{n}_prob" for n in LABEL_TO_ID)).write.parquet(path)
    rows = spark.read.parquet(path)
    p = F.element_at(F.array(*(f"{n}_prob" for n in LABEL_TO_ID)), F.col("label_id") + 1)
    own = rows.agg(F.avg(-F.ln(p)).alias("own_loss"), F.avg((F.col("sentiment_id") == F.col("label_id")).cast("int")).alias("own_accuracy"))
    report = eval_report(evaluation_rows(scorer, val), LOGITS, "label_id", order_key(["doc_id"]), TRAIN_BATCH_SIZE)
    near = (F.abs(F.col("loss") - F.col("own_loss")) < 1e-6) & (F.abs(F.col("accuracy") - F.col("own_accuracy")) < 1e-9)
    agree = report.select(F.lit(1).alias("k"), "loss", "accuracy").join(own.withColumn("k", F.lit(1)), "k").select("k", near.alias("evaluated_alike"))
    known = F.col("sentiment_id").isin(list(ID_TO_LABEL))
    each = rows.select(F.lit(1).alias("k"), "doc_id", "label_id", known.alias("has_label"), _r(sum((F.col(f"{n}_prob") for n in LABEL_TO_ID), F.lit(0.0))).alias("chances"))
    return each.join(agree, "k").drop("k")


def q_train_predict_rows(spark, sf):
    """The same predictions as they are."""
    scorer, val = _trained(spark, sf)
    scored = score_posts(val.withColumn("__m", model_text("text")), scorer, "__m")
    return scored.select("doc_id", "label_id", "sentiment_id", *(_r(f"{n}_prob").alias(f"{n}_prob") for n in LABEL_TO_ID))


BEST_ROUNDS = 2


def _self_trained(spark, sf, path, **kw):
    return self_train(labelled(spark, sf), unlabelled(spark, sf), threshold=THRESHOLD, iterations=BEST_ROUNDS, teacher=LetterShareScorer(), output_dir=path, **kw)


def q_self_train_best(spark, sf):
    """Two rounds of three steps from the test teacher: each step's counts, whether it
    is the best of its round, that weights went on, and that the saved model (the
    best step of all, as asked for) scores as the one in hand."""
    path = scratch_path(spark, "best_model")
    res = _self_trained(spark, sf, path, keep="best")
    docs = table(spark, sf, "documents").select("text")
    both = load_model(path).add_logits(res.scorer.add_logits(docs, "text", "__kept"), "text", "__loaded")
    same = both.agg((F.count_if(~F.col("__kept").eqNullSafe(F.col("__loaded"))) == 0).alias("same_after_load"))
    m = res.metrics
    by_round = Window.partitionBy("round")
    least = best_step(m.select(F.struct("round", "step").alias("step"), F.col("val_loss_batch_mean").alias("val_loss")))
    finite = (F.col("train_loss") < 1e6) & (F.col("val_loss") < 1e6) & F.col("train_accuracy").between(0, 1) & F.col("val_accuracy").between(0, 1)
    # untrained weights give each class the same chance; only the first round begins with them
    fresh = F.abs(F.col("start_loss") - F.ln(F.lit(float(len(ID_TO_LABEL))))) < 1e-9
    out = m.select(
        "round", "step", _r("threshold").alias("threshold"), "unlabelled", F.when(F.col("round") == 1, F.col("pseudo")).alias("pseudo_of_teacher"),
        "train", "validation", (F.col("combined") == F.col("train") + F.col("pseudo")).alias("combined_adds_up"), finite.alias("finite_metrics"),
        fresh.alias("starts_untrained"), F.count_if("best").over(by_round).alias("best_of_round"),
        (F.min_by("step", F.struct("val_loss_batch_mean", "step")).over(by_round) == F.min(F.when(F.col("best"), F.col("step"))).over(by_round)).alias("best_is_least"))
    kept = least.select((F.col("best_step.round") == res.best_round).alias("kept_is_least"))
    one = F.lit(1).alias("k")  # two reports of one row
    return out.select("*", one).join(same.select("*", one), "k").join(kept.select("*", one), "k").drop("k")


def q_self_train_steps(spark, sf):
    """Every round's and step's figures as they are."""
    m = _self_trained(spark, sf, None).metrics
    return m.select(*(_r(f.name).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in m.schema.fields))


# --- jobs, from files to files -------------------------------------------------------


def q_clean_job_table(spark, sf):
    """J1 by its job: a raw CSV, and the Parquet table that the job made of it."""
    out = scratch_path(spark, "clean_job")
    clean_job(spark, _raw_csv(spark, sf), out, order_by=["post_id"])
    return _comparable(read_clean(spark, out).select(*CLEAN_COLUMNS))


def q_clean_job_counts(spark, sf):
    """A1: the rows that the clean job read, found valid and wrote, as it ran."""
    done = clean_job(spark, _raw_csv(spark, sf), scratch_path(spark, "clean_job"), order_by=["post_id"])
    return spark.createDataFrame([(done["total"], done["valid"], done["written"])], "total long, valid long, written long")


def q_sentiment_job_counts(spark, sf):
    """A1: the same of the sentiment job, over all documents."""
    docs, report = table(spark, sf, "documents").select("doc_id", "text"), {}
    sentiment_job(spark, None, LetterShareScorer(), source=docs, id_cols=["doc_id"], report=report)
    return spark.createDataFrame([(report["total"], report["valid"], report["labelled"])], "total long, valid_text long, labelled long")


def _as_csv(spark, df, name) -> str:
    path = scratch_path(spark, name)
    write_scored(df.withColumn("doc_id", F.col("doc_id").cast("string")), path)
    return path


def q_self_train_job(spark, sf):
    """J3 by its job, from two CSV files: its counts (A1), taken as it ran."""
    lab, unl = _as_csv(spark, labelled(spark, sf), "labelled_csv"), _as_csv(spark, unlabelled(spark, sf), "unlabelled_csv")
    c = self_train_job(spark, lab, unl, iterations=1, teacher=LetterShareScorer(), id_cols=["doc_id"], epochs=1).counts
    names = ["labelled_total", "labelled_valid", "labelled", "unlabelled_total", "unlabelled_valid", "unlabelled", "accepted_1"]
    return spark.createDataFrame([tuple(c[n] for n in names)], ", ".join(f"{n} long" for n in names))


def q_ingest_event(spark, sf):
    """S4 + J4: a CSV of part files for each language, each named by an event; the
    rows that lie in the raw zone, beside their file's manifest."""
    folder, zone = scratch_path(spark, "incoming"), scratch_path(spark, "zone")
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang")
    out = []
    for lang in (r["lang"] for r in docs.select("lang").distinct().orderBy("lang").collect()):  # a few names
        docs.where(F.col("lang").eqNullSafe(lang)).write.option("header", "true").csv(f"{folder}/{lang}.csv")
        manifest = ingest_job(spark, {"source": "test", "test_data_location": f"{folder}/{lang}.csv"}, zone)
        m = manifest.first()
        told = [F.lit(m[c]).alias(n) for n, c in (("tag", "source"), ("file_name", "file_name"), ("dataset", "dataset"), ("record_count", "record_count"))]
        landed = spark.read.parquet(m["location"])
        out.append(landed.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").alias("source"), "lang", *told, F.lit(m["file_size_mb"] > 0).alias("has_size")))
    return reduce(DataFrame.unionByName, out)


# --- cases that the queries above don't meet ---------------------------------------------


NARROW = ["user_name", "user_location", "user_friends", "user_verified", "hashtags"]


def q_clean_posts_narrow(spark, sf):
    """P13 + D1: a posts table without some of the columns; two dedup keys are left."""
    return _comparable(clean_posts(raw_posts(spark, sf).drop(*NARROW), order_by=["post_id"]))


def q_dedup_single_key(spark, sf):
    """D1 with one key left: nothing is removed."""
    return _comparable(clean_posts(raw_posts(spark, sf).drop("user_name", "text"), order_by=["post_id"])).select("tweet_ts", "user_created_ts", "source")


def q_acceptance_above_cap(spark, sf):
    """G9 from a threshold above its cap."""
    scored = score_posts(_unlabelled_ready(spark, sf).withColumn("__m", model_text("text")), LetterShareScorer(), "__m")
    return acceptance(scored, threshold_schedule(0.98, ROUNDS)).select("step", _r("threshold").alias("threshold"), "accepted", "total", _r("percent").alias("percent"))


def q_exclude_labelled(spark, sf):
    """Leakage control over ids that are null in one row of eleven on both sides."""
    holed = F.when(F.col("doc_id") % 11 != 0, F.col("doc_id")).alias("id")
    docs = table(spark, sf, "documents").select(holed, "lang", "n_chars")
    known = table(spark, sf, "labels").where(F.col("doc_id") % 11 != 0).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    nulls = table(spark, sf, "labels").where(F.col("doc_id") % 11 == 0).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("lang <> 'de'")
    return without_labelled(docs, known.unionByName(nulls).select(holed, "lang"), ["id", "lang"])


def _roberta_like() -> str:
    """A byte-level tokenizer file, as the reference's model has one."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def q_truncate_subwords(spark, sf):
    """P17 in subword tokens: every text as a model of that tokenizer would see it."""
    return table(spark, sf, "documents").select("doc_id", truncate_subwords(F.col("text"), _roberta_like()).alias("model_input"))


def q_score_posts_subwords(spark, sf):
    """Every text scored on its first subword tokens."""
    return _score_cols(_scored_documents(spark, sf, LetterShareScorer(max_tokens=MAX_TOKENS, tokenizer=_roberta_like())))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # clean stage (J1 and its parts)
    "clean_posts": q_clean_posts,
    "parse_timestamps": q_parse_timestamps,
    "cast_counts": q_cast_counts,
    "parse_booleans": q_parse_booleans,
    "strip_urls": q_strip_urls,
    "strip_mentions": q_strip_mentions,
    "clean_text": q_clean_text,
    "parse_hashtags": q_parse_hashtags,
    "clean_location": q_clean_location,
    "derive_date": q_derive_date,
    "valid_posts": q_valid_posts,
    "nonnegative_counts": q_nonnegative_counts,
    "dedup_posts": q_dedup_posts,
    # sources and sinks
    "csv_scan_multiline": q_csv_scan_multiline,
    "csv_scan_na_tokens": q_csv_scan_na_tokens,
    "land_raw_rows": q_land_raw_rows,
    "write_partitioned_roundtrip": q_write_partitioned_roundtrip,
    "partition_pruned_read": q_partition_pruned_read,
    "write_scored_roundtrip": q_write_scored_roundtrip,
    "whole_text_read": q_whole_text_read,
    "ingest_manifest": q_ingest_manifest,
    "pick_csv_file": q_pick_csv_file,
    "record_envelope": q_record_envelope,
    "enveloped_records": q_enveloped_records,
    "split_s3_uri": q_split_s3_uri,
    "run_key_format": q_run_key_format,
    # labels, sampling, splitting, counts
    "map_labels": q_map_labels,
    "model_text": q_model_text,
    "truncate_tokens": q_truncate_tokens,
    "nonblank_text": q_nonblank_text,
    "sample_exact": q_sample_exact,
    "stratified_split": q_stratified_split,
    "stage_counts": q_stage_counts,
    # scoring and self-training
    "score_posts": q_score_posts,
    "score_posts_truncated": q_score_posts_truncated,
    "score_batches": q_score_batches,
    "softmax_probs": q_softmax_probs,
    "label_distribution": q_label_distribution,
    "sentiment_report": q_sentiment_report,
    "pseudo_label_filter": q_pseudo_label_filter,
    "pseudo_acceptance": q_pseudo_acceptance,
    "combine_train": q_combine_train,
    "eval_accuracy": q_eval_accuracy,
    "eval_cross_entropy": q_eval_cross_entropy,
    "self_train_round": q_self_train_round,
    "train_predict": q_train_predict,
    "train_predict_rows": q_train_predict_rows,
    "self_train_best": q_self_train_best,
    "self_train_steps": q_self_train_steps,
    "exclude_labelled": q_exclude_labelled,
    "acceptance_above_cap": q_acceptance_above_cap,
    "truncate_subwords": q_truncate_subwords,
    "score_posts_subwords": q_score_posts_subwords,
    # jobs, from files to files
    "clean_job_table": q_clean_job_table,
    "clean_job_counts": q_clean_job_counts,
    "sentiment_job_counts": q_sentiment_job_counts,
    "self_train_job": q_self_train_job,
    "ingest_event": q_ingest_event,
    "clean_posts_narrow": q_clean_posts_narrow,
    "dedup_single_key": q_dedup_single_key,
}
