"""Scans, sinks, ingest manifest, jobs and self-training."""

import os

import pytest
from pyspark.sql import functions as F

from locations import SF_MID, SF_SMALL
from postlake.operators.scoring import LetterShareScorer
from postlake.operators.training import load_model, self_train
from postlake.plans.fixtures import RAW_COLUMNS, labelled, raw_posts_strings, unlabelled
from postlake.plans.jobs import clean_job, ingest_job, self_train_job, sentiment_job
from postlake.session import scratch_path
from postlake.sources.ingest import envelope, ingest_manifest, list_files, pick_input_file, route_source
from postlake.sources.readers import (
    read_clean,
    read_posts_csv,
    read_table,
    read_text_csv,
    read_whole_text,
    require_columns,
)
from postlake.sources.writers import scored_path, write_scored


def local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_scan_edge_cases(spark):
    d = local(scratch_path(spark, "csv_edge"))
    write_text(f"{d}/a.csv", 'a,b,c\n1,"x, ""q""\nnext",3\n4,5\n6,7,8,9\n')
    rows = [tuple(r) for r in read_posts_csv(spark, d).orderBy("a").collect()]
    assert rows == [("1", 'x, "q"\nnext', "3"), ("4", "5", None), ("6", "7", "8")]


def test_table_scan_adds_no_exchange_unless_asked(spark):
    t = read_table(spark, f"{SF_MID}/documents.parquet")
    plan = t.filter(F.col("doc_id") > 10).select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThan(doc_id,10)]" in plan
    assert "ReadSchema: struct<doc_id:bigint>" in plan and "Exchange" not in plan
    wide = read_table(spark, f"{SF_MID}/documents.parquet", partitions=6)
    assert wide.rdd.getNumPartitions() == 6 and wide.count() == t.count()


def test_no_core_count_decides_a_plan():
    import postlake

    root = os.path.dirname(postlake.__file__)
    sources = [os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".py")]
    assert not [p for p in sources if "defaultParallelism" in open(p).read() or "cpu_count" in open(p).read()]


def test_landing_keeps_records_that_do_not_fit_the_header(spark):
    from postlake.sources.ingest import RAW_FILE, RAW_FILE_SIZE, RAW_RECORD, land_raw

    d = local(scratch_path(spark, "ragged"))
    body = 'a,b\n1,2\n3,4,5,6\n7\n8,"x, ""y""\nz"\n'
    write_text(f"{d}/r.csv", body)
    rows = spark.read.parquet(land_raw(spark, f"{d}/r.csv", scratch_path(spark, "zone"))).orderBy("a").collect()
    assert [(r.a, r.b, r[RAW_RECORD]) for r in rows] == [("1", "2", None), ("3", "4", "3,4,5,6"), ("7", None, "7"), ("8", 'x, "y"\nz', None)]
    assert {(r[RAW_FILE], r[RAW_FILE_SIZE]) for r in rows} == {("r.csv", len(body))}


def test_records_with_null_keys_stay_in_the_envelope(spark):
    from postlake.sources.ingest import enveloped

    df = spark.createDataFrame([(1, "a", "x"), (1, None, "y"), (None, "a", "z"), (None, None, "u"), (None, None, "w")], "k long, j string, v string")
    got = {r.v: r.record_count for r in enveloped(df, "s", ["k", "j"]).collect()}
    assert got == {"x": 1, "y": 1, "z": 1, "u": 2, "w": 2}


def test_pick_from_a_listing_with_equal_paths_gives_one_row(spark):
    from postlake.sources.ingest import select_input_file

    files = spark.createDataFrame([("/b", "b", 2), ("/a", "a", 1), ("/a", "a", 1)], "path string, file_name string, length long")
    assert [tuple(r) for r in select_input_file(files).collect()] == [("/a", "a", 1)]
    assert [tuple(r) for r in select_input_file(files, "b").collect()] == [("/b", "b", 2)]
    assert select_input_file(files.limit(0)).count() == 0


def test_named_scorer_and_command_line(spark):
    from postlake.plans.jobs import _parser, named_scorer

    assert isinstance(named_scorer("postlake.operators.scoring:LetterShareScorer"), LetterShareScorer)
    with pytest.raises(ValueError):
        named_scorer("postlake.operators.scoring")
    with pytest.raises(TypeError):
        named_scorer("builtins:dict")
    args = _parser().parse_args(["self-train", "-l", "a", "-u", "b", "--text-col", "text_clean", "--input-format", "parquet"])
    assert args.unlabeled_size is None and args.text_col == "text_clean"
    assert _parser().parse_args(["ingest", "--location", "x.csv", "--raw-root", "z"]).source == "test"


def test_sentiment_job_on_the_clean_table_with_own_labels(spark):
    from postlake.operators.clean import clean_posts
    from postlake.plans.fixtures import raw_posts
    from postlake.sources.writers import write_clean

    out = scratch_path(spark, "clean_in")
    write_clean(clean_posts(raw_posts(spark, SF_SMALL)), out)
    scored, dist = sentiment_job(spark, out, LetterShareScorer(), scratch_path(spark, "s"), text_col="text_clean", id2label={0: "A", 1: "E", 2: "O"}, input_format="parquet")
    assert {r.sentiment for r in dist.collect()} <= {"A", "E", "O"} and "A_prob" in scored.columns
    assert scored.count() == read_clean(spark, out).count()


def test_na_tokens_only_in_text_scans(spark):
    d = local(scratch_path(spark, "csv_na"))
    write_text(f"{d}/a.csv", "text,sentiment\nNA,positive\nnull,negative\nok,neutral\n")
    posts = sorted(r.text for r in read_posts_csv(spark, d).collect())
    text = sorted((r.text or "<null>") for r in read_text_csv(spark, d).collect())
    assert posts == ["NA", "null", "ok"]
    assert text == ["<null>", "<null>", "ok"]
    with pytest.raises(ValueError):
        require_columns(read_text_csv(spark, d), "label")


def test_scored_csv_roundtrip_keeps_spaces(spark):
    df = raw_posts_strings(spark, SF_SMALL)
    path = scratch_path(spark, "rt")
    write_scored(df, path)
    back = read_posts_csv(spark, path).select(*RAW_COLUMNS)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    assert scored_path("data/covid.csv") == "data/covid_roberta_sentiment.csv"


def test_clean_job_end_to_end(spark):
    src = scratch_path(spark, "raw_csv")
    write_scored(raw_posts_strings(spark, SF_MID), src)
    out = scratch_path(spark, "clean_out")
    clean_job(spark, src, out, order_by=["post_id"])
    back = read_clean(spark, out)
    assert back.count() == 760
    assert back.columns[-1] == "tweet_date"
    dates = sorted({r.tweet_date for r in back.select("tweet_date").distinct().collect()})
    files = [f for f in os.listdir(local(out)) if f.startswith("tweet_date=")]
    assert len(files) == len(dates)
    one = str(dates[0])
    assert read_clean(spark, out, dates=[one]).count() == back.filter(F.col("tweet_date") == one).count()
    with pytest.raises(ValueError):
        clean_job(spark, None, None)


def test_clean_job_from_landed_raw_zone_equals_csv(spark):
    from postlake.sources.ingest import land_raw

    src = scratch_path(spark, "raw_csv_z")
    write_scored(raw_posts_strings(spark, SF_MID), src)
    landed = land_raw(spark, src, scratch_path(spark, "raw_zone"))
    a, b = scratch_path(spark, "clean_csv"), scratch_path(spark, "clean_pq")
    clean_job(spark, src, a, order_by=["post_id"])
    clean_job(spark, landed, b, order_by=["post_id"], input_format="parquet")
    ta = read_clean(spark, a).withColumn("hashtags_arr", F.array_join("hashtags_arr", "|"))
    tb = read_clean(spark, b).withColumn("hashtags_arr", F.array_join("hashtags_arr", "|"))
    assert ta.count() == 760
    assert ta.exceptAll(tb).count() == 0 and tb.exceptAll(ta).count() == 0


def test_listing_manifest_and_pick_brute_force(spark):
    files = list_files(spark, SF_SMALL, glob="*.parquet")
    names = sorted(n for n in os.listdir(SF_SMALL) if n.endswith(".parquet"))
    man = ingest_manifest(files, "test_local", raw_root="s3://bucket")
    rows = {r.file_name: r for r in man.collect()}
    assert sorted(rows) == names
    for n in names:
        assert rows[n].file_size_mb == pytest.approx(os.path.getsize(f"{SF_SMALL}/{n}") / 1024 / 1024)
        assert rows[n].location == f"s3://bucket/raw/{n}"
        assert rows[n].dataset == n
    assert pick_input_file(spark, SF_SMALL, "orders.parquet", "*.parquet")["file_name"] == "orders.parquet"
    assert pick_input_file(spark, SF_SMALL, "nope.parquet", "*.parquet")["file_name"] == names[0]


def test_whole_text_read(spark):
    d = local(scratch_path(spark, "wt"))
    write_text(f"{d}/x.txt", "line1\nline2\n")
    r = read_whole_text(spark, d).first()
    assert r.value == "line1\nline2\n"


def test_route_source():
    assert route_source({"source": "test", "test_data_location": "s3://b/k/f.csv"})[1] == "test_s3"
    assert route_source({"test_data_location": "/x/f.csv"})[:2] == ("/x/f.csv", "test_local")
    with pytest.raises(NotImplementedError):
        route_source({"source": "production"})
    with pytest.raises(ValueError):
        route_source({"source": "kaggle"})


def test_ingest_job(spark):
    src = scratch_path(spark, "ingest_src")
    write_scored(raw_posts_strings(spark, SF_SMALL).coalesce(1), src)
    csv = [f for f in os.listdir(local(src)) if f.endswith(".csv")][0]
    root = scratch_path(spark, "zone")
    man = ingest_job(spark, {"source": "test", "test_data_location": f"{src}/{csv}"}, root).first()
    assert man.source == "test_local" and man.file_name == csv
    assert man.dataset == csv.replace(".csv", "")
    assert man.record_count == raw_posts_strings(spark, SF_SMALL).count()
    assert spark.read.parquet(man.location).count() == man.record_count


def test_envelope_counts(spark):
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    env = envelope(conv, "conversations", "conv_id", metadata={"dataset": "conv"})
    exp = {r.conv_id: r["count"] for r in conv.groupBy("conv_id").count().collect()}
    got = {r.conv_id: r.record_count for r in env.collect()}
    assert got == exp
    assert set(env.columns) >= {"source", "timestamp", "record_count", "dataset"}


def test_sentiment_job(spark):
    src = scratch_path(spark, "docs_csv")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").cast("string"), "text")
    write_scored(docs, src)
    out = scratch_path(spark, "scored")
    scored, dist = sentiment_job(spark, src, LetterShareScorer(), output_path=out, sample_size=50, id_cols=["doc_id"])
    assert scored.count() == 50
    assert sum(r["count"] for r in dist.collect()) == 50
    assert "positive_prob" in read_posts_csv(spark, out).columns


def test_self_train_job_from_csv_with_sizes(spark):
    lab_csv, unl_csv = scratch_path(spark, "lab_csv"), scratch_path(spark, "unl_csv")
    write_scored(labelled(spark, SF_MID).withColumn("doc_id", F.col("doc_id").cast("string")), lab_csv)
    write_scored(unlabelled(spark, SF_MID).withColumn("doc_id", F.col("doc_id").cast("string")), unl_csv)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    out = local(scratch_path(spark, "job_model"))
    res = self_train_job(
        spark, lab_csv, unl_csv, labeled_size=300, unlabeled_size=200, iterations=1,
        output_dir=out, teacher=LetterShareScorer(), id_cols=["doc_id"], epochs=None, max_iter=5,
    )
    r = res.rounds[0]
    # 300 sampled labelled rows (all labels known) -> ceil(0.2 * 300) validation rows
    assert r["train"] + r["validation"] == 300 and r["validation"] == 60
    assert r["unlabelled"] == 200 and 0 <= r["pseudo"] <= 200
    assert os.path.isdir(out)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before  # inputs released


def test_self_train_deterministic_and_saved(spark):
    lab, unl = labelled(spark, SF_SMALL), unlabelled(spark, SF_SMALL)
    out = scratch_path(spark, "model")
    kw = dict(iterations=2, teacher=LetterShareScorer(), epochs=None, max_iter=10)
    a = self_train(lab, unl, output_dir=out, **kw)
    b = self_train(lab, unl, **kw)
    ra = [tuple(r) for r in a.metrics.collect()]
    rb = [tuple(r) for r in b.metrics.collect()]
    assert len(ra) == 2
    for x, y in zip(ra, rb):
        assert x[:10] == y[:10] and x[-1] is y[-1] is True
        assert x[10:-1] == pytest.approx(y[10:-1], rel=1e-6)
    for r in a.rounds:
        assert r["combined"] == r["train"] + r["pseudo"]
        assert 0 < r["train_loss"] < 50 and 0 <= r["train_accuracy"] <= 1
    assert sum(a.label_counts.values()) == lab.count()
    assert [r["threshold"] for r in a.rounds] == pytest.approx([0.9, 0.92])
    assert a.rounds[0]["train"] + a.rounds[0]["validation"] == 87
    m = load_model(out)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    assert m.add_logits(docs, "text").filter(F.size("__logits") == 3).count() == docs.count()


def test_envelope_json_sink(spark):
    import datetime as dt

    from postlake.sources.ingest import write_envelope_json

    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    root = scratch_path(spark, "json_root")
    path = write_envelope_json(conv, root, "conversations", "conv_id", when=dt.datetime(2021, 2, 3, 4, 5, 6))
    assert path.endswith("covid_data/20210203040506/data.json")
    back = spark.read.json(path)
    assert back.count() == conv.count()
    bad = back.groupBy("conv_id", "record_count").count().filter(F.col("count") != F.col("record_count"))
    assert bad.count() == 0


def test_self_train_keep_best_and_exclude_labelled(spark):
    from postlake.operators.sampling import stratified_split
    from postlake.operators.training import evaluate, prepare_labelled
    from postlake.plans.fixtures import table

    lab = labelled(spark, SF_SMALL)
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")  # labelled docs included
    res = self_train(
        lab, docs, iterations=2, teacher=LetterShareScorer(), epochs=None, max_iter=5,
        keep="best", exclude_labelled=True,
    )
    n_lab = lab.count()
    assert all(r["unlabelled"] == docs.count() - n_lab for r in res.rounds)  # anti-join applied
    losses = [r["val_loss_batch_mean"] for r in res.rounds]
    assert res.best_round == 1 + losses.index(min(losses))  # earliest on ties
    split = stratified_split(prepare_labelled(lab).select("doc_id", "text", "label_id"), "label_id", ["doc_id"])
    val = split.filter(~F.col("is_train"))
    m = evaluate(res.scorer, val, "text", "label_id", ["doc_id"])
    assert m["loss_batch_mean"] == pytest.approx(min(losses), rel=1e-9)  # the kept model is the best round's
