"""Clean, dedup, sampling, split, scoring and metric operators."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from locations import SF_MID, SF_SMALL
from postlake.operators.clean import clean_posts, dedup_posts, typed_posts
from postlake.operators.metrics import acceptance, best_step, eval_metrics, eval_report, label_distribution
from postlake.operators.sampling import approximate_mode, first_in_order, order_key, sample_exact, split_quotas, stratified_split
from postlake.operators.scoring import (
    LOGITS,
    BatchScorer,
    LetterShareScorer,
    letter_share_factory,
    pseudo_label,
    score_posts,
)
from postlake.operators.training import next_threshold, threshold_schedule
from postlake.plans.fixtures import labelled, raw_posts, table


def md5_order(ids, seed=42):
    return sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{len(str(i))}:{i}".encode()).hexdigest())


def test_clean_posts_counts(spark):
    raw = raw_posts(spark, SF_MID)
    assert raw.count() == 1100
    typed = typed_posts(raw)
    assert typed.filter(F.col("tweet_ts").isNull()).count() == 117
    assert typed.filter(F.col("text_raw").isNull()).count() == 27
    out = clean_posts(raw, order_by=["post_id"])
    assert out.count() == 760
    assert out.columns[:3] == ["user_name", "user_location", "user_location_clean"]


def test_clean_text_properties(spark):
    out = clean_posts(raw_posts(spark, SF_SMALL))
    bad = out.filter(
        F.col("text_clean").startswith(" ") | F.col("text_clean").endswith(" ") | F.col("text_clean").contains("  ")
    )
    assert bad.count() == 0
    assert out.filter(F.col("hashtags_arr").isNull()).count() == 0


def test_barrier_and_plain_plans_agree(spark):
    raw = raw_posts(spark, SF_SMALL)
    a = clean_posts(raw, order_by=["post_id"], barrier=True)
    b = clean_posts(raw, order_by=["post_id"], barrier=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dedup_keys_unique_and_smallest_survivor(spark):
    rows = [(1, "u", "t", 5), (2, "u", "t", 3), (3, None, "t", 1), (4, None, "t", 2), (5, "v", None, 9)]
    df = spark.createDataFrame(rows, "id long, user_name string, text_clean string, v int")
    out = dedup_posts(df, keys=["user_name", "text_clean"], order_by=["id"]).orderBy("id").collect()
    assert [r.id for r in out] == [1, 3, 5]
    assert dedup_posts(df.select("user_name", "id")).count() == 5  # fewer than two default keys: unchanged


def test_sample_exact_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    ids = [r[0] for r in docs.select("doc_id").collect()]
    for n in (1, 37, 150):
        got = sorted(r[0] for r in sample_exact(docs, n, ["doc_id"]).select("doc_id").collect())
        assert got == sorted(md5_order(ids)[:n])
    assert sample_exact(docs, 10_000, ["doc_id"]).count() == len(ids)
    assert sample_exact(docs, None, ["doc_id"]).count() == len(ids)


def test_first_in_order_by_group(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "lang")
    quotas = {"en": 17, "fr": 3, "de": 0, "es": 1000}
    got = first_in_order(docs, ["doc_id"], quotas, "lang")
    exp = {}
    for lang, ids in docs.groupBy("lang").agg(F.collect_list("doc_id")).collect():
        exp[lang] = sorted(md5_order(ids)[: quotas.get(lang, 0)])
    res = {}
    for r in got.collect():
        res.setdefault(r.lang, []).append(r.doc_id)
    assert {k: sorted(v) for k, v in res.items()} == {k: v for k, v in exp.items() if v}


def test_split_quotas_match_contract():
    assert split_quotas({0: 51, 1: 49, 2: 299}) == {0: 41, 1: 39, 2: 239}
    assert approximate_mode({0: 1, 1: 1, 2: 1}, 2) == {0: 1, 1: 1, 2: 0}
    with pytest.raises(ValueError):
        split_quotas({0: 1, 1: 10})


def test_stratified_split_sizes(spark):
    lab = labelled(spark, SF_MID)
    sp = stratified_split(lab, "sentiment", ["doc_id"])
    sizes = {(r.sentiment, r.is_train): r["count"] for r in sp.groupBy("sentiment", "is_train").count().collect()}
    assert sizes == {
        ("negative", True): 41, ("negative", False): 10,
        ("neutral", True): 39, ("neutral", False): 10,
        ("positive", True): 239, ("positive", False): 60,
    }
    n_val = sum(v for (s, t), v in sizes.items() if not t)
    assert n_val == math.ceil(0.2 * 399)


def test_threshold_schedule():
    assert threshold_schedule(0.90, 4) == pytest.approx([0.90, 0.92, 0.94, 0.95])
    assert next_threshold(0.98) == 0.95
    assert threshold_schedule(0.98, 1) == [0.98]


def test_scorers_agree_and_probs_sum_to_one(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    a = score_posts(docs, LetterShareScorer(), "text")
    b = score_posts(docs, BatchScorer(letter_share_factory(), batch_size=7, max_tokens=None), "text")
    ra = {r.doc_id: r for r in a.collect()}
    rb = {r.doc_id: r for r in b.collect()}
    assert ra.keys() == rb.keys()
    for k, r in ra.items():
        assert r.sentiment_id == rb[k].sentiment_id
        assert abs(r.confidence - rb[k].confidence) < 1e-9
        assert abs(r.negative_prob + r.neutral_prob + r.positive_prob - 1) < 1e-9
        assert r.confidence == max(r.negative_prob, r.neutral_prob, r.positive_prob)


def test_pseudo_label_threshold_inclusive(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    scored = score_posts(docs, LetterShareScorer(), "text")
    t = scored.agg(F.min("confidence")).first()[0]
    assert pseudo_label(docs, LetterShareScorer(), t).count() == docs.count()
    plan = pseudo_label(docs, LetterShareScorer(), 0.9)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.strip().lstrip("+- :").startswith("Filter")]
    assert filters and all("regexp_replace" not in f and "exp(" not in f.lower() for f in filters)


def test_distribution_and_acceptance(spark):
    df = spark.createDataFrame([("a", 0.95), ("b", 0.5), ("a", 0.9), (None, 0.1)], "sentiment string, confidence double")
    d = [tuple(r) for r in label_distribution(df).collect()]
    assert d == [("a", 2, 200 / 3), ("b", 1, 100 / 3)]
    acc = {r.step: (r.accepted, r.total) for r in acceptance(df, [0.9, 0.95]).collect()}
    assert acc == {1: (2, 4), 2: (1, 4)}
    empty = acceptance(df.limit(0), [0.9]).first()
    assert empty.accepted == 0 and empty.percent == 0.0


def test_eval_metrics_batch_mean(spark):
    rows = [(i, [float(i % 3), 0.0, 1.0], i % 3) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, l array<double>, y int")
    m = eval_metrics(df, "l", "y", order_key(["doc_id"]), batch_size=4)
    import numpy as np

    def ce(l, y):
        l = np.array(l)
        return float(np.log(np.exp(l - l.max()).sum()) + l.max() - l[y])

    order = md5_order(list(range(10)))
    losses = [ce(rows[i][1], rows[i][2]) for i in order]
    batches = [losses[i : i + 4] for i in range(0, 10, 4)]
    assert m["loss"] == pytest.approx(sum(losses) / 10)
    assert m["loss_batch_mean"] == pytest.approx(sum(sum(b) / len(b) for b in batches) / len(batches))
    acc = sum(int(np.argmax(rows[i][1]) == rows[i][2]) for i in range(10)) / 10
    assert m["accuracy"] == pytest.approx(acc)


def test_best_step_first_on_ties(spark):
    m = spark.createDataFrame([(1, 0.5), (2, 0.4), (3, 0.4)], "step int, val_loss double")
    assert best_step(m).first().best_step == 2


def test_train_partitions_follow_the_data():
    from postlake.operators.training import train_partitions

    assert train_partitions(8_000) == 1  # few short rows: one dense gradient
    assert train_partitions(8_000, 3_300_000) == 4  # long documents
    assert train_partitions(10**9, 3 * 10**10) == 30_000


def slow_first(rows, ids, n, seed=42):
    """The first n rows by (hash of the ids, hash of the row), in Python."""
    import json

    def key(r):
        parts = "".join(":-" if r[c] is None else f":{len(str(r[c]))}:{r[c]}" for c in ids)
        body = json.dumps({k: v for k, v in r.items() if v is not None}, separators=(",", ":"))
        return hashlib.md5(f"{seed}{parts}".encode()).hexdigest(), hashlib.md5(f"{seed}:{body}".encode()).hexdigest()

    return sorted(rows, key=key)[:n]


def test_ids_that_collide_when_joined_and_null_ids_keep_one_order(spark):
    """One order whatever the size: more than any limit that was, and less."""
    for copies in (3, 400):
        rows = [dict(a=a, b=b, v=v) for a, b in (("a:b", "c"), ("a", "b:c"), (None, "x"), ("", "x"), ("-", "x"), (None, None)) for v in range(copies)]
        df = spark.createDataFrame([tuple(r.values()) for r in rows], "a string, b string, v long")
        keys = df.select(order_key(["a", "b"]).alias("k")).distinct().count()
        assert keys == 6
        for n in (1, copies - 1, copies, 2 * copies + 1, len(rows) - 1):
            got = sorted(map(str, (tuple(r) for r in sample_exact(df, n, ["a", "b"]).collect())))
            assert got == sorted(str(tuple(r.values())) for r in slow_first(rows, ["a", "b"], n))


def test_equal_rows_at_the_cut_are_repeated_exactly(spark):
    from collections import Counter

    from postlake.operators import sampling

    df = spark.createDataFrame([(7, "x", 1)] * 25_000 + [(i, "y", 0) for i in range(100, 150)], "doc_id long, t string, y int")
    for n in (1, 12_345, 24_999, 25_020):
        got = Counter(tuple(r) for r in sample_exact(df, n, ["doc_id"]).collect())
        assert sum(got.values()) == n
        assert got == Counter(tuple(r.values()) for r in slow_first([dict(doc_id=7, t="x", y=1)] * 25_000 + [dict(doc_id=i, t="y", y=0) for i in range(100, 150)], ["doc_id"], n))
    flagged = sampling.first_in_order(df, ["doc_id"], {None: 12_345}, flag="f")
    assert flagged.count() == 25_050 and flagged.where("f").count() == 12_345


def test_a_column_of_many_values_is_no_class_column(spark, monkeypatch):
    from postlake.operators import sampling

    monkeypatch.setattr(sampling, "MAX_CLASSES", 5)
    with pytest.raises(ValueError, match="class column"):
        stratified_split(spark.range(20), "id", ["id"])


def test_flag_takes_one_scan_and_no_union(spark):
    plan = stratified_split(labelled(spark, SF_SMALL), "sentiment", ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Window" not in plan


def test_two_class_student_has_three_finite_chances(spark):
    from postlake.operators.training import evaluate, load_model, save_model, train_classifier
    from postlake.session import scratch_path

    for labels in ((0, 1), (0, 2), (2,)):
        rows = [(i, f"word{i % len(labels)} text", labels[i % len(labels)]) for i in range(40)]
        df = spark.createDataFrame(rows, "doc_id long, text string, label_id int")
        model = train_classifier(df, "text", "label_id", max_iter=10)
        path = scratch_path(spark, "two_class")
        save_model(model, path)
        for m in (model, load_model(path)):
            out = score_posts(df, m, "text").collect()
            for r in out:
                p = [r.negative_prob, r.neutral_prob, r.positive_prob]
                assert all(math.isfinite(x) for x in p) and abs(sum(p) - 1) < 1e-9
                assert r.sentiment_id in labels and r.sentiment is not None
        assert evaluate(model, df)["accuracy"] == 1.0


def test_null_loss_is_an_error_not_the_best_loss(spark):
    df = spark.createDataFrame([(1, [0.1, 0.2, 0.3], 1), (2, None, 0)], "doc_id long, l array<double>, y int")
    with pytest.raises(ValueError, match="1 of 2"):
        eval_metrics(df, "l", "y")
    r = eval_report(df, "l", "y").first()
    assert r.null_losses == 1 and r.loss is None
    assert math.isnan(eval_metrics(df.limit(0), "l", "y")["loss"])


@pytest.mark.parametrize("n,size", [(0, 8), (5, 8), (8, 8), (9, 8), (61, 8), (64, 8), (63, 8), (61, 1)])
def test_batch_means_by_brute_force(spark, n, size):
    rnd = random.Random(n)
    rows = [(i // 3, [rnd.gauss(0, 1) for _ in range(3)], rnd.randrange(3)) for i in range(n)]  # three rows of each key
    rows = [(k, rows[3 * k][1], rows[3 * k][2]) for k, _, _ in rows]  # copies
    rows += [(None, [0.5, -0.5, 0.0], 1)] * (n // 20)  # no key: first
    df = spark.createDataFrame(rows, "k long, l array<double>, y int").repartition(4)
    ce = [math.log(sum(map(math.exp, l))) - l[y] for _, l, y in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    batches = [ce[i : i + size] for i in range(0, len(ce), size)]
    r = eval_report(df, "l", "y", F.col("k"), size)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert ("WindowGroupLimit" in plan) == (size > 1) and "cartesian" not in plan.lower() and "NestedLoop" not in plan
    r = r.first()
    assert r.n == len(ce) and r.null_losses == 0
    if ce:
        assert r.loss == pytest.approx(sum(ce) / len(ce))
        assert r.loss_batch_mean == pytest.approx(sum(sum(b) / len(b) for b in batches) / len(batches))
        assert r.accuracy == pytest.approx(sum(l.index(max(l)) == y for _, l, y in rows) / len(rows))
    else:
        assert r.loss is None and r.loss_batch_mean is None and r.accuracy is None


def test_scorers_with_a_token_limit_read_the_first_tokens(spark):
    text = " ".join(["aaa"] * 5 + ["ooo"] * 50)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert score_posts(df, LetterShareScorer(), "text").first().sentiment_id == 2
    assert score_posts(df, LetterShareScorer(max_tokens=5), "text").first().sentiment_id == 0
    assert score_posts(df, BatchScorer(letter_share_factory(), max_tokens=5), "text").first().sentiment_id == 0


def test_featurized_path_equals_text_path(spark):
    from postlake.operators.scoring import LOGITS
    from postlake.operators.training import featurize, on_features, prepare_labelled, train_classifier

    lab = prepare_labelled(labelled(spark, SF_SMALL)).select("doc_id", "text", "label_id")
    feats = featurize(lab, "text", ["doc_id", "text", "label_id"], max_iter=5)
    from_text = train_classifier(lab, "text", "label_id", max_iter=5)
    from_feats = train_classifier(feats, "text", "label_id", featurized=True, max_iter=5)

    def logits(df):
        return {r.doc_id: [round(v, 9) for v in r[LOGITS]] for r in df.select("doc_id", LOGITS).collect()}

    a = logits(from_text.add_logits(lab, "text"))
    b = logits(on_features(from_text).add_logits(feats, "text"))
    c = logits(from_feats.add_logits(lab, "text"))  # the returned model reads text
    assert a == b == c and len(a) == lab.count()


def test_sample_exact_boundaries_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id")
    ids = [r.doc_id for r in docs.collect()]
    total = len(ids)
    for n in (1, total - 1, total, total + 5):
        got = sorted(r.doc_id for r in sample_exact(docs, n, ["doc_id"]).collect())
        assert got == sorted(md5_order(ids)[: min(n, total)]), n
    assert sample_exact(docs.filter("doc_id < 0"), 5, ["doc_id"]).count() == 0
