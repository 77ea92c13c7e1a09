"""The stepwise student against plain Python, and rounds that go on from its weights."""

import math
import random

import numpy as np
import pytest
from locations import SF_SMALL
from pyspark.sql import functions as F

from postlake.operators import student as S
from postlake.operators.scoring import LOGITS, LetterShareScorer, score_posts
from postlake.operators.training import load_model, save_model, self_train, without_labelled
from postlake.plans.catalog import QUERIES
from postlake.plans.fixtures import labelled, unlabelled
from postlake.session import scratch_path

BUCKETS = 50


def rows(spark, n=60, seed=1, classes=3):
    r = random.Random(seed)
    made = []
    for i in range(n):
        y = r.randrange(classes)
        made.append((i, [r.choice([y, y + 3, r.randrange(BUCKETS)]) for _ in range(r.randint(0, 12))], y))
    return made, spark.createDataFrame(made, f"doc_id long, {S.TOKENS} array<int>, label_id int")


def packed(spark, df, n, tokens=0, ids=("doc_id",)):
    blocks, count = S.pack(df, n, tokens, ids)
    path = scratch_path(spark, "blocks")
    blocks.write.parquet(path)
    return spark.read.parquet(path), count


def slow_logits(weights, words):
    scale = 1 / math.sqrt(len(words) + 1)
    return [sum(w[t] for t in [*words, len(w) - 1]) * scale for w in weights]


def slow_loss(weights, words, y):
    l = slow_logits(weights, words)
    return math.log(sum(math.exp(x - max(l)) for x in l)) + max(l) - l[y]


def slow_pass(data, weights, power, order, batch_size, rate):
    """Mini-batch AdaGrad, number by number; a word's repeats count one after another."""
    means, right = 0.0, 0
    for first in range(0, len(order), batch_size):
        batch = [data[i] for i in order[first : first + batch_size]]
        before = [w[:] for w in weights]
        each = [slow_loss(before, words, y) for words, y in batch]
        means += sum(each) / len(each)
        adds = []
        for words, y in batch:
            l = slow_logits(before, words)
            right += l.index(max(l)) == y
            p = [math.exp(x - max(l)) for x in l]
            for c in range(len(weights)):
                g = (p[c] / sum(p) - (c == y)) / math.sqrt(len(words) + 1) / len(batch)
                adds += [(c, t, g) for t in [*words, len(before[0]) - 1]]
        for c, t, g in adds:
            power[c][t] += g * g
        for c, t, g in adds:
            weights[c][t] -= rate * g / math.sqrt(power[c][t] + 1e-6)
    return means, right


def test_a_pass_equals_plain_python():
    r = random.Random(2)
    data = [([r.randrange(BUCKETS) for _ in range(r.randint(0, 9))], r.randrange(3)) for _ in range(25)]
    order = r.sample(range(25), 25)
    w, s = np.zeros((3, BUCKETS + 1)), np.zeros((3, BUCKETS + 1))
    own = S.Rows(np.array([t for x, _ in data for t in x]), np.array([len(x) for x, _ in data]), BUCKETS)
    got = S.pass_over(own, np.array([y for _, y in data]), w, s, np.array(order), 4, 0.1)
    sw, sp = np.zeros((3, BUCKETS + 1)).tolist(), np.zeros((3, BUCKETS + 1)).tolist()
    want = slow_pass(data, sw, sp, order, 4, 0.1)
    assert got == pytest.approx(want) and np.allclose(w, sw) and np.allclose(s, sp)


def test_a_step_of_one_block_is_that_pass(spark):
    made, df = rows(spark)
    blocks, n = packed(spark, df, len(made))
    assert n == 1
    start = S.Student.new(3, BUCKETS)
    done, _, report = S.one_step(blocks, start, np.zeros_like(start.weights), 1, 4, 0.1, 1, 42)
    row = blocks.first()
    words, sizes, labels = S._arrays(row)
    cut = np.split(words, np.cumsum(sizes)[:-1])
    data = [(list(map(int, c)), int(y)) for c, y in zip(cut, labels)]
    assert sorted(map(str, data)) == sorted(str((w, y)) for _, w, y in made)
    order = np.random.default_rng([42, 1, row["block"]]).permutation(len(labels))
    w, s = np.zeros((3, BUCKETS + 1)).tolist(), np.zeros((3, BUCKETS + 1)).tolist()
    means, right = slow_pass(data, w, s, order.tolist(), 4, 0.1)
    assert np.allclose(done.weights, w)
    assert report["start_loss"] == pytest.approx(math.log(3)) and report["train_loss"] == pytest.approx(means / 15) and report["train_accuracy"] == right / 60


def test_weights_go_on_from_call_to_call(spark):
    made, df = rows(spark, 80)
    blocks, n = packed(spark, df, len(made))
    first = S.train_steps(blocks, n, S.Student.new(3, BUCKETS), steps=2)
    second = S.train_steps(blocks, n, first.last, steps=1)
    loss = sum(slow_loss(first.last.weights.tolist(), w, y) for _, w, y in made) / len(made)
    assert second.steps[0]["start_loss"] == pytest.approx(loss, rel=1e-9)
    assert first.steps[1]["start_loss"] < first.steps[0]["start_loss"] and second.steps[0]["start_loss"] < first.steps[1]["start_loss"]


def test_many_blocks_hold_each_row_once_and_no_layout_matters(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BLOCK", 20)
    made, df = rows(spark, 150, 3)
    out = []
    for df in (df.repartition(7), df.coalesce(1).sort(F.rand(5))):
        blocks, n = packed(spark, df, len(made))
        assert n == 8 and blocks.agg(F.sum("rows")).first()[0] == 150
        out.append(S.train_steps(blocks.repartition(3), n, S.Student.new(3, BUCKETS), steps=2))
    assert np.array_equal(out[0].last.weights, out[1].last.weights) and out[0].steps == out[1].steps
    scorer = S.StudentScorer(out[0].last, featurized=True)
    got = {r.doc_id: r[LOGITS] for r in scorer.add_logits(df, "text").collect()}
    for i, w, _ in made:
        assert got[i] == pytest.approx(slow_logits(out[0].last.weights.tolist(), w))


def test_a_kind_of_row_that_is_most_of_the_table_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BLOCK", 20)
    made = [(7, [1, 2, 3], 1)] * 300 + [(i, [i % 9], 0) for i in range(100)]
    blocks, n = packed(spark, spark.createDataFrame(made, f"doc_id long, {S.TOKENS} array<int>, label_id int"), len(made))
    sizes = [r["rows"] for r in blocks.collect()]
    assert n == 20 and sum(sizes) == 400 and max(sizes) < 60


def test_best_step_is_the_first_of_least_loss(spark):
    made, df = rows(spark, 40)
    blocks, n = packed(spark, df, len(made))
    told = iter([0.5, 0.3, 0.3, 0.4])
    seen = []
    done = S.train_steps(blocks, n, S.Student.new(3, BUCKETS), lambda s: seen.append(s) or {"loss": next(told)}, steps=4)
    assert done.best_step == 2 and done.best is seen[1] and done.last is seen[3]


def test_odd_texts_classes_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "  \n"), (4, "Éa, éa! 世界 _x1"), (5, "word " * 5000)], "doc_id long, text string")
    student = S.Student(np.random.default_rng(1).normal(size=(3, BUCKETS + 1)), max_tokens=8)
    path = scratch_path(spark, "student")
    save_model(S.StudentScorer(student), path)
    back = load_model(path)
    assert np.array_equal(back.student.weights, student.weights) and back.max_tokens == 8
    got = score_posts(df, back, "text").collect()
    assert len(got) == 5 and all(r.sentiment is not None and abs(r.negative_prob + r.neutral_prob + r.positive_prob - 1) < 1e-9 for r in got)
    assert got[0].confidence == got[1].confidence == got[2].confidence
    assert score_posts(df.limit(0), back, "text").count() == 0
    none, n = S.pack(rows(spark)[1].limit(0), 0, 0)
    done = S.train_steps(none, n, student, steps=1)
    assert np.array_equal(done.last.weights, student.weights)
    words = df.select(S.hashed_words(F.col("text"), BUCKETS).alias("w")).collect()
    assert words[3].w[0] == words[3].w[1] and len(words[3].w) == 4 and len(words[4].w) == 5000


def test_rounds_carry_weights_and_choose_by_step(spark):
    # nothing to pseudo-label: both rounds train on the same rows
    lab, unl = labelled(spark, SF_SMALL), unlabelled(spark, SF_SMALL).where("false")
    kw = dict(teacher=LetterShareScorer(), max_tokens=None)
    path = scratch_path(spark, "model")
    one, two = self_train(lab, unl, iterations=1, **kw), self_train(lab, unl, iterations=2, output_dir=path, **kw)
    assert two.steps[:3] == one.steps and [s["round"] for s in two.steps] == [1, 1, 1, 2, 2, 2]
    assert all(s["pseudo"] == 0 and s["combined"] == s["train"] for s in two.steps)
    # the first loss of round 2 is that of round 1's last weights on the same rows
    w = one.scorer.student.weights
    from postlake.operators.sampling import stratified_split
    from postlake.operators.training import prepare_labelled

    split = stratified_split(prepare_labelled(lab).select("doc_id", "text", "label_id"), "label_id", ["doc_id"])
    texts = split.select("is_train", "label_id", S.hashed_words(F.trim("text")).alias("w")).collect()
    loss = {t: [slow_loss(w, r.w, r.label_id) for r in texts if r.is_train is t] for t in (True, False)}
    assert two.steps[3]["start_loss"] == pytest.approx(np.mean(loss[True]), rel=1e-9)
    assert one.steps[-1]["val_loss"] == pytest.approx(np.mean(loss[False]), rel=1e-9)
    for r in (1, 2):
        own = [s for s in two.steps if s["round"] == r]
        least = min(s["val_loss_batch_mean"] for s in own)
        assert [s["best"] for s in own].index(True) == [s["val_loss_batch_mean"] for s in own].index(least) and sum(s["best"] for s in own) == 1
    # saved: the best step of the last round; in hand: its last step
    best = two.rounds[-1]["best_step"] == 3
    assert np.array_equal(load_model(path).student.weights, two.scorer.student.weights) is best


def test_null_ids_of_labelled_rows_are_kept_out(spark):
    lab = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "id long, k string")
    unl = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (None, "c"), (2, None), (3, None)], "id long, k string")
    left = sorted((tuple(r) for r in without_labelled(unl, lab, ["id", "k"]).collect()), key=str)
    assert left == sorted([(1, "b"), (None, "c"), (3, None)], key=str)


def test_registered_queries_hold_their_own_figures(spark):
    steps = QUERIES["self_train_steps"](spark, SF_SMALL).collect()
    assert [(r.round, r.step) for r in sorted(steps)] == [(a, b) for a in (1, 2) for b in (1, 2, 3)]
    assert all(r.combined == r.train + r.pseudo and math.isfinite(r.val_loss) for r in steps)
    rows_ = QUERIES["train_predict_rows"](spark, SF_SMALL).collect()
    assert len(rows_) == steps[0].validation
    for r in rows_:
        p = [r.negative_prob, r.neutral_prob, r.positive_prob]
        assert abs(sum(p) - 1) < 1e-5 and p[r.sentiment_id] == max(p)
