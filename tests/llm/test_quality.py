import math
import numpy as np
import pytest
from llm_data import EDGE_ROWS, LONG, edge_docs, no_docs, prose
from pyspark.sql import functions as F

from postlake.llm import quality
from postlake.llm.queries import QUERIES

BAD_TEXTS = [
    " | ".join(prose(i, 60).split()) for i in range(4)] + [
    " ".join(w + "$$$ ###" for w in prose(i, 60).split()) for i in range(4)] + [
    prose(i, 60).upper().replace(" ", "!! ") for i in range(4)] + [
    " ".join(w for w in prose(i, 12).split() for _ in range(8)) for i in range(4)]


def slow_posterior(model, votes):
    good, bad = model.good, 1 - model.good
    for j, v in enumerate(votes):
        if v != quality.SILENT:
            bad *= model.chance[j][0][v]
            good *= model.chance[j][1][v]
    return good / (good + bad)


def test_patterns_come_apart_again():
    r = np.random.default_rng(0)
    v = r.integers(0, 4, (50, len(quality.LABELLERS)))
    assert (quality.unpattern(np.array([quality.pattern(x.tolist()) for x in v])) == v).all()


def test_expectation_maximisation_finds_known_accuracies():
    r = np.random.default_rng(1)
    n, k = 20_000, len(quality.LABELLERS)
    good = r.random(n) < 0.8
    right = np.linspace(0.6, 0.95, k)
    votes = np.where(r.random((n, k)) < right, good[:, None], ~good[:, None]).astype(int)
    votes[r.random((n, k)) < 0.3] = quality.SILENT
    p, c = np.unique([quality.pattern(x.tolist()) for x in votes], return_counts=True)
    model = quality.estimate(p, c)
    assert abs(model.good - 0.8) < 0.02
    got = (model.chance[:, 0, quality.BAD] + model.chance[:, 1, quality.GOOD]) / 2
    assert np.abs(got - right).max() < 0.03
    for x in votes[:20]:
        assert np.isclose(model.posterior(np.array([quality.pattern(x.tolist())]))[0], slow_posterior(model, x))


def test_facts_of_a_small_text():
    f = quality.facts("The cat. The CAT.\nA dog | ran")
    assert f.words == 8 and f.distinct == 6 / 8 and f.marks == 1 / 8
    assert f.repeated_sentences == 0.0 and f.ended_lines == 0.5
    assert quality.facts("").words == 0 and quality.votes(quality.facts(""))[0] == quality.BAD


def test_rejects_junk_and_keeps_prose():
    good = [prose(i, 40 + i) for i in range(100)] + ["Short text.", "The river."] * 5
    texts = good + BAD_TEXTS * 2
    v = [quality.pattern(quality.votes(quality.facts(t))) for t in texts]
    p, c = np.unique(v, return_counts=True)
    scorer = quality.train(texts, quality.estimate(p, c))
    assert all(scorer.score(t)[0] >= 0.5 for t in good)
    assert sum(scorer.score(t)[0] < 0.5 for t in BAD_TEXTS) >= 14


def test_edge_cases(spark):
    docs = edge_docs(spark)
    scorer = quality.fit(docs)
    rows = docs.select("doc_id", "text", quality.judge(docs, scorer).alias("got")).collect()
    assert len(rows) == len(EDGE_ROWS)
    for r in rows:
        assert 0 <= r.got.quality_score <= 1 and len(r.got.votes) == len(quality.LABELLERS)
        if not (r.text or "").strip():
            assert r.got.quality_score == 0 and not r.got.keep
    assert {r.got.keep for r in rows if r.text == LONG} == {True}


def test_empty_table(spark):
    docs = no_docs(spark)
    assert docs.select(quality.judge(docs, quality.fit(docs))).count() == 0


def test_counts_cover_all_rows(spark):
    assert sum(quality.vote_patterns(edge_docs(spark)).values()) == len(EDGE_ROWS)


def test_query_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op7_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n = {(r.quality, r.keep): r.n for r in got.groupBy("quality", "keep").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n.get((1, False), 0) <= 0.01 * n[(1, True)]  # clean documents stay
    assert n.get((0, False), 0) >= 0.8 * (n.get((0, False), 0) + n.get((0, True), 0))


def slow_features(text, f, bits=12):
    """{bucket: weight}, shape by shape."""
    shape = ["a" if c >= 128 or 97 <= c <= 122 else "A" if 65 <= c <= 90 else "0" if 48 <= c <= 57 else chr(c) for c in text.encode("utf-8", "replace")]
    runs = [s for i, s in enumerate(shape) if i == 0 or shape[i - 1] != s]
    count = {}
    for n in (1, 2, 3):
        for i in range(len(runs) - n + 1):
            h = 0
            for j, s in enumerate(runs[i : i + n]):
                h = ord(s) + 1 if j == 0 else (h * 0x01000193 + ord(s) + 1) & 0xFFFFFFFF
            at = ((h * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - bits)
            count[at] = count.get(at, 0) + 1
    total = sum(count.values())
    out = {k: math.sqrt(v / total) for k, v in count.items()}
    shares = (f.symbols, f.upper, f.same_as_before, f.distinct if f.words >= 60 else 1.0, f.repeated_sentences, f.stop_words, f.marks)
    return out | {(1 << bits) + 8 * i + min(7, int(8 * x)): 0.5 for i, x in enumerate(shares)}


def test_query_equals_slow_scores(spark, monkeypatch):
    """Every document's score, shape by shape in plain Python."""
    sf, kept = "/root/testdata/sf0.001", []
    real = quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a, **k: kept.append(real(*a, **k)) or kept[-1])
    got = {r.doc_id: r for r in QUERIES["op7_quality"](spark, sf).collect()}
    (model,) = kept
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        f = quality.facts(r.text or "")
        z = model.bias + sum(model.weight[k] * w for k, w in slow_features(r.text, f).items()) if f.words else -math.inf
        score = 1 / (1 + math.exp(-min(30, max(-30, z)))) if f.words else 0.0
        assert got[r.doc_id].quality_score == pytest.approx(score, abs=1e-6) and got[r.doc_id].keep == (got[r.doc_id].quality_score >= 0.5)
        assert got[r.doc_id].votes == "".join(map(str, quality.votes(f)))


def test_a_table_of_long_texts_only_trains_a_scorer(spark):
    rows = [(i, prose(i, 5_500)) for i in range(20)] + [(50 + i, "BUY!!! $$$ ### " * 3_000) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scorer = quality.fit(docs)
    assert np.abs(scorer.weight).sum() > 0
    keep = {r.doc_id: r.f.keep for r in docs.select("doc_id", quality.judge(docs, scorer).alias("f")).collect()}
    assert all(keep[i] for i in range(20)) and not any(keep[50 + i] for i in range(6))
