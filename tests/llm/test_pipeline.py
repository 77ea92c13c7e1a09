import numpy as np
import pyarrow as pa
import pytest
from llm_data import SF, edge_docs, no_docs, prose

import corpus_pipeline as P
from postlake.llm import packing
from test_simhash import slow_components


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["language_id", "quality_classifier", "simhash_near_dedup", "packing"]
    assert P.ORACLE_SQL is None


@pytest.mark.parametrize("k", range(4))
def test_each_stage_stands_edge_cases(spark, k):
    docs = edge_docs(spark)
    out = P.STAGES[k][1](spark, docs, SF)
    rows = out.collect()
    if k < 3:
        assert out.columns == docs.columns
        assert len(rows) <= docs.count()
    assert P.STAGES[k][1](spark, no_docs(spark), SF).count() == 0


def test_near_dedup_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    kept = P.simhash_near_dedup(spark, docs, SF)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {low for _, _, low in slow_components(rows)}


def test_near_dedup_stage_loses_no_text_and_keeps_no_copy(spark):
    rows = [(3, prose(20, 60)), (7, prose(21, 60)), (7, prose(20, 60)), (None, prose(21, 60)), (None, prose(22, 60)), (None, prose(22, 60))]
    kept = P.simhash_near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[1], rows[4]], key=str)


def test_clean_documents_stay_in_the_filters(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in P.language_id(spark, docs, sf).select("doc_id").collect()}
    assert len(kept) == docs.count()  # all are in a language that was learned
    kept = {r.doc_id for r in P.quality_classifier(spark, docs, sf).select("doc_id").collect()}
    good, bad = ([d for d, q in labels.items() if q == y] for y in (1, 0))
    assert sum(d in kept for d in good) / len(good) > 0.99 and sum(d in kept for d in bad) / len(bad) < 0.2


def test_run_packs_what_the_stages_keep(spark):
    rows = P.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES[:3]:
        docs = stage(spark, docs, SF).cache()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in rows} == set(texts)
    words = packing.WordIds(packing.tokenizer_path())
    for (d, t), ids in zip(texts.items(), words.texts(pa.array(list(texts.values())))):
        assert sum(r.length for r in rows if r.doc_id == d) == len(np.frombuffer(ids, "<u4")) + 1
    docs.unpersist()
