"""Texts cut by a model's own tokens, against the tokenizer's truncation of whole texts."""

import subprocess
import sys

import pyarrow as pa
import pytest
from locations import ROOT, SF_SMALL
from pyspark.sql import functions as F

from postlake.functions.subwords import ROWS, cut_batch, cut_texts, truncate_subwords
from postlake.operators.scoring import BatchScorer, LetterShareScorer, letter_share_factory, score_posts
from postlake.plans.catalog import QUERIES

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")]
ODD = [None, "", " ", "\n\n \t", "x", "a  b   c", " lead and trail \n", "<|endoftext|> is text", "don't we'll", "naïve 世界 \U0001f30d" * 30,
       "x" * 5_000, "y " * 9_000, "One.  Two\n\n\nThree " * 700, "　" * 300 + "wide", "a" + " " * 3_000 + "b"]


def whole(path, text, n):
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.encode_special_tokens = True
    found = tok.encode(text, add_special_tokens=False)
    return text if len(found.ids) <= n else text[: found.offsets[n - 1][1]]


@pytest.mark.parametrize("path", FILES)
@pytest.mark.parametrize("n", [1, 3, 10, 510])
def test_equals_truncating_the_whole_text(path, n):
    assert cut_texts(ODD, path, n) == [None if t is None else whole(path, t, n) for t in ODD]
    assert cut_texts(["a"], path, 0) == [""]


def test_first_tokens_are_those_of_the_whole(spark):
    path = FILES[0]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.model_input for r in QUERIES["truncate_subwords"](spark, SF_SMALL).collect()}
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    cut = 0
    for r in docs.collect():
        assert got[r.doc_id] == whole(path, r.text, 510)
        ids = tok.encode(r.text, add_special_tokens=False).ids
        again = tok.encode(got[r.doc_id], add_special_tokens=False).ids
        assert again[:509] == ids[:509]
        cut += got[r.doc_id] != r.text
    assert cut and len(got) == docs.count()


def test_scorers_read_the_first_subwords(spark):
    df = spark.createDataFrame([(1, "a " * 5 + "o " * 50), (2, None), (3, "")], "doc_id long, text string")
    assert score_posts(df, LetterShareScorer(max_tokens=7, tokenizer=FILES[0]), "text").orderBy("doc_id").first().sentiment_id == 0
    assert score_posts(df, BatchScorer(letter_share_factory(), max_tokens=7, tokenizer=FILES[0]), "text").orderBy("doc_id").first().sentiment_id == 0
    assert df.select(truncate_subwords(F.col("text"), FILES[0], 7).alias("t")).collect()[1].t is None


def test_registered_query_scores_the_cut_texts(spark):
    got = {r.doc_id: r.confidence for r in QUERIES["score_posts_subwords"](spark, SF_SMALL).collect()}
    cut = QUERIES["truncate_subwords"](spark, SF_SMALL).withColumnRenamed("model_input", "text")
    want = score_posts(cut, LetterShareScorer(), "text")
    assert {r.doc_id: pytest.approx(r.confidence, abs=1e-6) for r in want.collect()} == got


PEAK = """
import sys
sys.path.insert(0, sys.argv[1])
from postlake.functions.subwords import cut_texts

def peak():
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith("VmHWM")) // 1024

texts = [f"{i} " + "word " * 800 for i in range(2_000)]
cut_texts(texts[:10], sys.argv[2], 510)
before = peak()
assert len(cut_texts(texts, sys.argv[2], 510)) == len(texts)
print(peak() - before)
"""


def test_tokens_of_few_texts_are_held_at_a_time():
    done = subprocess.run([sys.executable, "-c", PEAK, ROOT, FILES[0]], capture_output=True, text=True, timeout=120, check=True)
    assert int(done.stdout) < 60  # MB; the 1.6 million tokens at once took 173


def test_batches_are_cut_in_slices_of_rows():
    texts = [None if i % 7 == 0 else f"{i} " + "some words " * (i % 11) for i in range(2 * ROWS + 3)]
    assert cut_batch(pa.array(texts), FILES[0], 9).to_pylist() == cut_texts(texts, FILES[0], 9)
    assert cut_batch(pa.array(texts).slice(5, ROWS), FILES[0], 9).to_pylist() == cut_texts(texts[5 : 5 + ROWS], FILES[0], 9)
    assert cut_batch(pa.array([], pa.string()), FILES[0], 9).to_pylist() == []
