import math
import random
import zlib

import pytest
from llm_data import EDGE_ROWS, edge_docs, no_docs, prose, table
from pyspark.sql import functions as F

from postlake.llm import langid
from postlake.llm.common import crc_fold
from postlake.llm.queries import QUERIES


def slow_subwords(text):
    """Subwords as strings: 2- to 4-grams inside words with edges around."""
    out, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            w = f"<{word}>"
            out += [w[i : i + n] for n in (2, 3, 4) for i in range(len(w) - n + 1)]
            word = ""
    return out


@pytest.mark.parametrize("text", ["", " ", "a", "ab cd", "12 a1b2!", "Été naïve", "one, two - three", prose(4, 50)])
def test_subwords_follow_the_definition(text):
    got = langid.subwords(text, 20)
    want = slow_subwords(text)
    assert len(got) == len(want)
    assert len(set(got.tolist())) == len(set(want))  # 20 bits: no collision in so few


def test_learns_and_rejects():
    texts = [prose(i, 60) for i in range(60)] + [" ".join("der die das und nicht mit von".split()[(i * j) % 7] for j in range(60)) for i in range(60)]
    model = langid.train(texts, ["en"] * 60 + ["de"] * 60, epochs=3)
    names, score, rejected = langid.predict(model, ["the river and the stone", "die das und der", "", None, "42"])
    assert names == ["en", "de", "und", "und", "und"]
    assert list(rejected[2:]) == [True] * 3 and not score[2:].any() and (score <= 1).all()


def test_edge_cases(spark):
    docs = edge_docs(spark)
    model = langid.fit(docs, F.lit(True))
    rows = docs.select("doc_id", "text", langid.identify(docs, model).alias("found")).collect()
    assert len(rows) == len(EDGE_ROWS)
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.found.lang_pred == "und") == (not lettered)
        assert 0 <= r.found.score <= 1


def test_empty_table(spark):
    docs = no_docs(spark)
    model = langid.fit(docs, F.lit(True))
    assert docs.select(langid.identify(docs, model)).count() == 0
    assert langid.predict(model, ["abc"])[0] == ["und"]


def test_query_is_right_on_held_out_documents(spark):
    found = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert found.count() == docs.count()
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98


def test_fold_matches_crc_of_the_id_as_text(spark):
    got = spark.range(50).select("id", crc_fold(F.col("id"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)
    assert table(spark, "documents").count() > 0


GERMAN = "der die und das ist nicht auf dem den mit von haus fluss stein wolke gehen lesen grün leise tisch unter über nord süd weiß schön".split()


def german(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(GERMAN) for _ in range(n))


@pytest.mark.parametrize("english", [30, 5_500])
def test_a_language_of_long_texts_only_is_learned(spark, english):
    rows = [(i, german(i, 5_000), "de") for i in range(30)] + [(100 + i, prose(i, english), "en") for i in range(30)]
    assert min(len(t) for _, t, y in rows if y == "de") > 20_000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, F.col("doc_id") % 3 != 1)
    for r in docs.select("lang", langid.identify(docs, model).alias("f")).collect():
        assert r.f.lang_pred == r.lang and not r.f.rejected


def test_a_rare_language_is_learned(spark):
    rows = [(i, prose(i, 30), "en") for i in range(3_000)] + [(5_000 + i, german(i, 30), "de") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, F.lit(True), sample_rows=200)
    got = docs.where("lang = 'de'").select(langid.identify(docs, model).alias("f")).collect()
    assert model.langs == ["de", "en"] and all(r.f.lang_pred == "de" for r in got)


def test_the_sample_is_the_same_whatever_the_layout_and_bounded(spark):
    from postlake.llm.common import by_hash

    docs = spark.createDataFrame([(i % 300, f"t{i % 300}", "en" if i % 300 > 10 else "fr") for i in range(5_000)], "doc_id long, text string, lang string")
    picks = [F.col("doc_id"), F.col("text")]
    for kw in ({}, {"kind": "lang", "quota": {"en": (40, 4_800), "fr": (8, 200)}}):
        a, b = (sorted(tuple(r) for r in by_hash(d, picks, 50, 5_000, "s", **kw).collect()) for d in (docs.repartition(7), docs.coalesce(1)))
        assert a == b and len(set(a)) == len(a) <= 50
    few = by_hash(docs, picks, 50, 10**15, "s")  # a share far below one in a million lets next to nothing through
    assert few.count() <= 1


def test_query_equals_slow_prediction(spark, monkeypatch):
    """Every document's language and score, word by word in plain Python."""
    sf, kept = "/root/testdata/sf0.001", []
    real = langid.fit
    monkeypatch.setattr(langid, "fit", lambda *a, **k: kept.append(real(*a, **k)) or kept[-1])
    got = {r.doc_id: r for r in QUERIES["op6_language_id"](spark, sf).collect()}
    (model,) = kept
    bits = model.table.shape[0].bit_length() - 1

    def bucket(gram):
        codes = [0 if c in "<>" else ord(c) for c in gram]
        h = codes[0] + 1
        for c in codes[1:]:
            h = (h * 0x01000193 + c + 1) & 0xFFFFFFFF
        return ((h * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - bits)

    for r in table(spark, "documents").select("doc_id", "text").collect():
        grams, sums = slow_subwords(r.text or ""), [0.0] * len(model.langs)
        for g in grams:
            for k, w in enumerate(model.table[bucket(g)].tolist()):
                sums[k] += w
        if not grams:
            assert got[r.doc_id].lang_pred == "und" and got[r.doc_id].score == 0
            continue
        z = [(s / len(grams) + b) / model.temperature for s, b in zip(sums, model.bias.tolist())]
        e = [math.exp(x - max(z)) for x in z]
        assert got[r.doc_id].score == pytest.approx(max(e) / sum(e), abs=1e-4)
        assert got[r.doc_id].lang_pred == model.langs[e.index(max(e))]
