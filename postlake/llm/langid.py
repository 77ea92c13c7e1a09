"""Language identification: averaged hashed subword embeddings, linear softmax.

A text's letters are lower-cased and every run of other characters becomes one
word boundary; its subwords are the 2-, 3- and 4-grams inside bounded words,
hashed to 2 ** ``bits`` rows of an embedding table. The mean of a text's rows
goes through a linear softmax layer. Both are trained by stochastic gradient
descent in numpy on a bounded sample; a temperature and a rejection threshold
are then set on texts held out of that sample.

Edge cases: a null text, an empty one and one without a letter get ``und`` with
score 0 and are rejected. With no labelled row at all every text gets ``und``.
A language that only long texts have is learned from passages of them; a rare one
from ``least_rows`` rows at least. Equal rows are learned from once.
Repeated rows get equal results. Other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_hash, codepoints, cut_text, letters, passages

UNKNOWN = "und"
SCHEMA = "lang_pred string, score double, rejected boolean"


@dataclass
class LangModel:
    """``table`` holds embedding times softmax weights, one row for each bucket."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float


def subwords(text: str, bits: int) -> np.ndarray:
    """Bucket (of 2 ** ``bits``) of every subword of ``text``, with repeats."""
    cp = codepoints(text.lower())
    ok = letters()[cp]
    # a boundary before the first letter, one after each word, letters between
    first = ok & ~np.concatenate(([False], ok[:-1]))
    n_first = np.cumsum(first)
    if not len(cp) or not n_first[-1]:
        return np.empty(0, np.uint32)
    seq = np.zeros(int(ok.sum()) + int(n_first[-1]) + 1, np.uint32)
    seq[(np.cumsum(ok) - 1 + n_first)[ok]] = cp[ok]
    edge = seq == 0
    out = []
    with np.errstate(over="ignore"):
        h = seq = seq + np.uint32(1)
        inner = np.zeros(len(seq), bool)  # a boundary strictly inside the gram
        for n in (2, 3, 4):
            k = len(h) - 1
            h = h[:k] * np.uint32(0x01000193) + seq[n - 1 :]
            if n > 2:
                inner = inner[:k] | edge[n - 2 : n - 2 + k]
            gram = h[~inner[:k]] * np.uint32(0x9E3779B1)
            out.append(gram >> np.uint32(32 - bits))
    return np.concatenate(out)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], langs: list[str], bits: int = 15, dim: int = 16, epochs: int = 4, rate: float = 0.5,
          reject_share: float = 0.002, seed: int = 7) -> LangModel:
    """Fit on ``texts``; each also gives a short excerpt, so that short texts are known.

    One text in five is held out to fit the temperature and the rejection
    threshold: the score that the right language of all but ``reject_share`` of
    them reaches, 0.5 at most (above that a text is more likely right than wrong).
    """
    names = sorted(set(langs))
    buckets = 1 << bits
    if not names:
        return LangModel([], np.zeros((buckets, 0), np.float32), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    cases = []
    for t, lang in zip(texts, langs):
        words = t.split()
        for part in (t, " ".join(words[(a := int(rng.integers(0, max(1, len(words) - 4)))) : a + int(rng.integers(3, 30))])):
            f = subwords(part, bits)
            if len(f):
                u, c = np.unique(f, return_counts=True)
                cases.append((u, (c / len(f)).astype(np.float32), names.index(lang), rng.random() < 0.2))
    emb = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    out = np.zeros((dim, len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)
    fit = [c for c in cases if not c[3]] or cases
    steps, done = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fit)):
            u, w, y, _ = fit[i]
            lr = np.float32(rate * (1 - done / steps) + 0.01)
            done += 1
            v = w @ emb[u]
            g = _softmax(v @ out + bias)
            g[y] -= 1
            back = out @ g
            out -= lr * np.outer(v, g)
            bias -= lr * 0.1 * g
            emb[u] -= (lr * 8) * np.outer(w, back)  # a row's weight is small: its share of the text
    table = (emb @ out).astype(np.float32)
    held = [c for c in cases if c[3]] or cases
    z = np.array([w @ table[u] + bias for u, w, _, _ in held], float).reshape(len(held), len(names))
    y = np.array([c[2] for c in held], int)
    best = 1.0
    if len(held) and len(names) > 1:
        grid = np.geomspace(0.2, 5, 33)
        best = float(grid[np.argmin([-np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid])])
    right = _softmax(z / best)[np.arange(len(y)), y] if len(held) else np.ones(1)
    return LangModel(names, table, bias, best, float(min(0.5, np.quantile(right, reject_share))))


def predict(model: LangModel, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and rejection of each whole text."""
    bits, k = model.table.shape[0].bit_length() - 1, model.table.shape[1]
    total = np.zeros((len(texts), k), float)
    count = np.zeros(len(texts), np.int64)
    if k:
        for i, text in enumerate(texts):
            for part in cut_text(text or ""):
                f = subwords(part, bits)
                count[i] += len(f)
                total[i] += np.take(model.table, f, axis=0).sum(axis=0)
    known = count > 0
    p = np.zeros((len(texts), max(k, 1)))
    if k:
        p[known] = _softmax((total[known] / count[known, None] + model.bias) / model.temperature)
    top = p.argmax(axis=1)
    score = p.max(axis=1)
    names = [model.langs[j] if ok else UNKNOWN for j, ok in zip(top, known)]
    return names, score, ~known | (score < model.reject_below)


def fit(docs: DataFrame, eligible: Column, text: str = "text", lang: str = "lang", key: str = "doc_id",
        sample_rows: int = 4_000, least_rows: int = 100, **options) -> LangModel:
    """Train on about ``sample_rows`` rows that ``eligible`` admits: of each language
    its share of them, but at least ``least_rows``, or all if it has fewer.

    The rows are those with the smallest hashes of key and text. Of a text of more
    than 20,000 characters ten passages from all over it are learned from, which
    bounds what reaches the driver; whole texts are identified.
    """
    rows = docs.where(eligible & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    count = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    total = max(1, sum(count.values()))
    quota = {k: (max(least_rows, round(sample_rows * n / total)), n) for k, n in count.items()}
    few = by_hash(rows, [F.col("key"), F.col("text")], sample_rows, total, "lang", "lang", quota)
    got = few.select("key", passages(F.col("text")).alias("text"), "lang").toPandas().sort_values(["key", "text", "lang"])
    return train(got["text"].tolist(), got["lang"].tolist(), **options)


def identify(docs: DataFrame, model: LangModel, text: str = "text") -> Column:
    """A struct column (lang_pred, score, rejected) for ``docs``' whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages floats

    @F.arrow_udf(SCHEMA)
    def run(batch: pa.Array) -> pa.Array:
        names, score, rejected = predict(shared.value, batch.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score), pa.array(rejected)], ["lang_pred", "score", "rejected"])

    return run(F.col(text))
