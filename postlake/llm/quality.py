"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on each whole text; a
labeller is silent on texts too short for what it measures. Expectation-
maximisation over the counts of vote patterns (of all documents; at most 4 **
labellers exist, a few hundred occur) estimates each labeller's accuracy and the
class share without any true label. The patterns' posteriors label a bounded
sample, on which a logistic scorer over hashed features is trained in numpy;
its score decides, so that a text whose labellers abstain is judged too.

Features are hashed 1- to 3-grams of the text's shape (letters by case, digits,
white space and each other ASCII character, runs collapsed) and bucketed
shares of repeated words and sentences: they don't depend on a vocabulary.

Edge cases: a null text counts as empty. On a text without a word all are silent
but ``no_words``, which calls it bad; it is rejected with score 0.
Texts are judged whole, one at a time, in memory of some times their length.
Repeated rows get equal results and count as often as they occur. An empty
table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_hash

BAD, GOOD, ABSTAIN, SILENT = range(4)
#: Frequent short words of the languages the corpus is made of.
STOP_WORDS = frozenset(
    "the of and to in is that it for on was as with be by are this an or at from "
    "de la le les des et en un une que qui pour dans est du sur par pas plus avec "
    "der die und das den mit von ist zu auf für nicht ein eine sich dem als "
    "el los las una y por con no su para se lo como al del es".split()
)
_SENTENCE = re.compile(r"[.!?\n]+")
SCHEMA = "quality_score double, keep boolean, votes array<tinyint>"


@dataclass
class TextFacts:
    words: int
    symbols: float
    upper: float
    same_as_before: float
    distinct: float
    repeated_sentences: float
    stop_words: float
    ended_lines: float
    marks: float
    word_length: float


_LETTERS = np.concatenate((np.arange(65, 91), np.arange(97, 123)))
_DIGITS = np.arange(48, 58)
_PLAIN = np.array([9, 10, 11, 12, 13, *map(ord, " !\"'(),-.:;?")])
_MARKS = np.array([*map(ord, "!|#$%&*")])


def facts(text: str) -> TextFacts:
    """Shares measured over a whole text (0 where there is nothing to measure).

    Case does not count in words; letters beyond ASCII are no symbols.
    """
    data = text.encode("utf-8", "replace")
    per = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    ascii_ = int(per[:128].sum())
    alpha = int(per[_LETTERS].sum())
    words = text.lower().split()
    n = max(len(words), 1)
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    sentences = [x for x in map(str.strip, _SENTENCE.split(text)) if x]
    return TextFacts(
        words=len(words),
        symbols=(ascii_ - alpha - int(per[_DIGITS].sum()) - int(per[_PLAIN].sum())) / max(len(text), 1),
        upper=int(per[65:91].sum()) / max(alpha, 1),
        same_as_before=sum(map(str.__eq__, words, words[1:])) / n,
        distinct=len(set(words)) / n,
        repeated_sentences=1 - len(set(sentences)) / max(len(sentences), 1),
        stop_words=sum(map(STOP_WORDS.__contains__, words)) / n,
        ended_lines=sum(x[-1] in ".!?…:\"'" for x in lines) / max(len(lines), 1),
        marks=int(per[_MARKS].sum()) / n,
        word_length=len(text) / n - 1,
    )


def _from(value: float, least: float, vote: int) -> int:
    return vote if value >= least else ABSTAIN


def _to(value: float, most: float, vote: int) -> int:
    return vote if value <= most else ABSTAIN


#: Each labeller: fewest words of a text it votes on, and its vote.
LABELLERS = {
    "no_words": (0, lambda f: _to(f.words, 0, BAD)),
    "symbols": (3, lambda f: _from(f.symbols, 0.08, BAD)),
    "shouting": (8, lambda f: _from(f.upper, 0.5, BAD)),
    "stutter": (8, lambda f: _from(f.same_as_before, 0.2, BAD)),
    "poor_vocabulary": (60, lambda f: _to(f.distinct, 0.15, BAD)),
    "repeated_sentences": (20, lambda f: _from(f.repeated_sentences, 0.5, BAD)),
    "marks": (8, lambda f: _from(f.marks, 0.25, BAD)),
    "function_words": (20, lambda f: BAD if f.stop_words <= 0.02 else _from(f.stop_words, 0.15, GOOD)),
    "ended_lines": (20, lambda f: BAD if f.ended_lines <= 0.15 else _from(f.ended_lines, 0.7, GOOD)),
    "varied_words": (60, lambda f: _from(f.distinct, 0.4, GOOD)),
    "word_length": (8, lambda f: BAD if f.word_length > 25 else _to(abs(f.word_length - 6), 4, GOOD)),
}


def votes(f: TextFacts) -> list[int]:
    return [vote(f) if f.words >= least else SILENT for least, vote in LABELLERS.values()]


def pattern(v: list[int]) -> int:
    out = 0
    for x in v:
        out = out * 4 + x
    return out


def unpattern(p: np.ndarray, n: int = len(LABELLERS)) -> np.ndarray:
    return np.stack([(p // 4 ** (n - 1 - i)) % 4 for i in range(n)], axis=1)


@dataclass
class LabelModel:
    """Share of good texts, and the chance of each vote given the class."""

    good: float
    chance: np.ndarray  # labeller x class x vote, class 0 is bad

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance that a text of each vote pattern is good. To abstain says
        something, to be silent nothing."""
        v = unpattern(np.asarray(patterns, np.int64))
        log = np.log(np.array([1 - self.good, self.good])) + np.zeros((len(v), 2))
        for j in range(v.shape[1]):
            spoke = v[:, j] != SILENT
            log[spoke] += np.log(self.chance[j][:, v[spoke, j]]).T
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -700, 700)))


#: What a labeller is believed to do before any text is seen: a bad text is
#: called bad more often than a good one is (class x vote: bad, good, none).
BELIEF = np.array([[0.3, 0.3, 0.4], [0.02, 0.5, 0.48]])


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation from ``BELIEF``, whose pseudo-counts (a
    thousandth of the texts) keep the classes the right way round."""
    v = unpattern(np.asarray(patterns, np.int64))
    counts = np.asarray(counts, float)
    model = LabelModel(0.9, np.repeat(BELIEF[None], len(LABELLERS), axis=0))
    prior = 0.001 * counts.sum() + 1
    for _ in range(rounds if len(v) else 0):
        good = model.posterior(patterns)
        w = np.stack([(1 - good) * counts, good * counts])
        chance = np.empty_like(model.chance)
        for j in range(v.shape[1]):
            n = np.stack([w[:, v[:, j] == vote].sum(axis=1) for vote in (BAD, GOOD, ABSTAIN)], axis=1) + prior * BELIEF
            chance[j] = n / n.sum(axis=1, keepdims=True)
        share = (w[1].sum() + 9) / (counts.sum() + 10)
        moved = np.abs(chance - model.chance).max()
        model = LabelModel(float(share), chance)
        if moved < 1e-7:
            break
    return model


#: Shape of each UTF-8 byte: a lower-case letter (also all beyond ASCII), an
#: upper-case one, a digit, or the ASCII character itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48


def features(text: str, f: TextFacts, bits: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, weight) pairs of a text with a word."""
    s = _SHAPE[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    s = s[np.concatenate(([True], s[1:] != s[:-1]))]
    count = np.zeros(1 << bits, np.int64)
    with np.errstate(over="ignore"):
        base = h = s.astype(np.uint32) + np.uint32(1)
        for n in (1, 2, 3):
            if n > 1:
                h = h[:-1] * np.uint32(0x01000193) + base[n - 1 :]
            count += np.bincount((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits), minlength=1 << bits)
    at = np.flatnonzero(count)
    shares = (f.symbols, f.upper, f.same_as_before, f.distinct if f.words >= 60 else 1.0, f.repeated_sentences, f.stop_words, f.marks)
    own = np.array([(1 << bits) + 8 * i + min(7, int(8 * x)) for i, x in enumerate(shares)])
    return np.concatenate((at, own)), np.concatenate((np.sqrt(count[at] / count.sum()), np.full(len(own), 0.5)))


@dataclass
class Scorer:
    weight: np.ndarray
    bias: float
    labels: LabelModel

    def score(self, text: str | None) -> tuple[float, list[int]]:
        f = facts(text or "")
        v = votes(f)
        if not f.words:
            return 0.0, v
        at, w = features(text, f)
        return float(1 / (1 + np.exp(-np.clip(self.weight[at] @ w + self.bias, -30, 30)))), v


def train(texts: list[str], labels: LabelModel, bits: int = 12, epochs: int = 6, rate: float = 0.5, seed: int = 5) -> Scorer:
    """Logistic regression by stochastic gradient descent on posterior labels."""
    return learn([c for c in (case(t, bits) for t in texts) if c], labels, bits, epochs, rate, seed)


def case(text: str, bits: int = 12) -> tuple[np.ndarray, np.ndarray, int] | None:
    """(buckets, weights, vote pattern) of a text with a word."""
    f = facts(text)
    return (*features(text, f, bits), pattern(votes(f))) if f.words else None


def learn(found: list[tuple[np.ndarray, np.ndarray, int]], labels: LabelModel, bits: int = 12, epochs: int = 6, rate: float = 0.5, seed: int = 5) -> Scorer:
    rng = np.random.default_rng(seed)
    cases = [(at, x, float(labels.posterior(np.array([p]))[0])) for at, x, p in found]
    w, b = np.zeros((1 << bits) + 64), float(np.log(labels.good / (1 - labels.good)))
    steps, done = epochs * max(len(cases), 1), 0
    for _ in range(epochs):
        for i in rng.permutation(len(cases)):
            at, x, y = cases[i]
            lr = rate * (1 - done / steps) + 0.01
            done += 1
            g = 1 / (1 + np.exp(-np.clip(w[at] @ x + b, -30, 30))) - y
            w[at] -= lr * g * x
            b -= lr * 0.1 * g
    return Scorer(w, b, labels)


def vote_patterns(docs: DataFrame, text: str = "text") -> Counter:
    """How often each vote pattern occurs, over all of ``docs``."""

    @F.arrow_udf("int")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([pattern(votes(facts(x or ""))) for x in batch.to_pylist()], pa.int32())

    got = docs.select(run(F.col(text)).alias("p")).groupBy("p").count().collect()  # at most 4 ** labellers rows
    return Counter({r["p"]: r["count"] for r in got})


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", sample_rows: int = 4_000) -> Scorer:
    """Label model from all of ``docs``; scorer from about ``sample_rows`` rows, those
    with the smallest hashes of key and text. Their features are taken from whole
    texts, in tasks: at most 2 ** 12 and some numbers a row reach the driver.
    """
    seen = vote_patterns(docs, text)
    p = np.array(sorted(seen), np.int64)
    labels = estimate(p, np.array([seen[x] for x in p], float))
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    few = by_hash(rows, [F.col("key"), F.col("text")], sample_rows, sum(seen.values()), "quality")

    @F.arrow_udf("struct<at:array<smallint>,w:array<double>,p:int>")
    def found(batch: pa.Array) -> pa.Array:
        got = [case(t) for t in batch.to_pylist()]
        kind = pa.struct([("at", pa.list_(pa.int16())), ("w", pa.list_(pa.float64())), ("p", pa.int32())])
        return pa.array([None if c is None else {"at": c[0].astype(np.int16), "w": c[1], "p": c[2]} for c in got], kind)

    told = few.select("key", F.xxhash64("text").alias("h"), found("text").alias("c")).where("c is not null").select("key", "h", "c.*").toArrow()
    told = told.sort_by([("key", "ascending"), ("h", "ascending")])
    cases = [(np.asarray(at, np.int64), np.asarray(w, float), int(v)) for at, w, v in zip(*(told[c].to_pylist() for c in ("at", "w", "p")))]
    return learn(cases, labels)


def judge(docs: DataFrame, scorer: Scorer, text: str = "text", keep_from: float = 0.5) -> Column:
    """A struct column (quality_score, keep, votes) for ``docs``' whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # one weight for each bucket

    @F.arrow_udf(SCHEMA)
    def run(batch: pa.Array) -> pa.Array:
        got = [shared.value.score(x) for x in batch.to_pylist()]
        score = np.array([s for s, _ in got], float)
        return pa.StructArray.from_arrays(
            [pa.array(score), pa.array(score >= keep_from), pa.array([v for _, v in got], pa.list_(pa.int8()))], ["quality_score", "keep", "votes"])

    return run(F.col(text))
