"""Distributed 3-class scoring.

A scorer adds a ``logits array<double>`` column; everything after it
(softmax, argmax, confidence, label names, thresholds) is JVM arithmetic.

* ``ColumnScorer`` - logits as a Column expression; no Python worker at all.
* ``BatchScorer``  - a Python model behind an iterator ``pandas_udf``: the
  factory runs once per task, Arrow ships only the text column, and texts are
  re-chunked into the model's batch size. Arrow batches are bounded by rows
  and by bytes (``spark.sql.execution.arrow.maxRecordsPerBatch`` /
  ``maxBytesPerBatch``, 10k rows / 64 MB by default), so long documents
  cannot make a worker hold an unbounded batch. Rows stay where they are (the
  prediction is a column of the same row), so there is no positional join.
* ``ModelScorer``  - a fitted Spark ML ``PipelineModel`` (see ``training``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import ID_TO_LABEL, MAX_TOKENS, SCORE_BATCH_SIZE
from ..functions.probs import label_name
from ..functions.subwords import truncate_subwords
from ..functions.text import model_text, truncate_tokens
from .barrier import materialize

LOGITS = "__logits"


class Scorer:
    """Adds ``out_col`` (array<double> of class logits) for ``text_col``.

    ``max_tokens`` is the model's input limit (P17); None sees whole texts. It counts
    the tokens of ``tokenizer``, a tokenizer file (with the two special ones that a
    model adds), or white-space tokens without one."""

    n_classes: int = 3
    max_tokens: int | None = None
    tokenizer: str | None = None

    def clip(self, text: Column) -> Column:
        if self.max_tokens and self.tokenizer:
            return truncate_subwords(text, self.tokenizer, self.max_tokens)
        return truncate_tokens(text, self.max_tokens) if self.max_tokens else text

    def add_logits(self, df: DataFrame, text_col: str, out_col: str = LOGITS) -> DataFrame:
        raise NotImplementedError


class ColumnScorer(Scorer):
    """Scorer whose logits are a built-in Column expression."""

    def logits(self, text: Column) -> Column:
        raise NotImplementedError

    def add_logits(self, df: DataFrame, text_col: str, out_col: str = LOGITS) -> DataFrame:
        if self.tokenizer and self.max_tokens:  # the logits read the cut text several times
            x = materialize(df.withColumn("__clipped", self.clip(F.col(text_col))), {"__cut": F.col("__clipped")})
            return materialize(x, {out_col: self.logits(F.col("__cut"))}).drop("__clipped", "__cut")
        return materialize(df, {out_col: self.logits(self.clip(F.col(text_col)))})


# --- fixed values of the deterministic test scorer (FIXTURES.md section 5) ---
TEST_LETTERS = ["a", "e", "o"]
TEST_SCALE = 40.0
# -----------------------------------------------------------------------------


class LetterShareScorer(ColumnScorer):
    """Deterministic stand-in model for tests and the bench: the logit of class
    k is ``40 x`` the share of letter k (a, e, o) in the lower-cased text."""

    def __init__(self, letters: Sequence[str] = TEST_LETTERS, scale: float = TEST_SCALE, max_tokens: int | None = None, tokenizer: str | None = None):
        self.max_tokens, self.tokenizer = max_tokens, tokenizer
        self.letters = list(letters)
        self.scale = float(scale)
        self.n_classes = len(self.letters)

    def logits(self, text: Column) -> Column:
        n = F.length(text).cast("double")
        low = F.lower(text)
        parts = [
            F.try_divide(F.lit(self.scale) * (n - F.length(F.replace(low, F.lit(ch), F.lit("")))), n)
            for ch in self.letters
        ]
        return F.array(*parts)


class BatchScorer(Scorer):
    """Python model scorer. ``factory()`` returns ``predict(list[str]) ->
    ndarray[n, k]`` of logits; it is called once per task, never per row."""

    def __init__(
        self,
        factory: Callable[[], Callable[[list[str]], np.ndarray]],
        n_classes: int = 3,
        batch_size: int = SCORE_BATCH_SIZE,
        max_tokens: int | None = MAX_TOKENS,
        tokenizer: str | None = None,
    ):
        self.max_tokens, self.tokenizer = max_tokens, tokenizer
        self.factory = factory
        self.n_classes = n_classes
        self.batch_size = int(batch_size)

    def _udf(self):
        factory, bs, k = self.factory, self.batch_size, self.n_classes

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            predict = factory()
            for s in batches:
                texts = s.where(s.notna(), "").astype(str).tolist()
                outs = [np.asarray(predict(texts[i : i + bs]), dtype="float64") for i in range(0, len(texts), bs)]
                arr = np.concatenate(outs) if outs else np.empty((0, k))
                res = pd.Series(list(arr), index=s.index, dtype=object)
                res[s.isna().to_numpy()] = None
                yield res

        return score

    def add_logits(self, df: DataFrame, text_col: str, out_col: str = LOGITS) -> DataFrame:
        x = df.withColumn("__udf_logits", self._udf()(self.clip(F.col(text_col))))
        return materialize(x, {out_col: F.col("__udf_logits")}).drop("__udf_logits")


def score_batches(
    df: DataFrame,
    scorer_factory: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_size: int = SCORE_BATCH_SIZE,
    text_col: str = "text",
    n_classes: int = 3,
    out_col: str = LOGITS,
    max_tokens: int | None = MAX_TOKENS,
) -> DataFrame:
    """G1: batch inference over all rows - ``df`` plus the class logits of
    ``text_col`` (model loaded once per task, texts of at most ``max_tokens``
    tokens in batches of ``batch_size``)."""
    return BatchScorer(scorer_factory, n_classes, batch_size, max_tokens).add_logits(df, text_col, out_col)


def letter_share_factory(letters: Sequence[str] = TEST_LETTERS, scale: float = TEST_SCALE):
    """Factory for the pandas form of the test scorer (same numbers as
    ``LetterShareScorer``); exercises the Python batch path."""
    letters = list(letters)

    def factory():
        def predict(texts: list[str]) -> np.ndarray:
            s = pd.Series(texts, dtype=object)
            n = s.str.len().astype("float64")
            low = s.str.lower()
            cols = [scale * (n - low.str.replace(ch, "", regex=False).str.len()) / n.where(n > 0) for ch in letters]
            return np.column_stack(cols) if cols else np.empty((len(texts), 0))

        return predict

    return factory


class ModelScorer(Scorer):
    """Fitted Spark ML pipeline whose last stage yields ``rawPrediction``
    (multinomial logistic regression margins = logits). A class that no training
    row had, or that the model does not know, gets ``ABSENT_MARGIN``."""

    def __init__(self, model, input_col: str = "__model_text", n_classes: int = 3, max_tokens: int | None = MAX_TOKENS):
        self.max_tokens = max_tokens
        self.model = model
        self.input_col = input_col
        self.n_classes = n_classes

    def add_logits(self, df: DataFrame, text_col: str, out_col: str = LOGITS) -> DataFrame:
        cols = df.columns
        x = df.withColumn(self.input_col, self.clip(model_text(text_col)))
        return _logits_of(self.model.transform(x), cols, out_col, self.n_classes)

    def add_logits_featurized(self, df: DataFrame, tf_col: str, out_col: str = LOGITS) -> DataFrame:
        """Logits for rows that already carry the hashed term frequencies of
        the pipeline's tokenise + hash stages: only the fitted stages after
        them (IDF, classifier) run."""
        from pyspark.ml import PipelineModel
        from pyspark.ml.feature import HashingTF, RegexTokenizer

        stages = self.model.stages
        if not (isinstance(stages[0], RegexTokenizer) and isinstance(stages[1], HashingTF)):
            raise TypeError("the model does not start with tokenise + hash stages")
        cols = df.columns
        x = df.withColumn(stages[1].getOutputCol(), F.col(tf_col))
        return _logits_of(PipelineModel(stages[2:]).transform(x), cols, out_col, self.n_classes)


#: Logit of a class that a model does not know: finite, and no chance after softmax.
ABSENT_MARGIN = -1e6


def known_margins(margins: Column, n_classes: int) -> Column:
    """``n_classes`` finite logits from a model's margins; a class without one
    gets ``ABSENT_MARGIN``, the only class of the training rows (for which a
    model's margin is infinite) at most its opposite."""
    low, high = F.lit(ABSENT_MARGIN), F.lit(-ABSENT_MARGIN)
    return F.array(*(F.least(F.greatest(F.coalesce(F.get(margins, i), low), low), high) for i in range(n_classes)))


def _logits_of(transformed: DataFrame, cols: list[str], out_col: str, n_classes: int) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    y = materialize(transformed.select(*cols, "rawPrediction"), {"__margins": vector_to_array(F.col("rawPrediction"))})
    return materialize(y, {out_col: known_margins(F.col("__margins"), n_classes)}).drop("rawPrediction", "__margins")


class FeaturizedScorer(Scorer):
    """A ``ModelScorer`` applied to rows that carry its term-frequency vectors
    in ``tf_col`` (the text column passed to ``add_logits`` is not read)."""

    def __init__(self, inner: ModelScorer, tf_col: str):
        self.inner = inner
        self.tf_col = tf_col
        self.n_classes = inner.n_classes

    def add_logits(self, df: DataFrame, text_col: str, out_col: str = LOGITS) -> DataFrame:
        return self.inner.add_logits_featurized(df, self.tf_col, out_col)


# --- probability columns ------------------------------------------------------


def prob_columns(logits: Column | str, k: int = 3) -> list[Column]:
    """Softmax of a k-length logits array as k scalar Columns (codegen-able
    element arithmetic; the max shift keeps exp() finite)."""
    l = F.col(logits) if isinstance(logits, str) else logits
    xs = [F.get(l, i).cast("double") for i in range(k)]
    m = F.greatest(*xs) if k > 1 else xs[0]
    es = [F.exp(x - m) for x in xs]
    z = es[0]
    for e in es[1:]:
        z = z + e
    return [e / z for e in es]


def add_probs(df: DataFrame, logits_col: str = LOGITS, k: int = 3, out_col: str = "__probs") -> DataFrame:
    return materialize(df, {out_col: F.array(*prob_columns(logits_col, k))})


def score_posts(
    df: DataFrame,
    scorer: Scorer,
    text_col: str = "text",
    id2label: dict[int, str] | None = None,
) -> DataFrame:
    """Input rows + ``sentiment, sentiment_id, confidence, negative_prob,
    neutral_prob, positive_prob``.

    The probabilities are materialised once per row (``__probs``); argmax takes
    the first index on ties; confidence is the chosen class's probability.
    """
    cols = df.columns
    k = scorer.n_classes
    x = add_probs(scorer.add_logits(df, text_col), LOGITS, k)
    p = F.col("__probs")
    sid = (F.array_position(p, F.array_max(p)) - 1).cast("int")
    names = id2label or ID_TO_LABEL
    extra = [
        label_name(sid, names).alias("sentiment"),
        sid.alias("sentiment_id"),
        F.array_max(p).alias("confidence"),
    ]
    extra += [F.get(p, i).alias(f"{names.get(i, str(i))}_prob") for i in range(k)]
    return x.select(*cols, *extra)


def pseudo_label(
    df: DataFrame,
    scorer: Scorer,
    threshold: float,
    text_col: str = "text",
) -> DataFrame:
    """G6 + F6: confident rows only (``confidence >= threshold``, inclusive),
    with the predicted ``label_id`` and its ``confidence``. The model input is
    the stripped text, as in the reference's pseudo-labelling pass."""
    cols = df.columns
    if isinstance(scorer, FeaturizedScorer) or getattr(scorer, "featurized", False):  # reads stored vectors, no text
        s = score_posts(df, scorer, text_col)
    else:
        s = score_posts(df.withColumn("__model_text", model_text(text_col)), scorer, "__model_text")
    return s.filter(F.col("confidence") >= F.lit(float(threshold))).select(
        *cols, F.col("sentiment_id").alias("label_id"), "confidence"
    )
