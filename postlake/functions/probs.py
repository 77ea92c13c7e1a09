"""Class-probability arithmetic on ``array<double>`` columns (higher-order
functions, so no Python worker is involved)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import ID_TO_LABEL, LABEL_TO_ID
from .parse import word_value


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element
    ``transform``): a value used inside a lambda would otherwise be
    recomputed for every array element."""
    return F.get(F.transform(F.array(value), body), 0)


def softmax(logits: Column | str) -> Column:
    """Numerically stable softmax: shift by the max, exponentiate, normalise.
    The max and the normaliser are computed once per row (O(k))."""
    l = _c(logits).cast("array<double>")
    shifted = _let(F.array_max(l), lambda m: F.transform(l, lambda x: F.exp(x - m)))
    return _let(
        shifted,
        lambda e: _let(
            F.aggregate(e, F.lit(0.0).cast("double"), lambda acc, x: acc + x),
            lambda z: F.transform(e, lambda x: x / z),
        ),
    )


def argmax(probs: Column | str) -> Column:
    """0-based index of the largest value; the first index wins on ties."""
    p = _c(probs)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def confidence(probs: Column | str) -> Column:
    return F.array_max(_c(probs))


def log_softmax_at(logits: Column | str, idx: Column | str) -> Column:
    """``log p[idx]`` from logits (log-sum-exp form, never -inf for finite logits)."""
    l = _c(logits).cast("array<double>")

    def lse(mx: Column) -> Column:
        return mx + F.log(F.aggregate(l, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x - mx)))

    return F.get(l, _c(idx).cast("int")) - _let(F.array_max(l), lse)


def label_id(col: Column | str, mapping: dict[str, int] | None = None) -> Column:
    """Exact (case-sensitive) label name -> id; unknown -> null."""
    return word_value(col, mapping or LABEL_TO_ID).cast("int")


def label_name(col: Column | str, id2label: dict[int, str] | None = None) -> Column:
    """Class id -> label name via a literal map; unknown id -> null."""
    m = id2label or ID_TO_LABEL
    kv = []
    for k, v in m.items():
        kv += [F.lit(int(k)), F.lit(v)]
    return F.try_element_at(F.create_map(*kv), _c(col).cast("int"))
