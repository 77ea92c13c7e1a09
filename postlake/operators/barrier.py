"""Compute expensive derived columns exactly once per row.

Catalyst pushes a filter below the projection that defines the columns it
tests and substitutes their definitions into the predicate. For a cheap column
that is what we want; for a regex chain or a softmax over model logits it
evaluates the whole chain again inside the filter (and nested definitions
multiply: each softmax term re-expands every logit, each logit the text
preprocessing).

``materialize`` defines the columns through a one-row ``inline`` generator
instead of a projection. A filter that tests a generated column cannot move
below the generator, so each definition is evaluated once; filters on the
original columns still reach the scan. Generate is whole-stage-codegen'd, so
the barrier costs one small struct per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def materialize(df: DataFrame, cols: dict[str, Column], order: list[str] | None = None) -> DataFrame:
    """``df`` plus (or with replaced) ``cols``, each computed once per row."""
    keep = [c for c in df.columns if c not in cols]
    gen = F.inline(F.array(F.struct(*[e.alias(n) for n, e in cols.items()])))
    out = df.select(*keep, gen)
    if order is not None:
        out = out.select(*order)
    return out
