"""Text normalisation expressions (JVM regex, Java ASCII classes)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import MAX_TOKENS, MENTION_PATTERN, PY_SPACE_CLASS, URL_PATTERN, WHITESPACE_PATTERN


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_urls(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), URL_PATTERN, " ")


def strip_mentions(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), MENTION_PATTERN, " ")


def normalize_ws(col: Column | str) -> Column:
    """Whitespace runs -> one space, trim (spaces only), lower-case last."""
    return F.lower(F.trim(F.regexp_replace(_c(col), WHITESPACE_PATTERN, " ")))


def clean_text(col: Column | str) -> Column:
    """URLs, then mentions, then whitespace; lower-casing last (so upper-case
    ``HTTP://`` survives as ``http://``)."""
    return normalize_ws(strip_mentions(strip_urls(col)))


def clean_location(col: Column | str) -> Column:
    return normalize_ws(col)


def py_strip(col: Column | str) -> Column:
    """Python ``str.strip()`` (Unicode whitespace) as a JVM expression.

    Only anchored-at-start patterns are used: an end-anchored ``[...]+$`` is
    retried from every position of the text (quadratic in long runs of
    words), so the tail is stripped on the reversed string, and only when
    the last character is whitespace at all."""
    lead = f"^{PY_SPACE_CLASS}+"
    head = F.regexp_replace(_c(col), lead, "")
    tail_ws = F.substring(head, -1, 1).rlike(f"^{PY_SPACE_CLASS}$")
    return F.when(tail_ws, F.reverse(F.regexp_replace(F.reverse(head), lead, ""))).otherwise(head)


def is_blank(col: Column | str) -> Column:
    """True when null or only Unicode whitespace (the pandas-side blank test)."""
    c = _c(col)
    return c.isNull() | c.rlike(f"^{PY_SPACE_CLASS}*$")


def model_text(col: Column | str) -> Column:
    """Model input text: to string, stripped; null becomes ''."""
    return py_strip(F.coalesce(_c(col).cast("string"), F.lit("")))


def truncate_tokens(col: Column | str, n: int = MAX_TOKENS) -> Column:
    """The first ``n`` whitespace tokens, the input limit of a model. Scorers
    with ``max_tokens``, and training, apply it."""
    return F.array_join(F.slice(F.split(_c(col), WHITESPACE_PATTERN), 1, n), " ")
