"""Value parsers for the raw posts (all inputs are strings).

Every parser is a pure Column expression, so it stays inside whole-stage
codegen and never raises on malformed input under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (
    FALSE_WORDS,
    HASHTAG_SPLIT_PATTERN,
    HASHTAG_STRIP_PATTERN,
    TRUE_WORDS,
    TS_FORMAT,
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts(col: Column | str, fmt: str = TS_FORMAT) -> Column:
    """Strict ``dd-MM-yyyy HH:mm`` parse; anything else (one-digit fields,
    seconds, ISO order, 31 Feb, padding) becomes null."""
    return F.try_to_timestamp(_c(col), F.lit(fmt))


# Bytes the legacy string->long cast skips at both ends: ASCII whitespace and
# ISO control characters.
_CAST_PAD = r"^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$"


def to_long(col: Column | str) -> Column:
    """Count cast with the legacy (non-ANSI) semantics the reference relies on.

    ``'834.0'`` -> 834, ``'12.9'`` -> 12, ``'-0.5'`` -> 0, ``'.5'`` -> 0,
    ``' 7 '`` -> 7; exponents, junk and out-of-range values -> null. The
    integral part is extracted as text and range-checked by ``try_cast``, so
    nothing can round up and nothing throws.
    """
    t = F.regexp_replace(_c(col).cast("string"), _CAST_PAD, "")
    integral = F.regexp_extract(t, r"^([+-]?[0-9]+)", 1)
    return (
        F.when(t.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$"), integral.try_cast("bigint"))
        .when(t.rlike(r"^[+-]?\.[0-9]*$"), F.lit(0).cast("bigint"))
        .otherwise(F.lit(None).cast("bigint"))
    )


def word_value(col: Column | str, values: dict) -> Column:
    """The value that ``values`` has for a whole word; null for any other word,
    and for null. Words are compared as they are: fold the column's case, or
    trim it, before where that is wanted."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), _c(col).cast("string"))


def to_bool(col: Column | str) -> Column:
    """Boolean words in any case, not trimmed."""
    known = dict.fromkeys(TRUE_WORDS, True) | dict.fromkeys(FALSE_WORDS, False)
    return word_value(F.lower(_c(col).cast("string")), known)


def hashtags_str(col: Column | str) -> Column:
    """List punctuation removed everywhere (so apostrophes vanish); null -> ''."""
    return F.regexp_replace(F.coalesce(_c(col), F.lit("")), HASHTAG_STRIP_PATTERN, "")


def parse_hashtags(col: Column | str) -> Column:
    """``"['A','B ']"`` -> ``[a, b]``; order and duplicates kept, empties dropped,
    never null."""
    parts = F.split(hashtags_str(col), HASHTAG_SPLIT_PATTERN)
    return F.filter(F.transform(parts, lambda x: F.lower(F.trim(x))), lambda x: x != F.lit(""))


def derive_date(col: Column | str) -> Column:
    return F.to_date(_c(col))
