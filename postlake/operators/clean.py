"""Clean stage: typed projection, validity filters, deterministic dedup.

The whole stage is one scan, one projection and one shuffle (the dedup).
Every expression is a built-in function, so the stage runs inside
whole-stage codegen with no Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.constants import BOOL_COLUMNS, CLEAN_COLUMNS, COUNT_COLUMNS, DEDUP_KEYS
from ..functions.parse import derive_date, hashtags_str, parse_hashtags, parse_ts, to_bool, to_long
from ..functions.text import clean_location, clean_text
from .barrier import materialize


def typed_posts(df: DataFrame, barrier: bool = True) -> DataFrame:
    """All per-row derivations of the clean job, each evaluated once.

    ``date`` and ``user_created`` are required (used without a presence check,
    as in the reference); every other derived column exists only when its
    input column does.

    The columns the validity filters test (counts, ``tweet_ts``,
    ``text_clean``) are produced by a one-row generator (``barrier``), so the
    filters test the computed values instead of re-running the regex and cast
    chains inside a pushed-down predicate; the other derivations are a plain
    projection that Catalyst places after the filters, so dropped rows never
    pay for hashtag parsing or location cleanup.
    """
    cols = set(df.columns)
    tested: dict[str, Column] = {c: to_long(c) for c in df.columns if c in COUNT_COLUMNS}
    tested["tweet_ts"] = parse_ts("date")
    if "text" in cols:
        tested["text_clean"] = clean_text("text")
    if barrier:
        x = materialize(df, tested)
    else:
        x = df.select(*[F.col(c) for c in df.columns if c not in tested], *[e.alias(n) for n, e in tested.items()])
    rest: dict[str, Column] = {c: to_bool(c) for c in df.columns if c in BOOL_COLUMNS}
    rest["user_created_ts"] = parse_ts("user_created")
    if "text" in cols:
        rest["text_raw"] = F.col("text")
    if "hashtags" in cols:
        rest["hashtags_str"] = hashtags_str("hashtags")
        rest["hashtags_arr"] = parse_hashtags("hashtags")
    if "user_location" in cols:
        rest["user_location_clean"] = clean_location("user_location")
    rest["tweet_date"] = derive_date("tweet_ts")
    x = x.withColumns(rest)
    order = list(df.columns) + ["tweet_ts", "user_created_ts"]
    if "text" in cols:
        order += ["text_raw", "text_clean"]
    if "hashtags" in cols:
        order += ["hashtags_str", "hashtags_arr"]
    if "user_location" in cols:
        order.append("user_location_clean")
    return x.select(*order, "tweet_date")


def valid_posts(df: DataFrame) -> DataFrame:
    """F1 + F2: parsed timestamp and non-empty clean text (when present).

    ``length(text_clean) > 0`` already implies non-null, so no separate null
    test is emitted (it would repeat the regex chain once more after pushdown).
    """
    cond = F.lit(True)
    if "tweet_ts" in df.columns:
        cond = cond & F.col("tweet_ts").isNotNull()
    if "text_clean" in df.columns:
        cond = cond & (F.length("text_clean") > 0)
    return df.filter(cond)


def nonnegative_counts(df: DataFrame, columns: Sequence[str] = COUNT_COLUMNS) -> DataFrame:
    """each count is null or >= 0 (nulls kept)."""
    cond = F.lit(True)
    for c in columns:
        if c in df.columns:
            cond = cond & (F.col(c).isNull() | (F.col(c) >= 0))
    return df.filter(cond)


def dedup_posts(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key (nulls compare equal), deterministic survivor.

    Keys default to the available ones of ``user_name, tweet_ts, text_clean``;
    with fewer than two present nothing is removed, as in the reference.

    The survivor is the row with the smallest ``order_by`` values (default: the
    remaining columns in order): the ``min`` of one struct that holds every
    other column, in that order, so each row travels once. A grouped aggregate
    runs partially on the map side (a ``row_number`` window would not), so even
    a key holding a third of the table sends at most one row per map task
    through the shuffle, and the plan has a single exchange.
    """
    if keys is None:
        keys = [c for c in DEDUP_KEYS if c in df.columns]
        if len(keys) < 2:
            return df
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = [c for c in (order_by or []) if c in rest]
    order = order + [c for c in rest if c not in order]
    survivor = F.min(F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(survivor.alias("_survivor")).select(*keys, "_survivor.*").select(*df.columns)


def select_existing(df: DataFrame, desired: Sequence[str] = CLEAN_COLUMNS) -> DataFrame:
    """Fixed column order, only the columns that exist; all if none match."""
    cols = [c for c in desired if c in df.columns]
    return df.select(*cols) if cols else df


class StageCounts:
    """A1: row counts of named stages, taken by the job that computes them: no scan is
    added. Read them once the job's action is over (a task that runs again after a
    lost executor may count its rows twice)."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def mark(self, df: DataFrame, **counts: Column) -> DataFrame:
        """``df``, with a count of the rows for which each condition holds."""
        seen = Observation()
        self._seen.update(dict.fromkeys(counts, seen))
        return df.observe(seen, *(F.count_if(c).alias(n) for n, c in counts.items()))

    def read(self) -> dict[str, int]:
        return {n: int(seen.get[n]) for n, seen in self._seen.items()}


def clean_posts(raw: DataFrame, order_by: Sequence[str] | None = None, barrier: bool = True, counts: StageCounts | None = None) -> DataFrame:
    """J1 body: raw all-string posts -> clean posts (unwritten).

    Columns are projected to the output set *before* the dedup shuffle (the
    survivor is arbitrary in the reference, and the dropped inputs are never
    read again), so only output columns cross the network. ``order_by`` names
    tie-break columns; ones outside the output set ride along through the
    dedup and are dropped afterwards. ``counts`` gets the rows read (``total``), those
    that pass the filters (``valid``) and those that stay (``written``).
    """
    mark = counts.mark if counts else lambda df, **_: df
    typed = nonnegative_counts(valid_posts(typed_posts(mark(raw, total=F.lit(True)), barrier)))
    out_cols = select_existing(typed).columns
    extra = [c for c in (order_by or []) if c not in out_cols]
    slim = mark(typed.select(*out_cols, *extra), valid=F.lit(True))
    return mark(dedup_posts(slim, order_by=order_by).select(*out_cols), written=F.lit(True))
