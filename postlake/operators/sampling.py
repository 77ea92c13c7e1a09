"""Deterministic sampling and stratified splitting.

Row choice is driven by a seeded hash of the id columns (``order_key``), so a
re-run, or a partition computed again after a lost executor, picks exactly the
same rows, and DuckDB can reproduce the choice with the same expression.

Both operators keep the first ``q_g`` rows of every group ``g`` in the order of
(id hash, hash of the whole row). They find each group's cut point, the key of
its ``q_g``-th row, by histograms over 16 further bits of the hash per pass (a
hash aggregate of at most 65,536 buckets a group, of which one row a group
reaches the driver), until the bucket of the cut holds one key; a pass and the keys
it ends at take one job each for all groups. The rows are then flagged by comparison with the cut, in one scan and without moving any.
No table size changes the rule, and no group meets in one task.

Only the row hash can tell rows of one id apart; it is computed for the rows at
the cut alone. Rows still tied are equal in every column, so which of them are
in makes no difference: one of them is repeated as often as it is needed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import SEED, VALIDATION_FRACTION

HEX_DIGITS = 32  # of an md5
DIGITS_PER_PASS = 4  # 16 bits: at most 65,536 buckets per group and pass
MAX_CLASSES = 10_000  # classes whose counts the driver takes
REPEATS_PER_ROW = 10_000  # of a tied row, made by one row of the step before


def order_key(id_cols: Sequence[str], seed: int = SEED) -> Column:
    """Seeded hash of the ids. Each id goes in with its length, and null as a
    mark of its own, so different ids never give the same text."""
    parts: list[Column] = [F.lit(str(seed))]
    for c in id_cols:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.lit(":"), F.length(text).cast("string"), F.lit(":"), text), F.lit(":-")))
    return F.md5(F.concat(*parts))


def row_key(df: DataFrame, seed: int = SEED) -> Column:
    """Seeded hash of all columns."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def _is_group(col: str, value) -> Column:
    return F.col(col).isNull() if value is None else (F.col(col) == F.lit(value))


def _any_group(col: str, conds: dict) -> Column:
    out = F.lit(False)
    for value, c in conds.items():
        out = out | (_is_group(col, value) & c)
    return out


def cut_keys(keyed: DataFrame, quotas: dict) -> dict:
    """Of rows (``k`` hash, ``g`` group): {group: (cut key, rows needed at it,
    rows there are at it)}. A group with no more rows than its quota is left out.
    """
    open_ = {g: ("", int(q)) for g, q in quotas.items() if q and q > 0}
    cuts: dict = {}
    size = 0
    while open_:
        inside = _any_group("g", {g: F.col("k").startswith(F.lit(prefix)) for g, (prefix, _) in open_.items()})
        h = F.xxhash64("k")  # of fixed width, so this stays a hash aggregate
        hist = keyed.where(inside).groupBy("g", F.substring("k", size + 1, DIGITS_PER_PASS).alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min(h).alias("low"), F.max(h).alias("high")
        )
        before = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        need = F.lit(None).cast("bigint")
        for g, (_, q) in open_.items():
            need = F.when(_is_group("g", g), F.lit(q)).otherwise(need)
        found = hist.where((F.col("before") < need) & (F.col("before") + F.col("n") >= need)).collect()  # one row a group
        size += DIGITS_PER_PASS
        placed = {r["g"]: (open_[r["g"]][0] + r["b"], open_[r["g"]][1] - int(r["before"]), int(r["n"])) for r in found}
        keys = _only_keys(keyed, {r["g"]: placed[r["g"]][0] for r in found if r["low"] == r["high"] or size >= HEX_DIGITS})
        cuts.update((g, (key, *placed[g][1:])) for g, key in keys.items())
        open_ = {g: (prefix, q) for g, (prefix, q, _) in placed.items() if g not in keys}
    return cuts


def _only_keys(keyed: DataFrame, prefixes: dict) -> dict:
    """{group: key} for the groups whose rows with their prefix share one key, in
    one job. The buckets asked for hold one key each, but for equal 64-bit hashes."""
    if not prefixes:
        return {}
    inside = _any_group("g", {g: F.col("k").startswith(F.lit(prefix)) for g, prefix in prefixes.items()})
    found: dict = {}
    for r in keyed.where(inside).select("g", "k").distinct().collect():
        found.setdefault(r["g"], []).append(r["k"])
    return {g: keys[0] for g, keys in found.items() if len(keys) == 1}


def first_in_order(
    df: DataFrame,
    id_cols: Sequence[str],
    quotas: dict,
    group_col: str | None = None,
    seed: int = SEED,
    flag: str | None = None,
) -> DataFrame:
    """The first ``quotas[g]`` rows of each group ``g`` in (id hash, row hash)
    order (groups without a quota: none; ``quotas[None]`` with no ``group_col``).
    With ``flag`` all rows come back, and ``flag`` tells which those are.
    """
    key = order_key(id_cols, seed)
    group = F.col(group_col) if group_col else F.lit(0)
    if not group_col:
        quotas = {0: quotas[None]}
    quotas = {g: q for g, q in quotas.items() if q and q > 0}
    cuts = cut_keys(df.select(key.alias("k"), group.alias("g")), quotas)

    # rows of several with the id of the cut: go on by the hash of the row
    shared = {g: c for g, c in cuts.items() if c[1] < c[2]}
    finer: dict = {}
    if shared:
        at_cut = df.select(key.alias("id_key"), group.alias("g"), row_key(df, seed).alias("k"))
        at_cut = at_cut.where(_any_group("g", {g: F.col("id_key") == F.lit(c[0]) for g, c in shared.items()})).select("k", "g")
        finer = cut_keys(at_cut, {g: c[1] for g, c in shared.items()})

    work = df.withColumns({"__key": key, "__group": group})
    if finer:
        at_shared = _any_group("__group", {g: F.col("__key") == F.lit(shared[g][0]) for g in finer})
        work = work.withColumn("__row", F.when(at_shared, row_key(df, seed)))
    taken: dict = {}
    tied: dict = {}
    for g in quotas:
        if g not in cuts:
            taken[g] = F.lit(True)
        elif g not in finer:
            taken[g] = F.col("__key") <= F.lit(cuts[g][0])
        else:
            (id_cut, _, _), (row_cut, need, there) = cuts[g], finer[g]
            at = F.col("__key") == F.lit(id_cut)
            taken[g] = (F.col("__key") < F.lit(id_cut)) | (at & (F.col("__row") <= F.lit(row_cut)))
            if need < there:
                tied[g] = (at & (F.col("__row") == F.lit(row_cut)), need, there)
    in_ = _any_group("__group", taken)
    cols = [F.col(f"`{c}`") for c in df.columns]
    rest = work
    if tied:
        rest = work.where(~F.coalesce(_any_group("__group", {g: t[0] for g, t in tied.items()}), F.lit(False)))
    out = rest.where(in_).select(*cols) if flag is None else rest.select(*cols, F.coalesce(in_, F.lit(False)).alias(flag))
    for g, (equal, need, there) in tied.items():
        alike = work.where(_is_group("__group", g) & equal).select(*cols)
        copies = _repeated(alike, need if flag is None else there)
        out = out.union(copies.select(*cols) if flag is None else copies.select(*cols, (F.col("__copy") < need).alias(flag)))
    return out


def _repeated(alike: DataFrame, times: int) -> DataFrame:
    """Rows that are all equal, as ``times`` rows numbered ``__copy``. One of them
    is repeated in two steps with a shuffle between, so many tasks make them."""
    one = alike.agg(F.first(F.struct("*")).alias("row"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.lit(times - 1).cast("bigint"), F.lit(REPEATS_PER_ROW).cast("bigint"))
    dealt = one.select("row", F.explode(starts).alias("start")).repartition("start")
    end = F.least(F.col("start") + REPEATS_PER_ROW, F.lit(times)) - 1
    return dealt.select("row.*", F.explode(F.sequence("start", end)).alias("__copy"))


def sample_exact(df: DataFrame, n: int | None, id_cols: Sequence[str], seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows without replacement when the table has more than
    ``n`` rows; the table itself otherwise (``n`` of 0/None means no sampling)."""
    return first_in_order(df, id_cols, {None: int(n)}, None, seed) if n else df


def approximate_mode(class_counts: dict, n_draws: int) -> dict:
    """Largest-remainder allocation of ``n_draws`` proportional to the class
    counts (integer arithmetic; ties go to the smaller class value)."""
    total = sum(class_counts.values())
    floors = {c: (n * n_draws) // total for c, n in class_counts.items()}
    rems = {c: (n * n_draws) % total for c, n in class_counts.items()}
    extra = n_draws - sum(floors.values())
    for c in sorted(class_counts, key=lambda c: (-rems[c], c))[:extra]:
        floors[c] += 1
    return floors


def split_quotas(class_counts: dict, test_size: float = VALIDATION_FRACTION) -> dict:
    """Train rows per class for a stratified split with ``ceil(test_size*N)``
    validation rows (train quotas first, validation takes the rest)."""
    total = sum(class_counts.values())
    if total == 0:
        return {}
    if min(class_counts.values()) < 2:
        raise ValueError("The least populated class has only 1 member; at least 2 are required to stratify.")
    n_test = int(math.ceil(test_size * total))
    n_train = total - n_test
    k = len(class_counts)
    if n_train < k or n_test < k:
        raise ValueError(f"train ({n_train}) and validation ({n_test}) sizes must each be >= the number of classes ({k})")
    return approximate_mode(class_counts, n_train)


def class_counts(df: DataFrame, label_col: str) -> dict:
    """Rows of each class, nulls left out. A column with more than
    ``MAX_CLASSES`` values is no class column and is refused."""
    rows = df.where(F.col(label_col).isNotNull()).groupBy(label_col).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label_col!r} has more than {MAX_CLASSES} values; a split needs a class column")
    return {r[0]: int(r[1]) for r in rows}


def stratified_split(
    df: DataFrame,
    label_col: str,
    id_cols: Sequence[str],
    test_size: float = VALIDATION_FRACTION,
    seed: int = SEED,
    flag: str = "is_train",
) -> DataFrame:
    """D3: every row plus a boolean ``flag`` (train / validation).

    Class sizes follow the stratified-shuffle contract: ``ceil(test_size*N)``
    validation rows, train rows allocated to classes by largest remainder.
    Within a class the train rows are the first in seeded hash order. Rows
    without a label are left out.
    """
    quotas = split_quotas(class_counts(df, label_col), test_size)
    return first_in_order(df.where(F.col(label_col).isNotNull()), id_cols, quotas, label_col, seed, flag)
