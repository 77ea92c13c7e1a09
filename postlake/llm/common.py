"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_path, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by a path that only Spark needs to be able to open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage and pays an expensive pass once; the files are in the shared
    folder, so a lost executor loses none of them. ``paths`` gets the place, for
    ``drop`` once nothing reads the table any more.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.parquet(path)


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables, and empty the list."""
    while paths:
        drop_path(spark, paths.pop())


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def crc_fold(col: Column, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; a null value is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def by_hash(df: DataFrame, by: Sequence[Column], most: int, of: int, seed: str, kind: str | None = None, quota: dict | None = None) -> DataFrame:
    """The ``most`` rows of ``of`` with the smallest 64-bit hashes of ``by``; equal
    values of ``by`` are one row. With ``quota`` ({value of column ``kind``: (rows
    wanted, rows there are)}) that many of each kind.

    A share of the hashes is let through first, so that what is sorted is a few times
    what is taken, however large the table. The same rows are taken on every run.
    """

    def cut(wanted: int, there: int) -> int:
        return min(2**63 - 1, int(-(2**63) + min(1.0, 2 * (wanted + 50) / max(there, 1)) * 2**64))

    h, n = fresh(df, "hash"), fresh(df, "place")
    hashed = df.withColumn(h, F.xxhash64(F.lit(seed), *by))
    if quota is None:
        return hashed.where(F.col(h) <= cut(most, of)).dropDuplicates([h]).orderBy(h).limit(most).drop(h)
    if not quota:
        return df.limit(0)
    table = F.create_map(*(F.lit(x) for k, (w, t) in quota.items() for x in (k, cut(w, t))))
    wanted = F.create_map(*(F.lit(x) for k, (w, _) in quota.items() for x in (k, w)))
    few = hashed.where(F.col(h) <= table[F.col(kind)]).dropDuplicates([kind, h])
    placed = few.withColumn(n, F.row_number().over(Window.partitionBy(kind).orderBy(h)))
    return placed.where(F.col(n) <= wanted[F.col(kind)]).drop(h, n)


def passages(text: Column, most: int = 20_000, size: int = 2_000) -> Column:
    """A text, or of one of more than ``most`` characters as many passages as fit:
    one of ``size`` from each equal part of it, at a place that its hash chooses."""
    parts, n = most // size, F.length(text)
    step, h = F.floor(n / parts), F.xxhash64(text)
    found = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.substring(
        text, (i * step + F.pmod(F.xxhash64(h, i), step - size + 1) + 1).cast("int"), F.lit(size)))
    return F.when(n <= most, text).otherwise(F.concat_ws(" ", found))


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, rows: int, per_task: int = 20_000) -> DataFrame:
    """Gapless row numbers from 0 in each ``group``, without one task per group.

    Rows of a group are dealt to salts by a hash of ``order``, numbered inside
    (group, salt), and shifted by the counts of the salts before; a group with
    all ``rows`` is split over ``rows / per_task`` tasks. ``df`` is read twice,
    so it should be a written table. The order is that of (salt, ``order``).
    """
    salts = max(1, -(-int(rows) // per_task))
    s, n, off = (fresh(df, x) for x in ("salt", "salt_n", "salt_off"))
    salted = df.withColumn(s, F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    before = Window.partitionBy(*group).orderBy(s).rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy(*group, s).agg(F.count(F.lit(1)).alias(n))
    offsets = counts.select(*group, s, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(off))
    own = Window.partitionBy(*group, s).orderBy(*order)
    ranked = salted.withColumn(out, F.row_number().over(own).cast("long") - 1)
    return ranked.join(offsets, [*group, s]).withColumn(out, F.col(out) + F.col(off)).drop(s, off)


def text_runs(texts: Sequence[str | None], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` characters together (or of one row)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += n + 1
    if start < len(texts):
        yield start, len(texts)


def cut_text(text: str, most: int = 1 << 20) -> list[str]:
    """``text`` in parts of about ``most`` characters that end at white space, for
    measures that add up over words; a longer run without white space is cut."""
    parts, at = [], 0
    while len(text) - at > most:
        end = max(text.rfind(" ", at, at + most), text.rfind("\n", at, at + most)) + 1
        end = end if end > at else at + most
        parts.append(text[at:end])
        at = end
    return [*parts, text[at:]]


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter (one table per worker)."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTERS


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys, so that low bits can pick a bucket."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return h ^ (h >> np.uint64(29))


class Memo:
    """Values of the keys met lately: two generations of about ``most`` keys. A
    key of the older one that is met again moves to the newer."""

    def __init__(self, most: int):
        self.most = most
        self.now: dict = {}
        self.before: dict = {}

    def missing(self, keys: set) -> set:
        """Those of ``keys`` without a value; those with one are in ``now``."""
        if len(self.now) > self.most:
            self.before, self.now = self.now, {}
        new = keys.difference(self.now)
        if self.before:
            again = [k for k in new if k in self.before]
            self.now.update((k, self.before[k]) for k in again)
            new.difference_update(again)
        return new
