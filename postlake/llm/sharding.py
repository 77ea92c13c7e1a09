"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text form a group that stays whole. Groups are taken by falling
size; each enters the bin with the least room left that still holds it, found in
a balanced tree of the bins' rooms. Bins have one fixed capacity: as few bins as
that needs, or, where the number of bins is given, the least capacity (within
one part in ``slack``) whose packing does not open another.

Groups of one size are alike, so the driver packs counts of groups by size
class, never groups: sizes below 2 ** 16 bytes are exact, larger ones are
rounded up to 12 leading bits, so there are under 200,000 classes whatever the
corpus, and a bin's room is never overrun. Bins of one room that follow one
another are packed as one, with the places that each has, so what the driver
holds grows with the classes and not with the bins. The groups then take the
places of their class by rank, and their bin follows by division.

Edge cases: null texts form one group, empty ones another; each row counts its
UTF-8 bytes (null: none) plus 1. Repeated rows belong to one group and each take
a slot. Null keys are carried along. An empty table gives no rows. A group that
is larger than an even share has a bin to itself, one larger than the capacity asked
for sets it. Very long texts are only hashed and measured. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, materialise, numbered

_EXACT = 16
_LEADING = 12


class Rooms:
    """A treap of (room, bin): a search tree kept balanced by hashed priorities."""

    def __init__(self):
        self.root: list | None = None  # [key, priority, left, right]
        self.state = 1

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, room: int, bin_: int) -> None:
        self.state = self.state * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
        left, right = self._split(self.root, (room, bin_))
        self.root = self._merge(self._merge(left, [(room, bin_), self.state >> 32, None, None]), right)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room of ``size`` or more."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        node, up = right, None
        while node[2] is not None:
            node, up = node[2], node
        if up is None:
            right = node[3]
        else:
            up[2] = node[3]
        self.root = self._merge(left, right)
        return node[0]


@dataclass(frozen=True)
class Run:
    """Ranks ``first`` to ``first + count - 1`` of a size class are in ``shard`` and
    those after it, ``each`` in every one."""

    size: int
    first: int
    count: int
    shard: int
    each: int


def best_fit_decreasing(classes: Iterable[tuple[int, int]], capacity: int, bins: int = 0, open_more: bool = True) -> tuple[list[Run], int] | None:
    """Pack (size, number of groups) classes; ``bins`` are open from the start.

    Returns the runs and the number of bins, or None where one more is needed
    and ``open_more`` is false. As many groups of a class as fit enter the
    tightest bin at once: after the first, it is tighter still. So do those that
    fill the bins of the same room after it.
    """
    rooms, alike = Rooms(), {}  # the tree has the first bin of each stretch of one room, ``alike`` its bins

    def put(room: int, first: int, n: int) -> None:
        if n:
            rooms.add(room, first)
            alike[first] = n

    put(capacity, 0, bins)
    runs: list[Run] = []
    for size, count in sorted(classes, reverse=True):
        first = 0
        while count:
            found = rooms.take_tightest(size)
            if found is None:
                if not open_more or size > capacity:
                    return None
                found = (capacity, bins)
                alike[bins] = -(-count // (capacity // size))
                bins += alike[bins]
            room, b = found
            n, each = alike.pop(b), room // size
            full = min(n, count // each)
            put(room - each * size, b, full)
            taken = full * each
            if full < n and taken < count:  # the bin that the last of them share
                put(room - (count - taken) * size, b + full, 1)
                full, taken = full + 1, count
            put(room, b + full, n - full)
            runs.append(Run(size, first, taken, b, each))
            first, count = first + taken, count - taken
    return runs, bins


def pack_classes(classes: list[tuple[int, int]], bins: int | None = None, capacity: int | None = None, slack: int = 1 << 12) -> tuple[list[Run], int]:
    """Best-fit-decreasing into the fewest bins of ``capacity``, or into ``bins``
    bins of the least capacity that does, found by bisection."""
    if not classes:
        return [], bins or 0
    largest = max(s for s, _ in classes)
    if bins is None:
        got = best_fit_decreasing(classes, max(capacity or 0, largest))
        assert got
        return got
    # a group above an even share of what is left has a bin to itself
    left, alone = dict(classes), []
    total = sum(s * n for s, n in classes)
    for size in sorted(left, reverse=True):
        while left[size] and len(alone) + 1 < bins and size * (bins - len(alone)) > total:
            first = sum(r.count for r in alone if r.size == size)
            alone.append(Run(size, first, 1, len(alone), 1))
            left[size] -= 1
            total -= size
    rest = [(s, n) for s, n in left.items() if n]
    runs, _ = _even(rest, bins - len(alone), total, slack) if rest else ([], 0)
    taken = {r.size: sum(x.count for x in alone if x.size == r.size) for r in alone}
    return alone + [Run(r.size, r.first + taken.get(r.size, 0), r.count, r.shard + len(alone), r.each) for r in runs], bins


def _even(classes: list[tuple[int, int]], bins: int, total: int, slack: int) -> tuple[list[Run], int]:
    """Best-fit-decreasing into ``bins`` bins of the least capacity that does."""
    low = max(max(s for s, _ in classes), -(-total // bins))
    if got := best_fit_decreasing(classes, low, bins, open_more=False):
        return got
    step = max(1, low // slack)
    high = low + step
    while not (got := best_fit_decreasing(classes, high, bins, open_more=False)):
        low, step = high, step * 2
        high = low + step
    while high - low > max(1, low // slack):
        mid = (low + high) // 2
        if trial := best_fit_decreasing(classes, mid, bins, open_more=False):
            high, got = mid, trial
        else:
            low = mid
    return got


def size_class(size: Column) -> Column:
    """``size``, from 2 ** 16 on rounded up to its 12 leading bits."""
    bits = F.length(F.bin(size))
    unit = F.pow(F.lit(2.0), F.greatest(bits - _LEADING, F.lit(0))).cast("long")
    return F.when(size < (1 << _EXACT), size).otherwise(F.ceil(size / unit).cast("long") * unit)


def shard(docs: DataFrame, shards: int | None = 8, capacity: int | None = None, text: str = "text", key: str = "doc_id", task_rows: int = 20_000) -> DataFrame:
    """(key, size, text_crc32, shard, slot): all rows of ``docs``, in ``shards``
    shards of near equal bytes, or in the fewest of ``capacity`` bytes."""
    value = F.col(text)
    paths: list[str] = []
    rows = materialise(docs.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(value, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(value, 256)), F.lit("null").cast("binary")).alias("same"),
        F.monotonically_increasing_id().alias("row"),
    ), "shard-rows", paths)
    groups = materialise(rows.groupBy("same").agg(F.sum("size").alias("bytes")).withColumn("class", size_class(F.col("bytes"))).select("same", "class"), "shard-groups", paths)
    counts = groups.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()  # under 200,000 classes
    runs, _ = pack_classes([(r["class"], r["n"]) for r in counts], shards, capacity)
    spark = docs.sparkSession
    places = spark.createDataFrame([(r.size, r.first, r.first + r.count, r.shard, r.each) for r in runs], "class long, first long, until long, shard long, each long")
    per_class = places.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("first", "until", "shard", "each"))).alias("runs"))  # a run for each stretch of like bins
    ranked = numbered(groups, ["class"], ["same"], "rank", sum(r["n"] for r in counts), task_rows)
    own = F.filter("runs", lambda r: (r.first <= F.col("rank")) & (F.col("rank") < r.until))[0]
    homes = ranked.join(per_class, "class").select("same", "rank", own.alias("own"))
    homes = homes.select("same", (F.col("own.shard") + F.floor((F.col("rank") - F.col("own.first")) / F.col("own.each"))).cast("int").alias("shard"))
    dealt = materialise(rows.join(homes, "same").select("key", "size", "text_crc32", "shard", "row"), "shard-dealt")
    drop(spark, paths)
    n = dealt.count()
    slots = numbered(dealt, ["shard"], ["row"], "slot", n, task_rows)
    return slots.select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot")
