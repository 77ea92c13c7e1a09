"""Near-duplicates by SimHash: fingerprints within a few bits, found in BK-trees.

A BK-tree keeps fingerprints under a parent by their Hamming distance to it; a
search follows only the edges whose distance is within the radius of its own.
Two fingerprints at ``distance`` or fewer differing bits agree on at least one
of ``distance + 1`` bit blocks, so one tree is kept for each (block, value) and
a fingerprint is sought in the trees of its own values only. This loses no
link. A value with more than ``tree_rows`` fingerprints is split again by the
blocks of its other bits, and what is still larger becomes several trees, each
of which meets each part of the probes in a task of its own.

Sending every tree to every executor would broadcast data that grows with the
corpus; a tree is sent, by a shuffle, to the one task that probes it. Trees of
many values share a task, built and searched in numpy level by level. A task
gives a star over what it found linked instead of all pairs; components follow
from the stars.

Edge cases: a null or empty text, or one of white space, has fingerprint zero
and links like any other. Equal texts (repeated rows too) have equal
fingerprints and one component. A null ``key`` is not counted as a smallest
key; a component of null keys only has a null id. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, fresh, materialise
from .components import star_components

_SPACE = re.compile(rb"[ \t-\r]")


def _word_blocks(data: bytes, most: int = 1 << 22) -> Iterator[list[bytes]]:
    at = 0
    while len(data) - at > most and (m := _SPACE.search(data, at + most)):
        yield data[at : m.end()].split()
        at = m.end()
    yield data[at:].split()


def fingerprint(data: bytes | None, words: int = 3) -> int:
    """64-bit SimHash over the ``words``-word shingles of UTF-8 bytes, repeats
    included; ASCII letters count as lower case. Zero where there is no word."""
    ones, total, carry = np.zeros(64, np.int64), 0, []
    for block in _word_blocks((data or b"").lower()):
        w = carry + block
        carry = w[-(words - 1) :] if words > 1 else []
        if len(w) < words:
            carry = w
            continue
        n = len(w) - words + 1
        h = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(w[i:] for i in range(words)))), repeat(42)), np.uint64, n)
        for i in range(0, n, 1 << 15):
            part = h[i : i + (1 << 15)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += n
    if not total and carry:
        return xxhash.xxh64_intdigest(b" ".join(carry), 42)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, words: int = 3) -> Column:
    """The fingerprint of each whole text, as a long of the same 64 bits."""

    @F.arrow_udf("long")
    def run(batch: pa.Array) -> pa.Array:
        out = np.fromiter((fingerprint(x.as_buffer().to_pybytes() if x.is_valid else None, words) for x in batch), np.uint64, len(batch))
        return pa.array(out.view(np.int64))

    return run(text.cast("binary"))


def _runs(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row i repeated for each position in ``lo[i]:hi[i]``, and those positions."""
    n = hi - lo
    rows = np.repeat(np.arange(len(n)), n)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


class Forest:
    """BK-trees, one for each group of distinct fingerprints, in flat arrays."""

    def __init__(self, groups: np.ndarray, prints: np.ndarray):
        self.prints = prints
        self.roots: dict | None = None
        items = np.argsort(groups, kind="stable")
        self.groups, first = np.unique(groups[items], return_index=True)
        self.root = items[first]
        rest = np.ones(len(items), bool)
        rest[first] = False
        under = np.repeat(self.root, np.diff(np.append(first, len(items))))[rest]
        items = items[rest]
        edges, nodes = [], []
        while len(items):
            edge = under * 65 + np.bitwise_count(prints[items] ^ prints[under])
            order = np.argsort(edge, kind="stable")
            edge, items = edge[order], items[order]
            new = np.concatenate(([True], edge[1:] != edge[:-1]))
            edges.append(edge[new])
            nodes.append(items[new])
            under = items[new][np.cumsum(new) - 1][~new]
            items = items[~new]
        edge, node = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (edges, nodes))
        order = np.argsort(edge)
        self.edge, self.node = edge[order], node[order]

    def search(self, groups: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(probe, member) of each member within ``radius`` of a probe in its group."""
        if not len(self.groups):
            return (np.empty(0, np.int64),) * 2
        at = np.minimum(np.searchsorted(self.groups, groups), len(self.groups) - 1)
        probe = np.flatnonzero(self.groups[at] == groups)
        node = self.root[at[probe]]
        found = []
        while len(probe):
            far = np.bitwise_count(prints[probe] ^ self.prints[node]).astype(np.int64)
            near = far <= radius
            found.append((probe[near], node[near]))
            lo = np.searchsorted(self.edge, node * 65 + np.maximum(far - radius, 0))
            hi = np.searchsorted(self.edge, node * 65 + np.minimum(far + radius, 64), side="right")
            rows, to = _runs(lo, hi)
            probe, node = probe[rows], self.node[to]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2


def join_labels(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest index reachable, after adding edges (u, v) to the classes of ``label``."""
    while len(u):
        a, b = label[u], label[v]
        open_ = a != b
        if not open_.any():
            break
        u, v, low, high = u[open_], v[open_], np.minimum(a, b)[open_], np.maximum(a, b)[open_]
        np.minimum.at(label, high, low)
        while (jumped := label[label]).tobytes() != label.tobytes():
            label = jumped
    return label


def _links(radius: int, budget: int = 1 << 21):
    """Stars over the linked fingerprints of one bucket of trees."""

    def run(rows: pa.Table) -> pa.Table:
        col = {c: rows[c].to_numpy() for c in ("tree", "a", "b", "part", "fp")}
        _, group = np.unique(np.stack([col["tree"], col["a"], col["b"]], axis=1), axis=0, return_inverse=True)
        group = group.reshape(-1)
        prints, index = np.unique(col["fp"].view(np.uint64), return_inverse=True)
        member, probe = np.flatnonzero(col["part"] == col["a"]), np.flatnonzero(col["part"] == col["b"])
        forest = Forest(group[member], prints[index[member]])
        size = np.bincount(group[member], minlength=int(group.max()) + 1)
        probe = probe[np.argsort(group[probe], kind="stable")]
        slices = np.cumsum(size[group[probe]]) // budget
        label = np.arange(len(prints))
        for s in np.split(probe, np.flatnonzero(np.diff(slices)) + 1):
            q, m = forest.search(group[s], prints[index[s]], radius)
            label = join_labels(label, index[s[q]], index[member[m]])
        hung = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"u": prints[hung].view(np.int64), "v": prints[label[hung]].view(np.int64)})

    return run


def _blocks(bits: Column, width: int, n: int) -> list[Column]:
    """``n`` blocks of the lowest ``width`` bits, the last with what remains."""
    w = width // n
    cut = [(i * w, w if i + 1 < n else width - i * w) for i in range(n)]
    return [F.shiftrightunsigned(bits, a).bitwiseAND(F.lit((1 << k) - 1)) for a, k in cut]


def _trees(fp: Column, distance: int) -> Column:
    """One tree key for each block of ``fp``: (block number, 0, value)."""
    n = distance + 1
    return F.array(*(F.struct(F.lit(i).alias("i"), F.xxhash64(F.lit(i), v).alias("tree")) for i, v in enumerate(_blocks(fp, 64, n))))


def _finer(fp: Column, i: Column, tree: Column, distance: int) -> Column:
    """Keys of the trees that a tree of block ``i`` is split into, by its other bits."""
    n = distance + 1
    w = 64 // n
    out = F.array().cast("array<bigint>")
    for k in range(n):
        wide = w if k + 1 < n else 64 - k * w
        low = fp.bitwiseAND(F.lit((1 << (k * w)) - 1)) if k else F.lit(0).cast("long")
        high = F.shiftleft(F.shiftrightunsigned(fp, k * w + wide), k * w) if k + 1 < n else F.lit(0).cast("long")
        keys = F.array(*(F.xxhash64(tree, F.lit(j), v) for j, v in enumerate(_blocks(high.bitwiseOR(low), 64 - wide, n))))
        out = F.when(i == k, keys).otherwise(out)
    return out


def link(prints: DataFrame, distance: int = 3, tree_rows: int = 8_192, task_rows: int = 50_000, paths: list[str] | None = None) -> DataFrame:
    """Edges (``u``, ``v``) that connect the distinct longs ``fp`` of ``prints``
    as their Hamming distances of ``distance`` or less do (not all such pairs).

    ``prints`` should be a written table. Two trees whose keys collide in 64 bits
    only meet more probes: each distance is measured on the fingerprints.
    """
    if distance >= 16 or distance < 0:
        raise ValueError(f"distance {distance}: from 0 to 15 bits are supported")
    coarse = prints.select("fp", F.inline(_trees(F.col("fp"), distance)))
    large = coarse.groupBy("tree").count().where(F.col("count") > tree_rows).select("tree", F.lit(True).alias("split"))
    split = F.coalesce(F.col("split"), F.lit(False))
    keys = F.when(split, _finer(F.col("fp"), F.col("i"), F.col("tree"), distance)).otherwise(F.array("tree"))
    fine = materialise(coarse.join(large, "tree", "left").select("fp", F.explode(keys).alias("tree")), "simhash-trees", paths)
    counts = fine.groupBy("tree").count().where(F.col("count") > tree_rows)
    parts = counts.select("tree", F.ceil(F.col("count") / tree_rows).cast("int").alias("parts"), "count")
    extra = parts.select(F.coalesce(F.sum(F.col("count") * (F.col("parts") - 1)), F.lit(0))).first()[0]
    n = fine.count() + extra
    part = F.pmod(F.xxhash64(F.lit("part"), "fp"), F.col("parts")).cast("int")
    dealt = fine.join(parts.drop("count"), "tree", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("tree", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "fp")
    bucket = F.pmod(F.xxhash64("tree", "a", "b"), F.lit(max(1, -(-n // task_rows))))
    return dealt.groupBy(bucket.alias("bucket")).applyInArrow(_links(distance), "u long, v long")


def _rooted(prints: DataFrame, distance: int, **options) -> DataFrame:
    """``prints`` with ``root``, which fingerprints that are connected share."""
    trees: list[str] = []
    stars = star_components(link(prints.select("fp"), distance, paths=trees, **options))
    drop(prints.sparkSession, trees)
    hung = prints.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    return hung.withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 3, distance: int = 3, **options) -> DataFrame:
    """(key, ``fp`` long, ``component_id``: the smallest key linked, itself included)."""
    made = docs.select(F.col(key).alias("key"), fingerprints(F.col(text), words).alias("fp"))
    rows = materialise(made, "simhash-rows")
    prints = materialise(rows.groupBy("fp").agg(F.min("key").alias("low")), "simhash-prints")
    hung = _rooted(prints, distance, **options)
    lows = hung.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = hung.join(lows, "root").select("fp", "component_id")
    return rows.join(ids, "fp").select(F.col("key").alias(key), "fp", "component_id")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 3, distance: int = 3, keyless_stay: bool = True, **options) -> DataFrame:
    """One row of each component of ``docs``, with all columns: that of the
    smallest key, of equal keys the first row written. A key may stay on several
    rows whose texts do not link. Rows without a key stay; without
    ``keyless_stay`` they are copies like any other, and come after all keys."""
    row = fresh(docs, "row")
    fp = fresh(docs, "fp")
    made = docs.withColumn(fp, fingerprints(F.col(text), words)).withColumn(row, F.monotonically_increasing_id())
    rows = materialise(made, "simhash-rows")
    first = F.min(F.struct(F.col(key).isNull().alias("keyless"), F.col(key).alias("key"), F.col(row).alias("row")))
    prints = materialise(rows.groupBy(F.col(fp).alias("fp")).agg(first.alias("low")), "simhash-prints")
    kept = _rooted(prints, distance, **options).groupBy("root").agg(F.min("low").alias("low"))
    if keyless_stay:
        kept = kept.where(~F.col("low.keyless"))
    one = rows.join(kept.select(F.col("low.row").alias(row)), row, "left_semi").select(*docs.columns)
    return one.union(rows.where(F.col(key).isNull()).select(*docs.columns)) if keyless_stay else one
