import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm_data import EDGE_ROWS, SF, edge_docs, no_docs
from pyspark.sql import functions as F

from postlake.llm import sharding
from postlake.llm.queries import QUERIES


def slow_pack(items, capacity, bins=0):
    """Best-fit-decreasing, item by item, over all bins."""
    rooms, placed = [capacity] * bins, []
    for s in sorted(items, reverse=True):
        room, b = min(((x, i) for i, x in enumerate(rooms) if x >= s), default=(capacity, len(rooms)))
        if b == len(rooms):
            rooms.append(capacity)
        rooms[b] = room - s
        placed.append((s, b))
    return sorted(placed), len(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_item_by_item_packing(seed):
    r = random.Random(seed)
    items = [r.randint(1, 40) for _ in range(r.randint(1, 80))]
    capacity, bins = r.randint(40, 100), r.randint(0, 3)
    runs, n = sharding.best_fit_decreasing(Counter(items).items(), capacity, bins)
    assert (sorted((x.size, x.shard + j // x.each) for x in runs for j in range(x.count)), n) == slow_pack(items, capacity, bins)
    for size in set(items):  # the ranks of a class are dealt without a gap
        own = sorted((x.first, x.count) for x in runs if x.size == size)
        assert own[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(own, own[1:]))


def test_given_number_of_bins_is_near_equal():
    r = random.Random(1)
    classes = Counter(int(r.lognormvariate(7, 1)) + 1 for _ in range(20_000))
    runs, n = sharding.pack_classes(list(classes.items()), bins=8)
    load = defaultdict(int)
    for x in runs:
        for j in range(x.count):
            load[x.shard + j // x.each] += x.size
    assert n == 8 and max(load.values()) - min(load.values()) < 0.01 * sum(load.values()) / 8


def test_groups_above_an_even_share_stand_alone():
    classes = {900: 1, 300: 2, 10: 100, 7: 30}
    runs, n = sharding.pack_classes(list(classes.items()), bins=8)
    load, ranks = defaultdict(int), defaultdict(list)
    for x in runs:
        for j in range(x.count):
            load[x.shard + j // x.each] += x.size
        ranks[x.size] += range(x.first, x.first + x.count)
    assert n == 8 and set(load) == set(range(8)) and {s: sorted(r) for s, r in ranks.items()} == {s: list(range(n)) for s, n in classes.items()}
    assert sorted(load.values())[-3:] == [300, 300, 900] and max(sorted(load.values())[:5]) - min(load.values()) <= 30


def test_rooms_is_a_search_tree():
    r, rooms, held = random.Random(2), sharding.Rooms(), []
    for i in range(500):
        if r.random() < 0.6:
            x = r.randint(0, 50)
            rooms.add(x, i)
            held.append((x, i))
        else:
            size = r.randint(0, 60)
            want = min((h for h in held if h[0] >= size), default=None)
            assert rooms.take_tightest(size) == want
            if want:
                held.remove(want)


def test_size_classes_round_up_to_twelve_bits(spark):
    sizes = [0, 1, 65_535, 65_536, 65_537, 1_000_001, (1 << 40) + 1]
    got = [r.c for r in spark.createDataFrame([(s,) for s in sizes], "s long").select(sharding.size_class(F.col("s")).alias("c")).collect()]
    assert got[:4] == sizes[:4]
    assert all(s <= c <= s * (1 + 2**-11) for s, c in zip(sizes, got) if s)


def check(rows, docs, shards):
    """What the contract asks of rows (doc_id, size, text_crc32, shard, slot)."""
    expected = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    groups = defaultdict(set)
    for r in rows:
        groups[(r["size"], r.text_crc32)].add(r.shard)
    return groups


def test_edge_cases(spark):
    rows = sharding.shard(edge_docs(spark), shards=3, task_rows=2).collect()
    groups = check(rows, [(k, t) for k, t, _ in EDGE_ROWS], 3)
    assert all(len(s) == 1 for g, s in groups.items() if g[0] > 1)  # null and empty texts are two groups of size 1


def test_empty_table(spark):
    assert sharding.shard(no_docs(spark)).count() == 0


def test_fewest_bins_of_a_capacity(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 7 + 1)) for i in range(70)], "doc_id long, text string")
    rows = sharding.shard(docs, shards=None, capacity=100).collect()
    load = Counter()
    for r in rows:
        load[r.shard] += r["size"]
    sizes = Counter()
    for i in range(70):
        sizes[i % 7] += i % 7 + 2
    assert (max(load.values()) <= 100) and len(load) == slow_pack(sizes.values(), 100)[1]


def test_query(spark):
    rows = QUERIES["op1_sharding"](spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    groups = check(rows, docs, 8)
    assert all(len(s) == 1 for s in groups.values())
    load = Counter()
    for r in rows:
        load[r.shard] += r["size"]
    assert max(load.values()) - min(load.values()) <= max(r["size"] for r in rows)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_a_million_bins_are_few_runs():
    classes = [(900, 400_000), (700, 300_000), (300, 700_000), (290, 100_000), (100, 1_000_000), (7, 5_000_000)]
    runs, n = sharding.pack_classes(classes, capacity=1_000)
    assert n >= 700_000 and len(runs) <= 4 * len(classes)
    for size, count in classes:
        own = sorted((r.first, r.count) for r in runs if r.size == size)
        assert own[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(own, own[1:])) and sum(own[-1]) == count
    import numpy as np

    load = np.zeros(n, np.int64)
    for r in runs:
        np.add.at(load, r.shard + np.arange(r.count) // r.each, r.size)
    assert load.max() <= 1_000 and load.min() > 0


def test_many_bins_by_spark(spark):
    docs = spark.range(30_000).selectExpr("id as doc_id", "concat(cast(id as string), repeat('x', cast(20 + id % 11 as int)))  as text")
    rows = sharding.shard(docs, shards=None, capacity=64, task_rows=5_000).groupBy("shard").agg(F.sum("size").alias("load"), F.count(F.lit(1)).alias("n"), F.max("slot").alias("last")).collect()
    assert len(rows) > 10_000 and max(r.load for r in rows) <= 64 and all(r.last == r.n - 1 for r in rows)
    items = [len(str(i)) + 20 + i % 11 + 1 for i in range(30_000)]
    runs, n = sharding.best_fit_decreasing(Counter(items).items(), 64)
    assert n == len(rows)
