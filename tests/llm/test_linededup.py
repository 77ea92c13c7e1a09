import random
import re
from collections import defaultdict

import numpy as np
import pytest
from llm_data import CLASH, EDGE_ROWS, edge_docs, no_docs, prose

from postlake.llm import linededup
from postlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def key_of(line):
    s = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def slow(rows, min_chars=40, min_docs=5):
    """(id, lines, dropped, kept) of rows (id, text), line by line."""
    holders = defaultdict(list)
    for i, t in rows:
        for k in {key_of(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(i)
    keeper = {k: max((i for i in h if i is not None), default=None) for k, h in holders.items() if len(h) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key_of(x) not in keeper or keeper[key_of(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def fast(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = linededup.dedup_lines(df, **kw).select("doc_id", "lines.n_lines", "lines.n_dropped", "lines.kept")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def corpus(seed, docs=120):
    r = random.Random(seed)
    shared = [prose(1000 + i, r.randint(6, 14)) for i in range(25)] + ["É" * 39, "é" * 40, "x" * 39, "Y" * 40, "世" * 13 + "界" * 27]
    rows = []
    for i in range(docs):
        lines = [prose(seed * 10_000 + i * 50 + j, r.randint(0, 12)) for j in range(r.randint(0, 6))]
        for s in r.sample(shared, r.randint(0, 5)):
            lines.insert(r.randint(0, len(lines)), r.choice(["", " ", "\t\r"]) + r.choice([s, s.upper() if s.isascii() else s, s.title() if s.isascii() else s]) + r.choice(["", "\x0b \x0c"]))
        lines += r.choice([[], [shared[0]], [shared[0], shared[0]], ["", ""]])
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_line_by_line(spark, seed):
    rows = corpus(seed)
    want = slow(rows)
    assert any(d for _, _, d, _ in want)
    assert fast(spark, rows) == want


@pytest.mark.parametrize("options", [{"filter_bytes": 0}, {"known_bytes": 0}, {"known_bytes": 0, "filter_bytes": 0}])
def test_the_same_without_room_for_filter_or_keys(spark, options):
    rows = corpus(3)
    assert fast(spark, rows, **options) == slow(rows)


def test_a_hot_line_is_joined_apart(spark, monkeypatch):
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    join = linededup._dropped_by_join
    monkeypatch.setattr(linededup, "_dropped_by_join", lambda *a: join(*a, hot_lines=8))
    got = linededup.dedup_lines(df, known_bytes=0).select("doc_id", "lines.n_lines", "lines.n_dropped", "lines.kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == slow(rows)


@pytest.mark.parametrize("known_bytes", [0, 1 << 20])
def test_nulls_copies_long_texts_and_repeated_ids(spark, known_bytes):
    hot = "A passage that stands in more than five of these documents"
    rows = [(i, t) for i, t, _ in EDGE_ROWS] + [(None, hot)] * 3 + [(9, hot), (9, hot + "\n" + hot), (8, "  " + hot.upper())]
    rows += [(None, "Only documents without an id hold this passage of text")] * 6
    assert fast(spark, rows, known_bytes=known_bytes) == slow(rows)


def test_other_columns_stay_and_an_empty_table_is_empty(spark):
    docs = edge_docs(spark)
    for known_bytes in (0, 1 << 20):
        got = linededup.dedup_lines(docs, known_bytes=known_bytes)
        assert set(CLASH) <= set(got.columns) and got.count() == len(EDGE_ROWS)
        assert linededup.dedup_lines(no_docs(spark), known_bytes=known_bytes).count() == 0


def test_merged_filters_hold_all_that_repeats_and_little_else():
    r = np.random.default_rng(1)
    once, again = r.integers(0, 1 << 63, 30_000).astype(np.uint64), r.integers(0, 1 << 63, 1_000).astype(np.uint64)
    bits, per_key = linededup.filter_size(31_000 * 80, 1 << 26, 40)
    _, twice = linededup.both_filters(iter([once[:10_000], again, once[10_000:], again[::-1]]), bits, per_key)
    assert twice.has(twice.places(again)).all()
    assert twice.has(twice.places(once)).mean() < 0.05
    back = np.concatenate([linededup._bits(d) for _, d in twice.segments()])
    assert np.unpackbits(back).sum() == np.unpackbits(twice.data).sum()


def test_the_filter_is_bounded():
    for size in (0, 10**6, 10**10, 10**15):
        bits, _ = linededup.filter_size(size, 1 << 22, 40)
        assert bits <= 8 << 22
    assert linededup.filter_size(10**15, 1 << 22, 40) == (0, 0)


def test_few_lines_that_stand_once_are_suspected(spark):
    rows, report = corpus(5, 400), {}
    fast(spark, rows, report=report)
    lines = sum(len(t.split("\n")) for _, t in rows)
    assert report["bits"] and report["repeated"] and report["suspected"] < 0.2 * lines


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_line_dedup"](spark, SF).collect()
    want = {i: (n, d, kept) for i, n, d, kept in slow(rows)}
    assert len(got) == len(rows)
    import hashlib

    for r in got:
        n, d, kept = want[r.doc_id]
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == (n, d, hashlib.sha256(kept.encode()).hexdigest())
    assert re.fullmatch("[0-9a-f]{64}", got[0].kept_sha256)
