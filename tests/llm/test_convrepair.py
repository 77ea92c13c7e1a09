import hashlib
import random
import re
import zlib
from itertools import product

import numpy as np
import pytest

from postlake.llm import convrepair as R
from postlake.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, repaired lines) of (role, text, fault): one state and row at a time."""
    best = {0: (0, "", ())}

    def relax(to, cell):
        if to not in new or cell[:2] < new[to][:2]:
            new[to] = cell

    def inserts():
        for _ in range(3):
            for s, (c, a, out) in list(new.items()):
                t = {0: 2, 1: 2, 2: 3, 3: 2}[s]
                relax(t, (c + 3, a + "I", (*out, ("user:" if t == 2 else "assistant:"))))

    for role, text, fault in rows:
        new = best
        inserts()
        best, new = new, {}
        for s, (c, a, out) in best.items():
            relax(s, (c + 4, a + "D", out))
            if fault not in ("blank", "duplicate"):
                late = 3 if fault == "truncated" else 0
                t = {0: 2, 1: 2, 2: 3, 3: 2}[s]
                relax(t, (c + 3 + late, a + "R", (*out, f"{'user' if t == 2 else 'assistant'}:{text}")))
                t = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], s))
                if t:
                    relax(t, (c + late, a + "K", (*out, f"{role}:{text}")))
        best = new
    new = best
    inserts()
    return min((new[s] for s in (0, 3) if s in new), key=lambda x: x[:2])


def slow(conversations):
    """{conv: result} of {conv: [(turn, role, text)]}."""
    out = {}
    for conv, rows in conversations.items():
        rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
        both = {i: hashlib.sha256(f"{len(r)}:{r}:{x}".encode()).digest()[:16] for i, (_, r, x) in enumerate(rows)}
        order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1], both[i]))
        seen, found = set(), []
        for i in order:
            _, role, text = rows[i]
            said = text.rstrip(SPACE)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
            seen.add((role, text))
            found.append((role, text, fault))
        turns = [rows[i][0] for i in order if rows[i][0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _, _), (b, _, _) in zip(found, found[1:]))
        count = {f: sum(x[2] == f for x in found) for f in ("blank", "duplicate", "truncated")}
        cost, audit, lines = cheapest(found)
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def fast(spark, rows, **kw):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = R.repair(df, **kw).digests().collect()
    assert len({r.conv for r in got}) == len(got)
    return {r.conv: tuple(r)[1:] for r in got}


def grouped(rows):
    out = {}
    for c, *rest in rows:
        out.setdefault(c, []).append(tuple(rest))
    return out


ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "assistantly", "User"]
TEXTS = ["Yes.", "No!", "Why?", "cut off", "", " \t", None, "Yes. ", "é。", "ends. \n", "last…"]


def chat(r, conv, n):
    return [(conv, r.choice([i, i, i, i + 1, None]), r.choice(ROLES), r.choice(TEXTS + [f"Line {i}."] * 8 + [f"cut {i}"] * 2)) for i in range(n)]


@pytest.mark.parametrize("seed", range(30))
def test_matrices_equal_one_row_at_a_time(seed):
    r = random.Random(seed)
    rows = [(r.choice("suax"), "t", r.choice(["", "", "blank", "duplicate", "truncated"])) for _ in range(r.randint(0, 40))]
    code = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    symbols = np.array([R.symbol_of("suax".index(k), code[f]) for k, _, f in rows], np.int64)
    for least in (2, 4):
        rules, (text,) = R.re_pair([symbols], len(R.SYMBOLS), least=least)
        matrices = R.rule_matrices(rules)
        for whole in (True, False):
            assert R.finish(R.transfer(text, matrices, whole)) == cheapest(rows)[:2]


def test_audits_are_least_among_all_edits():
    """Every string of edits of short conversations, tried out."""
    pattern = re.compile("(s?(ua)+)?")
    for n in range(4):
        for roles in product("sua", repeat=n):
            for faults in product([0, 3, 1], repeat=n):
                best = None
                for edits in product(*[[(i, e, j) for i in ("", "u", "a", "ua", "au") for e, j in (("K", k), ("Ru", "u"), ("Ra", "a"), ("D", ""))] for k in roles], [(i, "", "") for i in ("", "u", "a", "ua", "au")]):
                    if any(f == 1 and e[1] != "D" for f, e in zip(faults, edits)) or not pattern.fullmatch("".join(i + j for i, _, j in edits)):
                        continue
                    cost = sum(3 * len(i) for i, _, _ in edits) + sum({"K": 0, "R": 3, "D": 4, "": 0}[e[:1]] for _, e, _ in edits)
                    cost += sum(3 for f, e in zip(faults, edits) if f == 3 and e[1] != "D")
                    audit = "".join("I" * len(i) + e[:1] for i, e, _ in edits)
                    best = min(best or (cost, audit), (cost, audit))
                got = R.NOTHING
                for k, f in zip(roles, faults):
                    got = R.product(got, R.SYMBOLS[R.symbol_of("sua".index(k), f)])
                assert R.finish(got) == best


def test_re_pair_is_lossless_and_shares_rules():
    r = random.Random(5)
    texts = [np.array([3, 5] * r.randint(0, 30) + [r.randrange(9) for _ in range(r.randint(0, 20))] + [2] * r.randint(0, 9), np.int64) for _ in range(60)]
    rules, out = R.re_pair(texts, 9, least=2)

    def expand(s):
        return [s] if s < 9 else [x for part in rules[s - 9] for x in expand(part)]

    assert [[y for x in o[o >= 0] for y in expand(int(x))] for o in out] == [t.tolist() for t in texts]
    assert sum(map(len, out)) < 0.4 * sum(map(len, texts)) and R.re_pair([], 9) == ([], [])


def test_ropes_compare_as_their_strings():
    r = random.Random(6)
    for _ in range(500):
        def rope(n):
            return "".join(r.choice("DK") for _ in range(r.randint(0, 2))) if n == 0 else (rope(n - 1), rope(r.randrange(n)))
        a, b = rope(r.randint(0, 3)), rope(r.randint(0, 3))
        assert R.less(a, b) == ("".join(R.leaves(a)) < "".join(R.leaves(b)))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [x for c in range(120) for x in chat(r, c if c else None, r.randint(1, 14))]
    assert fast(spark, rows) == slow(grouped(rows))


def test_a_long_conversation_is_split_and_put_together(spark):
    r = random.Random(3)
    rows = chat(r, 5, 700) + [(5, 300, "user", "Line 300.")] * 60 + chat(r, 6, 3) + chat(r, 4, 40)
    want = slow(grouped(rows))
    assert fast(spark, rows, rows_a_task=50, piece_rows=16) == want
    assert fast(spark, rows) == want


def test_repaired_rows_read_as_a_conversation(spark):
    r = random.Random(4)
    rows = [x for c in range(40) for x in chat(r, c, r.randint(1, 10))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = R.repair(df)
    kept, want = {}, slow(grouped(rows))
    for x in sorted(done.rows().collect(), key=lambda x: (x.conv, x.place)):
        kept.setdefault(x.conv, []).append(x)
    for conv, result in want.items():
        own = kept.get(conv, [])
        assert [x.place for x in own] == list(range(len(own))) and re.fullmatch("(s?(ua)+)?", "".join(x.role[:1] for x in own))
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in own).encode()).hexdigest() == result[-1]
        assert "".join(x.edit for x in own) == result[-2].replace("D", "")


def test_no_rows_clashing_columns_and_long_texts(spark):
    df = spark.createDataFrame([(1, 1, "user", "x" * 300_000 + "."), (1, 2, "assistant", "Ok."), (2, 1, "user", "gone")], "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 as conv", "2 as n", "'k' as kind", "'d' as digest", "cast(conv_id = 1 as int) as copies", "true as first")
    got = {r.conv: r for r in R.repair(df, copies=df["copies"]).digests().collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, "", empty) and got[1].audit == "KK" and got[1].cost == 0
    assert R.repair(df.limit(0)).digests().count() == 0 and R.repair(df.limit(0)).rows().count() == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect():
        conv, turn, role, text = r
        what = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        own = rows.setdefault(conv, [])
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        own += [(turn, "user" if what == 4 else role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    got = QUERIES["op13_conversation_repair"](spark, sf)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == slow(rows)
