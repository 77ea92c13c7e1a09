"""Conversation structure repair: grammar-compressed dynamic programming.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles: a system
row at most at the start, then user and assistant in turn. The cheapest edits to
that are found over row symbols, which say what the automaton sees of a row: its
role's initial (s, u, a or another) and whether it has to go or is truncated.

A symbol is a 4 x 4 transfer matrix over the states of the automaton: the least
cost from state to state and, of the edits with that cost, the ASCII-least audit.
Matrices multiply by (min, +); among edits of one cost on the same rows no audit
is the start of another, so least audits of the parts make the least of the whole.
Audits are ropes, a string or a pair of ropes, shared by all that contain them.

Re-Pair replaces the most frequent pair of neighbouring symbols in a batch of
conversations by a new symbol, again and again. Each rule's matrix is the product
of its two symbols' and is computed once; a conversation is the product of the
few symbols left of it.

On Spark: equal rows of a turn are counted first; the first of the rows with one
role and text is found by a partially aggregated minimum and flagged by grouping
with its own key, so no group grows with repeated rows. The slim rows (no texts)
are then dealt by range of (conversation, turn), so that a long conversation lies
in many tasks; each gives matrices of pieces of bounded length, multiplied per
conversation in balanced order. Texts travel once, sorted behind the audit of
their conversation, and stream through in bounded memory.

A digest of a whole conversation is one sequential hash: its texts pass through
one task, as a stream. That is the only step in which a conversation is not split.

Edge cases: null roles and texts are one space (role of no class; blank). Null
turns come first; rows of one turn are in order of role, then of the SHA-256 of
role and text (its first 128 bits stand for the pair). Repeated rows are rows. A
null conversation id is a conversation. A conversation without rows has zeros, an
empty audit and the empty string's digest. Very long texts and conversations are
read whole. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, materialise

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3  # faults; 0 is none
SPACE = " \t\n\x0b\x0c\r"
STATES = 4  # nothing yet; after s; after u; after a (complete, as is the first)
CLASSES = "sua"  # 3 is any other initial
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # by a row that is inserted or gets a role
KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

Rope = "str | tuple"
Matrix = list  # STATES * STATES cells, (cost, rope) or None


# --- ropes and matrices ------------------------------------------------------------


def leaves(rope: Rope) -> Iterator[str]:
    todo = [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            if r:
                yield r
        else:
            todo += (r[1], r[0])


def joined(a: Rope, b: Rope) -> Rope:
    return a + b if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) < 64 else (a, b)


def less(a: Rope, b: Rope) -> bool:
    """Whether ``a`` comes before ``b`` in ASCII order."""
    if a is b:
        return False
    if isinstance(a, str) and isinstance(b, str):
        return a < b
    xs, ys, x, y = leaves(a), leaves(b), "", ""
    while True:
        x, y = x or next(xs, ""), y or next(ys, "")
        if not x or not y:
            return bool(y)
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def _better(new: tuple, old: tuple | None) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and less(new[1], old[1]))


def product(a: Matrix, b: Matrix, sources: range = range(STATES)) -> Matrix:
    """The (min, +) product; only the rows ``sources`` of it."""
    out: Matrix = [None] * len(a)
    for i in sources:
        for k in range(STATES):
            left = a[i * STATES + k]
            if left is None:
                continue
            for j in range(STATES):
                right = b[k * STATES + j]
                if right is not None:
                    at, cost, old = i * STATES + j, left[0] + right[0], out[i * STATES + j]
                    if old is None or cost <= old[0]:
                        cell = (cost, joined(left[1], right[1]))
                        if _better(cell, old):
                            out[at] = cell
    return out


def _matrix(cells: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    return [cells.get((i, j)) for i in range(STATES) for j in range(STATES)]


def _inserts() -> Matrix:
    """Any number of rows inserted; more than two never pay."""
    cells = {(i, i): (0, "") for i in range(STATES)}
    for i in range(STATES):
        for n, j in enumerate((NEXT[i], NEXT[NEXT[i]]), 1):
            if (i, j) not in cells:
                cells[i, j] = (n * INSERT_COST, "I" * n)
    return _matrix(cells)


INSERTS = _inserts()
NOTHING = _matrix({(i, i): (0, "") for i in range(STATES)})


def row_matrix(kind: str, must_go: bool, truncated: bool) -> Matrix:
    """Rows inserted before a row, then one edit of it."""
    cells = {(i, i): (DELETE_COST, "D") for i in range(STATES)}
    if not must_go:
        more = TRUNCATED_COST if truncated else 0
        for i, j in NEXT.items():
            cells[i, j] = (REROLE_COST + more, "R")
        for i, j in KEEP.get(kind, {}).items():
            cells[i, j] = (more, "K")
    return product(INSERTS, _matrix(cells))


def symbol_of(kind: int, fault: int) -> int:
    """0 for rows that go; else 1 to 8."""
    return 0 if fault in (BLANK, DUPLICATE) else 1 + 2 * kind + (fault == TRUNCATED)


SYMBOLS = [row_matrix("", True, False), *(row_matrix((CLASSES + "-")[k], False, bool(t)) for k in range(4) for t in range(2))]


# --- Re-Pair -------------------------------------------------------------------------


def re_pair(sequences: list[np.ndarray], symbols: int, most_rules: int = 256, least: int = 4) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """(rules, sequences in rules): rule r is symbol ``symbols + r`` and stands for two
    earlier symbols. Ends after ``most_rules``, or when no pair stands ``least`` times."""
    if not sequences:
        return [], []
    end = np.array([-1])
    x = np.concatenate([p for s in sequences for p in (s, end)]).astype(np.int64)
    rules: list[tuple[int, int]] = []
    span = symbols + most_rules
    while len(rules) < most_rules and len(x) > 1:
        inside = np.flatnonzero((x[:-1] >= 0) & (x[1:] >= 0))
        if not len(inside):
            break
        counts = np.bincount(x[inside] * span + x[inside + 1], minlength=1)
        top = int(counts.argmax())
        if counts[top] < least:
            break
        a, b = divmod(top, span)
        at = inside[(x[inside] == a) & (x[inside + 1] == b)]
        if a == b:  # of a run of one symbol every second pair
            start = np.concatenate(([True], np.diff(at) > 1))
            first = np.maximum.accumulate(np.where(start, at, 0))
            at = at[(at - first) % 2 == 0]
        x[at] = symbols + len(rules)
        x = np.delete(x, at + 1)
        rules.append((a, b))
    return rules, np.split(x, np.flatnonzero(x < 0) + 1)[:-1]


def rule_matrices(rules: list[tuple[int, int]]) -> list[Matrix]:
    """The matrix of each symbol and rule, bottom up."""
    out = list(SYMBOLS)
    for a, b in rules:
        out.append(product(out[a], out[b]))
    return out


def fold(matrices: list[Matrix]) -> Matrix:
    """The product in balanced order."""
    while len(matrices) > 1:
        matrices = [product(*matrices[i : i + 2]) if i + 1 < len(matrices) else matrices[i] for i in range(0, len(matrices), 2)]
    return matrices[0] if matrices else NOTHING


def transfer(sequence: np.ndarray, matrices: list[Matrix], whole: bool) -> Matrix:
    """The matrix of a sequence of symbols and rules; ``whole``: its first row only."""
    parts = [matrices[s] for s in sequence[sequence >= 0].tolist()]
    if not whole or len(parts) > 64:
        return fold(parts)
    out = NOTHING
    for m in parts:
        out = product(out, m, range(1))
    return out


def finish(m: Matrix) -> tuple[int, str]:
    """(cost, audit) of a whole conversation's matrix."""
    last = product(m, INSERTS, range(1))
    done = [c for c in (last[0], last[3]) if c is not None]
    cost, rope = done[0] if len(done) == 1 or _better(done[0], done[1]) else done[1]
    return cost, "".join(leaves(rope))


# --- pieces of conversations ------------------------------------------------------------


PIECE = "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head string, tail string, costs array<long>, audits array<string>"


class _Piece:
    """Rows of one conversation that follow one another."""

    def __init__(self, row: dict, number: int):
        self.conv, self.turn, self.role, self.digest, self.number = row["conv"], row["turn"], row["role"], row["digest"], number
        self.faults, self.illegal, self.turns = [0, 0, 0, 0], 0, 0
        self.low = self.high = self.head = self.tail = None
        self.symbols: list[int] = []

    def add(self, row: dict, times: int, first: bool) -> None:
        """``times`` equal rows; the first of them may be the first of its role and text."""
        kind = row["kind"]
        letter = (CLASSES + "-")[kind]
        faults = [row["fault"] if first or row["fault"] == BLANK else DUPLICATE]
        rest = row["fault"] if row["fault"] == BLANK else DUPLICATE
        self.faults[faults[0]] += 1
        self.faults[rest] += times - 1
        self.illegal += times - 1 + (self.tail is not None and (self.tail, letter) not in LEGAL)
        self.head, self.tail = self.head or letter, letter
        if row["turn"] is not None:
            self.turns += self.high != row["turn"]
            self.low, self.high = row["turn"] if self.low is None else self.low, row["turn"]
        self.symbols.append(symbol_of(kind, faults[0]))
        self.symbols += [0] * (times - 1)


def _pieces(rows: Iterator[dict], most: int) -> Iterator[tuple[_Piece, bool]]:
    """(piece, whether it is the whole conversation) of rows in order; the first and the
    last conversation of a task may go on in another."""
    held, opening, number = None, True, 0
    for row in rows:
        if held is None or held.conv != row["conv"]:
            if held is not None:
                yield held, not opening and number == 0
                opening = False
            held, number = _Piece(row, 0), 0
        left, first = row["n"], row["first"]
        while left:
            if len(held.symbols) >= most:
                yield held, False
                number += 1
                held = _Piece(row, number)
            take = min(left, most - len(held.symbols))
            held.add(row, take, first)
            left, first = left - take, False
    if held is not None:
        yield held, False


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        yield from b.to_pylist()


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _solved(pieces: list[tuple[_Piece, bool]]) -> list[dict]:
    rules, texts = re_pair([np.array(p.symbols, np.int64) for p, _ in pieces], len(SYMBOLS))
    matrices, out = rule_matrices(rules), []
    for (p, whole), text in zip(pieces, texts):
        cells = transfer(text, matrices, whole)
        out.append({
            "conv": p.conv, "turn": p.turn, "role": p.role, "digest": p.digest, "number": p.number,
            "blank": p.faults[BLANK], "duplicate": p.faults[DUPLICATE], "truncated": p.faults[TRUNCATED], "illegal": p.illegal,
            "turns": p.turns, "low": p.low, "high": p.high, "head": p.head, "tail": p.tail,
            "costs": [None if c is None else c[0] for c in cells], "audits": [None if c is None else "".join(leaves(c[1])) for c in cells],
        })
    return out


class _Conversation:
    """Pieces of one conversation, put together in order."""

    def __init__(self, conv):
        self.conv, self.sums, self.turns = conv, dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0), 0
        self.low = self.high = self.tail = None
        self.stack: list[tuple[int, Matrix]] = []  # balanced: of like sizes two are multiplied

    def add(self, p: dict) -> None:
        for name in self.sums:
            self.sums[name] += p[name]
        if p["head"] is not None:
            self.sums["illegal"] += self.tail is not None and (self.tail, p["head"]) not in LEGAL
            self.tail = p["tail"]
        if p["low"] is not None:
            self.turns += p["turns"] - (self.high == p["low"])
            self.low, self.high = p["low"] if self.low is None else self.low, p["high"]
        size, m = 1, [None if c is None else (c, a) for c, a in zip(p["costs"], p["audits"])]
        while self.stack and self.stack[-1][0] == size:
            m, size = product(self.stack.pop()[1], m), 2 * size
        self.stack.append((size, m))

    def report(self) -> dict:
        cost, audit = finish(fold_right([m for _, m in self.stack]))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv": self.conv, "gaps": gaps, **self.sums, "cost": cost, "audit": audit}


def fold_right(matrices: list[Matrix]) -> Matrix:
    out = matrices[-1]
    for m in reversed(matrices[:-1]):
        out = product(m, out)
    return out


# --- the operator --------------------------------------------------------------------------


def faults(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies: Column | None) -> DataFrame:
    """(conv, turn, role, text, n, kind, fault, digest): what each row shows by itself."""
    x = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("n"))
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(0)
    both = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", F.lit(":"), "text").cast("binary"), 256)
    return x.select("*", kind.alias("kind"), fault.alias("fault"), F.substring(F.unhex(both), 1, 16).alias("digest"))


def _symbols(found: DataFrame) -> DataFrame:
    """One row for each (conv, turn, role, digest): how many, and whether the first
    of its role and text is among them."""
    key = ["conv", "turn", "role", "digest"]
    equal = found.groupBy(*key).agg(F.sum("n").alias("n"), F.max("kind").alias("kind"), F.max("fault").alias("fault"))
    first = equal.where(F.col("n") > 0).groupBy("conv", "digest").agg(F.min(F.struct("turn", "role")).alias("at"))
    none = F.lit(None).cast("int")
    marks = first.select("conv", "at.turn", "at.role", "digest", F.lit(0).cast("long").alias("n"), none.alias("kind"), none.alias("fault"), F.lit(True).alias("first"))
    both = equal.withColumn("first", F.lit(False)).unionByName(marks)
    return both.groupBy(*key).agg(F.sum("n").alias("n"), F.max("kind").alias("kind"), F.max("fault").alias("fault"), F.max("first").alias("first"))


def _reports(found: DataFrame, paths: list[str], rows_a_task: int, piece_rows: int) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation."""
    key = ["conv", "turn", "role", "digest"]
    symbols = materialise(_symbols(found), "repair-symbols", paths)
    tasks = max(1, -(-symbols.count() // rows_a_task))
    conv = T.StructType([symbols.schema["conv"]])
    pieces = T.StructType([*conv.fields, *T.StructType.fromDDL("turn long, role string, digest binary, number int, " + PIECE).fields])
    reports = T.StructType([*conv.fields, *T.StructType.fromDDL("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string").fields])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in _pieces(_records(batches), piece_rows):
            held.append(piece)
            size += len(piece[0].symbols) + 1
            if size > 4 * piece_rows:
                yield _table(_solved(held), _arrow(pieces))
                held, size = [], 0
        if held:
            yield _table(_solved(held), _arrow(pieces))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        for p in _records(batches):
            if held is None or held.conv != p["conv"]:
                if held is not None:
                    out.append(held.report())
                held = _Conversation(p["conv"])
                if len(out) >= 1_000:
                    yield _table(out, _arrow(reports))
                    out = []
            held.add(p)
        if held is not None:
            yield _table([*out, held.report()], _arrow(reports))

    ranged = symbols.repartitionByRange(tasks, *key).sortWithinPartitions(*key)
    solved = ranged.mapInArrow(solve, pieces)
    return solved.repartition("conv").sortWithinPartitions(*key, "number").mapInArrow(combine, reports)


def _edited(rows: Iterator[dict]) -> Iterator[tuple[dict, Iterator[tuple[str, str, str]]]]:
    """(report, its repaired rows as (edit, role, text)) of each conversation, from
    reports that stand before the rows of their conversation."""
    ahead = next(rows, None)

    def edits(audit: str) -> Iterator[tuple[str, str, str]]:
        nonlocal ahead
        state, at = 0, 0

        def inserted() -> Iterator[tuple[str, str, str]]:
            nonlocal state, at
            while audit[at : at + 1] == "I":
                state, at = NEXT[state], at + 1
                yield "I", "assistant" if state == 3 else "user", ""

        while True:
            row = ahead = next(rows, None)
            if row is None or row["report"] is not None:
                break
            for _ in range(row["n"]):
                yield from inserted()
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = KEEP[row["role"][0]][state]
                    yield edit, row["role"], row["text"]
                elif edit == "R":
                    state = NEXT[state]
                    yield edit, "assistant" if state == 3 else "user", row["text"]
        yield from inserted()

    while ahead is not None:
        head = {"conv": ahead["conv"], **ahead["report"]}
        own = edits(head["audit"])
        yield head, own
        for _ in own:  # what the caller left
            pass


class Repair:
    """``reports`` has a row for each conversation; ``rows`` and ``digests`` apply the audits."""

    def __init__(self, found: DataFrame, reports: DataFrame):
        self.reports = reports
        own = F.struct(*(c for c in reports.columns if c != "conv"))
        heads = reports.select("conv", own.alias("report"))
        texts = found.where(F.col("n") > 0).select("conv", "turn", "role", "digest", "text", "n")
        both = heads.unionByName(texts, allowMissingColumns=True).repartition("conv")
        self._stream = both.sortWithinPartitions("conv", F.col("report").isNull(), "turn", "role", "digest")
        self._conv = T.StructType([reports.schema["conv"]])

    def rows(self) -> DataFrame:
        """(conv, place, edit, role, text): the repaired rows, numbered from 0."""
        schema = T.StructType([*self._conv.fields, *T.StructType.fromDDL("place long, edit string, role string, text string").fields])

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, size = [], 0
            for head, rows in _edited(_records(batches)):
                for place, (edit, role, text) in enumerate(rows):
                    out.append({"conv": head["conv"], "place": place, "edit": edit, "role": role, "text": text})
                    size += len(text) + 100
                    if size > 1 << 22:
                        yield _table(out, _arrow(schema))
                        out, size = [], 0
            if out:
                yield _table(out, _arrow(schema))

        return self._stream.mapInArrow(apply, schema)

    def digests(self) -> DataFrame:
        """``reports`` and ``sha256``, that of the repaired ``role:text`` lines."""
        schema = T.StructType([*self.reports.schema.fields, T.StructField("sha256", T.StringType())])

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = []
            for head, rows in _edited(_records(batches)):
                sha = hashlib.sha256()
                for place, (_, role, text) in enumerate(rows):
                    sha.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                out.append({**head, "sha256": sha.hexdigest()})
                if len(out) >= 1_000:
                    yield _table(out, _arrow(schema))
                    out = []
            if out:
                yield _table(out, _arrow(schema))

        return self._stream.mapInArrow(apply, schema)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: Column | None = None,
           rows_a_task: int = 100_000, piece_rows: int = 1 << 16) -> Repair:
    """``copies`` says how often a row stands (0: not at all, but its conversation
    is there); without it each stands once."""
    paths: list[str] = []
    found = faults(rows, conv, turn, role, text, copies)
    reports = materialise(_reports(found, paths, rows_a_task, piece_rows), "repair-reports")
    drop(rows.sparkSession, paths)
    return Repair(found, reports)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, Column]:
    """(rows, copies): faults made by the crc32 of ``conv:turn`` (nulls: one space),
    modulo 20, for trials of the repair: 0 drops a row, 1 empties it, 2 takes its
    sentence ends, 3 repeats it, 4 calls its role user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    what = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    said = F.coalesce(F.col(text), space)
    x = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.when(what == 4, "user").otherwise(F.coalesce(F.col(role), space)).alias("role"),
        F.when(what == 1, "").when(what == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(what == 0, 0).when(what == 3, 2).otherwise(1).alias("copies"))
    return x, F.col("copies")
