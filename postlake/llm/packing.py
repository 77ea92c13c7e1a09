"""Packing token sequences by cutting-stock column generation.

A document's ids are cut into full sequences and one rest. Rests are counted by
length class (``grid`` ids wide, so at most ``capacity / grid`` classes whatever
the corpus). A linear program over patterns (how many rests of each class one
sequence takes) covers the counts with the fewest sequences: its columns are
generated by a knapsack dynamic program that prices patterns with the duals.
The solution is rounded down, patterns that the rests left over still fill are
used once more, what is left then is packed first-fit decreasing, and the ranked rests of each class are dealt to the places that the
patterns have for it. The driver sees class counts and patterns only.

Ids are those of a tokenizer file that splits at white space, so the ids of a
text are those of its words in turn; words met before are looked up.

Edge cases: a null text counts as empty; an empty text has the end id alone. A
repeated row is packed as often as it occurs. A null key is carried along. An empty table gives no pieces.
Other columns are not read.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memo, materialise, numbered

_SPACE = re.compile("[ \\t-\\r]+")
PIECES = "start long, length long, ids_crc32 long, doc_tokens long"
LETTERS_END = "\u0250"  # Latin letters lie before it; of those beyond, a tokenizer may know fewer than Python
#: Byte-level vocabularies write a byte as its Latin-1 character, or in turn from
#: U+0100 on where that is not printable; spaces stay between words.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_BYTES = np.arange(256, dtype="<u4")
_BYTES[_HIDDEN] = 256 + np.arange(len(_HIDDEN))
_BYTES[32] = 32


def _parts(text: str, most: int = 1 << 20) -> Iterator[str]:
    """``text`` in parts of ``most`` characters and what it takes to the next white space."""
    at = 0
    while len(text) - at > most and (m := _SPACE.search(text, at + most)):
        yield text[at : m.end()]
        at = m.end()
    yield text[at:]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, by their words.

    The distinct words of some texts are looked up, their ids put side by side,
    and the texts' ids gathered from there. Words are what ASCII white space
    parts; one that holds other white space is left to the tokenizer. Remembers
    the ids of words of up to 64 characters met lately.
    """

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.memo = Memo(most)
        # the same vocabulary without the search for words and case, for words known to be lower-case letters
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        probe = "word stra\u00dfe \u00e9t\u00e9 \u00f1and\u00fa \u010dlov\u011bk"
        if self._encode(self.bare, _as_bytes(probe)) != self._encode(self.tokenizer, probe):
            self.bare = None  # a vocabulary of another kind

    @staticmethod
    def _encode(tokenizer, text: str) -> bytes:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Letters before closing marks are words of their own to the tokenizer,
        and of either case; so "Word." needs the ids of "word" and of "."."""
        known, marked, cores, alone = self.memo.now, [], [], set()
        for w in words:
            core = w.lower().rstrip(".,;:!?")
            if core.isalpha() and (w.isascii() or ("Σ" not in w and unicodedata.is_normalized("NFC", w))):
                marked.append(w)
                cores.append(core)
            else:
                alone.add(w)
        self._letters(list(set(cores).difference(known)))
        alone.update({w[len(c) :] for w, c in zip(marked, cores)}.difference(known))
        some = list(alone)
        for e, w in zip(self.tokenizer.encode_batch_fast(some, add_special_tokens=False), some):
            known[w] = np.array(e.ids, "<u4").tobytes()
        known.update((w, known[c] + known[w[len(c) :]]) for w, c in zip(marked, cores) if w not in known)

    def _letters(self, words: list[str], most: int = 2_000) -> None:
        """Ids of words of letters, many in one text."""
        latin = [w for w in words if max(w) < LETTERS_END] if self.bare else []
        others = [w for w in words if max(w) >= LETTERS_END] if self.bare else words
        for a in range(0, len(latin), most):
            self._side_by_side(some := latin[a : a + most], self._encode(self.bare, _as_bytes(" ".join(some))))
        for a in range(0, len(others), most):
            self._side_by_side(some := others[a : a + most], self._encode(self.tokenizer, " ".join(some)))

    def _side_by_side(self, words: list[str], raw: bytes) -> None:
        """Each word ends with the one of its ids that ends a word."""
        ends = (4 * (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1)).tolist()
        if len(ends) == len(words):
            self.memo.now.update(zip(words, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends))))
        else:  # letters to us, not all to the tokenizer
            self.memo.now.update((w, self._encode(self.tokenizer, w)) for w in words)

    def texts(self, texts: pa.Array, most: int = 1 << 22) -> Iterator[bytes]:
        """Of each text of an Arrow array; null counts as empty."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
        a = 0
        while a < len(texts):
            before = int(ends[a - 1]) if a else 0
            n = max(1, int(np.searchsorted(ends, before + most, side="right")) - a)
            if ends[a] - before > most:  # part by part
                yield b"".join(ids for part in _parts(texts[a].as_py()) for ids in self._batch(pa.array([part], texts.type)))
            else:
                yield from self._batch(texts.slice(a, n))
            a += n

    def _batch(self, texts: pa.Array) -> Iterator[bytes]:
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = self.memo.missing(set(words))
        known = self.memo.now
        long = {w: self._encode(self.tokenizer, w) for w in new if len(w) > 64}
        self._learn(list(new.difference(long)))
        each = [long[w] if w in long else known[w] for w in words] if long else list(map(known.__getitem__, words))
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        at = coded.indices.to_numpy()
        n = sizes[at]
        ends = np.cumsum(n)
        ids = np.frombuffer(b"".join(each), "<u4")[np.repeat((np.cumsum(sizes) - sizes)[at] - ends + n, n) + np.arange(n.sum())]
        raw, ends = ids.tobytes(), np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()] * 4
        yield from (raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()))


def _as_bytes(text: str) -> str:
    return text if text.isascii() else _BYTES[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def pieces(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = 2048, path: str | None = None, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Every document's ids cut at multiples of ``capacity``: key, start, length,
    crc32 of the ids' bytes, the document's ids in all, and with ``with_ids``
    the ids themselves (as those bytes)."""
    path = path or tokenizer_path()
    end = int(end_id).to_bytes(4, "little")
    fields = T.StructType([T.StructField("key", docs.schema[key].dataType), *T._parse_datatype_string(PIECES + (", ids binary" if with_ids else "")).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        for batch in batches:
            out: list[tuple] = []
            for i, ids in enumerate(words.texts(batch.column(1))):
                ids += end
                n = len(ids) // 4
                for a in range(0, n, capacity):
                    part = ids[4 * a : 4 * (a + capacity)]
                    out.append((i, a, len(part) // 4, zlib.crc32(part), n, *([part] if with_ids else [])))
            if out:
                row, *rest = zip(*out)
                columns = [pa.array(c, t) for c, t in zip(rest, [pa.int64()] * 4 + [pa.binary()])]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *columns], names=fields.names)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, fields)


def best_pattern(value: np.ndarray, most: int) -> tuple[float, np.ndarray]:
    """The multiset of classes (class i is i + 1 units wide) of ``most`` units at
    most that is worth most; by dynamic programming over the units."""
    best = np.zeros(most + 1)
    pick = np.full(most + 1, -1)
    width = np.arange(1, len(value) + 1)
    for u in range(1, most + 1):
        k = min(u, len(value))
        worth = value[:k] + best[u - width[:k]]
        i = int(worth.argmax())
        best[u], pick[u] = (worth[i], i) if worth[i] > best[u - 1] + 1e-12 else (best[u - 1], -1)
    count, u = np.zeros(len(value), np.int64), most
    while u > 0:
        if pick[u] >= 0:
            count[pick[u]] += 1
            u -= pick[u] + 1
        else:
            u -= 1
    return float(best[most]), count


def cover(demand: np.ndarray, most: int, rounds: int = 4_000, gap: float = 1e-3, seeds: int = 2_000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used (a fraction), by column generation.

    Minimises the number of sequences that cover ``demand``: revised simplex with
    the inverse basis. The entering column is the dearest known pattern, or the
    knapsack's best where no known one is worth more than the sequence it takes.
    Known at first are the patterns of a first-fit packing of about ``seeds``
    rests in the same proportions. Ends at the optimum, or where the bound that
    the duals give is within ``gap``.
    """
    live = np.flatnonzero(demand)
    want = demand[live].astype(float)
    m = len(live)
    basis = np.zeros((m, m))  # column j is pattern j
    for j, c in enumerate(live):
        basis[j, j] = most // (c + 1)
    inverse = np.diag(1 / np.diag(basis))
    use = inverse @ want
    few = np.ceil(demand * min(1.0, seeds / max(1, demand.sum()))).astype(np.int64)
    pool = np.unique(np.stack(first_fit(few, most))[:, live], axis=0).astype(float)
    value = np.zeros(len(demand))
    for _ in range(rounds):
        duals = inverse.sum(axis=0)  # each pattern costs one sequence
        price = pool @ duals
        column = pool[int(price.argmax())]
        if price.max() <= 1 + 1e-7:
            value[live] = np.maximum(duals, 0)  # a rest that is worth less than nothing is in no best pattern
            worth, pattern = best_pattern(value, most)
            if worth <= 1 + 1e-7 or want @ duals / worth >= (1 - gap) * use.sum():
                break
            column = pattern[live].astype(float)
            pool = np.vstack([pool, column])
        step = inverse @ column
        ratio = np.full(m, np.inf)
        ok = step > 1e-9
        ratio[ok] = use[ok] / step[ok]
        r = int(ratio.argmin())
        inverse[r] /= step[r]
        use[r] /= step[r]
        others = np.arange(m) != r
        inverse[others] -= np.outer(step[others], inverse[r])
        use[others] = np.maximum(use[others] - step[others] * use[r], 0)
        basis[:, r] = column
    patterns = np.zeros((m, len(demand)), np.int64)
    patterns[:, live] = basis.T.round().astype(np.int64)
    return patterns, use


def first_fit(left: np.ndarray, most: int) -> list[np.ndarray]:
    """Patterns for what rounding left over: largest class first, into the first that has room."""
    rooms: list[int] = []
    bins: list[np.ndarray] = []
    for c in np.flatnonzero(left)[::-1]:
        for _ in range(int(left[c])):
            at = next((i for i, room in enumerate(rooms) if room >= c + 1), None)
            if at is None:
                rooms.append(most)
                bins.append(np.zeros(len(left), np.int64))
                at = len(rooms) - 1
            rooms[at] -= int(c) + 1
            bins[at][c] += 1
    return bins


@dataclass
class Plan:
    """Per class, parallel arrays of the ranks where a pattern's places begin,
    the pattern's first sequence, and its places for the class in one sequence."""

    sequences: int
    begins: list[np.ndarray]
    first: list[np.ndarray]
    places: list[np.ndarray]


def plan(demand: np.ndarray, most: int) -> Plan:
    """Whole uses of patterns with places for exactly the rests there are."""
    demand = np.asarray(demand, np.int64)
    uses: list[tuple[np.ndarray, int]] = []
    left = demand.copy()
    if demand.any():
        patterns, use = cover(demand, most)
        for p, x in sorted(zip(patterns, use), key=lambda z: -z[1]):
            full = int(min(np.floor(x + 1e-6), (left[p > 0] // p[p > 0]).min())) if p.any() else 0
            if full:
                uses.append((p, full))
                left -= full * p
        for p, _ in sorted(zip(patterns, use), key=lambda z: np.floor(z[1] + 1e-6) - z[1]):  # the nearest to another use first
            if p.any() and (left >= p).all():
                uses.append((p, 1))
                left -= p
    uses += [(p, 1) for p in first_fit(left, most)]
    begins, first, places = ([[] for _ in demand] for _ in range(3))
    at, dealt = 0, np.zeros(len(demand), np.int64)
    for p, n in uses:
        for c in np.flatnonzero(p):
            begins[c].append(int(dealt[c]))
            first[c].append(at)
            places[c].append(int(p[c]))
            dealt[c] += n * p[c]
        at += n
    assert (dealt == demand).all()
    return Plan(at, *([np.array(x, np.int64) for x in y] for y in (begins, first, places)))


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = 2048, grid: int = 8, path: str | None = None, with_ids: bool = False, task_rows: int = 20_000) -> DataFrame:
    """Pieces with their place: (key, start, length, ids_crc32, doc_tokens,
    sequence_id, offset). Full pieces are sequences of their own, after the others."""
    if capacity % grid:
        raise ValueError("capacity must be a multiple of grid")
    own = ["start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    cut = pieces(docs, text, key, capacity, path, with_ids=with_ids)
    cut = materialise(cut.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    # class capacity / grid (the last) holds pieces that fill a sequence alone
    wide = F.ceil(F.col("length") / grid).cast("int") - 1
    last = capacity // grid - 1
    counts = {r["c"]: r["n"] for r in cut.groupBy(wide.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity / grid rows
    demand = np.array([counts.get(c, 0) for c in range(last)], np.int64)
    made = plan(demand, last + 1)
    shared = docs.sparkSession.sparkContext.broadcast(made)  # a few patterns for each class
    ranked = numbered(cut.withColumn("c", wide), ["c"], ["row"], "rank", sum(counts.values()), task_rows)

    @F.arrow_udf("long")
    def place(c: pa.Array, rank: pa.Array) -> pa.Array:
        p = shared.value
        c, rank = c.to_numpy(), rank.to_numpy()
        out = p.sequences + rank
        order = np.argsort(c, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(c[order])) + 1):
            if len(rows) and (k := int(c[rows[0]])) < len(p.begins):
                i = np.searchsorted(p.begins[k], rank[rows], side="right") - 1
                out[rows] = p.first[k][i] + (rank[rows] - p.begins[k][i]) // p.places[k][i]
        return pa.array(out)

    placed = ranked.select("key", *own, place("c", "rank").alias("sequence_id"))
    # at most capacity pieces share a sequence
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "key", "start").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    return placed.select(F.col("key").alias(key), *own, "sequence_id", offset.alias("offset"))
