"""SentencePiece encoding and decoding by suffix-array matching.

The distinct segments of a batch (no piece crosses a segment's edge) are
concatenated, and the suffixes are sorted by as many characters as the longest
piece has. Each piece is binary-searched for the range of suffixes that begin
with it; each occurrence is an edge over the text. The edges, sorted by where
they end, are then relaxed from left to right.

The vocabularies are byte-pair encodings, for which the best path is not one of
greatest score: the encoding of a text ends with piece t exactly if t may follow
the last piece of the encoding of the text before it, that is if merging the two
on their own leaves them apart. So an edge is taken where its piece may follow
the piece that its start was reached by; one edge for each position may.

Edge cases: a null text is encoded as an empty one, to no ids, and decoded to
an empty text. Characters outside the vocabulary become their UTF-8 bytes. A
text that itself holds the mark U+2581 decodes with a space there, as the
format has it. Repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, codepoints

MARK = chr(0x2581)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass
class Pieces:
    """A piece vocabulary. Pieces are numbered by id; ``rank`` orders merges."""

    text: list[str]  # of normal pieces, else empty
    rank: np.ndarray
    byte_id: np.ndarray  # id of each of the 256 bytes
    unknown: int
    normal: np.ndarray = field(init=False)
    merge_key: np.ndarray = field(init=False)  # sorted left * size + right of all merges
    merge_rank: np.ndarray = field(init=False)
    right_spine: np.ndarray = field(init=False)  # the piece, its right part, that one's right part, ...; -1 after
    left_spine: np.ndarray = field(init=False)

    def __post_init__(self):
        at = {t: i for i, t in enumerate(self.text) if t}
        size = len(self.text)
        merges = [(at[t[:k]] * size + at[t[k:]], self.rank[i]) for t, i in at.items() for k in range(1, len(t)) if t[:k] in at and t[k:] in at]
        key = np.array([k for k, _ in merges], np.int64)
        order = np.argsort(key)
        self.merge_key, self.merge_rank = key[order], np.array([r for _, r in merges], np.int64)[order]
        parts = {i: self._parts(t, at) for t, i in at.items()}
        # a piece that merging its own characters does not give is never used
        self.normal = np.array([i for i, p in sorted(parts.items()) if p is not None], np.int64)
        deepest = max(map(len, at), default=1)
        self.right_spine, self.left_spine = np.full((2, size, deepest), -1, np.int64)
        for spine, side in ((self.right_spine, 1), (self.left_spine, 0)):
            for i in self.normal:
                j, d = int(i), 0
                while True:
                    spine[i, d] = j
                    if not parts[j]:
                        break
                    j, d = parts[j][side], d + 1

    def _parts(self, piece: str, at: dict[str, int]) -> tuple | None:
        """The two pieces last merged into ``piece`` (none for a character)."""
        symbols, last = list(piece), ()
        if any(c not in at for c in symbols):
            return None
        while len(symbols) > 1:
            ranks = [(self.rank[at[a + b]], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in at]
            if not ranks:
                return None
            k = min(ranks)[1]
            last = (at[symbols[k]], at[symbols[k + 1]])
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        return last

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging piece a followed by piece b leaves exactly those two.

        While the two form, the right end of a grows along its right spine and
        the left end of b along its left one. They are joined if a merge of two
        such ends is due before either end grows (at a tie, the merge further
        left is first: growth of a, else the join).
        """
        size, ok = len(self.text), np.ones(len(a), bool)
        never = np.iinfo(np.int64).max
        for i in range(self.right_spine.shape[1]):
            x = self.right_spine[a, i]
            some = np.flatnonzero((x >= 0) & ok)
            if not len(some):
                break
            a_grows = self.rank[self.right_spine[a[some], i - 1]] if i else np.full(len(some), never)
            for j in range(self.left_spine.shape[1]):
                y = self.left_spine[b[some], j]
                if not (y >= 0).any():
                    break
                key = x[some] * size + y
                k = np.minimum(np.searchsorted(self.merge_key, key), len(self.merge_key) - 1)
                due = np.where((self.merge_key[k] == key) & (y >= 0), self.merge_rank[k], never)
                b_grows = self.rank[self.left_spine[b[some], j - 1]] if j else np.full(len(some), never)
                ok[some[(due < a_grows) & (due <= b_grows) & (due < never)]] = False
        return ok


def load(path: str | None = None) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or model_path())
    n = sp.get_piece_size()
    special = [sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
    text = ["" if special[i] else sp.id_to_piece(i) for i in range(n)]
    score = np.array([sp.get_score(i) for i in range(n)])
    byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
    return Pieces(text, np.argsort(np.argsort(-score, kind="stable"), kind="stable").astype(np.int64), byte_id, sp.unk_id())


def _search(words: list[np.ndarray], keys: list[np.ndarray], after: bool) -> np.ndarray:
    """For each key (a tuple over ``keys``) the first sorted row not below it, or
    with ``after`` the first above it: binary search for all keys at once."""
    lo, hi = np.zeros(len(keys[0]), np.int64), np.full(len(keys[0]), len(words[0]), np.int64)
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        row = np.minimum(mid, len(words[0]) - 1)
        below, same = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for w, k in zip(words, keys):
            below |= same & (w[row] < k)
            same &= w[row] == k
        up = open_ & (below | (same if after else False))
        lo, hi = np.where(up, mid + 1, lo), np.where(open_ & ~up, mid, hi)
    return lo


class Encoder:
    """Encodes batches of texts; remembers the ids of segments met lately."""

    def __init__(self, pieces: Pieces, most: int = 300_000):
        self.p = pieces
        self.memo = Memo(most)
        used = [pieces.text[i] for i in pieces.normal]
        self.alphabet = np.array(sorted({ord(c) for t in used for c in t}), np.uint32)
        self.longest = max(map(len, used), default=1)
        flat = np.concatenate([codepoints(t) for t in used]) if used else np.empty(0, np.uint32)
        self.length = np.zeros(len(pieces.text) + 1, np.int64)
        self.length[pieces.normal] = [len(t) for t in used]
        self.length[-1] = 1  # number -1: a character that no piece has
        cut = np.cumsum([0, *(len(t) for t in used)])
        self.rows = np.zeros((len(used), self.longest), np.uint32)
        for i, (a, b) in enumerate(zip(cut, cut[1:])):
            self.rows[i, : b - a] = flat[a:b]
        # where a mark only begins a piece (or fills it), and line ends are in none, those are edges of segments
        whole = any(MARK in t.lstrip(MARK) for t in used) or any(c in t for t in used for c in "\n\t")
        self.segment = None if whole else re.compile(f"{MARK}+[^{MARK}\n\t]*|[^{MARK}\n\t]+|[\n\t]")
        self.pair = np.empty(0, np.int64)  # sorted pairs of pieces met, and whether the second may follow
        self.may = np.empty(0, bool)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        for a in range(0, len(texts), 512):
            marked = [(MARK + t).replace(" ", MARK) if t else "" for t in texts[a : a + 512]]
            if max(map(len, marked)) > 1 << 20:  # one by one, and part by part
                for t in marked:
                    yield b"".join(ids for part in self._parts(t) for ids in self._batch([part]))
            else:
                yield from self._batch(marked)

    def _parts(self, marked: str, most: int = 1 << 20) -> Iterator[str]:
        """Parts of about ``most`` characters that end where a segment does."""
        at = 0
        edge = re.compile(f"(?<=[^{MARK}]){MARK}")
        while self.segment and len(marked) - at > most and (m := edge.search(marked, at + most)):
            yield marked[at : m.start()]
            at = m.start()
        yield marked[at:]

    def _batch(self, marked: list[str]) -> Iterator[bytes]:
        if marked:
            split = [self.segment.findall(t) if self.segment else [t] for t in marked]
            new = list(self.memo.missing(set().union(*split)))
            size = 0
            group: list[str] = []
            for s in new:
                if size + len(s) > 1 << 19 and group:
                    self._learn(group)
                    size, group = 0, []
                group.append(s)
                size += len(s) + 1
            self._learn(group)
            for words in split:
                yield b"".join(map(self.memo.now.__getitem__, words))

    def _edges(self, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of every occurrence of a piece in ``cp``."""
        letters, code = np.unique(cp, return_inverse=True)  # 0, between segments, is the least
        bits = max(1, int(len(letters)).bit_length())
        per = 64 // bits
        n_words = -(-self.longest // per)
        padded = np.concatenate((code.reshape(-1).astype(np.uint64), np.zeros(n_words * per, np.uint64)))
        words = []
        for w in range(n_words):
            key = np.zeros(len(cp), np.uint64)
            for k in range(w * per, (w + 1) * per):
                key = (key << np.uint64(bits)) | padded[k : k + len(cp)]
            words.append(key)
        suffixes = np.lexsort(words[::-1])
        words = [w[suffixes] for w in words]
        # the pieces in the same code; one with a letter that does not occur is not sought
        place = np.minimum(np.searchsorted(letters, self.rows), len(letters) - 1)
        there = np.flatnonzero(((letters[place] == self.rows) | (self.rows == 0)).all(axis=1))
        filled = self.rows[there] != 0
        low = np.where(filled, place[there], 0).astype(np.uint64)
        high = np.where(filled, low, np.uint64((1 << bits) - 1))
        ranges = []
        for codes, after in ((low, False), (high, True)):
            fill = 0 if not after else (1 << bits) - 1
            keys = []
            for w in range(n_words):
                key = np.zeros(len(there), np.uint64)
                for k in range(w * per, (w + 1) * per):
                    key = (key << np.uint64(bits)) | (codes[:, k] if k < self.longest else np.uint64(fill))
                keys.append(key)
            ranges.append(_search(words, keys, after))
        n = ranges[1] - ranges[0]
        which = np.repeat(np.arange(len(there)), n)
        at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ranges[0], n)
        return suffixes[at], self.p.normal[there[which]]

    def _follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``may_follow``, each pair worked out once; at a segment's start, or
        next to a character that no piece has, anything may."""
        out = np.ones(len(a), bool)
        inner = np.flatnonzero((a >= 0) & (b >= 0))
        key, back = np.unique(a[inner] * len(self.p.text) + b[inner], return_inverse=True)
        known = np.searchsorted(self.pair, key)
        new = key if not len(self.pair) else key[self.pair[np.minimum(known, len(self.pair) - 1)] != key]
        if len(new):
            fits = self.p.may_follow(new // len(self.p.text), new % len(self.p.text))
            if len(self.pair) > 4_000_000:  # forget, but for what this call needs
                at = np.setdiff1d(key, new)
                keep = np.searchsorted(self.pair, at)
                self.pair, self.may = self.pair[keep], self.may[keep]
            at = np.searchsorted(self.pair, new)
            self.pair, self.may = np.insert(self.pair, at, new), np.insert(self.may, at, fits)
        out[inner] = self.may[np.searchsorted(self.pair, key)][back] if len(key) else True
        return out

    def _learn(self, segments: list[str]) -> None:
        if not segments:
            return
        cp = codepoints("\0".join(segments) + "\0")
        size = np.array([len(s) for s in segments], np.int64)
        first = np.cumsum(size + 1) - size - 1
        inside = np.ones(len(cp), bool)
        inside[first + size] = False
        start, piece = self._edges(np.where(inside & (cp == 0), np.uint32(0x10FFFF), cp))
        alone = np.flatnonzero(inside & ~np.isin(cp, self.alphabet))
        start, piece = np.concatenate((start, alone)), np.concatenate((piece, np.full(len(alone), -1)))
        end = start + self.length[piece]
        base = np.repeat(first, size + 1)  # of the segment of each position
        step = end - base[start]
        order = np.argsort(step.astype(np.uint16) if size.max() < 1 << 16 else step, kind="stable")
        start, piece, end, step = start[order], piece[order], end[order], step[order]
        NONE, START = -3, -2
        last = np.full(len(cp) + 1, NONE, np.int64)
        last[first] = START
        cuts = np.flatnonzero(np.diff(step)) + 1
        for s, t, e in zip(np.split(start, cuts), np.split(piece, cuts), np.split(end, cuts)):
            before = last[s]
            ok = before != NONE
            s, t, e, before = s[ok], t[ok], e[ok], before[ok]
            ok = self._follows(before, t)
            last[e[ok]] = t[ok]
        # walk back from each segment's end
        at, segment = first + size, np.arange(len(segments))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(at := at[(more := at > first[segment])]):
            segment = segment[more]
            at = at - self.length[last[at]]
            found.append((at, segment))
        if found:
            pos = np.sort(np.concatenate([x for x, _ in found]))
        else:
            pos = np.empty(0, np.int64)
        # the piece that begins at pos is the last one where the next begins, or the segment ends
        nxt = np.append(pos[1:], 0)
        seg_end = base[pos] + np.repeat(size, size + 1)[pos]
        nxt = np.where((nxt > pos) & (nxt <= seg_end), nxt, seg_end)
        token = last[nxt]
        char = cp[pos]
        wide = np.where(token >= 0, 1, 1 + (char > 0x7F) + (char > 0x7FF) + (char > 0xFFFF)).astype(np.int64)
        to = np.cumsum(wide) - wide
        ids = np.zeros(int(wide.sum()), "<u4")
        ids[to[token >= 0]] = token[token >= 0]
        for i in np.flatnonzero(token < 0):
            raw = chr(char[i]).encode("utf-8", "surrogatepass")
            ids[to[i] : to[i] + len(raw)] = self.p.byte_id[list(raw)]
        edge = np.searchsorted(pos, np.append(first, len(cp)))
        byte_at = 4 * np.append(to, len(ids))[edge]
        raw = ids.tobytes()
        for s, a, b in zip(segments, byte_at[:-1].tolist(), byte_at[1:].tolist()):
            self.memo.now[s] = raw[a:b]


class Decoder:
    def __init__(self, pieces: Pieces):
        self.bytes = [t.replace(MARK, " ").encode() for t in pieces.text]
        for b, i in enumerate(pieces.byte_id):
            self.bytes[i] = bytes([b])
        self.bytes[pieces.unknown] = " ⁇ ".encode()

    def decode(self, ids: bytes) -> str:
        """The text of ids (little-endian unsigned 32-bit), without the space put before it."""
        text = b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
        return text.removeprefix(" ")


_CODERS: dict[str, tuple[Encoder, Decoder]] = {}


def coders(path: str | None = None) -> tuple[Encoder, Decoder]:
    """The encoder and decoder of a model file, once in each process."""
    path = path or model_path()
    if path not in _CODERS:
        pieces = load(path)
        _CODERS[path] = Encoder(pieces), Decoder(pieces)
    return _CODERS[path]


def encode(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None, with_ids: bool = True) -> DataFrame:
    """(key, tokens, ids_crc32, decoded_crc32, round_trip, and ``ids`` as an
    array with ``with_ids``): every whole text encoded, and decoded again."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coders(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = []
            for t, ids in zip(texts, encoder.encode(texts)):
                back = decoder.decode(ids)
                rows.append((len(ids) // 4, zlib.crc32(ids), zlib.crc32(back.encode("utf-8", "surrogatepass")), back == (t or ""), *([np.frombuffer(ids, "<u4").astype(np.int32)] if with_ids else [])))
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32())))]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *names])

    names = ["tokens", "ids_crc32", "decoded_crc32", "round_trip", *(["ids"] if with_ids else [])]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, tokens int, ids_crc32 long, decoded_crc32 long, round_trip boolean" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def decode(encoded: DataFrame, ids: str = "ids", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """(key, text) of arrays of ids; a null array gives a null text."""
    path = path or model_path()

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        decoder = coders(path)[1]
        return pa.array([None if x is None else decoder.decode(np.array(x, "<u4").tobytes()) for x in batch.to_pylist()], pa.string())

    return encoded.select(F.col(key), run(F.col(ids)).alias("text"))
