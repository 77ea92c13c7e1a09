"""Line dedup: two Bloom filters pick the lines that may repeat; only those are counted.

A line's key is the line without ASCII white space at its ends and with A-Z in
lower case. A key of at least ``min_chars`` code points that stands in at least
``min_docs`` documents loses all its lines, except in the document with the
largest id that holds it.

1. Each task puts the hashes of its keys into a filter of those met once and a
   filter of those met again. Tasks ship the bits they set, dealt by stretches
   of the filter, and a stretch is merged bit by bit: what is in two tasks'
   first filters is in the second filter of all. Memory and traffic are
   proportional to the lines, not to tasks times filter.
2. The second filter goes to all tasks. Lines that it holds are suspected: their
   keys' 128-bit BLAKE2b digests are counted exactly, with a partial aggregate
   before the shuffle, so a line of a third of all documents is one row a task.
   A line that the filter wrongly holds is counted as one of few, and stays.
3. The repeated keys, 16 bytes and an id each, go to all tasks if they take at
   most ``known_bytes``. Beyond that, suspected lines meet them in a join: keys
   of very many lines, of which there can be few, by broadcast, the others by a
   shuffle that no key is hot in.

The filter has about ten bits for each 100 characters of text, but at most
``filter_bytes``. Beyond about 80 times that of text, more and more lines are
wrongly suspected and shuffled; where less than a bit a line is left, all are,
and no filter is made. The result is the same at every size.

Edge cases: a null or empty text is one empty line. A document is a row: rows
that repeat an id count each, and all rows of the largest id keep their lines. A
null id is below every other; where all holders have none, all keep. A key that
a document holds several times counts once. Very long texts are read whole. An
empty table gives no rows. Other columns stay, whatever their names; one named as the
result (``out``) is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, fresh, materialise

SPACE = b" \t\n\x0b\x0c\r"
SEGMENT = 1 << 16  # bits whose offsets fit two bytes
STRETCH = 16  # segments merged together
RESULT = "struct<n_lines:bigint,n_dropped:bigint,kept:binary>"


def keys_of(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(line number, key) of the lines whose keys have at least ``min_chars`` code points."""
    for i, line in enumerate(text.lower().split(b"\n")):  # bytes: only A-Z change
        if len(line) >= min_chars:
            key = line.strip(SPACE)
            if len(key) >= min_chars and (len(key) >= 4 * min_chars or key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
                yield i, key


def digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


class Bloom:
    """``bits`` bits, ``hashes`` of them for each 64-bit hash."""

    def __init__(self, bits: int, hashes: int, data: np.ndarray | None = None):
        self.bits, self.hashes = bits, hashes
        self.data = np.zeros(bits // 8, np.uint8) if data is None else data

    def places(self, h: np.ndarray) -> np.ndarray:
        low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
        return np.stack([(low + np.uint64(i) * high) % np.uint64(self.bits) for i in range(self.hashes)]).astype(np.int64)

    def add(self, places: np.ndarray) -> None:
        p = places.ravel()
        np.bitwise_or.at(self.data, p >> 3, (1 << (p & 7)).astype(np.uint8))

    def has(self, places: np.ndarray) -> np.ndarray:
        return ((self.data[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=0)

    def segments(self) -> Iterator[tuple[int, bytes]]:
        """The set bits of each segment that has any: two-byte offsets, or the bits where that is shorter."""
        for s, part in enumerate(self.data.reshape(-1, SEGMENT // 8)):
            if part.any():
                at = np.flatnonzero(np.unpackbits(part, bitorder="little"))
                yield s, at.astype("<u2").tobytes() if 2 * len(at) < len(part) else part.tobytes()


def _bits(data: bytes) -> np.ndarray:
    if len(data) == SEGMENT // 8:
        return np.frombuffer(data, np.uint8)
    flags = np.zeros(SEGMENT, np.uint8)
    flags[np.frombuffer(data, "<u2")] = 1
    return np.packbits(flags, bitorder="little")


def both_filters(hashes: Iterator[np.ndarray], bits: int, per_key: int) -> tuple[Bloom, Bloom]:
    """Filters of the hashes met once and met again, from batches of hashes."""
    once, twice = Bloom(bits, per_key), Bloom(bits, per_key)
    for h in hashes:
        h, n = np.unique(h, return_counts=True)
        at = once.places(h)
        twice.add(at[:, once.has(at) | (n > 1)])
        once.add(at)
    return once, twice


def filter_size(text_bytes: int, filter_bytes: int, min_chars: int) -> tuple[int, int]:
    """(bits, hashes a key) for a corpus; (0, 0) where the filter would be full."""
    lines = max(1, text_bytes // (2 * min_chars))
    wanted = -(-8 * lines // (SEGMENT * STRETCH)) * SEGMENT * STRETCH
    bits = min(wanted, max(1, 8 * filter_bytes // (SEGMENT * STRETCH)) * SEGMENT * STRETCH)
    if bits < lines:
        return 0, 0
    return bits, 2 if bits >= 3 * lines else 1


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _repeat_filter(docs: DataFrame, text: str, bits: int, per_key: int, min_chars: int) -> Bloom:
    """The filter of hashes met more than once, merged from all tasks."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashes() -> Iterator[np.ndarray]:
            for b in batches:
                found = [{xxhash.xxh3_64_intdigest(k) for _, k in keys_of(t, min_chars)} for t in _texts(b.column(0))]
                yield np.fromiter((h for f in found for h in f), np.uint64)

        for again, part in enumerate(both_filters(hashes(), bits, per_key)):
            rows = list(part.segments())
            for i in range(0, len(rows), 1024):
                some = rows[i : i + 1024]
                at = pa.array([s for s, _ in some], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([s // STRETCH for s, _ in some], pa.int32()), at, pa.array([again == 1] * len(some)), pa.array([d for _, d in some], pa.binary())], names=["stretch", "segment", "again", "data"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}  # 256 KB for each stretch of this task
        for b in batches:
            for segment, again, data in zip(b.column("segment").to_pylist(), b.column("again").to_pylist(), b.column("data").to_pylist()):
                once, twice = held.setdefault(segment, [np.zeros(SEGMENT // 8, np.uint8) for _ in range(2)])
                new = _bits(data)
                if again:
                    twice |= new
                else:
                    twice |= once & new
                    once |= new
        out = [(s, t.tobytes()) for s, (_, t) in held.items() if t.any()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int32()), pa.array([d for _, d in out], pa.binary())], names=["segment", "data"])

    parts = docs.select(text).mapInArrow(own, "stretch int, segment int, again boolean, data binary")
    merged = parts.repartition(min(bits // (SEGMENT * STRETCH), 512), "stretch").mapInArrow(merge, "segment int, data binary")
    out = Bloom(bits, per_key)
    for r in merged.toLocalIterator():  # bits / 8 bytes at most, which filter_bytes bounds
        out.data[r["segment"] * SEGMENT // 8 : (r["segment"] + 1) * SEGMENT // 8] = np.frombuffer(r["data"], np.uint8)
    return out


def _suspects(texts: list[bytes], twice: Bloom | None, min_chars: int) -> tuple[np.ndarray, list[int], list[bytes]]:
    """(row, line number, key) of the lines that the filter holds."""
    rows, lines, keys = [], [], []
    for r, t in enumerate(texts):
        for i, k in keys_of(t, min_chars):
            rows.append(r)
            lines.append(i)
            keys.append(k)
    row = np.array(rows, np.int64)
    if twice is None or not keys:
        return row, lines, keys
    at = np.flatnonzero(twice.has(twice.places(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)))))
    return row[at], [lines[i] for i in at], [keys[i] for i in at]


def _keep(texts: list[bytes], dropped: dict[int, set[int]]) -> pa.Array:
    """Texts without the lines whose numbers ``dropped`` has for their row."""
    out = []
    for r, t in enumerate(texts):
        lines, gone = t.split(b"\n"), dropped.get(r, ())
        out.append((len(lines), len(gone), b"\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else t))
    n, gone, kept = (list(x) for x in zip(*out)) if out else ([], [], [])
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], ["n_lines", "n_dropped", "kept"])


def dedup_lines(docs: DataFrame, text: str = "text", id: str = "doc_id", out: str = "lines", min_chars: int = 40, min_docs: int = 5,
                filter_bytes: int = 1 << 26, known_bytes: int = 1 << 26, report: dict | None = None) -> DataFrame:
    """``docs`` and a struct column ``out``: ``n_lines`` before, ``n_dropped``, and
    the text of the lines that stay (``kept``). ``report`` gets the filter's bits
    and the numbers of suspected and of repeated keys."""
    spark = docs.sparkSession
    size = docs.select(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    bits, per_key = filter_size(int(size), filter_bytes, min_chars)
    twice = spark.sparkContext.broadcast(_repeat_filter(docs, text, bits, per_key, min_chars) if bits else None)

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, _, keys = _suspects(_texts(b.column(1)), twice.value, min_chars)
            if len(rows):
                first: dict[tuple[int, bytes], None] = dict.fromkeys(zip(rows.tolist(), map(digest, keys)))
                yield pa.RecordBatch.from_arrays([pa.array([d for _, d in first], pa.binary()), b.column(0).take(pa.array([r for r, _ in first], pa.int64()))], names=["digest", "id"])

    kind = docs.schema[id].dataType
    pairs = docs.select(F.col(id).alias("id"), text).mapInArrow(suspected, T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("id", kind)]))
    counted = pairs.groupBy("digest").agg(F.count(F.lit(1)).alias("held"), F.max("id").alias("keeper"))
    known = materialise(counted.where(F.col("held") >= min_docs), "lines-known")
    n, most = known.select(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col("keeper").cast("string")) + 24), F.lit(0))).first()
    if report is not None:
        report.update(bits=bits, hashes=per_key, suspected=counted.count(), repeated=n)
    if most <= known_bytes:
        found = _dropped_by_lookup(docs, text, id, known, twice, min_chars)
    else:
        return _dropped_by_join(docs, text, id, out, known, twice, min_chars)
    return docs.withColumn(out, _as_text(found))


def _as_text(found: Column) -> Column:
    return F.struct(found["n_lines"].alias("n_lines"), found["n_dropped"].alias("n_dropped"), found["kept"].cast("string").alias("kept"))


def _dropped_by_lookup(docs: DataFrame, text: str, id: str, known: DataFrame, twice, min_chars: int) -> Column:
    table = known.select("digest", "keeper").toArrow()
    digests = np.array(table["digest"].to_pylist(), "S16")
    order = np.argsort(digests)
    shared = docs.sparkSession.sparkContext.broadcast((digests[order], table["keeper"].combine_chunks().take(pa.array(order))))  # known_bytes at most

    @F.arrow_udf(RESULT)
    def apply(ids: pa.Array, texts: pa.Array) -> pa.Array:
        digests, keepers = shared.value
        body = _texts(texts)
        dropped: dict[int, set[int]] = {}
        if len(digests):
            rows, lines, keys = _suspects(body, twice.value, min_chars)
            own = np.array([digest(k) for k in keys], "S16")
            at = np.minimum(np.searchsorted(digests, own), len(digests) - 1)
            hit = np.flatnonzero(digests[at] == own)
            mine, keeper = ids.take(pa.array(rows[hit])), keepers.take(pa.array(at[hit]))
            stays = pc.or_(pc.and_(pc.is_null(mine), pc.is_null(keeper)), pc.fill_null(pc.equal(mine, keeper), False))
            for i, stay in zip(hit.tolist(), stays.to_pylist()):
                if not stay:
                    dropped.setdefault(int(rows[i]), set()).add(lines[i])
        return _keep(body, dropped)

    return apply(F.col(id), F.col(text))


def _dropped_by_join(docs: DataFrame, text: str, id: str, out: str, known: DataFrame, twice, min_chars: int, hot_lines: int = 100_000) -> DataFrame:
    """The same where the repeated keys are too many for each task to hold."""
    row, paths = fresh(docs, "line_row"), []
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "lines-rows", paths)

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, lines, keys = _suspects(_texts(b.column(1)), twice.value, min_chars)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([digest(k) for k in keys], pa.binary()), b.column(0).take(pa.array(at)), pa.array(lines, pa.int64())], names=["digest", "row", "line"])

    lines = materialise(rows.select(row, text).mapInArrow(suspected, "digest binary, row long, line long"), "lines-suspected", paths)
    # at most one key for each hot_lines documents is hot, and never over 100,000 keys
    limit = max(hot_lines, lines.count() // 100_000)
    hot = F.broadcast(known.where(F.col("held") > limit))
    cold = known.where(F.col("held") <= limit)
    met = lines.join(hot, "digest").unionByName(lines.join(hot.select("digest"), "digest", "left_anti").join(cold, "digest"))
    keepers = met.groupBy("row").agg(F.collect_list(F.struct("line", "keeper")).alias("met"))
    both = rows.join(keepers.select(F.col("row").alias(row), F.col("met").alias(f"{row}_met")), row, "left")
    gone = F.transform(F.filter(F.coalesce(f"{row}_met", F.array()), lambda m: ~m.keeper.eqNullSafe(F.col(id))), lambda m: m.line)

    @F.arrow_udf(RESULT)
    def apply(texts: pa.Array, gone: pa.Array) -> pa.Array:
        return _keep(_texts(texts), {r: set(g) for r, g in enumerate(gone.to_pylist()) if g})

    return both.withColumn(out, _as_text(apply(F.col(text), gone))).select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()), out)
