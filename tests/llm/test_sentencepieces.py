import random

import numpy as np
import pytest
import sentencepiece
from llm_data import EDGE_ROWS, SF, edge_docs, no_docs, prose

from postlake.llm import sentencepieces as S
from postlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=S.model_path())


def ids_of(b):
    return np.frombuffer(b, "<u4").tolist()


ODD = ["", " ", "  ", "a", S.MARK, f"x{S.MARK}y", " lead  two   three    ", "\n\n\t x", "日本語テキスト 한국어", "\U0001f30d\U0001f30d a\U0001f30db", "\x00a\x00", "a" * 21, "ab" * 300,
       "don't https://x.y/z?q=1", "<s></s><unk><0x41>", "é́ ﬁ", "\U0010ffff", prose(1, 200)]


def test_encoding_and_decoding_equal_the_library(library):
    r = random.Random(1)
    odd = ODD + ["".join(r.choice(f"ab th e\n{S.MARK}éx.") for _ in range(r.randint(1, 60))) for _ in range(600)]
    odd += ["".join(chr(r.choice([r.randint(32, 126), r.randint(160, 900), r.randint(0x4E00, 0x5000)])) for _ in range(r.randint(1, 40))) for _ in range(200)]
    pieces = S.load()
    encoder, decoder = S.Encoder(pieces, most=500), S.Decoder(pieces)
    for t, ids in zip(odd, encoder.encode(odd)):
        assert ids_of(ids) == library.encode(t), t
        assert decoder.decode(ids) == library.decode(library.encode(t))
        if S.MARK not in t:
            assert decoder.decode(ids) == t


def test_parts_of_a_long_text_end_where_segments_do(library):
    encoder = S.coders()[0]
    marked = (S.MARK + "one  two\nthree   four five " * 50).replace(" ", S.MARK)
    parts = list(encoder._parts(marked, 40))
    assert "".join(parts) == marked and len(parts) > 10 and all(p[0] == S.MARK and q[-1] != S.MARK for q, p in zip(parts, parts[1:]))
    long = "some  words here.\n" * 70_000
    assert ids_of(next(encoder.encode([long]))) == library.encode(long)


def small(words):
    """A vocabulary from merges, in order of rank."""
    chars = sorted({c for w in words for c in w})
    text = ["", *words, *chars]
    return S.Pieces(text, np.arange(len(text)), np.zeros(256, np.int64), 0)


def merged(pieces, text):
    """Merging by the definition: the best-ranked pair, the leftmost of equals."""
    at = {t: i for i, t in enumerate(pieces.text) if t}
    parts = list(text)
    while True:
        ranks = [(pieces.rank[at[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in at]
        if not ranks:
            return [at[p] for p in parts]
        k = min(ranks)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


@pytest.mark.parametrize("seed", range(12))
def test_relaxed_edges_equal_merging(seed):
    r = random.Random(seed)
    alphabet, words = "abc", []
    have = set(alphabet)
    for _ in range(14):  # each merge joins two pieces there are
        w = r.choice(sorted(have)) + r.choice(sorted(have))
        if len(w) <= 7 and w not in have:
            words.append(w)
            have.add(w)
    words += [c for c in ()]
    pieces = small(words)
    encoder = S.Encoder(pieces)
    encoder.segment = None
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(1, 30))) for _ in range(60)]
    if not all(c in pieces.text for c in alphabet):
        pytest.skip("a letter is in no merge")
    encoder._learn(sorted(set(texts)))
    for t in texts:
        assert ids_of(encoder.memo.now[t]) == merged(pieces, t), (t, words)


def test_edges_are_all_occurrences():
    pieces = small(["ab", "abc", "bc", "aba"])
    encoder = S.Encoder(pieces)
    text = "abcabaxbc\0abab"
    start, piece = encoder._edges(S.codepoints(text))
    want = sorted((i, p) for p, t in enumerate(pieces.text) if p in pieces.normal for i in range(len(text)) if text.startswith(t, i))
    assert sorted(zip(start.tolist(), piece.tolist())) == want


def test_edge_cases(spark, library):
    rows = S.encode(edge_docs(spark)).collect()
    assert len(rows) == len(EDGE_ROWS)
    want = sorted((str(k), library.encode(t or "")) for k, t, _ in EDGE_ROWS)
    assert sorted((str(r.doc_id), list(r.ids)) for r in rows) == want
    assert all(r.round_trip and r.tokens == len(r.ids) for r in rows)
    back = S.decode(S.encode(edge_docs(spark))).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(k), t or "") for k, t, _ in EDGE_ROWS)


def test_empty_table(spark):
    assert S.encode(no_docs(spark)).count() == 0


def test_query(spark, library):
    rows = {r.doc_id: r for r in QUERIES["op9_sentencepiece"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    import zlib

    for d in docs:
        ids = np.array(library.encode(d.text), "<u4")
        r = rows[d.doc_id]
        assert (r.tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
        assert r.round_trip and r.decoded_crc32 == zlib.crc32(d.text.encode())
