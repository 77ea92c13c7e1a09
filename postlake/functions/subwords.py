"""P17 in the tokens of a model: text cut where its tokenizer reaches the limit."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import MAX_TOKENS

#: Tokens that a model's tokenizer puts around a text, within its limit.
SPECIAL_TOKENS = 2
#: Rows of a batch that are Python strings at a time.
ROWS = 64
WORD_END = re.compile(r"(?<=\S)(?=\s)")


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    return found


def _cut(text: str, tokenizer, n: int) -> str:
    reach = 8 * n
    while True:
        end = WORD_END.search(text, reach) if len(text) > reach else None
        part = text[: end.start()] if end else text
        found = tokenizer.encode(part, add_special_tokens=False)
        if len(found) > n:
            return text[: found.token_to_chars(n - 1)[1]]
        if len(part) == len(text):
            return text
        reach *= 4


def cut_texts(texts: Iterable[str | None], path: str, n: int) -> list[str | None]:
    """Each text up to the end of its ``n``-th token (whole, if it has no more). Only
    as much of a long text is tokenised as the limit takes: tokens never cross the
    end of a word, so a part that ends there has the first tokens of the whole. The
    tokens of one text are held at a time, as they take many times its memory."""
    if n <= 0:
        return [None if t is None else "" for t in texts]
    tokenizer = _tokenizer(path)
    return [_cut(t, tokenizer, n) if t else t for t in texts]


def cut_batch(batch: pa.Array, path: str, n: int) -> pa.Array:
    """``cut_texts`` of an Arrow batch, a slice of its rows in Python at a time."""
    parts = [pa.array(cut_texts(batch.slice(at, ROWS).to_pylist(), path, n), pa.string()) for at in range(0, len(batch), ROWS)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def truncate_subwords(text: Column, path: str, n: int = MAX_TOKENS, special: int = SPECIAL_TOKENS) -> Column:
    """The text up to the end of its token number ``n - special``, by the tokenizer
    file ``path`` (in the ``tokenizers`` library's format, at the same place on every
    machine). A character is not cut in two; null stays null, a text within the
    limit is returned as it is."""

    @F.arrow_udf("string")
    def cut(batch: pa.Array) -> pa.Array:
        return cut_batch(batch, path, n - special)

    return cut(text)
