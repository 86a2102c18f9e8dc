"""Byte-level BPE ids of whole texts with the tiktoken library, and their bytes again.

The vocabulary is a local file of ranks.  A long text is cut before white space that follows another
character, where the splitting pattern always ends a match; a very long run of white space, on which the
library's pattern fails, is taken out and encoded as the piece that the pattern would make of it.  Decoding
joins raw bytes, so it needs no valid text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRETCH = 1 << 16  # characters that the library gets at once, unless no safe cut follows
LONG_RUN = 1 << 14  # white space that is encoded as a piece of its own
# The characters that the pattern's \s means.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_RUN = re.compile(f"[{_WHITE}]{{{LONG_RUN},}}")
_CUT = re.compile(f"[^{_WHITE}](?=[{_WHITE}])")
_loaded: dict[tuple[str, str], "Codec"] = {}


class Codec:
    """Encodes and decodes with the ranks of a file; no special tokens."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}

        def encoding(split: str) -> tiktoken.Encoding:
            return tiktoken.Encoding("local", pat_str=split, mergeable_ranks=ranks, special_tokens={})

        self._texts = encoding(pattern)
        self._piece = cache(lambda: encoding("(?s:.+)"))  # only texts with a very long run need it

    def encode(self, text: str) -> list[int]:
        """All ids of a text, the same as of the text encoded at once."""
        if len(text) <= STRETCH:
            return self._texts.encode_ordinary(text)
        ids: list[int] = []
        begin = 0
        for run in _RUN.finditer(text):
            # the last white space before another character belongs to what follows
            end = run.end() - (run.end() < len(text))
            ids += self._stretches(text, begin, run.start())
            ids += self._piece().encode_ordinary(text[run.start():end])
            begin = end
        return ids + self._stretches(text, begin, len(text))

    def _stretches(self, text: str, begin: int, end: int) -> list[int]:
        ids: list[int] = []
        while begin < end:
            safe = _CUT.search(text, begin + STRETCH, end) if end - begin > STRETCH else None
            cut = safe.end() if safe else end
            ids += self._texts.encode_ordinary(text[begin:cut])
            begin = cut
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return self._texts.decode_bytes(ids)


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a rank file and pattern."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Codec(path, pattern)
    return _loaded[path, pattern]


def rank_file(path: str | None, pattern: str | None) -> tuple[str, str]:
    """The given rank file and pattern, or the public ones where the tokenizer files are installed."""
    if path and pattern:
        return path, pattern
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def _ids(own: Codec, texts: pa.Array) -> pa.Array:
    ends, parts = [0], [np.zeros(0, np.int32)]
    for body in texts:
        parts.append(np.array(own.encode(body.as_py() or ""), np.int32))
        ends.append(ends[-1] + len(parts[-1]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts)))


def _bytes(own: Codec, ids: pa.Array) -> pa.Array:
    return pa.array([own.decode(row.values.to_numpy().tolist()) if row.is_valid else b"" for row in ids], pa.binary())


def encode(text: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """Ids of a text column as ``array<int>``; a null text is empty and has none."""
    ranks, split = rank_file(path, pattern)

    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(ranks, split)
        for column in batches:
            yield _ids(own, column)

    return to_ids(text)


def decode(ids: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """Bytes of a column of ids as ``binary``; null ids have none.  An id outside the vocabulary fails."""
    ranks, split = rank_file(path, pattern)

    @F.arrow_udf("binary")
    def to_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(ranks, split)
        for column in batches:
            yield _bytes(own, column)

    return to_bytes(ids)


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
               pattern: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: every text's ids, and the bytes that these ids decode to.

    A null or empty text has no ids and no bytes.  Repeated rows and null ids stay as they are; an empty
    table gives an empty result; other columns are ignored.
    """
    ranks, split = rank_file(path, pattern)

    @F.arrow_udf("ids array<int>, decoded binary")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(ranks, split)
        for column in batches:
            ids = _ids(own, column)
            yield pa.StructArray.from_arrays([ids, _bytes(own, ids)], ["ids", "decoded"])

    # one pass through one worker; a text's ids and bytes never wait for another stage
    return docs.select(F.col(doc_id).alias("doc_id"), both(F.col(text)).alias("both")).select("doc_id", "both.*")
