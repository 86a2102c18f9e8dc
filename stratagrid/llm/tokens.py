"""Token ids of whole Arrow text columns with the tokenizers library.

A text is cut before ASCII spaces that follow a character other than white space, where the
tokenizer's own splitting always cuts too; each chunk is encoded once per worker and kept in a bounded
cache.  The pieces of a chunk come from the library's pre-tokenizer and their ids from its model, so
that the result equals encoding the whole text.  A text that holds an added token goes to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array

CACHE = 1 << 20  # chunks a worker keeps at most by default, about 200 bytes each
LONGEST = 64  # characters of a chunk that is kept at most: longer ones rarely come again
_UNSAFE = re.compile(r"\s (?:\s|$)")  # white space around a space: cutting there would split a run
_SAFE_CUT = re.compile(r"(?<=\S)(?= )")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII marks but the apostrophe, which may open a piece
# The pieces of the pre-tokenizer where only ASCII occurs.
_PLAIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
_loaded: dict[tuple[str, int], "Encoder"] = {}


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class _Chunks(dict):
    """Little-endian 32-bit ids of chunks; missing ones are encoded on first use."""

    def __init__(self, encoder: "Encoder", lead: str):
        super().__init__()
        self._encoder, self._lead = encoder, lead

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self._encoder.cache:
            self.clear()
        word = chunk.rstrip(_MARKS)
        if word and word.isalpha():  # letters, then marks: one piece each
            if len(word) == len(chunk):
                ids = self._encoder.piece_ids(self._lead + word)
            else:
                ids = self[word] + self._encoder.mark_ids(chunk[len(word):])
        elif chunk.isascii():
            ids = b"".join(map(self._encoder.mark_ids, _PLAIN_PIECES.findall(self._lead + chunk)))
        else:
            ids = self._encoder.chunk_ids(self._lead + chunk)
        if len(chunk) <= LONGEST:
            self[chunk] = ids
        return ids


class Encoder:
    """Encodes texts as the library does with ``add_special_tokens=False``: an added token in a text is one id."""

    def __init__(self, path: str, cache: int = CACHE):
        self.cache = cache
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        split = self.tokenizer.pre_tokenizer
        if (self.tokenizer.normalizer is not None or self.tokenizer.post_processor is not None
                or not isinstance(split, ByteLevel) or split.add_prefix_space or not split.use_regex):
            raise ValueError("only a plain byte-level tokenizer can be encoded by chunk")
        self._split = split.pre_tokenize_str
        self._model = self.tokenizer.model.tokenize
        self._letters = _byte_letters()
        self._marks: dict[str, bytes] = {}
        self._packed = [n.to_bytes(4, "little") for n in range(self.vocabulary)]
        self._spaced, self._plain = _Chunks(self, " "), _Chunks(self, "")

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _ids(self, mapped: str) -> bytes:
        return b"".join([self._packed[t.id] for t in self._model(mapped)])

    def piece_ids(self, piece: str) -> bytes:
        """Ids of a text that the pre-tokenizer would leave whole."""
        if piece.isascii() and piece.isprintable():  # only the space has another letter
            return self._ids(piece.replace(" ", self._letters[32]))
        return self._ids(piece.encode().decode("latin-1").translate(self._letters))

    def mark_ids(self, marks: str) -> bytes:
        ids = self._marks.get(marks)
        if ids is None:
            if len(self._marks) >= self.cache >> 2:
                self._marks.clear()
            ids = self.piece_ids(marks)
            if len(marks) <= LONGEST:
                self._marks[marks] = ids
        return ids

    def chunk_ids(self, chunk: str) -> bytes:
        return b"".join(self._ids(piece) for piece, _ in self._split(chunk))

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        if any(token in text for token in self._added):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if _UNSAFE.search(text):
            return b"".join(map(self._plain.__getitem__, _SAFE_CUT.split(text)))
        chunks = text.split(" ")
        first = self._plain[chunks[0]] if chunks[0] else b""
        del chunks[0]
        return first + b"".join(map(self._spaced.__getitem__, chunks))


def encoder(path: str, cache: int = CACHE) -> Encoder:
    """The worker's encoder for a vocabulary file, with at most ``cache`` chunks kept."""
    if (path, cache) not in _loaded:
        _loaded[path, cache] = Encoder(path, cache)
    return _loaded[path, cache]


def vocabulary_path(path: str | None) -> str:
    """The given file, or the public byte-level vocabulary where the tokenizer files are installed."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
