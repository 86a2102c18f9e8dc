"""Word and shingle hashes of whole Arrow text columns, vectorised with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18  # text hashed at once; one longer document is a slice of its own
_LONGEST = 4096

_random = np.random.RandomState(20240229)


def _odd(n: int) -> np.ndarray:
    return _random.randint(0, 1 << 62, n, dtype=np.uint64) * np.uint64(4) + np.uint64(1) | np.uint64(2)


_BYTE = _odd(256)
_PLACE = _odd(_LONGEST)
_FAR = _odd(_LONGEST)
_FAR[0] = 1  # a word hashes alike whether or not a very long one is near
_STEP = _odd(64)
for _b in b" \t\n\x0b\x0c\r":
    _BYTE[_b] = 0
_LOWERED = _BYTE.copy()
_LOWERED[65:91] = _BYTE[97:123]
_SPACE = _BYTE == 0


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE_BYTES`` of text."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + SLICE_BYTES, "right")) - 1)
        yield begin, end
        begin = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: empty) and the offsets of its rows."""
    filled = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset:filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the number of the first word of every row."""
    space = _SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    opens = np.empty(len(data), bool)
    opens[0] = True
    opens[1:] = space[:-1]
    opens[offsets[offsets < len(data)]] = True
    closes = np.empty(len(data), bool)
    closes[-1] = True
    closes[:-1] = space[1:]
    closes[offsets[offsets > 0] - 1] = True
    starts, ends = np.flatnonzero(opens & ~space), np.flatnonzero(closes & ~space) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of every word; ``lower`` compares A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data) - starts[0]) - np.repeat(starts - starts[0], lengths)
    values = (_LOWERED if lower else _BYTE)[data[starts[0]:]]
    values *= _PLACE[place % _LONGEST]
    if (ends - starts).max() > _LONGEST:  # a second key tells the stretches of a very long word apart
        values *= _FAR[(place // _LONGEST) % _LONGEST]
    return mix(np.add.reduceat(values, starts - starts[0]))


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (split at ASCII white space) and the first word of every row."""
    data, offsets = text_bytes(texts)
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(data, starts, ends, lower), first


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes (runs may cross rows).

    A width that a step up to ten divides is hashed as runs of runs.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    step = next((s for s in range(min(10, width - 1), 1, -1) if width % s == 0), 1) if width > 10 else 1
    inner = rolling(hashes, step) if step > 1 else hashes
    total = np.full(n, width, np.uint64)
    for j in range(width // step):
        total += inner[j * step:j * step + n] * _STEP[j % len(_STEP)]
    return mix(total)


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out
