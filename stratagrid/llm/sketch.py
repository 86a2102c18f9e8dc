"""A count-min sketch that tells which keys may occur in two rows or more.

Counters saturate at two, so a cell needs two bits while it is built and one bit when it is done.
Each task sends the cells it has touched as 16-bit offsets in their blocks, the blocks of a section in
one row: a full buffer makes ``SECTIONS`` rows at most, whatever the size of the sketch.  Sections are
merged where they meet.  The finished sketch has a fixed size, ``depth`` rows of ``cells`` bits, bounded by
``MAX_CELLS``: beyond the size that suits it, it only overestimates more.

Asked for, the sketch also lists its crowded cells with their counts, so that keys can be put in an order that
has the rare ones first; about ``MAX_CROWDED`` of them at most, for up to 2^36 keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagrid.llm.lean import lean
from stratagrid.llm.words import mix
from stratagrid.scratch import materialize

MIN_CELLS, MAX_CELLS = 1 << 20, 1 << 31  # two rows of them are told apart by 32 bits
BLOCK = 1 << 15
SECTIONS = 1 << 9
MAX_CROWDED, CROWDED = 1 << 20, 64  # listed cells at most, and the least count of a listed one
MOST = (1 << 16) - 1  # counts of crowded cells end here
FLUSH = 1 << 21  # touched cells that a task holds at most before it sends them
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03], np.uint64)


def cells_for(keys: float) -> int:
    """Cells of one row: a power of two, at least the expected number of keys, within the bounds."""
    cells = MIN_CELLS
    while cells < min(keys, MAX_CELLS):
        cells *= 2
    return cells


def crowd_for(keys: float) -> int:
    """The least count of a listed cell: so many keys give no more than ``MAX_CROWDED`` cells as much, up to 2^36."""
    return int(min(max(CROWDED, -(-keys // MAX_CROWDED)), MOST))


def _cell(keys: np.ndarray, row: int, cells: int) -> np.ndarray:
    return mix(keys ^ _SEEDS[row]) & np.uint64(cells - 1)


class Repeated:
    """The finished sketch: one bit per cell, set when the cell has counted two or more.

    ``crowded`` are the sorted places of the cells that were listed, ``counts`` what they have counted.
    """

    def __init__(self, bits: np.ndarray, cells: int, depth: int, crowded: np.ndarray, counts: np.ndarray):
        self.bits, self.cells, self.depth, self.crowded, self.counts = bits, cells, depth, crowded, counts

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """True for every key that two rows have; rarely for another one."""
        found = np.ones(len(keys), bool)
        for row in range(self.depth):
            at = _cell(keys, row, self.cells)
            byte = self.bits[(at >> np.uint64(3)).astype(np.int64) + row * (self.cells // 8)]
            found &= (byte >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found

    def crowd(self, keys: np.ndarray) -> np.ndarray:
        """What the cell of each key in the first row has counted when it was listed, else 0."""
        if not len(self.crowded):
            return np.zeros(len(keys), np.uint16)
        cell = _cell(keys, 0, self.cells).astype(np.uint32)
        at = np.minimum(np.searchsorted(self.crowded, cell), len(self.crowded) - 1)
        return np.where(self.crowded[at] == cell, self.counts[at], 0).astype(np.uint16)


def _payloads(touched: list[np.ndarray], blocks_each: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """Section, its touched blocks, their numbers of cells, all codes (offset and "twice or more"), and the
    counts of those that are."""
    at = np.concatenate(touched)
    touched.clear()
    at.sort()
    new = np.empty(len(at), bool)
    new[0] = True
    np.not_equal(at[1:], at[:-1], out=new[1:])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(at)))
    often = counts > 1
    counts = counts[often].clip(max=MOST).astype(np.uint16)
    ends = np.append(0, np.cumsum(often))
    at = at[first]
    codes = ((at % BLOCK).astype(np.uint16) << np.uint16(1)) | often.astype(np.uint16)
    blocks = at // BLOCK
    starts = np.append(0, np.flatnonzero(np.diff(blocks)) + 1)
    lengths = np.diff(np.append(starts, len(at))).astype(np.uint32)
    blocks = blocks[starts].astype(np.uint32)
    cuts = np.append(0, np.flatnonzero(np.diff(blocks // blocks_each)) + 1)
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(blocks)).tolist()):
        begin, end = int(starts[a]), int(starts[b]) if b < len(starts) else len(at)
        yield (int(blocks[a]) // blocks_each, blocks[a:b].tobytes(), lengths[a:b].tobytes(), codes[begin:end].tobytes(),
               counts[ends[begin]:ends[end]].tobytes())


def repeated_keys(docs: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], cells: int,
                  depth: int = 1, crowd: int | None = None) -> Repeated:
    """Count the keys of all rows; ``keys_of`` yields arrays in which a document has a key once.

    With ``crowd``, cells that count as many are listed with their counts.
    """

    blocks_each = max(1, cells * depth // BLOCK // SECTIONS)
    sent = ["section", "blocks", "lengths", "codes"] + (["counts"] if crowd else [])
    most, kind = (MOST, np.uint16) if crowd else (2, np.uint8)

    @lean
    def touch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send(touched: list[np.ndarray]) -> pa.RecordBatch:
            section, *parts = zip(*_payloads(touched, blocks_each))
            return pa.record_batch([pa.array(section, pa.int64()), *[
                pa.array(p, pa.binary()) for p in parts[:len(sent) - 1]]], sent)

        touched, held = [], 0
        for batch in batches:
            for keys in keys_of(batch):
                for row in range(depth):
                    touched.append((_cell(keys, row, cells) + np.uint64(row * cells)).astype(np.uint32))
                    held += len(keys)
                if held >= FLUSH:
                    yield send(touched)
                    touched, held = [], 0
        if held:
            yield send(touched)

    @lean
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in zip(*batch.columns[1:]):
                blocks, lengths, codes, *several = (np.frombuffer(part.as_buffer(), as_) for part, as_ in zip(
                    row, (np.uint32, np.uint32, np.uint16, np.uint16)))
                seen = (codes & 1).astype(np.uint32) + 1
                if crowd:
                    seen[seen > 1] = several[0]
                cuts = np.cumsum(lengths[:-1], dtype=np.int64)
                for block, code, more in zip(blocks.tolist(), np.split(codes, cuts), np.split(seen, cuts)):
                    count = counts.setdefault(block, np.zeros(BLOCK, kind))
                    at = code >> 1
                    count[at] = np.minimum(count[at] + more, most)
        for block, count in counts.items():
            if (count >= 2).any():
                bits = np.packbits(count >= 2, bitorder="little").tobytes()
                listed = np.flatnonzero(count >= crowd) if crowd else np.zeros(0, np.int64)
                yield pa.record_batch([
                    pa.array([block], pa.int64()), pa.array([bits], pa.binary()),
                    pa.array([listed.astype(np.uint16).tobytes()], pa.binary()),
                    pa.array([count[listed].astype(np.uint16).tobytes()], pa.binary())],
                    ["block", "bits", "listed", "counts"])

    # written first: read straight to the driver, partitions would be merged one after another
    merged = materialize(docs.mapInArrow(touch, ", ".join(["section long", *[f"{c} binary" for c in sent[1:]]])).repartition(
        "section").mapInArrow(merge, "block long, bits binary, listed binary, counts binary"))
    bits = np.zeros(cells * depth // 8, np.uint8)  # as large as all that comes to the driver
    crowded, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint16)]
    for block, found, listed, listed_counts in merged.toLocalIterator(prefetchPartitions=True):
        bits[block * (BLOCK // 8):(block + 1) * (BLOCK // 8)] = np.frombuffer(found, np.uint8)
        if listed:
            crowded.append(np.frombuffer(listed, np.uint16).astype(np.uint32) + np.uint32(block * BLOCK))
            counts.append(np.frombuffer(listed_counts, np.uint16))
    places = np.concatenate(crowded)
    order = np.argsort(places)
    return Repeated(bits, cells, depth, places[order], np.concatenate(counts)[order])


def text_size(docs: DataFrame, text: str) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0]
