"""Bounded-space online packing of token ids into sequences of a fixed capacity.

Each task keeps at most ``open_windows`` windows.  A document goes to the window it fits best.  When none
fits, the fullest is sent out; if it lacks more than ``cut_gap`` ids, the document is cut to fill it first.
Else only documents longer than a window are cut.
What stays open at the end of the tasks is merged: pieces of a few neighbouring tasks meet and are
placed best-fit, longest first.  Nothing else is shuffled, and no task sees more than its own split or
the leftovers of ``MERGED`` tasks.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagrid.llm.tokens import CACHE, encoder, vocabulary_path
from stratagrid.scratch import materialize

CAPACITY, OPEN_WINDOWS, CUT_GAP, MERGED = 2048, 64, 32, 8
_TASK = 1 << 32  # sequence numbers of one task
_BATCH_ROWS, _BATCH_BYTES = 20_000, 1 << 23  # pieces that a task holds before it hands them on
_COLUMNS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class OpenWindows:
    """Windows that still take pieces, by the room they have left."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.rooms: list[tuple[int, int]] = []  # sorted (room, window)
        self.pieces: dict[int, list[tuple]] = {}
        self._next = 0

    def best(self, length: int) -> int | None:
        at = bisect_left(self.rooms, (length, -1))
        return at if at < len(self.rooms) else None

    def put(self, at: int | None, piece: tuple, length: int) -> list[tuple] | None:
        """Add a piece to the window at ``at`` (None: a new one); a window it fills is returned."""
        if at is None:
            room, window = self.capacity, self._next
            self._next += 1
            self.pieces[window] = []
        else:
            room, window = self.rooms.pop(at)
        self.pieces[window].append((*piece, self.capacity - room))
        if room == length:
            return self.pieces.pop(window)
        insort(self.rooms, (room - length, window))
        return None

    def pop_fullest(self) -> list[tuple]:
        return self.pieces.pop(self.rooms.pop(0)[1])

    @property
    def full(self) -> bool:
        return len(self.rooms) >= self.most


def place(pieces: Iterator[tuple], windows: OpenWindows, cut_gap: int) -> Iterator[list[tuple]]:
    """Place ``(doc_id, start, ids, doc_tokens)`` pieces online; yields the windows that close.

    In a window a piece is ``(doc_id, start, length, ids, doc_tokens, offset)``.
    """
    def piece(doc_id, start, ids, doc_tokens):
        return doc_id, start, len(ids) // 4, ids, doc_tokens

    for doc_id, start, ids, doc_tokens in pieces:
        at, total = 0, len(ids) // 4  # an offset moves on, so that a very long text is copied once
        while at < total:
            length = min(total - at, windows.capacity)
            spot = windows.best(length)
            if spot is None and windows.full:
                room = windows.rooms[0][0]  # of the fullest
                if room > cut_gap:
                    spot, length = 0, room  # filled by a cut, it goes out as full
                else:
                    yield windows.pop_fullest()
            closed = windows.put(spot, piece(doc_id, start + at, ids[4 * at:4 * (at + length)], doc_tokens), length)
            if closed:
                yield closed
            at += length


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
         end_id: int = 1, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS,
         cut_gap: int = CUT_GAP, cache: int = CACHE) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset, ids_crc32``.

    A document is its ids and ``end_id``; a null text is empty and has only that.  ``start`` counts the
    document's ids before the piece, ``offset`` the ids before it in its sequence, without gaps.
    ``ids`` are the piece's ids as little-endian 32-bit integers, ``ids_crc32`` is their checksum: the
    pieces of a ``sequence_id`` in order of ``offset`` are the sequence.  Every id lies in one piece;
    repeated rows and null ids are packed like any other.  Reruns over the same files agree.  Other
    columns are ignored.  A worker keeps the ids of at most ``cache`` chunks of text.
    """
    path = vocabulary_path(vocabulary)
    end = end_id.to_bytes(4, "little")

    def place_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, cache).encode
        windows = OpenWindows(capacity, open_windows)
        task = TaskContext.get().partitionId()

        def documents():
            for batch in batches:
                for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = encode(body.as_py() or "") + end
                    yield name, 0, ids, len(ids) // 4

        rows, held, sequence = [], 0, 0

        def closed(window: list[tuple], is_open: bool) -> None:
            nonlocal held, sequence
            held += 4 * sum(p[2] for p in window)
            rows.extend((*p[:5], task * _TASK + sequence, p[5], is_open, task // MERGED) for p in window)
            sequence += 1

        for window in place(documents(), windows, cut_gap):
            closed(window, False)
            if len(rows) >= _BATCH_ROWS or held >= _BATCH_BYTES:
                yield _batch(rows)
                rows.clear()
                held = 0
        while windows.rooms:
            closed(windows.pop_fullest(), True)
        if rows:
            yield _batch(rows)

    placed = materialize(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        place_split, _SCHEMA + ", open boolean, merge long"))

    def merge(key: tuple, left: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True], kind="stable")
        windows = OpenWindows(capacity, len(left) + 1)
        done = []
        for row in left[_COLUMNS[:5]].itertuples(index=False):
            closed = windows.put(windows.best(row.length), tuple(row), row.length)
            if closed:
                done.append(closed)
        done += list(windows.pieces.values())
        base = (1 << 62) + int(key[0]) * _TASK
        return pd.DataFrame([(*p[:5], base + n, p[5]) for n, window in enumerate(done) for p in window],
                            columns=_COLUMNS).astype({"doc_id": "Int64"})

    merged = placed.filter("open").groupBy("merge").applyInPandas(merge, _SCHEMA)
    pieces = placed.filter("not open").select(*_COLUMNS).unionByName(merged)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3 + [pa.bool_(), pa.int64()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], [*_COLUMNS, "open", "merge"])
