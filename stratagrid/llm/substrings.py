"""Substring dedup: windows of words that an earlier document has too are removed.

1. Every window of ``width`` words is represented by its anchor, the least hash among its runs of
   ``width // 2`` words.  The same window has the same anchor wherever it stands, and neighbouring
   windows mostly share theirs, so a count-min sketch of anchors, merged from all partitions,
   overestimates the number of documents of every window from about a thirteenth of the keys.
2. The second pass groups exactly the windows estimated repeated, by anchor and window hash.  A
   partition first settles the windows that it holds more than once and sends each window once, with
   its least document; a group thus has at most one row from each partition, however often a passage
   occurs.  Windows of one anchor travel together as one row.
3. The removals come back to their documents by id and text hash, and the words are cut there; the
   texts of other documents are not shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagrid.llm import sketch
from stratagrid.llm.keyset import key_set
from stratagrid.llm.words import rolling, slices, text_bytes, window_min, word_hashes, word_spans
from stratagrid.scratch import HOT_KEYS, materialize

WIDTH = 50
HELD = 1 << 22  # windows that a task holds at most before it settles and sends them
ROWS = 50_000
CROWD = 1000  # windows from which on an anchor may count as hot
_NO_ID = np.iinfo(np.int64).max  # a null id comes after all others


def _windows(texts: pa.Array, width: int):
    """Per slice: window hashes, their anchors, and for each its row and first word."""
    half = width // 2
    for begin, end in slices(texts):
        hashes, first = word_hashes(texts.slice(begin, end - begin))
        if len(hashes) < width:
            continue
        anchors = window_min(rolling(hashes, half), width - half + 1)
        whole = rolling(hashes, width)
        counts = np.maximum(np.diff(first) - width + 1, 0)
        rows = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        places = np.repeat(first[:-1], counts) + at
        yield begin + rows, at, whole[places], anchors[places]


def _least(keys: np.ndarray, anchors: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every window: the least id that has it here."""
    order = np.lexsort((ids, keys, anchors))
    new = _changes(keys[order], anchors[order])
    group = np.cumsum(new) - 1
    least = np.empty(len(order), np.int64)
    least[order] = ids[order][new][group]
    return least


def _runs(ids, texts, at) -> tuple[np.ndarray, ...]:
    """Consecutive windows of a document as (id, text hash, first, number)."""
    order = np.lexsort((at, texts, ids))
    i, t, a = ids[order], texts[order], at[order]
    new = _changes(i, t)
    new[1:] |= a[1:] > a[:-1] + 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(order)) - 1
    return i[first], t[first], a[first], a[last] - a[first] + 1


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _local(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Settle what is held: later documents' windows are removals, the least document's travel on."""
    names = ["done", "anchor", "id", "text_hash", "start", "n", "windows"]
    ids, hashes, at, keys, anchors = (np.concatenate(x) for x in zip(*held))
    gone = ids > _least(keys, anchors, ids)
    if gone.any():
        runs = _run_batch(ids[gone], hashes[gone], at[gone])
        yield pa.record_batch([
            pa.array(np.ones(len(runs), bool)), pa.nulls(len(runs), pa.int64()), runs.column("id"),
            runs.column("text_hash"), runs.column("start"), runs.column("n"), pa.nulls(len(runs), pa.binary())], names)
    ids, hashes, at, keys, anchors = (x[~gone] for x in (ids, hashes, at, keys, anchors))
    order = np.lexsort((at, hashes, ids))
    ids, hashes, at, keys, anchors = (x[order] for x in (ids, hashes, at, keys, anchors))
    new = _changes(ids, hashes, anchors)
    new[1:] |= at[1:] != at[:-1] + 1
    begin = np.flatnonzero(new)
    cuts = np.append(begin, len(ids)) * 8
    data = pa.py_buffer(keys.tobytes())
    for a in range(0, len(begin), ROWS):
        some, bounds = begin[a:a + ROWS], cuts[a:a + ROWS + 1]
        windows = pa.Array.from_buffers(pa.binary(), len(some), [
            None, pa.py_buffer((bounds - bounds[0]).astype(np.int32).tobytes()),
            data.slice(int(bounds[0]), int(bounds[-1] - bounds[0]))])
        yield pa.record_batch([
            pa.array(np.zeros(len(some), bool)), pa.array(anchors[some].view(np.int64)), pa.array(ids[some]),
            pa.array(hashes[some]), pa.array(at[some].astype(np.int32)),
            pa.array((np.diff(bounds) // 8).astype(np.int32)), windows], names)


#: Runs of windows: ``done`` ones are removals, the others travel on with the hash of each window.
_SENT = "done boolean, anchor long, id long, text_hash long, start int, n int, windows binary"
#: A run of windows from ``start`` on, or one window (``windows`` holds its hash) and all its places in a text.
_OPEN = "anchor long, id long, text_hash long, start int, windows binary, places binary"
_RUN = "id long, text_hash long, start int, n int"


def _run_batch(ids, texts, at) -> pa.RecordBatch:
    i, t, a, n = _runs(ids, texts, at)
    return pa.record_batch([pa.array(i), pa.array(t), pa.array(a.astype(np.int32)), pa.array(n.astype(np.int32))],
                           ["id", "text_hash", "start", "n"])


def _removals(keyed: DataFrame, width: int, repeated) -> DataFrame:
    """``id, text_hash, start, n``: runs of windows that an earlier document has too."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        estimate = repeated.value
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            hashes = batch.column("text_hash").to_numpy(zero_copy_only=False)
            for rows, at, keys, anchors in _windows(batch.column("body"), width):
                new = _changes(anchors)
                some = np.repeat(estimate(anchors[new]), np.diff(np.append(np.flatnonzero(new), len(new))))
                if some.any():
                    held.append((ids[rows[some]], hashes[rows[some]], at[some], keys[some], anchors[some]))
                if sum(len(x[0]) for x in held) >= HELD:
                    yield from _local(held)
                    held = []
        if held:
            yield from _local(held)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            runs = batch.filter(batch.column("places").is_null())
            keys, counts, more = _unfolded(runs)
            spread = lambda c: np.repeat(runs.column(c).to_numpy(), counts)
            held.append((keys, spread("anchor"), spread("id"), spread("text_hash"), spread("start") + more))
            ones = batch.filter(batch.column("places").is_valid())
            places, times = _flat(ones.column("places"), np.int32)
            spread = lambda c: np.repeat(ones.column(c).to_numpy(), times)
            held.append((np.repeat(_flat(ones.column("windows"), np.uint64)[0], times), spread("anchor"), spread("id"),
                         spread("text_hash"), places))
        if not held:
            return
        keys, anchors, ids, hashes, at = (np.concatenate(x) for x in zip(*held))
        gone = ids > _least(keys, anchors, ids)
        if gone.any():
            yield _run_batch(ids[gone], hashes[gone], at[gone])

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts, more = _unfolded(batch)
            spread = lambda c: np.repeat(batch.column(c).to_numpy(), counts)
            ids, texts, anchors, at = spread("id"), spread("text_hash"), spread("anchor"), spread("start") + more
            # a text that repeats a window, thousands of times maybe, has one row for it
            order = np.lexsort((at, texts, ids, keys))
            begin = np.flatnonzero(_changes(keys[order], ids[order], texts[order]))
            first = order[begin]
            names = keys[first]
            yield pa.record_batch([
                pa.array(anchors[first]), pa.array(ids[first]), pa.array(texts[first]),
                pa.array(at[first].astype(np.int32)), _packed(names, np.arange(len(names) + 1)),
                _packed(at[order].astype(np.int32), np.append(begin, len(order))), pa.array(names.view(np.int64))],
                ["anchor", "id", "text_hash", "start", "windows", "places", "key"])

    sent = materialize(keyed.mapInArrow(send, _SENT))
    # what a task has settled itself needs no other task: neither one id nor rows without id gather
    known = sent.filter("done").select("id", "text_hash", "start", "n")
    open_ = sent.filter("not done")
    crowds = open_.groupBy("anchor").agg(F.sum("n").alias("windows"))
    total = open_.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # an anchor inside a very common passage also stands for the windows that reach beyond it: those
    # travel one by one.  At most HOT_KEYS anchors have more than that share of the windows
    hot = materialize(crowds.filter(F.col("windows") > max(CROWD, total // HOT_KEYS)).select(
        "anchor", F.lit(True).alias("hot")))
    marked = open_.join(F.broadcast(hot), "anchor", "left").withColumn("hot", F.col("hot").isNotNull())
    columns = ["anchor", "id", "text_hash", "start", "windows"]
    whole = marked.filter("not hot").select(*columns, F.lit(None).cast("binary").alias("places"), F.col("anchor").alias("key"))
    single = marked.filter("hot").select(*columns).mapInArrow(unfold, _OPEN + ", key long")
    settled = whole.unionByName(single).repartition("key").mapInArrow(settle, _RUN)
    return known.unionByName(settled)


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed arrays, and how many each row has."""
    packed = column.cast(pa.large_binary())
    ends = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset:packed.offset + len(packed) + 1]
    if not len(packed) or packed.buffers()[2] is None:
        return np.zeros(0, kind), np.zeros(len(packed), np.int64)
    width = np.dtype(kind).itemsize
    return np.frombuffer(packed.buffers()[2], np.uint8)[ends[0]:ends[-1]].copy().view(kind), np.diff(ends) // width


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """``values`` cut into rows of packed numbers."""
    offsets = pa.py_buffer((cuts * values.itemsize).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(values.tobytes())])


def _unfolded(sent: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window hashes of a batch of runs, the number in each run, and each one's place in its run."""
    keys, counts = _flat(sent.column("windows"), np.uint64)
    return keys, counts, np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)


def drop_repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                          cells: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_text``.

    A window is ``width`` consecutive words (split at ASCII white space, unchanged) of one document.  A
    word goes when a window covers it whose words also start in a document with a smaller id; windows
    are judged on the input.  A null id is greater than all others and equal to itself, so copies within
    one id stay.  A null text has no words; texts shorter than a window stay whole.  ``kept_text`` holds
    the kept words joined by one space.  Other columns are ignored.
    """
    keyed = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(int(_NO_ID))).alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )

    def anchors_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for rows, _, _, anchors in _windows(batch.column(0), width):
            new = _changes(rows, anchors)
            rows, anchors = rows[new], anchors[new]
            order = np.lexsort((anchors, rows))
            yield anchors[order][_changes(rows[order], anchors[order])]

    expected = sketch.text_size(docs, text) / 6 / (width / 4 + 1)  # about two anchors for width + 2 words
    repeated = sketch.repeated_keys(
        keyed.select("body"), anchors_of, cells or sketch.cells_for(4 * expected), depth=2)
    shared = docs.sparkSession.sparkContext.broadcast(repeated)  # at most 2 * MAX_CELLS bits
    runs = materialize(_removals(keyed, width, shared).groupBy(F.col("id").alias("i"), F.col("text_hash").alias("t")).agg(
        F.array_sort(F.collect_set(F.struct("start", "n"))).alias("runs")).select(
        "i", "t", F.xxhash64("i", "t").alias("key"), "runs"))
    # a bitmap of the documents that lose words keeps the texts of most others out of the shuffle
    marked = keyed.withColumn("cut", key_set(runs, "key").may_hold(F.xxhash64("id", "text_hash")))
    met = marked.filter("cut").join(runs, (F.col("id") == F.col("i")) & (F.col("text_hash") == F.col("t")), "left").select(
        "id", "body", F.col("runs.start").alias("starts"), F.col("runs.n").alias("lengths"))
    none = F.lit(None).cast("array<int>")
    joined = marked.filter("not cut").select("id", "body", none.alias("starts"), none.alias("lengths")).unionByName(met)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("body")):
                part = batch.slice(begin, end - begin)
                data, offsets = text_bytes(part.column("body"))
                starts, ends, first = word_spans(data, offsets)
                raw = data.tobytes()
                n_words, n_removed, kept = [], [], []
                for row, (at, n) in enumerate(zip(part.column("starts"), part.column("lengths"))):
                    a, b = first[row], first[row + 1]
                    stay = np.ones(b - a, bool)
                    if at.is_valid:
                        change = np.zeros(b - a + 1, np.int64)
                        s = np.asarray(at.as_py())
                        np.add.at(change, s, 1)
                        np.add.at(change, s + np.asarray(n.as_py()) + width - 1, -1)
                        stay = np.cumsum(change[:-1]) == 0
                    pieces = [raw[x:y] for x, y in zip(starts[a:b][stay].tolist(), ends[a:b][stay].tolist())]
                    n_words.append(int(b - a))
                    n_removed.append(int((~stay).sum()))
                    kept.append(b" ".join(pieces))
                yield pa.record_batch([
                    part.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ], ["id", "n_words", "n_removed", "kept_text"])

    out = joined.mapInArrow(cut, "id long, n_words long, n_removed long, kept_text string")
    return out.select(F.when(F.col("id") != int(_NO_ID), F.col("id")).alias("doc_id"), "n_words", "n_removed",
                      "kept_text")
