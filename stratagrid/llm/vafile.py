"""Exact top-k search over a vector-approximation file.

Vectors are stored in slices: cells of a coarse grid (``BITS`` bits, a byte, for a component) with the
grid's origin and step apart from the exact integers.  Equal vectors of a slice are one entry with the
ids that can matter.  A search takes three steps, queries in blocks:

1. The cells alone are scanned for lower bounds of every inner product.  The k greatest of each query,
   folded over all slices, bound its kth score from below.
2. The cells are scanned again for entries whose upper bound reaches that bound, for any query of a block.
3. Only those entries' exact vectors are read and sent to the block; there they are scored in order of
   their upper bounds until the kth score is certain.  Each part gives its k best, and the best of those
   are the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratagrid.scratch import materialize

SLICE, BLOCK, GROUP = 4096, 1024, 4
BITS = 8  # 4 bits leave a sixth of all given vectors to read for each query, 6 bits 0.1 %, 8 bits 0.01 %
TOGETHER = 256  # queries whose bounds with a slice are held at once
FOLDED = 256  # query blocks whose lower bounds a task folds before it sends them
LARGEST = 1 << 62  # scores beyond it do not fit 64 bits with room for their bounds: an error, never a cut
_CELLS = ["slice", "n", "dims", "ids", "ends", "cells", "origin", "step"]
_SLICES = ("slice long, n int, dims int, ids binary, ends binary, cells binary, origin binary, step binary, "
           "exact binary")
_ARROW = pa.schema([("slice", pa.int64()), ("n", pa.int32()), ("dims", pa.int32()),
                    *[(name, pa.binary()) for name in ("ids", "ends", "cells", "origin", "step", "exact")]])


def _vectors(batch: pa.RecordBatch, scale: float) -> tuple[list[int], list[np.ndarray]]:
    """Ids and integer vectors of the rows that take part."""
    ids, rows = [], []
    for name, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
        if name is None or not vector.is_valid:
            continue
        x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component becomes NaN
        if np.isfinite(x).all():
            ids.append(name)
            rows.append(np.floor(x * scale))
    return ids, rows


def _matrix(rows: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _entries(ids: list[int], matrix: np.ndarray, keep: int | None) -> tuple[np.ndarray, list[list[int]]]:
    """Distinct vectors, each with the rows that can be among a query's ``keep`` best.

    These are its ``keep + 1`` least ids (one may be the query's own), each ``keep`` times at most.
    Without ``keep`` every row is an entry of its own.
    """
    if keep is None:
        return matrix, [[name] for name in ids]
    holders: dict[bytes, list[int]] = {}
    for i, row in enumerate(matrix + 0.0):  # no negative zeros
        holders.setdefault(row.tobytes(), []).append(i)
    names = []
    for rows in holders.values():
        values, counts = np.unique([ids[i] for i in rows], return_counts=True)
        names.append(np.repeat(values[:keep + 1], np.minimum(counts[:keep + 1], keep)).tolist())
    return matrix[[rows[0] for rows in holders.values()]], names


def _row(number: int, entries: np.ndarray, names: list[list[int]], cells: np.ndarray, origin: bytes,
         step: bytes) -> dict:
    """A stored slice, or a part of one; integers of 32 bits where they fit."""
    width = np.int32 if np.abs(entries).max(initial=0) < 1 << 31 else np.int64
    return {"slice": number, "n": len(entries), "dims": entries.shape[1],
            "ids": np.array([i for some in names for i in some], np.int64).tobytes(),
            "ends": np.cumsum([len(some) for some in names], dtype=np.int32).tobytes(),
            "cells": cells.tobytes(), "origin": origin, "step": step, "exact": entries.astype(width).tobytes()}


def _store(vectors: DataFrame, rows_each: int, scale: float, keep: int | None) -> DataFrame:
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        ids, rows = [], []

        def close(some: int) -> pa.RecordBatch:
            nonlocal n, ids, rows
            matrix = _matrix(rows[:some])
            if np.abs(matrix).max(initial=0) >= 2.0 ** 53:
                raise ValueError("a component is too large to be scored exactly")
            entries, names = _entries(ids[:some], matrix, keep)
            low = entries.min(axis=0)
            step = np.floor((entries.max(axis=0) - low) / (1 << BITS)) + 1
            cells = ((entries - low) // step).astype(np.uint8)
            row = _row(task * (1 << 32) + n, entries, names, cells, low.tobytes(), step.tobytes())
            ids, rows, n = ids[some:], rows[some:], n + 1
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            more, vectors_ = _vectors(batch, scale)
            ids += more
            rows += vectors_
            while len(rows) >= rows_each:
                yield close(rows_each)
        if rows:
            yield close(len(rows))

    return vectors.mapInArrow(store, _SLICES)


def _exact(row: dict, prefix: str = "") -> np.ndarray:
    n, dims, held = row[prefix + "n"], row[prefix + "dims"], row[prefix + "exact"]
    width = np.int32 if len(held) == 4 * n * dims else np.int64
    return np.frombuffer(held, width).reshape(n, dims).astype(np.int64)


def _cells(row: dict) -> np.ndarray:
    return np.frombuffer(row["cells"], np.uint8).reshape(row["n"], row["dims"])


def _names(row: dict) -> list[np.ndarray]:
    return np.split(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["ends"], np.int32)[:-1])


class Bounds:
    """Bounds of twice the inner products of a block of queries with the entries of a slice."""

    def __init__(self, row: dict):
        self.query_ids, self.queries = np.frombuffer(row["q_ids"], np.int64), _exact(row, "q_")
        n, dims = row["n"], max(row["dims"], self.queries.shape[1])
        pad = lambda name, fill: np.pad(
            np.frombuffer(row[name]), (0, dims - row["dims"]), constant_values=fill)
        self.queries = np.pad(self.queries, ((0, 0), (0, dims - self.queries.shape[1])))
        cells = np.pad(_cells(row).astype(np.float64), ((0, 0), (0, dims - row["dims"])))
        self.step = pad("step", 1)
        # twice the cells' middles and radii are integers
        self.middle = 2 * pad("origin", 0) + (2 * cells + 1) * self.step - 1
        self.names = _names(row)
        # entries that one id holds alone are no candidates of that id
        self.lone = np.array([names[0] == names[-1] for names in self.names], bool)
        self.first = np.array([names[0] for names in self.names], np.int64)
        self.single = np.array([len(names) == 1 for names in self.names], bool)

    def parts(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Some queries' range, their lower and upper bounds, and which entries are their own alone."""
        for begin in range(0, len(self.queries), TOGETHER):
            size = np.abs(self.queries[begin:begin + TOGETHER]).astype(np.float64)
            estimate = self.queries[begin:begin + TOGETHER].astype(np.float64) @ self.middle.T
            reach = size @ np.abs(self.middle).max(axis=0, initial=0)
            if reach.max(initial=0) >= LARGEST:
                raise ValueError("vectors are too large to be scored exactly in 64 bits")
            # the slack covers the rounding of sums beyond 53 bits
            radius = size @ (self.step - 1) + reach * (len(self.step) + 4) * 2.0 ** -52
            own = self.lone & (self.first == self.query_ids[begin:begin + TOGETHER, None])
            yield begin, begin + len(size), estimate - radius[:, None], estimate + radius[:, None], own


def lower_bounds(row: dict, k: int) -> np.ndarray:
    """The k greatest lower bounds of each query in a slice (minus infinity where there are fewer)."""
    bounds = Bounds(row)
    out = np.full((len(bounds.queries), k), -np.inf)
    for begin, end, low, _, own in bounds.parts():
        low[own] = -np.inf
        take = min(k, low.shape[1])
        out[begin:end, :take] = np.partition(low, low.shape[1] - take, axis=1)[:, low.shape[1] - take:]
    return out


def _kth(row: dict) -> np.ndarray:
    """Each query's lower bound of its kth score, doubled."""
    out = np.full(row["q_n"], -np.inf)
    for q, bound in row["q_bounds"] or []:
        out[q] = bound
    return out


def wanted_entries(row: dict) -> np.ndarray:
    """Places of the entries that may be among the k best of some query of the block."""
    kth, wanted = _kth(row), np.zeros(row["n"], bool)
    for begin, end, _, upper, own in Bounds(row).parts():
        wanted |= ((upper >= kth[begin:end, None]) & ~own).any(axis=0)
    return np.flatnonzero(wanted).astype(np.int32)


def search_slice(row: dict, k: int) -> Iterator[tuple[int, int, int]]:
    """``(query index, vector id, score)`` of each query's k best in a slice (ties: the lesser id)."""
    bounds, exact, floors = Bounds(row), _exact(row), _kth(row)
    exact = np.pad(exact, ((0, 0), (0, bounds.queries.shape[1] - exact.shape[1])))
    for begin, end, _, uppers, own in bounds.parts():
        for q in range(begin, end):
            upper = uppers[q - begin]
            others = np.flatnonzero(~own[q - begin] & (upper >= floors[q]))
            others = others[np.argsort(-upper[others], kind="stable")]
            scores, names, kth, at = np.zeros(0, np.int64), np.zeros(0, np.int64), None, 0
            while at < len(others) and (kth is None or upper[others[at]] >= 2.0 * kth):
                some = others[at:at + 4 * k]
                at += 4 * k
                more, held = exact[some] @ bounds.queries[q], bounds.first[some]
                if not bounds.single[some].all():
                    each = [bounds.names[i][bounds.names[i] != bounds.query_ids[q]] for i in some]
                    more, held = np.repeat(more, [len(h) for h in each]), np.concatenate(each)
                scores, names = np.append(scores, more), np.append(names, held)
                best = np.lexsort((names, -scores))[:k]
                scores, names = scores[best], names[best]
                kth = scores[-1] if len(scores) == k else None
            for name, score in zip(names.tolist(), scores.tolist()):
                yield q, name, score


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


def top_k(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5,
          every: int = 50, scale: float = 256.0) -> DataFrame:
    """Each query's k highest inner products: ``query_id, rank, vec_id, score``.

    Components become ``floor(scale * x)``; queries are the rows whose id ``every`` divides, candidates
    all rows of another id; ties go to the lesser id.  A vector that is null or holds a null or
    non-finite component takes no part, nor does a row without an id.  A shorter vector counts as
    padded with zeros.  A row that repeats an id is a candidate, and a query, of its own.  Vectors so large
    that twice a score might not fit 64 bits raise an error.  An empty table gives no rows; other columns
    are ignored.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    slices = materialize(_store(rows, SLICE, scale, k))
    blocks = materialize(_store(rows.filter(F.col("id") % every == 0), BLOCK, scale, None).select(
        *[F.col(c).alias(f"q_{c}") for c in ("slice", "n", "dims", "ids", "exact")]))
    found = materialize(_wanted(slices.select(*_CELLS), blocks, k))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            at, names = np.frombuffer(row["wanted"], np.int32), _names(row)
            part = _row(row["slice"], _exact(row)[at], [names[i].tolist() for i in at],
                        _cells(row)[at], row["origin"], row["step"])
            yield pa.RecordBatch.from_pylist([{**part, "q_slice": row["q_slice"], "q_bounds": row["q_bounds"]}],
                                             schema=_ARROW.append(pa.field("q_slice", pa.int64())).append(
                pa.field("q_bounds", pa.list_(pa.struct([("q", pa.int32()), ("bound", pa.float64())])))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            best = list(search_slice({**row, "q_bounds": [b.values() for b in row["q_bounds"] or []]}, k))
            names = np.frombuffer(row["q_ids"], np.int64)
            yield pa.record_batch([
                pa.array([row["q_slice"]] * len(best), pa.int64()), pa.array([f[0] for f in best], pa.int32()),
                pa.array([names[f[0]] for f in best], pa.int64()), pa.array([f[1] for f in best], pa.int64()),
                pa.array([f[2] for f in best], pa.int64())], ["q_slice", "q", "query_id", "vec_id", "score"])

    # exact vectors meet their own slice's wanted places; only what is wanted goes on to the queries
    parts = slices.join(found, "slice").mapInArrow(
        gather, f"{_SLICES}, q_slice long, q_bounds array<struct<q: int, bound: double>>")
    best = parts.join(blocks, "q_slice").mapInArrow(
        search, "q_slice long, q int, query_id long, vec_id long, score long")
    order = Window.partitionBy("q_slice", "q").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _wanted(cells: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Per slice and block with any: ``slice, q_slice, q_bounds, wanted``, the places to read exactly."""
    # block numbers from 0; only the numbers pass through the window
    numbers = materialize(blocks.select("q_slice").withColumn(
        "turn", F.row_number().over(Window.orderBy("q_slice")).cast("long") - 1))
    turns, groups = numbers.count(), max(1, cells.count() // GROUP)
    every_turn = F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))
    every_group = F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))
    spread = cells.withColumn("group", F.pmod(F.xxhash64("slice"), F.lit(groups))).withColumn(
        "turn", F.explode(every_turn if turns else F.array().cast("array<bigint>")))
    # a stated query set against all rows, in blocks: each group of slices meets each block of queries
    asked = blocks.join(numbers, "q_slice").withColumn("group", F.explode(every_group))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded: dict[int, np.ndarray] = {}

        def send() -> Iterator[pa.RecordBatch]:
            for block, low in folded.items():
                q, _ = kept = np.nonzero(np.isfinite(low))
                yield pa.record_batch([pa.array(np.full(len(q), block, np.int64)), pa.array(q.astype(np.int32)),
                                       pa.array(low[kept])], ["q_slice", "q", "low"])
            folded.clear()

        for row in _rows(batches):
            low, block = lower_bounds(row, k), row["q_slice"]
            folded[block] = low if block not in folded else np.partition(
                np.concatenate([folded[block], low], axis=1), k, axis=1)[:, k:]
            if len(folded) >= FOLDED:
                yield from send()
        yield from send()

    def want(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            at = wanted_entries({**row, "q_bounds": [b.values() for b in row["q_bounds"] or []]})
            if len(at):
                yield pa.record_batch([pa.array([row["slice"]], pa.int64()), pa.array([row["q_slice"]], pa.int64()),
                                       pa.array([at.tobytes()], pa.binary())], ["slice", "q_slice", "wanted"])

    lows = spread.join(asked, ["group", "turn"]).mapInArrow(bound, "q_slice long, q int, low double")
    ranked = lows.withColumn("turn", F.row_number().over(
        Window.partitionBy("q_slice", "q").orderBy(F.col("low").desc()))).filter(F.col("turn") <= k)
    kth = ranked.groupBy("q_slice", "q").agg(F.min("low").alias("bound"), F.count(F.lit(1)).alias("m")).filter(
        F.col("m") == k)
    bounds = materialize(kth.groupBy("q_slice").agg(F.collect_list(F.struct("q", "bound")).alias("q_bounds")))
    bounded = asked.join(bounds, "q_slice", "left")
    places = spread.join(bounded, ["group", "turn"]).mapInArrow(want, "slice long, q_slice long, wanted binary")
    return places.join(bounds, "q_slice", "left")
