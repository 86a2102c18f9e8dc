"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, of labelled good text and of all raw text, give every document
a log importance weight, the sum of its n-grams' log probability ratios.  Documents are drawn without
replacement by Gumbel top-k: a hash of the document gives each weight its Gumbel noise and the k greatest
stay.  The raw counts cover every document; both models are vectors of ``FAMILIES * BUCKETS`` numbers.

A word (split at ASCII white space, A-Z lower-cased) gives three n-grams, each hashed into the buckets of
its family: the word, the word with the one before it, and the shapes of these two.  The shape of a word is
the kind of its first, second and last character, its length class, and whether it repeats the word before;
shapes carry quality over from one language and vocabulary to another, and the words tell what shapes
cannot.  A ratio is drawn towards one by ``PRIOR`` occurrences, so that words that only the few labelled
documents miss count for little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagrid.llm.carried import carry, given_back
from stratagrid.llm.lean import hand_back, lean
from stratagrid.llm.words import mix, slices, span_hashes, text_bytes, word_spans
from stratagrid.scratch import materialize

BUCKETS = 1 << 16  # of each family
FAMILIES = 3  # words, word bigrams, shape bigrams
MAX_LABELLED = 50_000  # good labelled documents that the target model is fitted on at most
PRIOR = 10.0  # occurrences by which both models agree on every bucket
SLACK = 6.0
PAGE = 1024
CELLS = 4096


_KIND = np.array([
    1 if 65 <= b < 91 else 2 if 48 <= b < 58 else 3 if b in b",;:" else 4 if b in b".?" else
    5 if 33 <= b < 128 and not chr(b).isalnum() else 0 for b in range(256)], np.uint32)
_LENGTH = np.array([0] * 3 + [1] * 3 + [2] * 4 + [3] * 6 + [4], np.uint32)
_START = np.uint32(0x1FFF)
_NO_WORD, _ODD = np.uint64(0x1FFF), np.uint64(0x9E3779B97F4A7C15)


def _before(values: np.ndarray, opens: np.ndarray, none: np.unsignedinteger) -> np.ndarray:
    """The value before each one in its row; ``none`` before the first."""
    before = np.empty_like(values)
    before[1:] = values[:-1]
    before[opens] = none
    return before


def _buckets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slice: its first row, the buckets of every word's n-grams (a row for each family), and the
    first word of every row."""
    for begin, end in slices(texts):
        data, offsets = text_bytes(texts.slice(begin, end - begin))
        starts, ends, first = word_spans(data, offsets)
        opens = first[:-1][first[:-1] < len(starts)]
        hashes = span_hashes(data, starts, ends, lower=True)
        before = _before(hashes, opens, _NO_WORD)
        shape = ((hashes == before).astype(np.uint32) | _KIND[data[starts]] << np.uint32(1)
                 | _KIND[data[np.minimum(starts + 1, ends - 1)]] << np.uint32(4) | _KIND[data[ends - 1]] << np.uint32(7)
                 | _LENGTH[np.minimum(ends - starts, len(_LENGTH) - 1)] << np.uint32(10))
        shapes = (_before(shape, opens, _START) << np.uint32(13) | shape) * np.uint32(2654435761)
        yield begin, np.stack([
            (hashes >> np.uint64(48)).astype(np.int64), (mix(hashes + before * _ODD) >> np.uint64(48)).astype(np.int64) + BUCKETS,
            (shapes >> np.uint32(16)).astype(np.int64) + 2 * BUCKETS]), first


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", max_labelled: int = MAX_LABELLED) -> np.ndarray:
    """Log probability ratio, target to raw, of every bucket of every family.

    The target is the text of at most ``max_labelled`` documents labelled 1, the least by hash of id.
    Without labelled or raw text all ratios are zero.
    """
    good = labels.filter(F.col(label) == 1).select(F.col(doc_id).cast("long").alias("id")).filter(
        "id is not null").distinct()
    chosen = np.sort(np.array([r[0] for r in good.orderBy(F.xxhash64("id"), "id").limit(max_labelled).collect()],
                              np.int64))

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(FAMILIES * BUCKETS, np.int64), np.zeros(FAMILIES * BUCKETS, np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            is_good = np.isin(ids, chosen)
            for begin, buckets, first in _buckets(batch.column(1)):
                raw += np.bincount(buckets.ravel(), minlength=len(raw))
                good_rows = is_good[begin:begin + len(first) - 1]
                if good_rows.any():
                    target += np.bincount(buckets[:, np.repeat(good_rows, np.diff(first))].ravel(), minlength=len(raw))
        pages = range(0, len(raw), PAGE)
        yield pa.record_batch([
            pa.array([p // PAGE for p in pages], pa.int32()), pa.array([raw[p:p + PAGE].tobytes() for p in pages]),
            pa.array([target[p:p + PAGE].tobytes() for p in pages])], ["page", "raw", "target"])

    @lean
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for page, raw, target in zip(*(c.to_pylist() for c in batch.columns)):
                both = np.stack([np.frombuffer(raw, np.int64), np.frombuffer(target, np.int64)])
                sums[page] = sums.get(page, 0) + both
        for page, both in sums.items():
            yield pa.record_batch([pa.array([page], pa.int32()), pa.array([both[0].tobytes()]),
                                   pa.array([both[1].tobytes()])], ["page", "raw", "target"])

    schema = "page int, raw binary, target binary"
    read = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    totals = np.zeros((2, FAMILIES * BUCKETS))
    for page, raw, target in read.mapInArrow(count, schema).repartition("page").mapInArrow(add, schema).collect():
        at = slice(page * PAGE, (page + 1) * PAGE)
        totals[0, at], totals[1, at] = np.frombuffer(raw, np.int64), np.frombuffer(target, np.int64)
    raw, target = totals
    if not raw.sum() or not target.sum():
        return np.zeros(FAMILIES * BUCKETS)
    # every word gives one n-gram of each family, so that the share of labelled text is one for all
    return np.log((target + PRIOR) / (raw * (target.sum() / raw.sum()) + PRIOR))


def log_weight(text: Column, ratios: np.ndarray) -> Column:
    """Log importance weight of a text; null for one without words."""

    @F.arrow_udf("double")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out = np.full(len(column), np.nan)
            for begin, buckets, first in _buckets(column):
                rows = np.flatnonzero(np.diff(first))
                if len(rows):  # each row summed on its own: the same in every batch
                    out[begin + rows] = np.add.reduceat(ratios[buckets].sum(axis=0), first[rows])
            yield pa.array(out)
            hand_back()

    return F.nullif(weigh(text), F.lit(float("nan")))


def gumbel(seed: int, *columns: Column) -> Column:
    """Gumbel noise from a hash of columns: the same row always draws the same."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def kth_greatest(keys: DataFrame, column: str, k: int) -> float:
    """The kth greatest value of a written table's column, by counting ever narrower ranges."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) / CELLS
        if low + width == low:
            break
        cell = F.least(F.floor((F.col(column) - low) / width), F.lit(CELLS - 1))
        rows = keys.filter(F.col(column).between(low, high)).groupBy(cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")
        ).orderBy(F.desc("cell")).collect()  # at most CELLS rows
        for row in rows:
            if row["n"] >= k:
                low, high = row["lo"], row["hi"]
                break
            k -= row["n"]
    return high if k <= 1 else low


def resample(docs: DataFrame, ratios: np.ndarray, doc_id: str = "doc_id", text: str = "text", k: int | None = None,
             slack: float = SLACK, seed: int = 11, with_numbers: bool = True) -> DataFrame:
    """The ``k`` documents drawn, with all columns of ``docs`` and ``log_weight`` and ``gumbel_key``.

    These two replace columns of their names; without ``with_numbers`` the result has the caller's
    columns alone.

    Without ``k``, as many are drawn as there are documents that the raw model explains at most
    ``exp(slack)`` times better than the target does.  A text without words, or null, has no weight and is never drawn.  Rows
    that tie with the kth all stay, so equal rows stay or go together.  An empty table gives an empty result.
    """
    rows = carry(docs, doc_id=F.col(doc_id), text=F.col(text))
    noise = gumbel(seed, F.col("doc_id").cast("string"), F.xxhash64("text"))
    keyed = rows.withColumn("log_weight", log_weight(F.col("text"), ratios)).withColumn(
        "gumbel_key", F.col("log_weight") + noise)
    numbers = ["log_weight", "gumbel_key"] if with_numbers else []
    columns = [*given_back(keyed, tuple(numbers)), *numbers]
    keys = materialize(keyed.select("log_weight", "gumbel_key").filter("gumbel_key is not null"))
    k = keys.filter(F.col("log_weight") >= -slack).count() if k is None else k
    if k <= 0:
        return keyed.limit(0).select(*columns)
    return keyed.filter(F.col("gumbel_key") >= F.lit(kth_greatest(keys, "gumbel_key", k))).select(*columns)
