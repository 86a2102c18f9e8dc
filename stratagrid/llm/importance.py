"""Importance resampling towards a target text, drawn by a distributed quickselect.

Features are the runs of one to three words, hashed by CRC-32 into ``BUCKETS`` buckets: the checksum of
a run goes on from that of the run without its last word, so no run is ever joined.  Two counts over all
texts give every bucket its gain, an array that scores whole documents.  The draw never sorts the corpus:
random pivot keys and exact counts before, at and after each narrow the range that holds the kth key, and
only the winners are sorted and ranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratagrid.llm.byteterms import LETTERS_DIGITS, words
from stratagrid.scratch import materialize

BUCKETS, LONGEST = 10_000, 3
MIN_WORDS, PERCENT, SEED = 20, 5, 42
PIVOTS, SLOTS = 32, 16
KEY = ["score", "doc_id", "row"]


def buckets(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Per stretch of a text: its number of words and the buckets of the runs that end in it."""
    ones, twos = [], []  # checksums of the last word and the last two words of the stretch before
    for stretch in words(text, LETTERS_DIGITS):
        if not stretch:
            continue
        spaced = list(map(b" ".__add__, stretch))
        single = list(map(crc32, stretch))
        double = list(map(crc32, spaced[1 - len(ones):], ones + single))
        triple = list(map(crc32, spaced[2 - len(ones) - len(twos):], twos + double))
        yield len(stretch), np.array(single + double + triple, np.int64) % BUCKETS
        ones, twos = single[-1:], double[-1:] or twos


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Features of all texts by bucket; a null text has none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for body in batch.column(0):
                for _, found in buckets(body.as_py() or b""):
                    total += np.bincount(found, minlength=BUCKETS)
        slot = TaskContext.get().partitionId() % SLOTS
        yield pa.record_batch([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                              ["slot", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for counts in batch.column(1):
                total += np.frombuffer(counts.as_buffer(), np.int64)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["counts"])

    vectors = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(count, "slot int, counts binary")
    summed = vectors.repartition(SLOTS, "slot").mapInArrow(add, "counts binary")
    # one vector a slot comes to the driver, however many tasks there were
    return sum((np.frombuffer(row["counts"], np.int64) for row in summed.collect()), np.zeros(BUCKETS, np.int64))


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed bucket shares, target to raw, rounded down."""
    all_raw, all_target = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * all_raw / ((float(s) + 1) * all_target)))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, row, n_words, n_features, weight, score`` of every document, and the columns to ``keep``.

    ``weight`` sums the gains of all features; ``score`` adds Gumbel noise drawn from a hash of ``seed``
    and the id (of ``seed`` alone for a null id).  ``row`` tells repeated rows apart.  The result is a
    written table.
    """

    @F.arrow_udf("n_words long, n_features long, weight long")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out = np.zeros((3, len(column)), np.int64)
            for i, body in enumerate(column):
                for n, found in buckets(body.as_py() or b""):
                    out[0, i] += n
                    out[1, i] += len(found)
                    out[2, i] += gain[found].sum()
            yield pa.StructArray.from_arrays([pa.array(line) for line in out], ["n_words", "n_features", "weight"])

    own = [F.col(f"`{c}`") for c in keep if c not in ("doc_id", "row", "measures")]
    measured = docs.select(F.col(doc_id).alias("doc_id"), *own, measure(F.col(text).cast("binary")).alias("measures"))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    return materialize(measured.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), "measures.*",
        (F.col("measures.weight") + noise).alias("score"), *[F.col(f"`{c}`") for c in keep
                                                             if c not in ("doc_id", "row", "measures")]))


def _key(score: Column, doc_id: Column, row: Column) -> Column:
    """Greater scores first, then lesser ids, null ids last; ``row`` makes every key differ."""
    return F.struct((-score).alias("s"), doc_id.isNull().alias("m"), doc_id.alias("d"), row.alias("r"))


def kth_key(rows: DataFrame, k: int) -> Column:
    """Key of the ``k``-th row of a written table in the order of the draw; ``1 <= k <= rows``.

    Each round picks at most ``PIVOTS`` random rows of the range that still holds the key and counts
    exactly how many of its rows come before and at each of them.
    """
    kind = rows.schema["doc_id"].dataType
    key = _key(*map(F.col, KEY))
    inside, turn = rows, 0
    while True:
        turn += 1
        picked = inside.orderBy(F.xxhash64("row", F.lit(turn)), "row").limit(PIVOTS).select(*KEY).collect()
        pivots = [(p["score"], _key(F.lit(p["score"]), F.lit(p["doc_id"]).cast(kind), F.lit(p["row"])))
                  for p in sorted(picked, key=lambda p: (-p["score"], p["doc_id"] is None, p["doc_id"], p["row"]))]
        counted = inside.agg(*[c for i, (_, pivot) in enumerate(pivots) for c in (
            F.count_if(key < pivot).alias(f"before{i}"), F.count_if(key == pivot).alias(f"at{i}"))]).first()
        high = next((i for i in range(len(pivots)) if counted[f"before{i}"] + counted[f"at{i}"] >= k), None)
        if high is not None and counted[f"before{high}"] < k:
            return pivots[high][1]
        low = (len(pivots) if high is None else high) - 1
        if high is not None:  # the plain filters on the score reach the scan
            inside = inside.filter((F.col("score") >= pivots[high][0]) & (key < pivots[high][1]))
        if low >= 0:
            inside = inside.filter((F.col("score") <= pivots[low][0]) & (key > pivots[low][1]))
            k -= counted[f"before{low}"] + counted[f"at{low}"]


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` from 1 in the order of the draw, sorted in many tasks."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    placed = materialize(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a sorted partition
    bases = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    in_part = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return placed.withColumn("in_part", in_part).join(bases, "part").withColumn(
        "rank", F.col("base") + F.col("in_part")).drop("part", "in_part", "base")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text", min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
             keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document, and the columns to ``keep``.

    Of the documents with at least ``min_words`` words, ``percent`` in a hundred (rounded down) are drawn,
    the greatest scores first, ties to the lesser id, null ids last; ``rank`` is null for the others.
    Rows that repeat an id and score are drawn one by one.  A null or empty text has no feature and weight 0.  An empty
    table gives an empty result, an empty target makes every bucket's gain that of no target text.
    Columns not kept are ignored; a kept column named like a result is replaced by the result.
    """
    results = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    keep = tuple(c for c in keep if c not in results)
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    scored = weigh(docs, gain, doc_id, text, seed, keep)
    columns = results + [c for c in keep if c not in ("row", "measures")]
    able = scored.filter(F.col("n_words") >= min_words)
    k = able.count() * percent // 100
    undrawn = F.lit(None).cast("long").alias("rank")
    if k == 0:
        return scored.select("*", undrawn).select(*columns)
    last = kth_key(able, k)
    key = _key(*map(F.col, KEY))
    is_drawn = (F.col("n_words") >= min_words) & (key <= last)
    rest = scored.filter(~is_drawn).select("*", undrawn)
    return ranked(scored.filter(is_drawn)).select(*columns).unionByName(rest.select(*columns))
