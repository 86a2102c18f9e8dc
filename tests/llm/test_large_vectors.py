"""Exact top-k against brute force: large components, copies, repeated ids, and one bound over all slices."""

import math
import random

import pytest

from stratagrid.llm import vafile

TYPE = "vec_id long, embedding array<double>"


def brute(rows, every, k=5):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    out = []
    for i, q in whole:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), c) for c, v in whole if c != i)
            out += [(i, n + 1, c, -s) for n, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def searched(spark, rows, every, parts=3):
    return sorted(tuple(r) for r in vafile.top_k(
        spark.createDataFrame(rows, TYPE).repartition(parts), every=every).collect())


def test_large_components(spark):
    rng = random.Random(3)
    rows = [(0, [1.0, 0.0]), (1, [4096.5, 0.0]), (2, [9000.0, 0.0])]
    rows += [(i, [rng.choice([1, -1]) * 10 ** rng.uniform(3.6, 6) for _ in range(2)]) for i in range(3, 300)]
    assert searched(spark, rows, 50) == brute(rows, 50)


def test_vectors_beyond_64_bits_raise(spark):
    rows = spark.createDataFrame([(0, [1e9]), (1, [1e9])], TYPE)
    with pytest.raises(Exception, match="too large"):
        vafile.top_k(rows).collect()


def test_copies_repeated_ids_and_ragged_vectors(spark, monkeypatch):
    monkeypatch.setattr(vafile, "SLICE", 64)
    monkeypatch.setattr(vafile, "BLOCK", 8)
    rng = random.Random(5)
    rows = [(i, [0.5, -0.25, 0.5] if i % 3 == 0 else [rng.uniform(-0.6, 0.6) for _ in range(rng.choice([2, 3, 3]))])
            for i in range(600)]
    rows += [(0, [0.5, -0.25, 0.5])] * 20 + [(3, [0.5, -0.25, 0.5])] * 9 + [(50, [0.0, 0.1])] * 3 + [(7, [])]
    rng.shuffle(rows)
    assert searched(spark, rows, 50) == brute(rows, 50)


def test_the_bound_over_all_slices_leaves_few_vectors_to_read(spark, monkeypatch):
    monkeypatch.setattr(vafile, "SLICE", 250)
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.1) for _ in range(16)]) for i in range(5000)]
    rows += [(5000 + i, [x * 10 for x in rows[100 * i][1]]) for i in range(40)]
    table = spark.createDataFrame(rows, TYPE).repartition(4)
    assert sorted(tuple(r) for r in vafile.top_k(table, every=1000).collect()) == brute(rows, 1000)
    slices = vafile._store(table, 250, 256.0, 5).persist()
    blocks = vafile._store(table.filter("vec_id % 1000 = 0"), 1024, 256.0, None).selectExpr(
        *[f"{c} as q_{c}" for c in ("slice", "n", "dims", "ids", "exact")])
    found = vafile._wanted(slices.select(*vafile._CELLS), blocks, 5).collect()
    read = sum(len(r.wanted) // 4 for r in found)
    # each slice by itself would read at least its five best for each of the six queries
    assert 5 <= read < 5 * 20 * 6 / 2, read
