"""Boilerplate that many documents share goes to the end of op9's order."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stratagrid.llm import jaccard, sketch


def words(rng, n):
    return ["".join(rng.choices("abcdefghij", k=7)) for _ in range(n)]


def pairs_of_copies(rng, groups):
    """Two near copies a group; every text ends with the same passage of 40 words."""
    passage = words(rng, 40)
    rows = []
    for group in range(groups):
        body = words(rng, 120)
        rows.append((2 * group, " ".join(body + passage)))
        body[rng.randrange(120)] = "changed"
        rows.append((2 * group + 1, " ".join(body + passage)))
    return rows


def test_lists_of_near_copies_do_not_grow_with_shared_boilerplate(spark, monkeypatch):
    rows = pairs_of_copies(random.Random(5), 150)
    longest, led = [], jaccard._led

    def watched(lists, turn):
        longest.append(lists.groupBy("gram").count().agg(F.max("count")).first()[0])
        return led(lists, turn)

    monkeypatch.setattr(jaccard, "_led", watched)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in jaccard.similar_components(table).collect()}
    assert found == {i: i - i % 2 for i, _ in rows}
    assert longest[0] == 2  # each list holds the two copies of a group, none all 300 documents


def test_any_order_gives_the_same_components(spark):
    rng = random.Random(6)
    rows = pairs_of_copies(rng, 40)
    passage = rows[0][1].split()[-40:]
    rows += [(100 + i, " ".join(passage[:30 + i % 8])) for i in range(24)]  # boilerplate alone
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    expected = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((expected[i], expected[j]))
                expected = {k: a if v == b else v for k, v in expected.items()}
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for crowd in (2, 60_000):
        got = jaccard.similar_components(table, crowd=crowd).collect()
        assert {r.doc_id: r.component_id for r in got} == expected


def test_crowded_cells_carry_whole_counts(spark, monkeypatch):
    rng = random.Random(7)
    rows = [rng.choices(range(400), [1 + 4000 // (1 + k) for k in range(400)], k=30) for _ in range(500)]
    rows = [sorted(set(row)) for row in rows]
    true = Counter(k for row in rows for k in row)
    monkeypatch.setattr(sketch, "FLUSH", 100)  # so that a task sends many buffers

    def keys_of(batch: pa.RecordBatch):
        return (np.array(row, np.uint64) for row in batch.column(0).to_pylist())

    docs = spark.createDataFrame([(row,) for row in rows], "ids array<long>").repartition(4)
    found = sketch.repeated_keys(docs, keys_of, sketch.MIN_CELLS, crowd=20)
    keys = np.arange(400, dtype=np.uint64)
    cell = Counter()
    for k, at in zip(range(400), sketch._cell(keys, 0, sketch.MIN_CELLS).tolist()):
        cell[at] += true[k]
    of = [cell[at] for at in sketch._cell(keys, 0, sketch.MIN_CELLS).tolist()]
    assert found.crowd(keys).tolist() == [n if n >= 20 else 0 for n in of]
    assert found(keys).tolist() == [n >= 2 for n in of]
    assert any(n >= 20 for n in of) and any(2 <= n < 20 for n in of)


def test_the_list_of_crowded_cells_is_bounded():
    assert sketch.crowd_for(10) == sketch.CROWDED
    for keys in (1 << 27, 1 << 33, 1 << 35):
        assert keys / sketch.crowd_for(keys) <= sketch.MAX_CROWDED
