import pytest
from pyspark.sql import functions as F

from stratagrid import scratch
from stratagrid.operators import graph


def test_scratch_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = scratch.scratch_dir(spark)
    assert configured is None or folder == configured.rstrip("/")
    table = scratch.materialize(spark.range(5))
    assert folder in table.inputFiles()[0] and table.count() == 5


def test_rounds_delete_what_they_replace(spark, tmp_path):
    rounds = scratch.Rounds(spark)
    first = rounds.put("t", spark.range(3), watch="id > 0")
    assert rounds.seen == 2
    second = rounds.put("t", first.filter("id > 1"))
    rounds.sweep()
    assert second.count() == 1 and rounds.seen == 1
    with pytest.raises(Exception):
        first.count()


def test_lookup_of_a_hot_key_loses_and_repeats_nothing(spark):
    left = spark.range(9000).select("id", F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("key"))
    right = spark.range(0, 9000, 2).select(F.col("id").alias("key"), (F.col("id") * 10).alias("v"))
    right = right.union(spark.sql("select 7L, 70L"))
    for how in ("inner", "left"):
        plain = left.join(right, "key", how).select("id", "key", "v")
        salted = scratch.lookup(left, right, "key", "id", how).select("id", "key", "v")
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_only_counted_hot_keys_are_salted(spark):
    left = spark.range(9000).select("id", F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("key"))
    assert scratch.hot_keys(left, ["key"]) is None  # small: no job, no copies
    scratch.HOT_KEYS, before = 90, scratch.HOT_KEYS
    try:
        hot = scratch.hot_keys(left, ["key"], task_bytes=0)
        assert [tuple(r) for r in hot.collect()] == [(7, 30 + 1)] or [r["key"] for r in hot.collect()] == [7]
        right = spark.range(0, 9000, 2).select(F.col("id").alias("key"), (F.col("id") * 10).alias("v"))
        right = right.union(spark.sql("select 7L, 70L"))
        for how in ("inner", "left"):
            plain = left.join(right, "key", how).select("id", "key", "v")
            dealt = scratch.lookup(left, right, "key", "id", how, task_bytes=0).select("id", "key", "v")
            assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
        _, copies = scratch.salted(left, right, ["key"], hot, ["id"])
        assert copies.filter("key <> 7").count() == right.count() - 1  # nothing else is copied
    finally:
        scratch.HOT_KEYS = before


def test_clean_removes_written_tables(spark):
    table = scratch.materialize(spark.range(5))
    scratch.clean(spark)
    with pytest.raises(Exception):
        table.count()


def test_resolve_follows_long_chains_and_stars(spark):
    n = 500
    chain = spark.range(n).select(F.col("id").alias("node"), F.greatest(F.col("id") - 1, F.lit(0)).alias("root"))
    star = spark.range(1000, 2000).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("root"))
    out = graph.resolve(chain.union(star), scratch.Rounds(spark))
    assert out.count() == n + 1000 and out.filter("root <> 0").isEmpty()


def test_connect_finds_components(spark):
    path = spark.range(1, 300).select((F.col("id") * 37 % 300).alias("a"), ((F.col("id") + 1) * 37 % 300).alias("b"))
    star = spark.range(401, 500).select(F.lit(400).cast("long").alias("a"), F.col("id").alias("b"))
    out = {r.node: r.root for r in graph.connect(path.union(star), scratch.Rounds(spark)).collect()}
    assert {out[n] for n in range(400, 500)} == {400}
    assert len({out[n] for n in range(300)}) == 1


def test_subtree_sums(spark):
    nodes = spark.createDataFrame(
        [(1, 2, 1), (2, 3, 10), (3, None, 100), (4, 3, 1000), (5, 1, 5)], "node long, next long, weight long"
    )
    out = {r.node: r.total for r in graph.subtree_sums(nodes, scratch.Rounds(spark)).collect()}
    assert out == {5: 5, 1: 6, 2: 16, 4: 1000, 3: 1116}


def test_spill_levels_are_minimax_paths(spark):
    import itertools
    import random

    rng = random.Random(6)
    n, outside = 40, -1
    edges = {tuple(sorted(rng.sample(range(n), 2))): rng.randrange(20) for _ in range(120)}
    edges |= {(outside, b): rng.randrange(20) for b in rng.sample(range(n), 4)}
    edges |= {(i, i + 1): edges.get((i, i + 1), 19) for i in range(n - 1)}
    level = dict.fromkeys(range(n), 10 ** 9) | {outside: -1}
    for _, ((a, b), w) in itertools.product(range(n), edges.items()):
        for x, y in ((a, b), (b, a)):
            if y != outside:
                level[y] = min(level[y], max(w, level[x]))
    df = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "a long, b long, w long")
    got = {r.node: r.level for r in graph.spill_levels(df, outside, scratch.Rounds(spark)).collect()}
    assert got == {k: v for k, v in level.items() if k != outside}
