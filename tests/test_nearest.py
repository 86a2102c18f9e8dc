import random

from pyspark.sql import functions as F

from stratagrid.operators import nearest


def brute(points, targets, k):
    out = set()
    for i, x, y in points:
        ranked = sorted((((x - nx) ** 2 + (y - ny) ** 2) ** 0.5, j) for j, nx, ny in targets)[:k]
        out |= {(i, j, round(d, 9), n + 1) for n, (d, j) in enumerate(ranked)}
    return out


def run(spark, points, targets, k, most=None):
    near = nearest.near_table(
        spark.createDataFrame(points, "in_id long, x double, y double"),
        spark.createDataFrame(targets, "near_id long, nx double, ny double"), k, most,
    )
    return {(r.in_id, r.near_id, round(r.near_dist, 9), r.near_rank) for r in near.collect()}


def test_near_table_equals_brute_force(spark):
    rng = random.Random(4)
    points = [(i, rng.randrange(200) + 0.5, rng.randrange(200) + 0.5) for i in range(150)]
    # a dense cluster and a few lone targets, so that points finish at different widths
    targets = [(1000 + i, rng.randrange(12) + 0.5, rng.randrange(12) + 0.5) for i in range(60)]
    targets += [(2000 + i, rng.randrange(200) + 0.5, rng.randrange(200) + 0.5) for i in range(15)]
    assert run(spark, points, targets, 5) == brute(points, targets, 5)
    assert run(spark, points, targets, 5, 6) == brute(points, targets, 5)


def test_fewer_targets_than_k(spark):
    points = [(1, 0.5, 0.5), (2, 90.5, 3.5)]
    targets = [(7, 50.5, 0.5), (8, 0.5, 0.5)]
    assert run(spark, points, targets, 5) == brute(points, targets, 5)


def test_many_targets_and_points_on_one_spot(spark):
    points = [(i, 10.5, 10.5) for i in range(200)] + [(500, 40.5, 3.5)]
    targets = [(j, 11.5, 10.5) for j in range(300)] + [(900, 30.5, 30.5)]
    assert run(spark, points, targets, 5) == brute(points, targets, 5)


def test_no_targets(spark):
    assert run(spark, [(1, 0.5, 0.5)], [], 5) == set()


def test_filter_by_zone_comes_after_the_cut(spark):
    # the only target of the own zone is the second nearest: with k = 1 it is lost
    points = spark.createDataFrame([(1, 0.0, 0.0, 7)], "pointid long, x double, y double, fzone long")
    targets = spark.createDataFrame([(10, 1.0, 0.0, 8), (11, 2.0, 0.0, 7)], "pointid long, x double, y double, fzone long")
    for k, expected in ((1, None), (2, 2.0)):
        near = nearest.near_table(
            points.select(F.col("pointid").alias("in_id"), "x", "y"),
            targets.select(F.col("pointid").alias("near_id"), F.col("x").alias("nx"), F.col("y").alias("ny")), k,
        )
        kept = nearest.same_zone(near, points, targets)
        assert nearest.with_near_distance(points, kept).first().near_dist == expected


def test_first_per_zone_takes_the_nearest_and_missing_last(spark):
    df = spark.createDataFrame(
        [(1, 5, None), (2, 5, 3.0), (3, 5, 2.0), (4, 6, None), (6, 6, None), (8, 7, 1.0), (7, 7, 1.0)],
        "pointid long, fzone long, near_dist double",
    )
    assert sorted((r.fzone, r.pointid) for r in nearest.first_per_zone(df).collect()) == [(5, 3), (6, 4), (7, 7)]


def test_lone_points_and_a_cluster_meet_few_targets(spark):
    """Lone points far from a dense cluster, points inside it, and points and targets without coordinates."""
    rng = random.Random(6)
    targets = [(j, 9000 + rng.random(), 9000 + rng.random()) for j in range(4000)]
    targets += [(5000 + j, 9000.25, 9000.25) for j in range(300)]
    points = [(i, rng.random() * 5000, rng.random() * 5000) for i in range(40)]
    points += [(100 + i, 9000 + rng.random(), 9000 + rng.random()) for i in range(200)]
    assert run(spark, points, targets, 5) == brute(points, targets, 5)
    points += [(900, None, 1.0)]
    targets += [(9999, 2.0, None)]
    pairs = nearest.candidates(
        spark.createDataFrame(points, "in_id long, x double, y double"),
        spark.createDataFrame(targets, "near_id long, nx double, ny double"), 5).groupBy("in_id").count().collect()
    assert len(pairs) == 240 and max(r["count"] for r in pairs) <= 80


def test_targets_on_a_circle(spark):
    """All are as near as the kth: nothing can be left out until cells are spots."""
    import math

    targets = [(j, 50 + 10 * math.cos(j), 50 + 10 * math.sin(j)) for j in range(150)]
    points = [(1, 50.0, 50.0), (2, 60.0, 50.0), (3, -5.0, 50.0)]
    got = run(spark, points, targets, 5)
    assert {r for r in got if r[0] != 1} == {r for r in brute(points, targets, 5) if r[0] != 1}
    assert sorted(r[2] for r in got if r[0] == 1) == [10.0] * 5
