"""Cost windows against Dijkstra, ledger and sheet round trips, joins and projections at hostile inputs."""

import heapq
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratagrid.functions.columns import lon_lat
from stratagrid.grid import DIRECTIONS
from stratagrid.operators import joins, kernels, ledger as led, nearest
from stratagrid.sources import tables

STRAIGHT, DIAGONAL = 10.0, 14.0


def dijkstra(height, start):
    cost = np.full(height.shape, np.inf)
    if np.isnan(height[start]):
        return cost
    cost[start] = 0.0
    queue = [(0.0, start)]
    while queue:
        c, (r, k) = heapq.heappop(queue)
        if c > cost[r, k]:
            continue
        for _, dc, dr in DIRECTIONS:
            y, x = r + dr, k + dc
            if 0 <= y < height.shape[0] and 0 <= x < height.shape[1] and not np.isnan(height[y, x]):
                via = c + (height[r, k] + height[y, x]) / 2 * (DIAGONAL if dc and dr else STRAIGHT)
                if via < cost[y, x]:
                    cost[y, x] = via
                    heapq.heappush(queue, (via, (y, x)))
    return cost


def heights(side, windows, seed):
    rng = np.random.RandomState(seed)
    height = rng.randint(1, 500, (windows, side, side)).astype(float)
    height[rng.rand(windows, side, side) < 0.1] = np.nan
    return height


@pytest.mark.parametrize("radius,windows", [(0, 2), (3, 3), (50, 1)])
def test_cost_surfaces_equal_dijkstra(radius, windows):
    height = heights(2 * radius + 1, windows, radius)
    centre = np.full(windows, radius)
    cost, back = kernels.cost_surfaces(height, (centre, centre), DIRECTIONS, STRAIGHT, DIAGONAL)
    steps = {code: (dr, dc) for code, dc, dr in DIRECTIONS}
    for w in range(windows):
        assert np.array_equal(cost[w], dijkstra(height[w], (radius, radius)))
        for r, c in np.argwhere(np.isfinite(cost[w])):
            if (r, c) == (radius, radius):
                assert back[w, r, c] == 0
            else:
                dr, dc = steps[back[w, r, c]]
                assert cost[w, r + dr, c + dc] < cost[w, r, c]


def test_targets_bound_the_search_and_keep_the_cheapest_exact():
    height = heights(101, 2, 7)
    centre = np.full(2, 50)
    target = np.random.RandomState(1).rand(*height.shape) < 0.002
    full, _ = kernels.cost_surfaces(height, (centre, centre), DIRECTIONS, STRAIGHT, DIAGONAL)
    cost, _ = kernels.cost_surfaces(height, (centre, centre), DIRECTIONS, STRAIGHT, DIAGONAL, target)
    for w in range(2):
        best = full[w][target[w]].min()
        exact = full[w] <= best
        assert np.array_equal(cost[w][exact], full[w][exact])
        assert np.isfinite(cost[w]).sum() < np.isfinite(full[w]).sum()


def test_one_window_of_the_full_radius():
    height = heights(801, 1, 3)
    centre = np.full(1, 400)
    begun = time.process_time()
    cost, _ = kernels.cost_surfaces(height, (centre, centre), DIRECTIONS, 1.0, math.sqrt(2))
    assert time.process_time() - begun < 15 and np.isfinite(cost).mean() > 0.85


def test_a_planned_batch_can_be_appended_and_planned_on(spark, tmp_path):
    path = str(tmp_path / "ledger")
    points = spark.createDataFrame([(i, i, i + 0.5, -0.5) for i in range(1, 21)],
                                   "id long, main_file_id long, x double, y double")
    tiles = spark.createDataFrame([("t", "a/t.tif", 0.0, 10.0, -5.0, 0.0)],
                                  "tilename string, ascii_path string, xmin double, xmax double, ymin double, ymax double")
    for batch in (1, 2):
        old = tables.read_ledger(spark, path)
        rows = led.next_batch(points, old, 5)
        planned = led.status_rows(rows, joins.locate(rows, tiles, 5.0), "store", "shade",
                                  added=F.lit("2024-01-02 03:04:05").cast("timestamp"))
        tables.append_ledger(planned, path)
        now = tables.read_ledger(spark, path)
        assert now.count() == 5 * batch and now.filter("added is null").isEmpty()
        assert [r[0] for r in now.select("main_file_id").orderBy("fid").collect()] == list(range(1, 5 * batch + 1))
    assert now.filter("ftp = 'Out of Bounds'").count() == 1


def test_a_sheet_is_read_by_name(spark, tmp_path):
    path = str(tmp_path / "sheet")
    spark.createDataFrame([(1.5, 2.5, 7)], "X double, Y double, Id long").write.csv(path, header=True)
    assert tuple(tables.read_sheet(spark, path, ("Id", "X", "Y")).first()) == (7, 1.5, 2.5)
    with pytest.raises(ValueError, match="lacks"):
        tables.read_sheet(spark, path, ("Id", "Z"))


def test_utm_meets_published_points(spark):
    for x, y, crs, lon, lat in ((630084.0, 4833438.0, 32617, -79.387139, 43.642566),
                                (500000.0, 0.0, 32633, 15.0, 0.0), (500000.0, 10_000_000.0, 32733, 15.0, 0.0)):
        got = spark.range(1).select(*lon_lat(F.lit(x), F.lit(y), crs)).first()
        assert got[0] == pytest.approx(lon, abs=2e-5) and got[1] == pytest.approx(lat, abs=2e-5)
    with pytest.raises(ValueError):
        lon_lat(F.lit(0), F.lit(0), 25832)


def test_near_table_in_degrees_does_not_meet_all_pairs(spark):
    rng = random.Random(4)
    spots = [(rng.uniform(7, 14), rng.uniform(47, 50)) for _ in range(600)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "in_id long, x double, y double")
    targets = spark.createDataFrame([(i, x + 0.01, y) for i, (x, y) in enumerate(spots)],
                                    "near_id long, nx double, ny double")
    met = spark.sparkContext.accumulator(0)
    plain = nearest.block_join

    def counted(*args, **kwargs):
        out = plain(*args, **kwargs)
        met.add(out.count())
        return out

    nearest.block_join = counted
    try:
        got = {(r.in_id, r.near_rank): r.near_id for r in nearest.near_table(points, targets, 3).collect()}
    finally:
        nearest.block_join = plain
    assert met.value < 600 * 600 / 4
    for i, (x, y) in enumerate(spots[:50]):
        best = sorted((math.hypot(x - a - 0.01, y - b), j) for j, (a, b) in enumerate(spots))[:3]
        assert [got[i, k] for k in (1, 2, 3)] == [j for _, j in best]


def test_a_long_road_is_cut_into_pieces(spark):
    road = spark.createDataFrame([(1, 0.0, 0.0, 4000.0, 4000.0, 2.0)],
                                 "road_id long, ax double, ay double, bx double, by double, half_width double")
    boxes = joins.road_boxes(road, 5.0)
    blocks = boxes.selectExpr("sum((floor(xmax/5)-floor(xmin/5)+1)*(floor(ymax/5)-floor(ymin/5)+1)) as n").first().n
    assert blocks < 12_000
    rng = random.Random(2)
    spots = [(i, d, d + rng.uniform(-6, 6)) for i, d in enumerate(rng.uniform(-5, 4005) for _ in range(300))]
    points = spark.createDataFrame(spots, "id long, x double, y double")

    def on(x, y):
        t = min(max((x + y) / 8000, 0), 1)
        return int(math.hypot(x - 4000 * t, y - 4000 * t) <= 2)

    got = {r.id: r.join_count for r in joins.join_count(points, road, 5.0).collect()}
    assert got == {i: on(x, y) for i, x, y in spots}
