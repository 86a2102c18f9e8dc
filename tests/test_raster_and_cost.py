import heapq
import math

import numpy as np
import pytest
from conftest import D8, as_map, cells_of, grid_for
from pyspark.sql import functions as F

from stratagrid.operators import cost, raster
from stratagrid.plans import sinks


def shade(array, r, c, cell):
    """Trigonometric form of the shade, sun at 315 / 45 degrees."""
    def z(dr, dc):
        rr, cc = r + dr, c + dc
        inside = 0 <= rr < array.shape[0] and 0 <= cc < array.shape[1]
        return array[rr, cc] if inside and not np.isnan(array[rr, cc]) else array[r, c]

    p = ((z(-1, 1) + 2 * z(0, 1) + z(1, 1)) - (z(-1, -1) + 2 * z(0, -1) + z(1, -1))) / (8 * cell)
    q = ((z(1, -1) + 2 * z(1, 0) + z(1, 1)) - (z(-1, -1) + 2 * z(-1, 0) + z(-1, 1))) / (8 * cell)
    zenith, azimuth = math.radians(45), math.radians(360 - 315 + 90)
    slope, aspect = math.atan(math.hypot(p, q)), math.atan2(q, -p)
    value = 255 * (math.cos(zenith) * math.cos(slope) + math.sin(zenith) * math.sin(slope) * math.cos(azimuth - aspect))
    return max(0.0, value)


def test_hillshade_equals_the_trigonometric_form(spark):
    array = np.random.default_rng(0).integers(0, 9, (9, 11)).astype(float)
    array[4, 5] = np.nan
    got = as_map(raster.hillshade(cells_of(spark, array), grid_for(array, cell=2.0)), "gridcode")
    expected = {
        (c, r): math.floor(round(shade(array, r, c, 2.0), 6))
        for r in range(9) for c in range(11) if not np.isnan(array[r, c])
    }
    assert got == expected


def test_near_cells_keeps_whole_blocks_round_points(spark):
    array = np.ones((40, 40))
    grid = grid_for(array, block=8)
    points = spark.createDataFrame([(1, 4.0, -4.0), (2, 100.0, 5.0)], "id long, x double, y double")
    kept = {(r.col, r.row) for r in raster.near_cells(cells_of(spark, array), points, 5.0, grid).collect()}
    assert {(c, r) for c in range(10) for r in range(10)} <= kept
    assert (20, 20) not in kept


def test_zonal_operators(spark):
    z = spark.createDataFrame(
        [(c, 0, c % 2, v) for c, v in enumerate([5, 1, 9, 1, 9, 4])], "col long, row long, zone long, z long"
    )
    grid = grid_for(np.zeros((1, 6)), cell=3.0)
    table = {r.zone: tuple(r)[1:] for r in raster.zonal_table(z, "z", grid).collect()}
    assert table == {0: (3, 27.0, 5, 9, 4), 1: (3, 27.0, 1, 4, 3)}
    assert sorted(r.col for r in raster.extreme_cells(z, "z", highest=True).collect()) == [2, 4, 5]
    assert sorted(r.col for r in raster.extreme_cells(z, "z", highest=False).collect()) == [0, 1, 3]
    assert raster.large_zones(z.filter("col < 5"), 2).select("zone").distinct().collect()[0].zone == 0


def test_map_algebra_and_points(spark):
    a = cells_of(spark, np.array([[1, 2, np.nan]]))
    b = cells_of(spark, np.array([[5, 2, 7]]), "f")
    diff = as_map(raster.combine(b, a, "d", F.col("f") - F.col("z")), "d")
    assert diff == {(0, 0): 4, (1, 0): 0}
    grid = grid_for(np.zeros((1, 3)), cell=2.0, x0=10.0, y0=20.0)
    p = raster.raster_points(a, grid, "z").orderBy("pointid").collect()
    assert [tuple(r) for r in p] == [(0, 11.0, 19.0, 1), (1, 13.0, 19.0, 2)]
    at = spark.createDataFrame([(1, 12.5, 18.5), (2, 15.0, 19.0), (3, 99.0, 19.0)], "id long, x double, y double")
    assert [(r.id, r.z) for r in raster.cell_value_at(at, a, grid).collect()] == [(1, 2)]


def dijkstra(array, start, straight, diagonal):
    best, heap = {}, [(0.0, start)]
    if not array[start[1], start[0]] > 0:
        return best
    while heap:
        k, (c, r) = heapq.heappop(heap)
        if (c, r) in best:
            continue
        best[c, r] = k
        for _, dc, dr in D8:
            n = (c + dc, r + dr)
            if 0 <= n[0] < array.shape[1] and 0 <= n[1] < array.shape[0] and array[n[1], n[0]] > 0:
                step = (array[r, c] + array[n[1], n[0]]) / 2 * (diagonal if dc and dr else straight)
                heapq.heappush(heap, (k + step, n))
    return best


def windows_of(spark, array, starts, half):
    rows = [
        (i, c0, r0, c, r, int(array[r, c]))
        for i, (c0, r0) in enumerate(starts)
        for r in range(max(0, r0 - half), min(array.shape[0], r0 + half + 1))
        for c in range(max(0, c0 - half), min(array.shape[1], c0 + half + 1))
    ]
    return spark.createDataFrame(rows, "id long, start_col long, start_row long, col long, row long, z long")


@pytest.mark.parametrize("weights", [(10.0, 14.0), (1.0, math.sqrt(2.0))])
def test_costs_and_paths_equal_dijkstra(spark, weights):
    array = np.random.default_rng(7).integers(0, 30, (20, 24)).astype(float)  # zeros are closed
    starts, half = [(3, 3), (12, 10), (0, 19), (23, 0), (11, 11)], 6
    windows = windows_of(spark, array, starts, half)
    grid = grid_for(array)
    got = {}
    for r in cost.cost_distance(windows, grid, *weights).collect():
        got.setdefault(r.id, {})[r.col, r.row] = (r.cost, r.back)
    target = (F.col("col") + F.col("row")) % 5 == 0
    paths = {}
    for r in cost.flow_paths(windows.withColumn("target", target), grid, *weights).orderBy("id", "step").collect():
        paths.setdefault(r.id, []).append((r.step, r.col, r.row, r.cost))
    for i, (c0, r0) in enumerate(starts):
        window = np.zeros_like(array)
        rows, cols = slice(max(0, r0 - half), r0 + half + 1), slice(max(0, c0 - half), c0 + half + 1)
        window[rows, cols] = array[rows, cols]
        best = dijkstra(window, (c0, r0), *weights)
        assert {k: pytest.approx(v) for k, v in best.items()} == {k: v[0] for k, v in got.get(i, {}).items()}
        ends = [(k, r, c) for (c, r), k in best.items() if (c + r) % 5 == 0]
        if not ends:
            assert i not in paths
            continue
        k, r, c = min(ends, key=lambda e: (round(e[0], 9), e[1], e[2]))
        path = paths[i]
        assert [p[0] for p in path] == list(range(len(path)))
        assert path[0][1:3] == (c0, r0) and path[-1][1:3] == (c, r) and path[-1][3] == pytest.approx(k)
        for a, b in zip(path, path[1:]):
            assert max(abs(a[1] - b[1]), abs(a[2] - b[2])) == 1 and b[3] > a[3]


def test_batches_that_cut_windows_change_nothing(spark):
    array = np.random.default_rng(8).integers(1, 30, (12, 12)).astype(float)
    windows = windows_of(spark, array, [(2, 2), (6, 6), (9, 3)], 4)
    grid = grid_for(array)
    whole = sorted(cost.cost_distance(windows, grid).collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(cost.cost_distance(windows, grid).collect()) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_flow_line_leaves_the_zone(spark):
    array = np.full((9, 9), 5.0)
    array[4, 4] = 2  # the sink
    array[4, 7] = 1  # the lowest cell outside the zone
    zone = np.full((9, 9), np.nan)
    zone[3:6, 3:6] = 1
    grid = grid_for(array)
    zones = cells_of(spark, zone, "zone")
    points = spark.createDataFrame([(40, 4.5, -4.5), (99, 0.5, -0.5)], "id long, x double, y double")
    drawn = sinks.flow_path_lines(points, cells_of(spark, array), zones, 4.0, grid).collect()
    assert [(r.id, r.zone) for r in drawn] == [(40, 1)]  # the point off any zone drops out
    assert [(p.x, p.y) for p in drawn[0].line] == [(4.5, -4.5), (5.5, -4.5), (6.5, -4.5), (7.5, -4.5)]


def test_sink_points_keep_one_minimum_per_zone(spark):
    zones = spark.createDataFrame(
        [(0, 0, 1, 1), (1, 0, 9, 1), (2, 0, 1, 1), (3, 0, 8, 1), (4, 0, 4, 2), (5, 0, 6, 2)],
        "col long, row long, z long, zone long",
    )
    inflow = spark.createDataFrame([(c, 0, a) for c, a in enumerate([0, 0, 0, 9, 0, 9])], "col long, row long, acc long")
    got = sinks.sink_points(zones, inflow, grid_for(np.zeros((1, 6))), 5).orderBy("fzone").collect()
    assert [(r.pointid, r.fzone, r.elev, r.near_dist, r.mpcount) for r in got] == [(2, 1, 1.0, 1.0, 2), (4, 2, 4.0, 1.0, 1)]
    pour, low = sinks.pour_and_min_points(zones, inflow, grid_for(np.zeros((1, 6))))
    assert sorted((r.pointid, r.fillelev) for r in pour.collect()) == [(3, 9.0), (5, 6.0)]
