import math
import random

import numpy as np
from conftest import cells_of, grid_for

from stratagrid.grid import GridSpec
from stratagrid.operators import joins, vector


def segment_distance(px, py, ax, ay, bx, by):
    length2 = (bx - ax) ** 2 + (by - ay) ** 2
    t = 0 if length2 == 0 else max(0, min(1, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / length2))
    return math.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay))


ROADS = "road_id long, ax double, ay double, bx double, by double, half_width double"


def some_roads(rng, n, extent):
    return [
        (i, *[rng.uniform(0, extent) * s for s in (1, -1, 1, -1)], rng.choice([0.7, 1.3, 4.1])) for i in range(n)
    ]


def test_join_count_with_a_hot_block(spark):
    rng = random.Random(1)
    roads = some_roads(rng, 25, 60)
    # a third of the points crowd into one block
    points = [(i, rng.uniform(0, 60), -rng.uniform(0, 60)) for i in range(200)]
    points += [(200 + i, 5 + i * 0.01, -5.0) for i in range(100)]
    got = joins.join_count(
        spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(roads, ROADS), 10.0
    ).collect()
    expected = {
        p[0]: sum(segment_distance(p[1], p[2], *r[1:5]) <= r[5] for r in roads) for p in points
    }
    assert {r.id: r.join_count for r in got} == expected


def test_locate_takes_the_first_tile_by_name(spark):
    points = spark.createDataFrame([(1, 1.0, -1.0), (2, 9.0, -1.0), (3, 5.0, -5.0)], "id long, x double, y double")
    tiles = spark.createDataFrame(
        [("t2", "b", 0.0, 6.0, -6.0, 0.0), ("t1", "a", 0.0, 5.5, -5.5, 0.0)],
        "tilename string, ascii_path string, xmin double, xmax double, ymin double, ymax double",
    )
    assert sorted((r.id, r.tilename) for r in joins.locate(points, tiles, 2.0).collect()) == [(1, "t1"), (3, "t1")]
    assert sorted(r.id for r in joins.in_tiles(points, tiles, 2.0).collect()) == [1, 3]
    assert [r.id for r in joins.out_of_tiles(points, tiles, 2.0).collect()] == [2]


def test_road_cells_match_brute_force_for_slanted_lines(spark):
    rng = random.Random(2)
    roads = some_roads(rng, 6, 200) + [(99, 50.0, -50.0, 50.0, -50.0, 2.0)]
    grid = GridSpec(ncol=220, nrow=210, cell=1.0)
    got = {(r.col, r.row) for r in vector.road_cells(spark.createDataFrame(roads, ROADS), grid).collect()}
    expected = {
        (c, r) for c in range(220) for r in range(210)
        if any(segment_distance(c + 0.5, -(r + 0.5), *road[1:5]) <= road[5] for road in roads)
    }
    assert got == expected


def test_buffer_off_centre_and_clipped(spark):
    grid = GridSpec(ncol=12, nrow=9, cell=2.0, x0=100.0, y0=50.0)
    points = [(1, 111.3, 40.2), (2, 100.1, 49.9), (3, 500.0, 40.0)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    got = {(r.id, r.col, r.row) for r in vector.buffer_cells(df, 5.0, grid).collect()}
    expected = {
        (i, c, r) for i, x, y in points for c in range(12) for r in range(9)
        if math.hypot(100 + (c + 0.5) * 2 - x, 50 - (r + 0.5) * 2 - y) <= 5.0
    }
    assert got == expected


def test_centred_strip_leaves_two_equal_parts(spark):
    grid = GridSpec(ncol=30, nrow=30)
    point = spark.createDataFrame([(1, 15.5, -15.5)], "id long, x double, y double")
    road = spark.createDataFrame([(1, 0.5, -15.5, 29.5, -15.5, 1.0)], ROADS)
    cells = vector.erase(vector.buffer_cells(point, 5.0, grid).select("id", "col", "row"), vector.road_cells(road, grid))
    parts = vector.single_parts(cells, ["id"], grid)
    ranks = [r.part_rank for r in vector.ranked_parts(parts, grid).collect()]
    assert ranks == [1.5, 1.5]
    assert vector.ranked_parts(parts, grid, 2.0).count() == 2  # both sides stay
    assert vector.ranked_parts(parts, grid, 1.0).count() == 0  # no single largest part
    ends = vector.end_parts(parts).first()
    assert ends.min_part < 15 * 30 < ends.max_part
    total = vector.area(parts, ["id"], grid).first().area
    assert total == cells.count()


def test_areas_and_centroids_use_the_cell_size(spark):
    array = np.array([[1, 1], [1, np.nan]])
    grid = grid_for(array, cell=10.0, x0=1000.0, y0=2000.0)
    cells = cells_of(spark, array)
    assert vector.area(cells, ["z"], grid).first().area == 300.0
    c = vector.centroids(cells, ["z"], grid).first()
    assert (round(c.cx, 6), round(c.cy, 6)) == (1008.333333, 1991.666667)
