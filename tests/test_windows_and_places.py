"""Windows cut from packed blocks, rasters read by place, roads near points."""

import glob
import random

import numpy as np
import pytest
from conftest import as_map, cells_of, grid_for
from pyspark.sql import functions as F

from stratagrid.grid import GridSpec
from stratagrid.operators import cost, raster, vector, windows
from stratagrid.plans import isolated, sinks


def window_by_hand(array, zone, grid, points, half):
    out = set()
    for i, px, py in points:
        for r in range(array.shape[0]):
            for c in range(array.shape[1]):
                x, y = grid.x0 + (c + 0.5) * grid.cell, grid.y0 - (r + 0.5) * grid.cell
                if abs(x - px) <= half and abs(y - py) <= half and not np.isnan(array[r, c]):
                    out.add((i, c, r, int(array[r, c]), None if np.isnan(zone[r, c]) else int(zone[r, c])))
    return out


@pytest.fixture(scope="module")
def scene():
    rng = np.random.default_rng(4)
    array = rng.integers(1, 50, (23, 31)).astype(float)
    array[rng.random(array.shape) < 0.1] = np.nan
    zone = rng.integers(0, 3, array.shape).astype(float)
    zone[rng.random(array.shape) < 0.4] = np.nan
    draw = random.Random(1)
    points = [(i, 100 + draw.uniform(-1, 63), 50 - draw.uniform(-1, 47)) for i in range(12)]
    points += [(20 + i, 111.0, 39.0) for i in range(30)]  # many points in one block
    return array, zone, points


@pytest.mark.parametrize("block,at_once", [(4, 1 << 20), (7, 60), (64, 1)])
def test_windows_equal_brute_force(spark, scene, monkeypatch, block, at_once):
    monkeypatch.setattr(windows, "CELLS_AT_ONCE", at_once)
    array, zone, points = scene
    grid = grid_for(array, block, cell=2.0, x0=100.0, y0=50.0)
    where = spark.createDataFrame(points, "id long, px double, py double")
    pieces = windows.cut(where, {"z": cells_of(spark, array), "zone": cells_of(spark, zone, "zone")}, 7.0, grid)
    got = {(r.id, r.col, r.row, r.z, r.zone) for r in windows.window_rows(pieces).collect()}
    assert got == window_by_hand(array, zone, grid, points, 7.0)
    blocks = windows.touched_blocks(where, 7.0, grid, "px", "py").groupBy("id").count()
    most = {r["id"]: r["count"] for r in blocks.collect()}
    pieces_of = {r["id"]: r["count"] for r in pieces.groupBy("id").count().collect()}
    assert all(n <= most[i] for i, n in pieces_of.items())  # rows shuffled per point: blocks touched


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_costs_of_pieces_equal_costs_of_rows(spark, scene, batch):
    array, zone, points = scene
    grid = grid_for(array, 5, cell=2.0, x0=100.0, y0=50.0)
    where = spark.createDataFrame(points, "id long, x double, y double")
    dem, zones = cells_of(spark, array), cells_of(spark, zone, "zone")
    pieces = sinks.flow_windows(where, dem, zones, 4.0, grid)
    rows = windows.window_rows(pieces)
    marked = sinks.window_targets(where, dem, zones, 4.0, grid)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        assert sorted(cost.cost_distance(pieces, grid).collect()) == sorted(cost.cost_distance(rows, grid).collect())
        paths = sorted(cost.flow_paths(pieces, grid, radius=4.0).collect())
        assert paths == sorted(cost.flow_paths(marked, grid).collect()) and paths
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_windows_of_nothing(spark, scene):
    array, zone, _ = scene
    grid = grid_for(array, 5)
    nobody = spark.createDataFrame([], "id long, x double, y double")
    pieces = sinks.flow_windows(nobody, cells_of(spark, array), cells_of(spark, zone, "zone"), 4.0, grid)
    assert pieces.count() == 0 and cost.cost_distance(pieces, grid).count() == 0


def spoil(folder, keep):
    """Make the files of all tiles but ``keep`` unreadable."""
    spoilt = 0
    for path in glob.glob(f"{folder}/tile_col=*/tile_row=*/*.parquet"):
        tile = tuple(int(part.split("=")[1]) for part in path.split("/") if part.startswith("tile_"))
        if tile not in keep:
            with open(path, "wb") as out:
                out.write(b"not a raster")
            spoilt += 1
    return spoilt


def test_plans_read_only_the_tiles_they_need(spark, tmp_path):
    rng = np.random.default_rng(6)
    array = rng.integers(10, 400, (130, 130)).astype(float)
    grid = grid_for(array, 4)  # a tile is 64 cells wide: nine tiles
    terrain = sinks.Terrain(cells_of(spark, array), grid, str(tmp_path / "terrain"))
    zones = terrain.large_zones(3)
    near = zones.filter("col between 20 and 40 and row between 20 and 40")
    found = near.select(grid.cell_id(), grid.x(), grid.y()).limit(5).collect()
    starts = spark.createDataFrame([tuple(r) for r in found], "id long, x double, y double")
    lonely = starts.select("id", F.col("id").alias("main_file_id"), "x", "y")
    road = spark.createDataFrame([(1, 0.0, -30.0, 129.0, -30.0, 1.0)], "road_id long, ax double, ay double, bx double, by double, half_width double")

    def results():
        paths = sinks.flow_path_lines(starts, terrain.dem, zones, 5.0, grid).collect()
        lines = isolated.isolated_lines(lonely, road, terrain.dem, grid, 6.0).collect()
        return sorted(map(str, paths)), sorted(map(str, lines))

    whole = results()
    assert whole[0] and whole[1]
    assert spoil(tmp_path / "terrain" / "dem", {(0, 0)}) >= 8
    assert spoil(tmp_path / "terrain" / "zones-over-3", {(0, 0)}) >= 4
    assert results() == whole
    with pytest.raises(Exception):
        terrain.dem.agg(F.sum("z")).collect()


def test_terrain_by_place_equals_operators(spark):
    array = np.random.default_rng(2).integers(0, 90, (20, 30)).astype(float)
    grid = grid_for(array, 4)
    terrain = sinks.Terrain(cells_of(spark, array), grid)
    assert as_map(terrain.dem, "z") == {k: int(v) for k, v in np.ndenumerate(array.T)}
    filled = as_map(terrain.filled, "z", "fill")
    raised = {k for k, (z, fill) in filled.items() if z != fill}
    assert set(as_map(terrain.fill_regions, "zone")) == raised
    flat = sinks.Terrain(cells_of(spark, np.full((6, 6), 3.0)), grid_for(np.zeros((6, 6)), 4))
    assert flat.fill_regions.count() == 0 and flat.large_zones(1).count() == 0


def test_roads_near_points_are_the_same_cells(spark):
    rng = random.Random(3)
    roads = [(i, *(rng.uniform(0, 90) * s for s in (1, -1, 1, -1)), rng.uniform(0.5, 3)) for i in range(25)]
    roads = spark.createDataFrame(roads, "road_id long, ax double, ay double, bx double, by double, half_width double")
    grid = GridSpec(ncol=90, nrow=90, block=8)
    points = spark.createDataFrame([(1, 12.5, -30.5), (2, 70.2, -71.9)], "id long, x double, y double")
    buffers = vector.buffer_cells(points, 6.0, grid).select("id", "col", "row")
    every, near = vector.road_cells(roads, grid), vector.road_cells(roads, grid, points, 6.0)
    assert sorted(vector.erase(buffers, near).collect()) == sorted(vector.erase(buffers, every).collect())
    blocks = {(r.bc, r.br) for r in vector.touched_blocks(points, 6.0, grid).collect()}
    assert {(r.col // 8, r.row // 8) for r in near.collect()} <= blocks
    assert near.count() < every.count()


def test_hillshade_does_not_depend_on_blocks(spark):
    array = np.random.default_rng(1).integers(0, 60, (15, 22)).astype(float)
    array[3:5, 4:9] = np.nan
    shades = [as_map(raster.hillshade(cells_of(spark, array), grid_for(array, b)), "gridcode") for b in (3, 8, 64)]
    assert shades[0] == shades[1] == shades[2] and len(shades[0]) == np.isfinite(array).sum()
