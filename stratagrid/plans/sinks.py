"""Terrain products, sink and pour points, flow paths from the sinks."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagrid.grid import GridSpec
from stratagrid.operators import cost, fields, hydrology, nearest, raster, windows
from stratagrid.operators.components import components
from stratagrid.operators.groups import spread
from stratagrid.scratch import materialize, note_written, scratch_dir
from stratagrid.sources import tables


class Terrain:
    """Rasters derived from one DEM; each is computed once, saved by place, and read from then on.

    A plan that needs a raster near some points reads only the tiles under them.
    """

    def __init__(self, dem: DataFrame, grid: GridSpec, folder: str | None = None):
        self._dem, self.grid = dem, grid
        self._folder = folder or f"{scratch_dir(dem.sparkSession)}/terrain-{uuid.uuid4().hex}"
        self._saved: dict[str, DataFrame] = {}

    def _product(self, name: str, build) -> DataFrame:
        if name not in self._saved:
            spark, path = self._dem.sparkSession, f"{self._folder}/{name}"
            cells = build()
            cells = cells.drop("tile_col", "tile_row")
            tables.save_raster(cells, path, self.grid)
            note_written(spark, path)
            self._saved[name] = tables.read_raster(spark, path, cells.schema)
        return self._saved[name]

    @property
    def dem(self) -> DataFrame:
        """``(col, row, z)``"""
        return self._product("dem", lambda: self._dem)

    @property
    def filled(self) -> DataFrame:
        """``(col, row, z, fill)``"""
        return self._product("fill", lambda: hydrology.fill(self.dem, self.grid))

    @property
    def directions(self) -> DataFrame:
        """``(col, row, dir)``"""
        return self._product("direction", lambda: hydrology.flow_direction(self.filled, self.grid))

    @property
    def accumulation(self) -> DataFrame:
        """``(col, row, acc)``"""
        return self._product("accumulation", lambda: hydrology.flow_accumulation(self.directions, self.grid))

    @property
    def fill_regions(self) -> DataFrame:
        """``(col, row, z, zone)``: connected raised cells."""
        return self._product("regions", lambda: components(
            self.filled.filter("z <> fill").select("col", "row", "z"), self.grid
        ).withColumnRenamed("component", "zone"))

    def large_zones(self, more_than: int) -> DataFrame:
        """``(col, row, z, zone)``: fill regions with more than ``more_than`` cells."""
        return self._product(f"zones-over-{more_than}", lambda: raster.large_zones(
            self.fill_regions.select("col", "row", "z", "zone"), more_than))


def pour_and_min_points(zones: DataFrame, inflow: DataFrame, grid: GridSpec):
    """Pour points ``(pointid, x, y, fzone, fillelev)`` and minimum points ``(.., elev)`` of zones.

    ``zones`` is ``(col, row, z, zone)``, ``inflow`` ``(col, row, acc)``.  FILLELEV is the zone's
    greatest elevation, ELEV its least.
    """
    zones, inflow = zones.select("col", "row", "z", "zone"), inflow.select("col", "row", "acc")
    stats = raster.zonal_table(zones, "z", grid)
    pour_cells = raster.extreme_cells(zones.join(inflow, ["col", "row"]), "acc", highest=True)
    min_cells = raster.extreme_cells(zones, "z", highest=False)

    def tagged(cells: DataFrame, source: str, name: str) -> DataFrame:
        points = raster.raster_points(cells, grid, F.col("zone").alias("fzone"))
        return fields.join_one_field(
            points, "fzone", stats.withColumn(source, F.col(source).cast("double")), "zone", source,
            name=name, salt_by="pointid",
        ).drop("matched")

    return tagged(pour_cells, "max", "fillelev"), tagged(min_cells, "min", "elev")


def sink_points(zones: DataFrame, inflow: DataFrame, grid: GridSpec, k: int = 5) -> DataFrame:
    """One minimum point per zone: ``(pointid, x, y, fzone, elev, near_dist, mpcount)``."""
    pour, low = pour_and_min_points(zones, inflow, grid)
    pour, low = materialize(pour), materialize(low)
    near = nearest.near_table(
        low.select(F.col("pointid").alias("in_id"), "x", "y"),
        pour.select(F.col("pointid").alias("near_id"), F.col("x").alias("nx"), F.col("y").alias("ny")),
        k,
    )
    measured = nearest.with_near_distance(low, nearest.same_zone(near, low, pour))
    counts = low.groupBy("fzone").agg(F.count(F.lit(1)).alias("mpcount"))
    counted = fields.join_one_field(
        measured, "fzone", counts, "fzone", "mpcount", salt_by="pointid"
    ).drop("matched")
    return nearest.first_per_zone(counted)


def flow_windows(points: DataFrame, dem: DataFrame, zones: DataFrame, radius: float,
                 grid: GridSpec) -> DataFrame:
    """Pieces of each point's window with elevation and zone, cells as arrays (``windows.cut``).

    ``points`` is ``(id, x, y)``; pieces also carry ``px, py, start_col, start_row, own_zone``.  The window
    is a square of half-width ``2 * radius``.  Points on no zone drop out.  Of rasters saved by place only
    the tiles near points are read.
    """
    own = materialize(raster.cell_value_at(
        points.select("id", "x", "y"), zones.select("*", F.col("zone").alias("own_zone")).drop("zone", "z"), grid
    ).select(
        "id", F.col("x").alias("px"), F.col("y").alias("py"), F.col("col").alias("start_col"),
        F.col("row").alias("start_row"), "own_zone",
    ))
    around = own.select(F.col("px").alias("x"), F.col("py").alias("y"))
    near = {name: raster.near_cells(cells, around, 2.0 * radius, grid) for name, cells in (("z", dem), ("zone", zones))}
    return windows.cut(own, near, 2.0 * radius, grid)


def window_targets(points: DataFrame, dem: DataFrame, zones: DataFrame, radius: float, grid: GridSpec) -> DataFrame:
    """Cells of the windows, one row each, with the ``target`` flag."""
    rows = windows.window_rows(flow_windows(points, dem, zones, radius, grid))
    return cost.flow_targets(spread(rows, "id"), raster.in_circle(radius, grid))


def flow_path_lines(points: DataFrame, dem: DataFrame, zones: DataFrame, radius: float,
                    grid: GridSpec, straight: float = 1.0, diagonal: float = math.sqrt(2.0)) -> DataFrame:
    """``(id, zone, line)``: the least-cost way from each point to the lowest cell outside its zone."""
    points = materialize(points)  # read twice below
    pieces = flow_windows(points, dem, zones, radius, grid)
    paths = cost.flow_paths(pieces, grid, straight, diagonal, radius=radius)
    own = raster.cell_value_at(points.select("id", "x", "y"), zones.drop("z"), grid)
    return cost.path_lines(paths, grid).join(own.select("id", "zone"), "id").select("id", "zone", "line")
