"""Map algebra, zonal operators, hillshade, windows and masks; cells are rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagrid.functions.columns import hillshade as shade
from stratagrid.grid import DIRECTIONS, GridSpec, with_block
from stratagrid.operators.components import components
from stratagrid.operators.patches import Patch, map_patches
from stratagrid.operators.vector import disc, touched_blocks
from stratagrid.scratch import lookup, materialize

CELL = ["col", "row"]


def combine(left: DataFrame, right: DataFrame, name: str, expression: Column) -> DataFrame:
    """Cell-wise expression over two rasters, on the cells that both have."""
    return left.join(right, CELL).select(*CELL, expression.alias(name))


def set_null(value: Column, where: Column) -> Column:
    return F.when(~where, value)


def zone_sizes(zones: DataFrame, zone: str = "zone") -> DataFrame:
    """Raster attribute table: cells per value."""
    return zones.groupBy(zone).agg(F.count(F.lit(1)).alias("count"))


def large_zones(zones: DataFrame, more_than: int, zone: str = "zone") -> DataFrame:
    """Cells of zones with more than ``more_than`` cells."""
    kept = zone_sizes(zones, zone).filter(F.col("count") > more_than).select(zone)
    return lookup(zones, kept, zone, CELL)


def zonal_statistics(zones: DataFrame, zone: str = "zone", **named: Column) -> DataFrame:
    """Broadcast aggregates of a zone back to its cells.

    Zones may be as large as the raster, so this is a combinable aggregate and a salted
    lookup, not a window that would hold a whole zone in one task.
    """
    stats = zones.groupBy(zone).agg(*[column.alias(name) for name, column in named.items()])
    return lookup(zones, stats, zone, CELL)


def zonal_table(zones: DataFrame, value: str, grid: GridSpec, zone: str = "zone") -> DataFrame:
    low, high = F.min(value), F.max(value)
    return zones.groupBy(zone).agg(
        F.count(F.lit(1)).alias("count"),
        (F.count(F.lit(1)) * F.lit(grid.cell * grid.cell)).alias("area"),
        low.alias("min"), high.alias("max"), (high - low).alias("range"),
    )


def extreme_cells(zones: DataFrame, value: str, highest: bool, zone: str = "zone") -> DataFrame:
    """Cells at the greatest (pour) or least (minimum) value of their zone; ties all stay."""
    edge = F.max(value) if highest else F.min(value)
    return zonal_statistics(zones, zone, _edge=edge).filter(
        F.col(value) == F.col("_edge")
    ).drop("_edge")


def raster_points(cells: DataFrame, grid: GridSpec, *columns: str) -> DataFrame:
    """One point per cell, at its centre; the point id is the cell id."""
    return cells.select(
        grid.cell_id().alias("pointid"), grid.x().alias("x"), grid.y().alias("y"), *columns
    )


def hillshade(dem: DataFrame, grid: GridSpec, value: str = "z") -> DataFrame:
    """Shade 0-255 as an integer: ``(col, row, gridcode)``.

    Gradients weigh the 3 x 3 window (1, 2, 1); a missing neighbour counts as the centre.
    """
    def gradients(patch: Patch) -> pa.Table:
        z, p, q = patch.dense("z"), np.zeros(len(patch.cells)), np.zeros(len(patch.cells))
        for code, dc, dr in DIRECTIONS:
            near = patch.cells + patch.offset[code]
            rise = np.where(patch.known[near], z[near] - z[patch.cells], 0)
            p += rise * float(dc * (1 if dr else 2))
            q += rise * float(dr * (1 if dc else 2))
        return pa.table({"col": patch.col(patch.cells), "row": patch.row(patch.cells), "p": p, "q": q})

    cells = dem.filter(F.col(value).isNotNull()).select(*CELL, F.col(value).cast("double").alias("z"))
    around = map_patches(cells, grid, gradients, "col long, row long, p double, q double")
    run = F.lit(8.0 * grid.cell)
    return around.select(
        *CELL, F.floor(F.round(shade(F.col("p") / run, F.col("q") / run), 6)).cast("long").alias("gridcode")
    )


def value_regions(cells: DataFrame, grid: GridSpec, value: str) -> DataFrame:
    """Raster to polygons: cells with the region of equal value they belong to, 4 neighbours."""
    return components(cells, grid, value=value, neighbours=4)


def cell_value_at(points: DataFrame, raster: DataFrame, grid: GridSpec, tile_blocks: int = 16) -> DataFrame:
    """Raster value under each point; points off the raster or on NoData drop out.

    Of a raster saved by place, only the tiles under points are read.
    """
    at = points.withColumn("col", grid.col_at()).withColumn("row", grid.row_at())
    if {"tile_col", "tile_row"} <= set(raster.columns):
        raster = near_cells(raster, points, 0.0, grid, tile_blocks)
    return at.join(raster, CELL)


def near_cells(raster: DataFrame, points: DataFrame, reach: float, grid: GridSpec,
               tile_blocks: int = 16) -> DataFrame:
    """Raster cells in the blocks that lie within ``reach`` of a point.

    A semi join on the block key, so that a costly operator runs only where results are needed.  The
    wanted blocks are written first, so that the planner knows how few they are; of a raster saved by
    place (``tables.save_raster`` with the same ``tile_blocks``) only their tiles are then read.
    """
    wanted = touched_blocks(points.select("x", "y"), reach, grid).select("bc", "br").distinct()
    keys = ["bc", "br"]
    if {"tile_col", "tile_row"} <= set(raster.columns):
        # the plain filter tells the optimizer that these keys can prune the partitions of the raster
        wanted = wanted.selectExpr("*", f"cast(floor(bc / {tile_blocks}) as int) as tile_col",
                                   f"cast(floor(br / {tile_blocks}) as int) as tile_row")
        wanted = materialize(wanted).filter("tile_col >= 0 and tile_row >= 0")
        keys += ["tile_col", "tile_row"]
    else:
        wanted = materialize(wanted)
    return with_block(raster, grid).join(wanted, keys, "left_semi").drop(*keys)


def in_circle(radius: float, grid: GridSpec) -> Column:
    """True for window cells within ``radius`` of the window's point."""
    return disc(F.col("px"), F.col("py"), radius, grid)
