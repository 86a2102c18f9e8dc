"""Axis-snapped lines through structures off any road."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagrid.grid import GridSpec
from stratagrid.operators import lines, raster, vector
from stratagrid.operators.components import group_components
from stratagrid.scratch import materialize
from stratagrid.plans.crossing import parts_off_road, ranked_cells


def isolated_lines(structures: DataFrame, roads: DataFrame, dem: DataFrame, grid: GridSpec,
                   radius: float = 25.0, keep: float = 1.0, darkest: int = 5,
                   fraction: float = 0.5) -> DataFrame:
    """``(id, main_file_id, found, line)`` for structures off the roads.

    Start: the nearest of the darkest shade regions.  End: the nearest dissolved dark part that
    lies nearer to the structure than to the start, or the structure itself.
    """
    structures = materialize(structures)  # read five times below
    parts = parts_off_road(structures, roads, radius, grid)
    largest = ranked_cells(parts, keep, grid).filter("part = max_part").select("id", "col", "row")
    near_dem = raster.near_cells(dem, structures, radius + 2 * grid.cell, grid)
    masked = vector.extract_by_mask(raster.hillshade(near_dem, grid), largest)
    labelled = materialize(
        group_components(masked, ["id"], grid, value="gridcode").withColumnRenamed("component", "fid")
    )
    regions = vector.centroids(labelled, ["id", "fid"], grid, F.first("gridcode").alias("gridcode"))
    dark = materialize(lines.below_threshold(regions, fraction))
    points = structures.select("id", "x", "y")
    focus = lines.nearest_region(lines.darkest(dark, ["id"], darkest).join(points, "id"), ["id"])
    flagged = flag_focus(dark, focus)
    dissolved = group_components(
        labelled.select("id", "fid", "col", "row").join(flagged.select("id", "fid", "diss"), ["id", "fid"]),
        ["id", "diss"], grid,
    )
    pieces = materialize(
        vector.centroids(dissolved, ["id", "diss", "component"], grid).withColumnRenamed("component", "part")
    )
    ends = lines.opposite_end(pieces, structures)
    return ends.withColumn("line", lines.snapped_line()).join(
        structures.select("id", "main_file_id"), "id"
    ).select("id", "main_file_id", "found", "line")


def flag_focus(regions: DataFrame, focus: DataFrame) -> DataFrame:
    """``diss`` is true for each structure's focus region only."""
    chosen = focus.select("id", F.col("fid").alias("focus_fid"))
    return regions.join(chosen, "id", "left").withColumn(
        "diss", F.coalesce(F.col("fid") == F.col("focus_fid"), F.lit(False))
    ).drop("focus_fid")
