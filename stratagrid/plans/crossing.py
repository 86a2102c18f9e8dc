"""Lines that join the two sides of a road at each structure on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagrid.grid import GridSpec
from stratagrid.operators import lines, raster, vector
from stratagrid.operators.components import group_components
from stratagrid.scratch import materialize


def parts_off_road(structures: DataFrame, roads: DataFrame, radius: float, grid: GridSpec) -> DataFrame:
    """Single parts of each structure's buffer after the road strips are cut out."""
    cells = vector.buffer_cells(structures.select("id", "x", "y"), radius, grid).select("id", "col", "row")
    return vector.single_parts(vector.erase(cells, vector.road_cells(roads, grid, structures, radius)), ["id"], grid)


def ranked_cells(parts: DataFrame, keep: float, grid: GridSpec) -> DataFrame:
    """Cells of the parts that keep a rank, with the greatest and least kept part of the point."""
    parts = materialize(parts)  # read three times below
    kept = vector.ranked_parts(parts, grid, keep).select("id", "part")
    return parts.join(kept, ["id", "part"]).join(vector.end_parts(kept), "id")


def shade_regions(cells: DataFrame, shade: DataFrame, keys: list[str], grid: GridSpec) -> DataFrame:
    """Regions of equal shade inside each cell set: ``(keys, fid, gridcode, cx, cy)``."""
    masked = vector.extract_by_mask(shade, cells.select(*keys, "col", "row"))
    labelled = group_components(masked, keys, grid, value="gridcode")
    return vector.centroids(
        labelled, keys + ["component"], grid, F.first("gridcode").alias("gridcode")
    ).withColumnRenamed("component", "fid")


def road_crossing_lines(structures: DataFrame, roads: DataFrame, dem: DataFrame, grid: GridSpec,
                        radius: float = 35.0, keep: float = 2.0, darkest: int = 30) -> DataFrame:
    """``(id, main_file_id, one_sided, line)`` for structures on a road.

    The two sides are the greatest and least part that keep rank ``keep``.  On each side the
    nearest of the darkest shade regions is one end.  With a single part both ends coincide.
    """
    structures = materialize(structures)  # read five times below
    parts = parts_off_road(structures, roads, radius, grid)
    ends = ranked_cells(parts, keep, grid).filter("part = max_part or part = min_part").withColumn(
        "one_sided", F.col("max_part") == F.col("min_part")
    )
    sided = ends.select(
        "id", "col", "row", "one_sided",
        F.explode(F.when(F.col("one_sided"), F.array(F.lit(0), F.lit(1)))
                  .when(F.col("part") == F.col("max_part"), F.array(F.lit(0)))
                  .otherwise(F.array(F.lit(1)))).alias("side"),
    )
    keys = ["id", "side", "one_sided"]
    near_dem = raster.near_cells(dem, structures, radius + 2 * grid.cell, grid)
    regions = shade_regions(sided, raster.hillshade(near_dem, grid), keys, grid)
    located = lines.darkest(regions, ["id", "side"], darkest).join(structures.select("id", "x", "y"), "id")
    near = lines.nearest_region(located, keys)
    return lines.side_lines(near, "side", "one_sided").join(
        structures.select("id", "main_file_id"), "id"
    ).select("id", "main_file_id", "one_sided", "line")
