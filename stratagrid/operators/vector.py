"""Polygons as cell sets: buffers, road strips, erase, areas, centroids, ranked parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagrid.functions.columns import average_rank, within_segment
from stratagrid.grid import GridSpec
from stratagrid.operators.components import group_components
from stratagrid.scratch import materialize

PIECE = 64  # cells of a road line that share one candidate box


def _cells_in_box(shapes: DataFrame, grid: GridSpec) -> DataFrame:
    """Cells whose centre lies in ``(xmin, xmax, ymin, ymax)``, clipped to the grid."""
    half, cell = F.lit(0.5), F.lit(grid.cell)
    boxed = shapes.select(
        "*",
        F.greatest(F.ceil((F.col("xmin") - grid.x0) / cell - half), F.lit(0)).alias("_c0"),
        F.least(F.floor((F.col("xmax") - grid.x0) / cell - half), F.lit(grid.ncol - 1)).alias("_c1"),
        F.greatest(F.ceil((F.lit(grid.y0) - F.col("ymax")) / cell - half), F.lit(0)).alias("_r0"),
        F.least(F.floor((F.lit(grid.y0) - F.col("ymin")) / cell - half), F.lit(grid.nrow - 1)).alias("_r1"),
    ).filter("_c0 <= _c1 and _r0 <= _r1")
    return boxed.withColumn("col", F.explode(F.sequence("_c0", "_c1"))).withColumn(
        "row", F.explode(F.sequence("_r0", "_r1"))
    ).drop("_c0", "_c1", "_r0", "_r1")


def disc(x: Column, y: Column, radius: float, grid: GridSpec) -> Column:
    """True for cells whose centre is within ``radius`` of (x, y)."""
    dx, dy = grid.x() - x, grid.y() - y
    return dx * dx + dy * dy <= F.lit(float(radius) * radius)


def boxes(points: DataFrame, half_width: float) -> DataFrame:
    """Square extents round points."""
    return points.select(
        "*",
        (F.col("x") - half_width).alias("xmin"), (F.col("x") + half_width).alias("xmax"),
        (F.col("y") - half_width).alias("ymin"), (F.col("y") + half_width).alias("ymax"),
    )


def buffer_cells(points: DataFrame, radius: float, grid: GridSpec) -> DataFrame:
    """Buffer of each point as cells: the point's columns plus ``col, row``."""
    return _cells_in_box(boxes(points, radius), grid).filter(
        disc(F.col("x"), F.col("y"), radius, grid)
    ).drop("xmin", "xmax", "ymin", "ymax")


def block_range(low: Column, high: Column, cells: int, grid: GridSpec) -> Column:
    """One row for each block of a range of cells, kept inside the grid."""
    top = (cells - 1) // grid.block
    return F.explode(F.sequence(*[
        F.least(F.greatest(F.floor(c / F.lit(grid.block)), F.lit(0)), F.lit(top)) for c in (low, high)]))


def touched_blocks(points: DataFrame, reach: float, grid: GridSpec, x: str = "x", y: str = "y") -> DataFrame:
    """Each point once for every block within ``reach``: its columns and ``bc, br``."""
    cols = block_range(grid.col_at(F.col(x) - reach), grid.col_at(F.col(x) + reach), grid.ncol, grid)
    rows = block_range(grid.row_at(F.col(y) + reach), grid.row_at(F.col(y) - reach), grid.nrow, grid)
    return points.withColumn("bc", cols).withColumn("br", rows)


def road_cells(roads: DataFrame, grid: GridSpec, points: DataFrame | None = None, reach: float = 0.0) -> DataFrame:
    """Cells of the road strips.  Long lines are cut into pieces to keep candidate boxes small.

    With ``points`` only pieces that touch a block within ``reach`` of one become cells, and of those only
    the cells in such blocks: the work follows the points, not the road network.
    """
    piece = F.lit(PIECE * grid.cell)
    length = F.sqrt(
        (F.col("bx") - F.col("ax")) * (F.col("bx") - F.col("ax"))
        + (F.col("by") - F.col("ay")) * (F.col("by") - F.col("ay"))
    )
    pieces = roads.withColumn("_n", F.greatest(F.ceil(length / piece), F.lit(1))).withColumn(
        "_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))
    )

    def at(start: str, end: str, k: Column) -> Column:
        return F.col(start) + (F.col(end) - F.col(start)) * k / F.col("_n")

    k, hw = F.col("_k"), F.col("half_width")
    x0, x1 = at("ax", "bx", k), at("ax", "bx", k + 1)
    y0, y1 = at("ay", "by", k), at("ay", "by", k + 1)
    boxed = pieces.select(
        "*", (F.least(x0, x1) - hw).alias("xmin"), (F.greatest(x0, x1) + hw).alias("xmax"),
        (F.least(y0, y1) - hw).alias("ymin"), (F.greatest(y0, y1) + hw).alias("ymax"),
    )
    if points is not None:
        wanted = materialize(touched_blocks(points.select("x", "y"), reach, grid).select("bc", "br").distinct())
        size = F.lit(grid.block * grid.cell)
        cols = block_range(grid.col_at("xmin"), grid.col_at("xmax"), grid.ncol, grid)
        rows = block_range(grid.row_at("ymax"), grid.row_at("ymin"), grid.nrow, grid)
        boxed = boxed.withColumn("bc", cols).withColumn("br", rows).join(wanted, ["bc", "br"], "left_semi").select(
            "*", (grid.x0 + F.col("bc") * size).alias("_west"), (grid.y0 - F.col("br") * size).alias("_north")
        ).select(
            *roads.columns, F.greatest("xmin", "_west").alias("xmin"),
            F.least(F.col("xmax"), F.col("_west") + size).alias("xmax"),
            F.greatest(F.col("ymin"), F.col("_north") - size).alias("ymin"), F.least("ymax", "_north").alias("ymax"))
    return _cells_in_box(boxed, grid).filter(within_segment(grid.x(), grid.y())).select(
        "col", "row"
    ).distinct()


def erase(cells: DataFrame, mask: DataFrame) -> DataFrame:
    return cells.join(mask.select("col", "row"), ["col", "row"], "left_anti")


def extract_by_mask(raster: DataFrame, mask: DataFrame) -> DataFrame:
    """Raster values under a cell set; a cell may belong to several polygons.

    The planner takes an exploded buffer to be as small as its points, so without the hint it would send every cell
    of a large mask to the driver and broadcast it.
    """
    return mask.hint("merge").join(raster, ["col", "row"])


def area(cells: DataFrame, keys: list[str], grid: GridSpec) -> DataFrame:
    return cells.groupBy(*keys).agg((F.count(F.lit(1)) * F.lit(grid.cell * grid.cell)).alias("area"))


def centroids(cells: DataFrame, keys: list[str], grid: GridSpec, *extra: Column) -> DataFrame:
    """True centroid of each polygon: the mean of its cell centres."""
    return cells.groupBy(*keys).agg(
        F.avg(grid.x()).alias("cx"), F.avg(grid.y()).alias("cy"), *extra
    )


def single_parts(cells: DataFrame, keys: list[str], grid: GridSpec) -> DataFrame:
    """Connected parts of small polygons; cells that touch only at a corner are apart."""
    return group_components(cells, keys, grid).withColumnRenamed("component", "part")


def ranked_parts(parts: DataFrame, grid: GridSpec, keep: float | None = None) -> DataFrame:
    """``(id, part, area, part_rank)``: parts of each point by descending area, ties averaged."""
    ranked = area(parts, ["id", "part"], grid).withColumn("part_rank", average_rank(["id"], "area"))
    return ranked if keep is None else ranked.filter(F.col("part_rank") <= keep)


def end_parts(parts: DataFrame) -> DataFrame:
    """Greatest and least part id of each point."""
    return parts.groupBy("id").agg(F.max("part").alias("max_part"), F.min("part").alias("min_part"))
