"""Spatial joins of points with shapes, by block key and exact predicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagrid.functions.columns import within_segment
from stratagrid.scratch import hot_keys, salted

def block_join(points: DataFrame, shapes: DataFrame, size: float, within: Column,
               salt_by: list[str], how: str = "inner", task_bytes: int | None = None) -> DataFrame:
    """Join points ``(x, y)`` to shapes ``(xmin, xmax, ymin, ymax)`` where ``within`` holds.

    A shape is copied to the blocks its box touches, a point has exactly one block, so the
    join is an equi join and meets each pair once.  A block whose counted points are too many for one
    task is spread over several, and only its shapes are copied further.
    """
    keyed = points.selectExpr("*", f"floor(x / {size}) as _px", f"floor(y / {size}) as _py")
    copies = shapes.selectExpr(
        "*", f"explode(sequence(floor(xmin / {size}), floor(xmax / {size}))) as _sx"
    ).selectExpr(
        "*", f"explode(sequence(floor(ymin / {size}), floor(ymax / {size}))) as _sy"
    )
    met = (F.col("_px") == F.col("_sx")) & (F.col("_py") == F.col("_sy"))
    hot = hot_keys(keyed, ["_px", "_py"], task_bytes)
    if hot is not None:
        keyed, copies = salted(keyed, copies, ["_px", "_py"], hot, salt_by, ["_sx", "_sy"])
        met = met & (F.col("_salt") == F.col("_copy"))
    return keyed.join(copies, met & within, how).drop("_px", "_py", "_salt", "_sx", "_sy", "_copy")


def road_boxes(roads: DataFrame, size: float) -> DataFrame:
    """Each road with the boxes of its pieces, no longer than a block: boxes grow with its length."""
    longest = F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay")))
    count = F.greatest(F.ceil(longest / F.lit(size)), F.lit(1))
    cut = roads.withColumn("_of", count).withColumn("_piece", F.explode(F.sequence(F.lit(1).cast("long"), "_of")))
    at = lambda a, b, n: F.col(a) + (F.col(b) - F.col(a)) * (n / F.col("_of"))
    x0, x1 = at("ax", "bx", F.col("_piece") - 1), at("ax", "bx", F.col("_piece"))
    y0, y1 = at("ay", "by", F.col("_piece") - 1), at("ay", "by", F.col("_piece"))
    hw = F.col("half_width")
    return cut.select(
        "*", (F.least(x0, x1) - hw).alias("xmin"), (F.greatest(x0, x1) + hw).alias("xmax"),
        (F.least(y0, y1) - hw).alias("ymin"), (F.greatest(y0, y1) + hw).alias("ymax"),
    ).drop("_of", "_piece")


def join_count(points: DataFrame, roads: DataFrame, size: float) -> DataFrame:
    """Every point with ``join_count``, the number of road strips it lies on."""
    met = block_join(
        points, road_boxes(roads, size), size, within_segment(F.col("x"), F.col("y")), ["id"], "left"
    )
    # pieces of one road may meet a point in the same block: a road counts once
    return met.groupBy(*points.columns).agg(F.count_distinct("road_id").alias("join_count"))


def inside_box() -> Column:
    """Half-open box test: west and north edges belong to a tile, east and south do not."""
    x, y = F.col("x"), F.col("y")
    return (x >= F.col("xmin")) & (x < F.col("xmax")) & (y <= F.col("ymax")) & (y > F.col("ymin"))


def locate(points: DataFrame, tiles: DataFrame, size: float) -> DataFrame:
    """Points inside a tile with their tile; of several tiles the first by name."""
    met = block_join(points, tiles, size, inside_box(), ["id"])
    return met.groupBy(*points.columns).agg(
        F.min(F.struct("tilename", "ascii_path")).alias("t")
    ).select(*points.columns, "t.tilename", "t.ascii_path")


def in_tiles(points: DataFrame, tiles: DataFrame, size: float) -> DataFrame:
    return block_join(points, tiles, size, inside_box(), ["id"], "left_semi")


def out_of_tiles(points: DataFrame, tiles: DataFrame, size: float) -> DataFrame:
    return block_join(points, tiles, size, inside_box(), ["id"], "left_anti")
