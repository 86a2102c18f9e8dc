"""From dark regions to structure lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratagrid.functions.columns import distance, snap_to_axis

# every window below is partitioned by one structure's regions, at most the cells of a buffer


def darkest(regions: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` regions of least gridcode per group, ties by region id."""
    order = Window.partitionBy(*keys).orderBy("gridcode", "fid")
    return regions.withColumn("dark_rank", F.row_number().over(order)).filter(F.col("dark_rank") <= n)


def below_threshold(regions: DataFrame, fraction: float, keys: list[str] = ["id"]) -> DataFrame:
    """Regions with gridcode at most ``round((max - min) * fraction + min)``, halves to even."""
    group = Window.partitionBy(*keys)
    low, high = F.min("gridcode").over(group), F.max("gridcode").over(group)
    limit = F.bround((high - low) * F.lit(float(fraction)) + low, 0)
    return regions.withColumn("threshold", limit.cast("long")).filter("gridcode <= threshold")


def nearest_region(regions: DataFrame, keys: list[str]) -> DataFrame:
    """Of each group the region whose centroid is nearest to the structure at ``(x, y)``."""
    far = distance(F.col("x"), F.col("y"), F.col("cx"), F.col("cy"))
    return regions.withColumn("dist", far).groupBy(*keys).agg(
        F.min(F.struct("dist", "gridcode", "fid", "cx", "cy")).alias("n")
    ).select(*keys, "n.fid", "n.gridcode", "n.cx", "n.cy", "n.dist")


def side_lines(ends: DataFrame, order: str, *carried: str) -> DataFrame:
    """Polyline of each structure through its side points, in order of ``order``."""
    return ends.groupBy("id").agg(F.sort_array(F.collect_list(
        F.struct(F.col(order).alias("ord"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    )).alias("v"), *[F.first(c).alias(c) for c in carried]).select("id", *carried, F.transform("v", lambda p: F.struct(p.x.alias("x"), p.y.alias("y"))).alias("line"))


def vertices(lines: DataFrame, *columns: str) -> DataFrame:
    """One row per vertex, numbered from 0, rounded to 6 places."""
    return lines.select(*columns, F.posexplode("line").alias("vertex", "p")).select(
        *columns, F.col("vertex").cast("long").alias("vertex"),
        F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"),
    )


def opposite_end(parts: DataFrame, structures: DataFrame) -> DataFrame:
    """The line's other end: ``(id, x, y, focus_x, focus_y, end_x, end_y, found)``.

    ``parts`` is ``(id, part, diss, cx, cy)``; the part with ``diss`` is the focus.  Parts strictly nearer to the
    structure than to the focus are candidates and the nearest wins; without a candidate the
    structure itself is the end.
    """
    focus = parts.filter("diss").groupBy("id").agg(
        F.min(F.struct("part", "cx", "cy")).alias("f")
    ).select("id", F.col("f.cx").alias("focus_x"), F.col("f.cy").alias("focus_y"))
    near = focus.join(structures.select("id", "x", "y"), "id")
    measured = parts.join(near, "id").select(
        "id", "part", "cx", "cy",
        distance(F.col("x"), F.col("y"), F.col("cx"), F.col("cy")).alias("central"),
        distance(F.col("focus_x"), F.col("focus_y"), F.col("cx"), F.col("cy")).alias("lookup"),
    )
    ends = measured.filter(F.col("central") < F.col("lookup")).groupBy("id").agg(
        F.min(F.struct("central", "part", "cx", "cy")).alias("e")
    )
    return near.join(ends, "id", "left").select(
        "id", "x", "y", "focus_x", "focus_y",
        F.coalesce("e.cx", "x").alias("end_x"), F.coalesce("e.cy", "y").alias("end_y"),
        F.col("e").isNotNull().alias("found"),
    )


def snapped_line() -> Column:
    return snap_to_axis(*[F.col(c) for c in ("focus_x", "focus_y", "x", "y", "end_x", "end_y")])


def side_ranking(parts: DataFrame) -> DataFrame:
    """Parts ranked by distance on each of their two sides of the structure.

    ``parts`` is ``(id, part, cx, cy, x, y)``; a part level with the structure counts as right / above.
    """
    far = distance(F.col("x"), F.col("y"), F.col("cx"), F.col("cy"))
    sides = F.array(
        F.when(F.col("cx") < F.col("x"), "left").otherwise("right"),
        F.when(F.col("cy") < F.col("y"), "below").otherwise("above"),
    )
    order = Window.partitionBy("id", "side").orderBy("dist", "part")
    return parts.select("id", "part", far.alias("dist"), F.explode(sides).alias("side")).withColumn(
        "side_rank", F.row_number().over(order)
    )
