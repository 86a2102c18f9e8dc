"""k nearest targets, nearest minimum per zone, near-table joins.

Points and targets stand in a quadtree each, of which a level is one aggregate: the count and the tight
box of every cell that holds any.  A search goes down both trees at once with pairs of a point cell and
a target cell that may hold one of its nearest.  The targets' counts bound the kth distance of every
point of a cell, and pairs whose boxes are farther apart go.  A point cell stops where few targets are
left, so lone points and dense clusters each end at a width of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratagrid.functions.columns import distance
from stratagrid.scratch import Rounds, hot_keys, lookup, salted

DEPTH = 30  # levels of the trees: a cell is a 2^30th of the extent at last
FIRST = 3  # the first level that is looked at: at most 64 x 64 pairs of cells
SLACK = 1 + 1e-9  # rounding of the distances of boxes


def near_table(points: DataFrame, targets: DataFrame, k: int, most: int | None = None) -> DataFrame:
    """The ``k`` nearest targets of every point: ``(in_id, near_id, near_dist, near_rank)``.

    ``points`` is ``(in_id, x, y)``, ``targets`` ``(near_id, nx, ny)``, in whatever unit the coordinates have;
    rows without coordinates take no part.  A point meets about ``most`` targets (by default ``16 * k``),
    more only where so many may be the kth nearest, as on a circle about it.  Distance ties take the
    lesser id; with fewer than ``k`` targets a point has them all.
    """
    nearest = Window.partitionBy("in_id").orderBy("near_dist", "near_id")
    ranked = candidates(points, targets, k, most).select(
        "in_id", "near_id", distance(F.col("px"), F.col("py"), F.col("x"), F.col("y")).alias("near_dist"),
    ).withColumn("near_rank", F.row_number().over(nearest)).filter(F.col("near_rank") <= k)
    rounds = Rounds(points.sparkSession)
    near = rounds.put("near", ranked)
    rounds.keep("near")
    return near


def candidates(points: DataFrame, targets: DataFrame, k: int, most: int | None = None) -> DataFrame:
    """``in_id, px, py, near_id, x, y``: every point with targets that hold its ``k`` nearest."""
    spark = points.sparkSession
    rounds, most = Rounds(spark), most or 16 * k
    points = points.select("in_id", "x", "y").dropna(subset=["x", "y"])
    # of targets on one spot only the k least ids can be among the nearest k
    spot = Window.partitionBy("nx", "ny").orderBy("near_id")
    targets = targets.dropna(subset=["nx", "ny"]).select(
        "near_id", F.col("nx").alias("x"), F.col("ny").alias("y"), F.row_number().over(spot).alias("spot_rank")
    ).filter(F.col("spot_rank") <= k).drop("spot_rank")
    points, targets = rounds.put("point", points), rounds.put("target", targets)
    x0, y0, x1, y1 = points.select("x", "y").union(targets.select("x", "y")).agg(
        F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    if x0 is None:
        x0 = y0 = x1 = y1 = 0.0
    width = max(x1 - x0, y1 - y0) or 1.0
    at = lambda c, low: F.least(F.floor((F.col(c) - low) / width * (1 << DEPTH)), F.lit((1 << DEPTH) - 1))
    points, targets = (side.withColumns({"ix": at("x", x0), "iy": at("y", y0)}) for side in (points, targets))
    zero = F.lit(0).cast("long")
    pairs = spark.range(1).select(*[zero.alias(c) for c in ("pc", "pr", "tc", "tr")], F.lit(float("inf")).alias("bound"))
    level, down, parts = 0, FIRST, []
    while True:
        level += down
        looked = rounds.put("pair", _next(pairs, points, targets, level, down, k, most), watch="not done")
        if level == DEPTH or not rounds.seen:
            parts.append(_met(looked, points, targets, level))
            break
        parts.append(_met(looked.filter("done"), points, targets, level))
        rounds.keep("pair")  # its finished part is read at the end
        pairs, down = looked.filter("not done").select("pc", "pr", "tc", "tr", "bound"), 1
    return reduce(DataFrame.unionByName, parts)


def _cell(side: str, level: int) -> Column:
    return F.shiftright(side, DEPTH - level)


def _cells(side: DataFrame, level: int, down: int, name: str) -> DataFrame:
    """The cells of a level: number, parent ``down`` levels above, count and box."""
    c, r = f"{name}c", f"{name}r"
    box = [f(v).alias(f"{name}{v}{n}") for v in ("x", "y") for n, f in ((0, F.min), (1, F.max))]
    cells = side.groupBy(_cell("ix", level).alias(f"_{c}"), _cell("iy", level).alias(f"_{r}")).agg(
        F.count(F.lit(1)).alias(f"{name}n"), *box)
    return cells.select("*", F.shiftright(f"_{c}", down).alias(c), F.shiftright(f"_{r}", down).alias(r))


def _next(pairs: DataFrame, points: DataFrame, targets: DataFrame, level: int, down: int, k: int, most: int) -> DataFrame:
    """The pairs of cells one step further down: ``pc, pr, tc, tr, bound, done``."""
    met = block_join(block_join(pairs, _cells(points, level, down, "p"), ["pc", "pr"], ["tc", "tr"]),
                 _cells(targets, level, down, "t"), ["tc", "tr"], ["_pc", "_pr"])
    apart = lambda v: F.greatest(F.col(f"t{v}0") - F.col(f"p{v}1"), F.col(f"p{v}0") - F.col(f"t{v}1"), F.lit(0.0))
    across = lambda v: F.greatest(F.col(f"t{v}1") - F.col(f"p{v}0"), F.col(f"p{v}1") - F.col(f"t{v}0"))
    extent = F.greatest(*[F.col(f"{n}{v}1") - F.col(f"{n}{v}0") for n in "pt" for v in "xy"])
    near = met.withColumn("least", F.sqrt(apart("x") ** 2 + apart("y") ** 2)).filter(
        F.col("least") <= F.col("bound") * SLACK).withColumn("greatest", F.sqrt(across("x") ** 2 + across("y") ** 2))
    # the kth nearest is no farther than the cells that hold the first k targets, in order of their far ends
    cell = Window.partitionBy("_pc", "_pr")
    upto = cell.orderBy("greatest", "_tc", "_tr").rowsBetween(Window.unboundedPreceding, 0)
    bound = F.min(F.when(F.col("held") >= k, F.col("greatest"))).over(cell)
    kept = near.withColumn("held", F.sum("tn").over(upto)).withColumn(
        "bound", F.coalesce(bound, F.lit(float("inf")))).filter(F.col("least") <= F.col("bound") * SLACK)
    # few targets are left, or there is nothing to tell apart
    done = (F.sum("tn").over(cell) <= most) | (F.max(extent).over(cell) <= 0)
    return kept.select(F.col("_pc").alias("pc"), F.col("_pr").alias("pr"), F.col("_tc").alias("tc"),
                       F.col("_tr").alias("tr"), "bound", done.alias("done"))


def _met(pairs: DataFrame, points: DataFrame, targets: DataFrame, level: int) -> DataFrame:
    """The points and targets of pairs of cells."""
    own = points.select("in_id", F.col("x").alias("px"), F.col("y").alias("py"),
                        _cell("ix", level).alias("pc"), _cell("iy", level).alias("pr"))
    far = targets.select("near_id", "x", "y", _cell("ix", level).alias("tc"), _cell("iy", level).alias("tr"))
    asked = block_join(own, pairs.select("pc", "pr", "tc", "tr"), ["pc", "pr"], ["in_id"])
    return block_join(asked, far, ["tc", "tr"], ["in_id"]).select("in_id", "px", "py", "near_id", "x", "y")


def block_join(left: DataFrame, right: DataFrame, keys: list[str], salt_by: list[str]) -> DataFrame:
    """Join on ``keys``, each of which has few rows in ``right`` but may be hot in ``left``."""
    hot = hot_keys(left, keys)
    if hot is None:
        return left.join(right, keys)
    dealt, copies = salted(left, right, keys, hot, salt_by)
    return dealt.join(copies.withColumnRenamed("_copy", "_salt"), [*keys, "_salt"]).drop("_salt")


def same_zone(near: DataFrame, points: DataFrame, targets: DataFrame) -> DataFrame:
    """Near pairs whose point and target lie in one zone; applied after the cut to ``k``."""
    from_zone = points.select(F.col("pointid").alias("in_id"), F.col("fzone").alias("in_zone"))
    to_zone = targets.select(F.col("pointid").alias("near_id"), F.col("fzone").alias("near_zone"))
    tagged = lookup(near.join(from_zone, "in_id", "left"), to_zone, "near_id", ["in_id"], "left")
    return tagged.filter(F.col("in_zone") == F.col("near_zone"))


def with_near_distance(points: DataFrame, near: DataFrame) -> DataFrame:
    """Bring each point's least remaining distance across; null where no pair remains."""
    least = near.groupBy(F.col("in_id").alias("pointid")).agg(F.min("near_dist").alias("near_dist"))
    return points.join(least, "pointid", "left")


def first_per_zone(points: DataFrame) -> DataFrame:
    """One minimum point per zone: the nearest to a pour point, missing distances last."""
    order = F.struct(
        F.col("near_dist").isNull().alias("missing"), F.col("near_dist"), F.col("pointid")
    )
    kept = [c for c in points.columns if c != "fzone"]
    return points.groupBy("fzone").agg(
        F.min_by(F.struct(*kept), order).alias("p")
    ).select("fzone", "p.*")
