"""Connected regions: region group, raster to polygon, single parts, dissolve."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratagrid.grid import DIRECTIONS, GridSpec, steps, with_block
from stratagrid.operators import kernels
from stratagrid.operators.graph import connect
from stratagrid.operators.groups import map_groups, spread
from stratagrid.scratch import Rounds, materialize

# half of each neighbourhood is enough to meet every pair once
HALF_STEPS = {4: (1, 4), 8: (1, 2, 4, 8)}


def _labeller(neighbours: int, value: str | None, keys: list[str]):
    offsets = [(dc, dr) for code, dc, dr in DIRECTIONS if code in HALF_STEPS[neighbours]]

    def label(cells: pd.DataFrame) -> pd.DataFrame:
        group = cells.groupby(keys, sort=False).ngroup().to_numpy() if keys else None
        order = ["_group", "row", "col"] if keys else ["row", "col"]
        cells = (cells.assign(_group=group) if keys else cells).sort_values(order, ignore_index=True)
        u, v = kernels.adjacent_pairs(
            cells["col"].to_numpy(), cells["row"].to_numpy(), offsets,
            cells["_group"].to_numpy() if keys else None,
        )
        if value is not None:
            values = cells[value].to_numpy()
            same = values[u] == values[v]
            u, v = u[same], v[same]
        root = kernels.least_labels(len(cells), u, v)
        cells["component"] = cells["cell_id"].to_numpy()[root]
        return cells.drop(columns="_group") if keys else cells

    return label


def _with_component(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("component", T.LongType())])


def group_components(cells: DataFrame, keys: list[str], grid: GridSpec, value: str | None = None,
                     neighbours: int = 4) -> DataFrame:
    """Components inside groups that are small by construction, such as one structure's buffer.

    Adds ``component``, the least cell id of the part.  With ``value``, cells join only when
    their values are equal.
    """
    cells = cells.withColumn("cell_id", grid.cell_id())
    return map_groups(
        cells, keys, _labeller(neighbours, value, keys), _with_component(cells.schema)
    ).drop("cell_id")


def components(cells: DataFrame, grid: GridSpec, value: str | None = None,
               neighbours: int = 8) -> DataFrame:
    """Components of a whole raster; adds ``component``, the least cell id of the region.

    Blocks are labelled on their own, in one shuffle.  Only cells on block rims then look for
    neighbours in other blocks, and the loop runs on that much smaller graph of labels.
    """
    cells = cells.withColumn("cell_id", grid.cell_id())
    labelled = materialize(
        spread(with_block(cells, grid), "bc", "br").groupBy("bc", "br").applyInPandas(
            _block_labeller(neighbours, value), _with_component(cells.schema)
        )
    )
    rim = labelled.filter(grid.on_block_rim()).select(
        "col", "row", F.col("component").alias("a"),
        F.lit(0).alias("value") if value is None else F.col(value).alias("value"),
    )
    reach = rim.withColumn("s", F.explode(steps(HALF_STEPS[neighbours]))).select(
        (F.col("col") + F.col("s.dc")).alias("col"), (F.col("row") + F.col("s.dr")).alias("row"),
        F.col("a").alias("b"), "value", grid.block_col().alias("bc"), grid.block_row().alias("br"),
    ).filter((grid.block_col() != F.col("bc")) | (grid.block_row() != F.col("br")))
    crossing = rim.join(reach, ["col", "row", "value"]).select("a", "b")
    merged = connect(crossing, Rounds(cells.sparkSession))
    # a local label belongs to one block, so no key of this join is hot
    named = merged.select(F.col("node").alias("component"), F.col("root"))
    return labelled.join(named, "component", "left").withColumn(
        "component", F.coalesce("root", "component")
    ).drop("root", "cell_id")


def _block_labeller(neighbours: int, value: str | None):
    label = _labeller(neighbours, value, [])

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        return label(cells.drop(columns=["bc", "br"]))

    return run
