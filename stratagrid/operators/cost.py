"""Least-cost distances and flow paths inside the window of each point."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratagrid.grid import DIRECTIONS, GridSpec
from stratagrid.operators import kernels
from stratagrid.operators.groups import map_groups
from stratagrid.operators.windows import is_packed, map_windows

STEP_COL, STEP_ROW = np.zeros(129, dtype=np.int64), np.zeros(129, dtype=np.int64)
for _code, _dc, _dr in DIRECTIONS:
    STEP_COL[_code], STEP_ROW[_code] = _dc, _dr


def _surfaces(cells: pd.DataFrame, straight: float, diagonal: float, to_target: bool = False):
    """Cost and back-link grids of the windows in a batch, each centred on its start.

    Returns the position (window, row, col) of every cell, the grids, and their half-width.
    """
    window = cells.groupby("id", sort=False).ngroup().to_numpy()
    dc = (cells["col"] - cells["start_col"]).to_numpy()
    dr = (cells["row"] - cells["start_row"]).to_numpy()
    half = int(max(np.abs(dc).max(), np.abs(dr).max()))
    at = (window, dr + half, dc + half)
    height = np.full((window.max() + 1, 2 * half + 1, 2 * half + 1), np.nan)
    height[at] = cells["z"].to_numpy(dtype=float)
    height[~(height > 0)] = np.nan  # costs must be positive
    centre = np.full(len(height), half)
    target = None
    if to_target:
        target = np.zeros(height.shape, dtype=bool)
        target[at] = cells["target"].to_numpy(dtype=bool)
    cost, back = kernels.cost_surfaces(height, (centre, centre), DIRECTIONS, straight, diagonal, target)
    return at, cost, back, half


def cost_distance(windows: DataFrame, grid: GridSpec, straight: float = 1.0,
                  diagonal: float = math.sqrt(2.0), is_spread: bool = False) -> DataFrame:
    """Cost and back link of every reachable window cell: ``(id, col, row, cost, back)``.

    ``windows`` is ``(id, start_col, start_row, col, row, z)``, a row per cell or pieces of arrays
    (``windows.cut``).  One step costs the mean of the two elevations times its length.  A window is bounded by the buffer, so all points run
    in parallel and each window lies in one task.
    """
    straight, diagonal = straight * grid.cell, diagonal * grid.cell

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        at, cost, back, _ = _surfaces(cells, straight, diagonal)
        out = cells[["id", "col", "row"]].assign(cost=cost[at], back=back[at])
        return out[np.isfinite(out["cost"])]

    needed = windows.select("id", "start_col", "start_row", "col", "row", "z")
    schema = "id long, col long, row long, cost double, back long"
    return map_windows(needed, run, schema) if is_packed(windows) else map_groups(needed, ["id"], run, schema, is_spread)


def flow_paths(windows: DataFrame, grid: GridSpec, straight: float = 1.0,
               diagonal: float = math.sqrt(2.0), is_spread: bool = False, radius: float | None = None) -> DataFrame:
    """Least-cost path from each point to its cheapest target cell: ``(id, step, col, row, cost)``.

    Rows of ``windows`` also have the boolean ``target``; in pieces the targets are those of
    ``mark_targets`` in the circle of ``radius``.  One path per point, ties by least cell id.  Points
    without a reachable target have no path.
    """
    straight, diagonal = straight * grid.cell, diagonal * grid.cell

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        at, cost, back, half = _surfaces(cells, straight, diagonal, to_target=True)
        reached = cells.assign(window=at[0], r=at[1], c=at[2], cost=cost[at])
        reached = reached[reached["target"] & np.isfinite(reached["cost"])]
        ends = reached.sort_values(["window", "cost", "row", "col"]).drop_duplicates("window")
        # all paths of the batch walk back together, one step at a time
        w, r, c = ends["window"].to_numpy(), ends["r"].to_numpy(), ends["c"].to_numpy()
        walked = []
        while len(w):
            walked.append(pd.DataFrame({"window": w, "r": r, "c": c, "cost": cost[w, r, c]}))
            code = back[w, r, c]
            on = code > 0
            w, code = w[on], code[on]
            r, c = r[on] + STEP_ROW[code], c[on] + STEP_COL[code]
        names = ["id", "step", "col", "row", "cost"]
        if not walked:
            return pd.DataFrame({name: [] for name in names})
        path = pd.concat(walked, keys=range(len(walked)), names=["hop"]).reset_index("hop")
        path["step"] = path.groupby("window")["hop"].transform("max") - path["hop"]
        starts = cells.assign(window=at[0]).drop_duplicates("window")[
            ["window", "id", "start_col", "start_row"]
        ]
        path = path.merge(starts, on="window")
        path["col"] = path["c"] - half + path["start_col"]
        path["row"] = path["r"] - half + path["start_row"]
        return path[names]

    schema = "id long, step long, col long, row long, cost double"
    if is_packed(windows):
        needed = windows.select("id", "px", "py", "start_col", "start_row", "own_zone", "col", "row", "z", "zone")
        return map_windows(needed, lambda cells: run(mark_targets(cells, radius, grid)), schema)
    needed = windows.select("id", "start_col", "start_row", "col", "row", "z", "target")
    return map_groups(needed, ["id"], run, schema, is_spread)


def mark_targets(cells: pd.DataFrame, radius: float, grid: GridSpec, tolerance: float = 0.001) -> pd.DataFrame:
    """``flow_targets`` on the cells of whole windows inside a task."""
    dx = grid.x0 + (cells["col"].to_numpy() + 0.5) * grid.cell - cells["px"].to_numpy()
    dy = grid.y0 - (cells["row"].to_numpy() + 0.5) * grid.cell - cells["py"].to_numpy()
    in_zone = cells["zone"].to_numpy() == cells["own_zone"].to_numpy()
    if "zone_known" in cells:
        in_zone &= cells["zone_known"].to_numpy()
    is_open = (dx * dx + dy * dy <= float(radius) * radius) & ~in_zone
    z, window = cells["z"].to_numpy(), cells.groupby("id", sort=False).ngroup().to_numpy()
    lowest = np.full(window.max() + 1, np.inf)
    np.minimum.at(lowest, window[is_open], z[is_open])
    return cells.assign(target=is_open & (np.abs(z - lowest[window]) < tolerance))


def flow_targets(windows: DataFrame, in_circle: Column, tolerance: float = 0.001) -> DataFrame:
    """Flag the target cells of each window.

    Targets lie in the circle, outside the point's own zone (no zone counts as outside), and
    within ``tolerance`` of the least elevation there.  ``windows`` has ``zone`` and ``own_zone``.
    """
    open_cell = in_circle & ~F.col("zone").eqNullSafe(F.col("own_zone"))
    lowest = F.min(F.when(open_cell, F.col("z"))).over(Window.partitionBy("id"))  # one bounded window
    return windows.withColumn("_open", open_cell).withColumn("_low", lowest).withColumn(
        "target", F.coalesce(F.col("_open") & (F.abs(F.col("z") - F.col("_low")) < tolerance), F.lit(False))
    ).drop("_open", "_low")


def path_lines(paths: DataFrame, grid: GridSpec, *carried: str) -> DataFrame:
    """One polyline per point through the path's cell centres."""
    return paths.groupBy("id", *carried).agg(F.sort_array(F.collect_list(
        F.struct("step", grid.x().alias("x"), grid.y().alias("y"))
    )).alias("v")).select(
        "id", *carried, F.transform("v", lambda p: F.struct(p.x.alias("x"), p.y.alias("y"))).alias("line")
    )
