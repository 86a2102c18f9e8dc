"""Raster blocks as dense arrays inside a task: one block with a margin of its neighbours' cells.

A raster is shuffled once, with copies of the cells near block borders only; a step then sees every
block whole and works on arrays, whatever the order in which the raster was stored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratagrid.grid import DIRECTIONS, GridSpec, with_halo
from stratagrid.operators.groups import spread

HALF = (1, 2, 4, 8)  # directions that lead to a greater cell id


class Patch:
    """Cells of one block: flat arrays of a square that is ``margin`` cells wider on every side.

    ``known`` marks cells that exist, ``core`` those of the block itself; ``cells`` are the positions of
    the core cells in row order, ``positions`` those of the table's rows.  A step in direction ``code`` adds ``offset[code]`` to a position.
    """

    def __init__(self, table: pa.Table, grid: GridSpec, margin: int):
        self.table, self.grid, self.margin = table, grid, margin
        self.bc, self.br = table["bc"][0].as_py(), table["br"][0].as_py()
        self.width = grid.block + 2 * margin
        self.col0, self.row0 = self.bc * grid.block - margin, self.br * grid.block - margin
        self.positions = (table["row"].to_numpy() - self.row0) * self.width + table["col"].to_numpy() - self.col0
        self.known = np.zeros(self.width * self.width, bool)
        self.known[self.positions] = True
        inner = np.zeros((self.width, self.width), bool)
        inner[margin:self.width - margin, margin:self.width - margin] = True
        self.core = self.known & inner.reshape(-1)
        self.cells = np.flatnonzero(self.core)
        self.offset = {code: dr * self.width + dc for code, dc, dr in DIRECTIONS}

    def dense(self, name: str) -> np.ndarray:
        """A column as an array, zero where no cell is known."""
        values = self.table[name].to_numpy()
        out = np.zeros(len(self.known), values.dtype)
        out[self.positions] = values
        return out

    def col(self, at: np.ndarray) -> np.ndarray:
        return at % self.width + self.col0

    def row(self, at: np.ndarray) -> np.ndarray:
        return at // self.width + self.row0

    def cell_id(self, at: np.ndarray) -> np.ndarray:
        return self.row(at) * self.grid.ncol + self.col(at)


def map_patches(cells: DataFrame, grid: GridSpec, step: Callable[[Patch], pa.Table], schema: str,
                margin: int = 1) -> DataFrame:
    """Apply ``step`` to every block of a raster without nulls.

    One shuffle of the raster and its block margins; a group is one block, bounded by its size.
    """
    def run(table: pa.Table) -> pa.Table:
        patch = Patch(table, grid, margin)
        return step(patch)

    return spread(with_halo(cells, grid, margin).drop("core"), "bc", "br").groupBy("bc", "br").applyInArrow(run, schema)
