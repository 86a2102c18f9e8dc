"""The raster grid: cell keys, block keys, neighbour offsets.

A raster is a DataFrame with one row per cell, keyed by ``col`` and ``row`` (row 0 is the
north edge).  An absent row, or a null value, is NoData.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# D8 direction codes with their (column, row) steps.
DIRECTIONS = (
    (1, 1, 0), (2, 1, 1), (4, 0, 1), (8, -1, 1),
    (16, -1, 0), (32, -1, -1), (64, 0, -1), (128, 1, -1),
)


@dataclass(frozen=True)
class GridSpec:
    """Extent, cell size and block size of a raster; passed explicitly to every operator."""

    ncol: int
    nrow: int
    cell: float = 1.0
    x0: float = 0.0
    y0: float = 0.0
    block: int = 256

    def cell_id(self, col: Column | str = "col", row: Column | str = "row") -> Column:
        return _col(row) * F.lit(self.ncol) + _col(col)

    def x(self, col: Column | str = "col") -> Column:
        return F.lit(self.x0) + (_col(col) + F.lit(0.5)) * F.lit(self.cell)

    def y(self, row: Column | str = "row") -> Column:
        return F.lit(self.y0) - (_col(row) + F.lit(0.5)) * F.lit(self.cell)

    def col_at(self, x: Column | str = "x") -> Column:
        return F.floor((_col(x) - F.lit(self.x0)) / F.lit(self.cell)).cast("long")

    def row_at(self, y: Column | str = "y") -> Column:
        return F.floor((F.lit(self.y0) - _col(y)) / F.lit(self.cell)).cast("long")

    def inside(self, col: Column | str = "col", row: Column | str = "row") -> Column:
        return _col(col).between(0, self.ncol - 1) & _col(row).between(0, self.nrow - 1)

    def block_col(self, col: Column | str = "col") -> Column:
        return F.floor(_col(col) / F.lit(self.block)).cast("long")

    def block_row(self, row: Column | str = "row") -> Column:
        return F.floor(_col(row) / F.lit(self.block)).cast("long")

    def on_block_rim(self) -> Column:
        """True for cells that touch the border of their block."""
        last = self.block - 1
        return (
            F.pmod("col", F.lit(self.block)).isin(0, last)
            | F.pmod("row", F.lit(self.block)).isin(0, last)
        )


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def steps(codes=None, centre: bool = False) -> Column:
    """Array literal of ``(code, dc, dr)`` structs, optionally only for some direction codes."""
    wanted = [d for d in DIRECTIONS if codes is None or d[0] in codes]
    listed = ([(0, 0, 0)] if centre else []) + wanted
    return F.expr("array({})".format(", ".join(
        f"named_struct('code', {code}, 'dc', {dc}, 'dr', {dr})" for code, dc, dr in listed
    )))


def neighbourhood(cells: DataFrame, values: list[str], codes=None) -> DataFrame:
    """One row per cell with its values and its neighbours' values ``<name>_<code>`` (null if absent).

    Every cell sends its values to itself and its neighbours and the copies meet in one grouped
    ``max`` (one copy per direction).  Partial aggregation folds the copies of cells that lie in
    the same input partition before the shuffle, so a raster stored in spatial order shuffles
    about one row per cell, and the whole stencil stays in hash aggregation and code generation.
    Cells whose first value is null are NoData.
    """
    sent = (
        cells.select("col", "row", *values)
        .filter(F.col(values[0]).isNotNull())
        .withColumn("s", F.explode(steps(codes, centre=True)))
        .selectExpr("col - s.dc as col", "row - s.dr as row", "s.code as code", *values)
    )
    sides = [("", 0)] + [(f"_{d[0]}", d[0]) for d in DIRECTIONS if codes is None or d[0] in codes]
    met = sent.groupBy("col", "row").agg(*[
        F.expr(f"max(if(code = {code}, {name}, null)) as {name}{suffix}")
        for name in values for suffix, code in sides
    ])
    return met.filter(F.col(values[0]).isNotNull())


def with_halo(cells: DataFrame, grid: GridSpec, margin: int = 1) -> DataFrame:
    """Give every cell its block key and copy cells near a border into the blocks beyond it.

    Adds ``bc``, ``br`` and ``core`` (false for a copy).  Only cells within ``margin`` of a border (at
    most a block) are copied, so the result is about ``1 + 4 * margin / block`` times the input.
    """
    def touched(axis: str) -> str:
        near = ", ".join(f"floor(({axis} + {step}) / {grid.block})" for step in (-margin, 0, margin))
        return f"explode(array_distinct(array({near})))"

    return cells.selectExpr("*", f"{touched('col')} as bc").selectExpr(
        "*", f"{touched('row')} as br"
    ).selectExpr("*", f"bc = floor(col / {grid.block}) and br = floor(row / {grid.block}) as core")


def with_block(cells: DataFrame, grid: GridSpec) -> DataFrame:
    return cells.selectExpr(
        "*", f"floor(col / {grid.block}) as bc", f"floor(row / {grid.block}) as br"
    )


def with_tile(cells: DataFrame, grid: GridSpec, tile_blocks: int) -> DataFrame:
    """Adds the key of the stored tile, ``tile_blocks`` blocks wide."""
    wide = grid.block * tile_blocks
    return cells.selectExpr(
        "*", f"cast(floor(col / {wide}) as int) as tile_col", f"cast(floor(row / {wide}) as int) as tile_row")
