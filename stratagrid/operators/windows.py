"""Square windows round points, cut from packed raster blocks.

A raster block travels as one row of arrays.  Points of a block meet it once, and each point takes the
rectangle it needs: what is shuffled by point is one piece per block touched, never a row per cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from stratagrid.grid import GridSpec, with_block
from stratagrid.operators.groups import spread
from stratagrid.operators.vector import touched_blocks
from stratagrid.scratch import lookup, materialize

CELLS_AT_ONCE = 1 << 20  # cells that the points of one group cut at most from their block
KEYS = ["bc", "br"]


def packed_blocks(rasters: dict[str, DataFrame], grid: GridSpec) -> DataFrame:
    """One row per block ``(bc, br, col, row, values...)`` of arrays, cells in row order.

    The first raster says which cells exist; the others are looked up in it, null where they have none.
    Rasters meet by block, not by cell.
    """
    names = list(rasters)
    rows = None
    for n, (name, raster) in enumerate(rasters.items()):
        kinds = {m: rasters[m].schema[m].dataType for m in names}
        side = raster.filter(F.col(name).isNotNull()).select(
            "col", "row", F.lit(n).alias("which"),
            *[F.col(m) if m == name else F.lit(None).cast(kinds[m]).alias(m) for m in names])
        rows = side if rows is None else rows.unionByName(side)
    block = grid.block

    def pack(table: pa.Table) -> pa.Table:
        bc, br = table["bc"][0].as_py(), table["br"][0].as_py()
        at = (table["row"].to_numpy() - br * block) * block + table["col"].to_numpy() - bc * block
        which = table["which"].to_numpy()
        found = np.full((len(names), block * block), -1)
        found[which, at] = np.arange(len(at))
        cells = np.flatnonzero(found[0] >= 0)
        out = {"bc": pa.array([bc]), "br": pa.array([br])}
        lists = {"col": pa.array((cells % block + bc * block).astype(np.int32)),
                 "row": pa.array((cells // block + br * block).astype(np.int32))}
        for n, name in enumerate(names):
            take = found[n][cells]
            lists[name] = table[name].combine_chunks().take(pa.array(take, mask=take < 0))
        return pa.table({**out, **{k: pa.ListArray.from_arrays(pa.array([0, len(cells)], pa.int32()), v)
                                   for k, v in lists.items()}})

    values = ", ".join(f"{name} array<{rasters[name].schema[name].dataType.simpleString()}>" for name in names)
    return spread(with_block(rows, grid), *KEYS).groupBy(*KEYS).applyInArrow(
        pack, f"bc long, br long, col array<int>, row array<int>, {values}")


def cut(points: DataFrame, rasters: dict[str, DataFrame], half_width: float, grid: GridSpec) -> DataFrame:
    """Pieces ``(point columns, col, row, values...)`` of the square round each point, cells as arrays.

    ``points`` is ``(id, px, py, ...)`` with a unique id.  A point has one piece per block that its square
    touches.  A block with many points is copied to several groups of them.
    """
    names = ["col", "row", *rasters]
    carried = points.columns
    near = materialize(touched_blocks(points, half_width, grid, "px", "py").withColumn("block", F.struct(*KEYS)))
    window = int(2 * half_width / grid.cell) + 2
    most = max(1, CELLS_AT_ONCE // min(grid.block, window) ** 2)
    parts = materialize(near.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).alias("parts")))
    dealt = lookup(near, parts, "block", "id").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).select(
        *carried, *KEYS, "part")
    blocks = packed_blocks(rasters, grid).join(parts.select("block.*", "parts"), KEYS).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")

    def pieces(here: pa.Table, block: pa.Table) -> pa.Table:
        here = here.slice(0, here.num_rows if block.num_rows else 0)
        flat = {name: pc.list_flatten(block[name]).combine_chunks() for name in names}
        taken, ends = [np.zeros(0, np.int64)], [0]
        if here.num_rows:
            size = grid.block
            c0, r0 = block["bc"][0].as_py() * size, block["br"][0].as_py() * size
            number = np.full((size, size), -1)
            number[flat["row"].to_numpy() - r0, flat["col"].to_numpy() - c0] = np.arange(len(flat["col"]))
            xs = grid.x0 + (c0 + np.arange(size) + 0.5) * grid.cell
            ys = grid.y0 - (r0 + np.arange(size) + 0.5) * grid.cell
            for px, py in zip(here["px"].to_numpy(), here["py"].to_numpy()):
                cols, rows = np.abs(xs - px) <= half_width, np.abs(ys - py) <= half_width
                inside = number[rows][:, cols].reshape(-1)
                taken.append(inside[inside >= 0])
                ends.append(ends[-1] + len(taken[-1]))
        take, bounds = pa.array(np.concatenate(taken)), pa.array(ends, pa.int32())
        out = pa.table({**{c: here[c] for c in carried},
                        **{k: pa.ListArray.from_arrays(bounds, v.take(take)) for k, v in flat.items()}})
        return out.filter(pc.greater(pc.list_value_length(out["col"]), 0))

    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema]
                      + ["col array<int>", "row array<int>"]
                      + [f"{n} array<{r.schema[n].dataType.simpleString()}>" for n, r in rasters.items()])
    keys = [*KEYS, "part"]
    return spread(dealt, *keys).groupBy(*keys).cogroup(spread(blocks, *keys).groupBy(*keys)).applyInArrow(pieces, kinds)


def is_packed(windows: DataFrame) -> bool:
    return isinstance(windows.schema["col"].dataType, ArrayType)


def _cells(pieces: pa.Table) -> pd.DataFrame:
    """Pieces as one row per cell; nulls of a value become its ``<name>_known`` flag."""
    counts = pc.list_value_length(pieces["col"]).to_numpy()
    out = {}
    for name, column in zip(pieces.column_names, pieces.columns):
        if pa.types.is_list(column.type):
            flat = pc.list_flatten(column).combine_chunks()
            if flat.null_count:
                out[f"{name}_known"] = flat.is_valid().to_numpy(zero_copy_only=False)
                flat = flat.fill_null(0)
            out[name] = flat.to_numpy(zero_copy_only=False)
        else:
            out[name] = np.repeat(column.to_numpy(), counts)
    for name in ("col", "row"):
        out[name] = out[name].astype(np.int64)
    return pd.DataFrame(out)


def _whole_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of pieces sorted by id, cut again so that no window is split."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        ids = table["id"].to_numpy()
        if held and held[-1]["id"][-1].as_py() != ids[0]:
            yield pa.concat_tables(held)
            held = []
        last = int(np.flatnonzero(ids != ids[-1])[-1]) + 1 if (ids != ids[-1]).any() else 0
        if last:
            yield pa.concat_tables([*held, table.slice(0, last)])
            held = []
        held.append(table.slice(last))
    if held:
        yield pa.concat_tables(held)


def map_windows(pieces: DataFrame, step: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``step`` to the cells of whole windows, some windows at a time.

    One shuffle of the pieces by ``id``; a task holds one Arrow batch, whose bytes Spark bounds, and a window.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_windows(batches):
            out = step(_cells(table))
            if len(out):
                yield from pa.Table.from_pandas(out, preserve_index=False).to_batches(CELLS_AT_ONCE)

    return spread(pieces, "id").sortWithinPartitions("id").mapInArrow(run, schema)


def window_rows(pieces: DataFrame) -> DataFrame:
    """One row per window cell; for results that are rows themselves."""
    lists = [f.name for f in pieces.schema if isinstance(f.dataType, ArrayType)]
    others = [c for c in pieces.columns if c not in lists]
    opened = pieces.select(*others, F.explode(F.arrays_zip(*lists)).alias("cell"))
    return opened.select(*others, F.col("cell.col").cast("long").alias("col"), F.col("cell.row").cast("long").alias("row"),
                         *[F.col(f"cell.{n}").alias(n) for n in lists if n not in ("col", "row")])
