"""Depression filling, flow direction, flow accumulation, fill zones."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagrid.grid import DIRECTIONS, GridSpec, neighbourhood, with_block
from stratagrid.operators import kernels
from stratagrid.operators.groups import spread
from stratagrid.operators.graph import resolve, spill_levels, subtree_sums
from stratagrid.operators.patches import HALF, Patch, map_patches
from stratagrid.scratch import Rounds, materialize

OUTSIDE = -1  # the node beyond the raster's edge
NOWHERE = -2  # "next" of a row that only brings weight
_NUMPY = {"smallint": "int16", "int": "int32", "bigint": "int64", "float": "float32", "double": "float64"}
ALL_CODES = [code for code, _, _ in DIRECTIONS]


def _chain_ends(cells: pd.DataFrame) -> pd.DataFrame:
    """Where each cell's pointer chain leaves the block, or the cell where it ends inside."""
    cells = cells.sort_values("cell_id", ignore_index=True)
    nxt = cells["next"].to_numpy()
    last = kernels.jump(kernels.local_pointers(cells["cell_id"].to_numpy(), nxt))
    cells["exit"] = nxt[last]
    return cells.drop(columns=["bc", "br", "next"])


def _drainage(dem: DataFrame, grid: GridSpec, rounds: Rounds) -> tuple[DataFrame, DataFrame]:
    """Way down from every cell, lowest neighbour first.

    Returns the cells ``(col, row, z, rim, cell_id, exit)``, where ``exit`` is the end of the chain
    inside the block or the first cell beyond it, and ``(exit, pit)`` for the exits that lie
    beyond a block: only those take part in the distributed pointer loop.
    """
    around = neighbourhood(dem, ["z"])
    # a cell id belongs to each neighbour by its step; the least (z, id) is the way down
    ways = [F.struct("z", grid.cell_id().alias("id"))] + [
        F.when(F.col(f"z_{code}").isNotNull(), F.struct(
            F.col(f"z_{code}").alias("z"),
            grid.cell_id(F.col("col") + dc, F.col("row") + dr).alias("id"),
        ))
        for code, dc, dr in DIRECTIONS
    ]
    rim = F.lit(False)
    for code in ALL_CODES:
        rim = rim | F.col(f"z_{code}").isNull()
    down = around.select(
        "col", "row", "z", rim.alias("rim"), grid.cell_id().alias("cell_id"),
        F.least(*ways)["id"].alias("next"),
    )
    schema = _replace_column(down, "next", "exit long")
    local = materialize(
        spread(with_block(down, grid), "bc", "br").groupBy("bc", "br").applyInPandas(_chain_ends, schema)
    )
    entries = local.filter(_crosses(grid)).select(F.col("exit").alias("cell_id")).distinct()
    # a cell that is entered from another block touches its border
    pointers = local.filter(grid.on_block_rim()).select("cell_id", "exit").join(entries, "cell_id", "left_semi").select(
        F.col("cell_id").alias("node"), F.col("exit").alias("root")
    )
    pits = resolve(pointers, rounds).select(F.col("node").alias("exit"), F.col("root").alias("pit"))
    return local, pits


def basins(dem: DataFrame, grid: GridSpec) -> DataFrame:
    """``(col, row, z, basin)``: the pit that each cell drains to."""
    local, pits = _drainage(dem, grid, Rounds(dem.sparkSession))
    # at most the cells of the neighbouring blocks share one exit, so this join has no hot key
    return local.join(pits, "exit", "left").select(
        "col", "row", "z", F.coalesce("pit", "exit").alias("basin")
    )


def _replace_column(df: DataFrame, name: str, ddl: str) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != name]
    return ", ".join(fields + [ddl])


def _crosses(grid: GridSpec):
    """True where ``exit`` lies in another block than the cell."""
    width = F.lit(grid.ncol)
    exit_col, exit_row = F.pmod("exit", width), F.floor(F.col("exit") / width)
    return (grid.block_col() != grid.block_col(exit_col)) | (
        grid.block_row() != grid.block_row(exit_row)
    )


def _steepest(patch: Patch, z: np.ndarray) -> np.ndarray:
    """Way down from every core cell inside its block: the least (height, id) of it and its neighbours."""
    low, to = z[patch.cells], patch.cells
    for step in patch.offset.values():
        near = patch.cells + step
        better = patch.core[near] & ((z[near] < low) | ((z[near] == low) & (near < to)))
        low, to = np.where(better, z[near], low), np.where(better, near, to)
    return to


def _least_by_pair(a: np.ndarray, b: np.ndarray, w: np.ndarray):
    """The least ``w`` of every (a, b)."""
    order = np.lexsort((w, b, a))
    a, b, w = a[order], b[order], w[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[first], b[first], w[first]


TREE, CROSSING, MEMBER, BLOCK = range(4)  # kinds of rows that a block hands on


def _block_levels(patch: Patch) -> pa.Table:
    """What one block knows about filling.

    Basins of the block and the lowest heights between them shrink to a tree between the basins that
    touch another block and the outside (``TREE``).  ``CROSSING`` rows lead from such a basin to a cell
    beyond the border, ``MEMBER`` rows tell the basin of a cell at the border.  The ``BLOCK`` row keeps
    cells, basins and the whole tree packed for the last pass.
    """
    z, cells = patch.dense("z"), patch.cells
    number = np.zeros(len(z), np.int64)
    number[cells] = np.arange(len(cells))
    root = kernels.jump(number[_steepest(patch, z)])
    pits, basin = np.unique(root, return_inverse=True)
    label = np.zeros(len(z), np.int64)
    label[cells] = basin
    pit_id, n = patch.cell_id(cells[pits]), len(pits)

    sides, crossing = [], []
    at_edge, at_border = np.zeros(len(cells), bool), np.zeros(len(cells), bool)
    for code, step in patch.offset.items():
        near = cells + step
        at_edge |= ~patch.known[near]
        beyond = patch.known[near] & ~patch.core[near]
        at_border |= beyond
        if code not in HALF:
            continue
        u, v = cells[beyond], near[beyond]
        crossing.append((label[u], patch.cell_id(v), np.maximum(z[u], z[v])))
        apart = patch.core[near] & (label[near] != basin)
        u, v = cells[apart], near[apart]
        sides.append((np.minimum(label[u], label[v]), np.maximum(label[u], label[v]), np.maximum(z[u], z[v])))
    edge = cells[at_edge]
    sides.append((label[edge], np.full(len(edge), n), z[edge]))  # node n is the outside
    a, b, w = _least_by_pair(*map(np.concatenate, zip(*sides)))
    terminal = np.zeros(n + 1, bool)
    terminal[label[cells[at_border]]] = True
    terminal[n] = len(edge) > 0
    tree, between = kernels.spanning_tree(n + 1, a, b, w, terminal)

    name = np.append(pit_id, OUTSIDE)
    joins = np.array(between, np.int64).reshape(-1, 3)
    cu, cv, cw = _least_by_pair(*map(np.concatenate, zip(*crossing)))
    border = cells[at_border]
    kinds = np.repeat([TREE, CROSSING, MEMBER, BLOCK], [len(joins), len(cu), len(border), 1])
    filler = np.zeros(1, np.int64)
    packed = {"cells": cells.astype(np.int32), "z": z[cells], "label": basin.astype(np.int32), "pits": pit_id,
              "tree_a": a[tree].astype(np.int32), "tree_b": b[tree].astype(np.int32), "tree_w": w[tree]}
    return pa.table({
        "kind": pa.array(kinds, pa.int32()), "bc": pa.array(np.full(len(kinds), patch.bc)),
        "br": pa.array(np.full(len(kinds), patch.br)),
        "a": pa.array(np.concatenate([name[joins[:, 1]], pit_id[cu], patch.cell_id(border), filler])),
        "b": pa.array(np.concatenate([name[joins[:, 2]], cv, pit_id[label[border]], filler])),
        "w": pa.array(np.concatenate([w[joins[:, 0]], cw, z[border], filler.astype(z.dtype)])),
        **{key: pa.array([None] * (len(kinds) - 1) + [values.tobytes()], pa.binary()) for key, values in packed.items()},
    })


def _filled_cells(grid: GridSpec, kind: np.dtype):
    """Last pass over one block: levels of its border basins run down its tree to all basins."""
    names = {"z": kind, "pits": np.int64, "tree_w": kind, "cells": np.int32, "label": np.int32, "tree_a": np.int32,
             "tree_b": np.int32}

    def run(block: pa.Table, levels: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({"col": pa.array([], pa.int64()), "row": pa.array([], pa.int64()),
                             "z": pa.array([], pa.from_numpy_dtype(kind)), "fill": pa.array([], pa.from_numpy_dtype(kind))})
        part = {key: np.frombuffer(block[key][0].as_py(), of) for key, of in names.items()}
        n = len(part["pits"])
        border = np.searchsorted(part["pits"], levels["node"].to_numpy())
        sources = [*zip(levels["level"].to_numpy().tolist(), border.tolist()), (float("-inf"), n)]
        reached = kernels.flood_tree(n + 1, part["tree_a"], part["tree_b"], part["tree_w"], sources)
        level = np.array(reached[:n], kind)
        width = grid.block + 2
        return pa.table({
            "col": pa.array(part["cells"] % width - 1 + block["bc"][0].as_py() * grid.block, pa.int64()),
            "row": pa.array(part["cells"] // width - 1 + block["br"][0].as_py() * grid.block, pa.int64()),
            "z": pa.array(part["z"]), "fill": pa.array(np.maximum(part["z"], level[part["label"]])),
        })

    return run


def rim_graph(blocks: DataFrame) -> DataFrame:
    """Edges ``(a, b, w)`` between the basins that touch a block border, and the outside."""
    # a cell at a border lies in one basin, so no key is hot
    member = blocks.filter(F.col("kind") == MEMBER).select(F.col("a").alias("cell"), F.col("b").alias("other"))
    crossing = blocks.filter(F.col("kind") == CROSSING).select("a", F.col("b").alias("cell"), "w")
    return crossing.join(member, "cell").select("a", F.col("other").alias("b"), "w").unionByName(
        blocks.filter(F.col("kind") == TREE).select("a", "b", "w"))


def fill(dem: DataFrame, grid: GridSpec) -> DataFrame:
    """Depression-free surface: ``(col, row, z, fill)``, no depth limit.

    Every block finds its own basins and hands on only a tree between those that touch its border; the
    distributed loop finds their levels on that rim graph, and one more pass over the packed blocks
    brings the levels to all basins.  The raster is shuffled twice, the loop's size follows block rims.
    """
    spark = dem.sparkSession
    z_type = dem.schema["z"].dataType.simpleString()
    packed = ", ".join(f"{c} binary" for c in ("cells", "z", "label", "pits", "tree_a", "tree_b", "tree_w"))
    blocks = materialize(map_patches(
        dem.filter("z is not null").select("col", "row", "z"), grid, _block_levels,
        f"kind int, bc long, br long, a long, b long, w {z_type}, {packed}"))
    levels = spill_levels(rim_graph(blocks), OUTSIDE, Rounds(spark))
    col, row = F.pmod("node", F.lit(grid.ncol)), F.floor(F.col("node") / F.lit(grid.ncol))
    placed = levels.select(grid.block_col(col).alias("bc"), grid.block_row(row).alias("br"), "node", "level")
    whole = blocks.filter(F.col("kind") == BLOCK).drop("kind", "a", "b", "w")
    kind = np.dtype(_NUMPY[z_type])
    return spread(whole, "bc", "br").groupBy("bc", "br").cogroup(
        spread(placed, "bc", "br").groupBy("bc", "br")
    ).applyInArrow(_filled_cells(grid, kind), f"col long, row long, z {z_type}, fill {z_type}")


def _first(conditions) -> F.Column:
    out = None
    for condition, code in conditions:
        out = F.when(condition, code) if out is None else out.when(condition, code)
    return out


OUTWARD = (16, 1, 64, 4, 2, 8, 32, 128)  # west, east, north, south, then the corners
MARGIN = 2  # cells round a block or pool: a walk from the first one beyond the border looks at the second
SPAN = 8  # blocks along one side of a pool, the square in which flats are walked at once


def flow_direction(surface: DataFrame, grid: GridSpec, value: str = "fill") -> DataFrame:
    """D8 direction ``(col, row, dir)``: edge cells outward, else steepest drop, else across the flat.

    Slopes are compared squared (twice the squared drop for straight steps, the squared drop
    for diagonal ones), so integral heights give no floating ties; ties take the least code.  A flat
    cell goes the fewest steps, inside its level, to a cell with a direction.  A flat cell that
    reaches none (on a surface with pits) has a null direction.  One shuffle of the raster; only flats
    that cross a block border take part in the loop.
    """
    rounds = Rounds(surface.sparkSession)
    level = surface.schema[value].dataType.simpleString()
    cells = surface.filter(F.col(value).isNotNull()).select("col", "row", F.col(value).alias("level"))
    known = rounds.put("known", map_patches(
        cells, grid, _block_directions, f"col long, row long, dir long, level {level}, seed long, open boolean", MARGIN),
        watch="open")
    done = known.filter("not open").select("col", "row", "dir")
    if not rounds.seen:
        return done
    return done.unionByName(_across_borders(known.filter("open").select("col", "row", "level", "seed"), grid, rounds))


def _walk_flats(hops: np.ndarray, level: np.ndarray, free: np.ndarray, steps: list[int], start: np.ndarray) -> None:
    """Lower ``hops`` of ``free`` cells to the fewest steps inside a level from the cells at ``start``."""
    while len(start):
        moved = []
        for step in steps:
            to, via = start + step, hops[start] + 1
            nearer = free[to] & (level[to] == level[start]) & (via < hops[to])
            to = to[nearer]
            hops[to] = via[nearer]  # cells differ, and so do their neighbours at one step
            moved.append(to)
        start = np.unique(np.concatenate(moved))


def _onward(at: np.ndarray, hops: np.ndarray, level: np.ndarray, seed: np.ndarray, flat: np.ndarray,
            offset: dict[int, int]) -> np.ndarray:
    """Direction of flat cells: out of the flat where a step leads out, else one step nearer; 0 for none."""
    code = np.zeros(len(at), np.int64)
    for direction in sorted(offset, reverse=True):  # the least code is written last
        to = at + offset[direction]
        code[flat[to] & (level[to] == level[at]) & (hops[to] == hops[at] - 1)] = direction
    return np.where(seed[at] > 0, seed[at], code)


def _block_directions(patch: Patch) -> pa.Table:
    """Directions of the cells of one block; flats that go on beyond the block stay open.

    The margin of two cells tells the directions of all cells next to the block too.
    """
    level = patch.dense("level")
    if level.dtype.kind == "i":
        level = level.astype(np.int64)
    ring = np.zeros((patch.width, patch.width), bool)
    ring[1:-1, 1:-1] = True
    at = np.flatnonzero(patch.known & ring.reshape(-1))
    found, steepest = np.zeros(len(at), np.int64), np.zeros(len(at), level.dtype)
    for code, dc, dr in DIRECTIONS:
        to = at + patch.offset[code]
        drop = np.where(patch.known[to], level[at] - level[to], 0)
        slope = drop * drop * (1 if dc and dr else 2)
        better = (drop > 0) & (slope > steepest)
        found[better], steepest[better] = code, slope[better]
    for code in reversed(OUTWARD):
        found[~patch.known[at + patch.offset[code]]] = code
    way = np.zeros(len(level), np.int64)
    way[at] = found
    flat = np.zeros(len(level), bool)
    flat[at] = found == 0

    cells, here = patch.cells, flat & patch.core
    pooled = np.flatnonzero(here)
    seed = np.zeros(len(level), np.int64)
    beyond = np.zeros(len(pooled), bool)
    for code in sorted(patch.offset, reverse=True):
        to = pooled + patch.offset[code]
        same = patch.known[to] & (level[to] == level[pooled])
        seed[pooled[same & ~flat[to]]] = code
        beyond |= same & flat[to] & ~patch.core[to]
    steps = list(patch.offset.values())
    is_open = np.full(len(level), kernels.INF)
    is_open[pooled[beyond]] = 0
    _walk_flats(is_open, level, here, steps, pooled[beyond])
    open_cell = here & (is_open < kernels.INF)
    closed = here & ~open_cell
    hops = np.full(len(level), kernels.INF)
    starts = np.flatnonzero(closed & (seed > 0))
    hops[starts] = 1
    _walk_flats(hops, level, closed, steps, starts)
    inside = np.flatnonzero(closed)
    way[inside] = _onward(inside, hops, level, seed, closed, patch.offset)
    still = open_cell[cells]
    return pa.table({
        "col": pa.array(patch.col(cells)), "row": pa.array(patch.row(cells)),
        "dir": pa.array(way[cells], mask=way[cells] == 0),
        "level": pa.array(level[cells].astype(patch.dense("level").dtype), mask=~still),
        "seed": pa.array(seed[cells], mask=~still | (seed[cells] == 0)), "open": pa.array(still),
    })


class _Pool:
    """Open flat cells of a square of blocks and the flat cells next to it, packed in one row."""

    SCHEMA = "at binary, core binary, level binary, seed binary, hops binary"

    def __init__(self, row: pa.Table, grid: GridSpec, kind: np.dtype):
        part = {key: np.frombuffer(row[key][0].as_py(), of) for key, of in
                {"at": np.int32, "core": bool, "level": kind, "seed": np.int16, "hops": np.int64}.items()}
        self.bc, self.br, self.ncol = row["bc"][0].as_py(), row["br"][0].as_py(), grid.ncol
        self.width = grid.block + 2 * MARGIN
        self.col0, self.row0 = self.bc * grid.block - MARGIN, self.br * grid.block - MARGIN
        self.offset = {code: dr * self.width + dc for code, dc, dr in DIRECTIONS}
        at = part["at"].astype(np.int64)
        size = self.width * self.width
        self.flat, self.core = np.zeros(size, bool), np.zeros(size, bool)
        self.flat[at], self.core[at] = True, part["core"]
        self.level, self.seed = np.zeros(size, kind), np.zeros(size, np.int16)
        self.level[at], self.seed[at] = part["level"], part["seed"]
        self.hops = np.full(size, kernels.INF)
        self.hops[at] = part["hops"]
        self.cells = at[part["core"]]

    def walk(self, incoming: pa.Table) -> None:
        """Go on from the cells beyond the border whose steps are known."""
        cell = incoming["cell"].to_numpy()
        at = (cell // self.ncol - self.row0) * self.width + cell % self.ncol - self.col0
        self.hops[at] = incoming["hops"].to_numpy()
        _walk_flats(self.hops, self.level, self.core, list(self.offset.values()), at)

    def border(self, grid: GridSpec) -> dict[str, np.ndarray]:
        """Steps of the cells that have a flat neighbour in another pool, once for each such pool."""
        sent = []
        for step in self.offset.values():
            to = self.cells + step
            out = self.flat[to] & ~self.core[to] & (self.level[to] == self.level[self.cells])
            out &= self.hops[self.cells] < kernels.INF
            u, v = self.cells[out], to[out]
            sent.append(np.stack([(v % self.width + self.col0) // grid.block, (v // self.width + self.row0) // grid.block,
                                  (u // self.width + self.row0) * self.ncol + u % self.width + self.col0, self.hops[u]]))
        bc, br, cell, hops = np.unique(np.concatenate(sent, axis=1), axis=1)
        return {"bc": bc, "br": br, "cell": cell, "hops": hops}


def _across_borders(flats: DataFrame, grid: GridSpec, rounds: Rounds) -> DataFrame:
    """Directions of the flats that cross block borders.

    Their cells are packed once by pools of ``SPAN`` x ``SPAN`` blocks.  A round walks a pool through and
    sends only the steps of its border cells on, and only pools that hear of fewer steps walk again: a
    flat takes one round for each pool it crosses, and the rounds write rims alone.
    """
    wide = replace(grid, block=grid.block * SPAN)
    level = flats.schema["level"].dataType.simpleString()
    kind = np.dtype(_NUMPY[level])
    rim = "bc long, br long, cell long, hops long"

    def pack(patch: Patch) -> pa.Table:
        at = np.flatnonzero(patch.known)
        seed = np.zeros(len(patch.known), np.int16)
        row_seed = patch.table["seed"].fill_null(0).to_numpy()
        seed[patch.positions] = row_seed
        hops = np.full(len(patch.known), kernels.INF)
        starts = patch.cells[seed[patch.cells] > 0]
        hops[starts] = 1
        heights = patch.dense("level")
        _walk_flats(hops, heights, patch.core, list(patch.offset.values()), starts)
        packed = {"at": at.astype(np.int32), "core": patch.core[at], "level": heights[at], "seed": seed[at], "hops": hops[at]}
        one = pa.table({"bc": pa.array([patch.bc]), "br": pa.array([patch.br]),
                        **{key: pa.array([v.tobytes()], pa.binary()) for key, v in packed.items()}})
        sent = _Pool(one, wide, kind).border(wide)
        n = len(sent["cell"])
        return pa.table({
            "bc": pa.array(np.append(sent["bc"], patch.bc)), "br": pa.array(np.append(sent["br"], patch.br)),
            "cell": pa.array(np.append(sent["cell"], 0), mask=np.arange(n + 1) == n),
            "hops_in": pa.array(np.append(sent["hops"], 0)),
            **{key: pa.array([None] * n + [v.tobytes()], pa.binary()) for key, v in packed.items()}})

    def again(pool: pa.Table, incoming: pa.Table) -> pa.Table:
        if not pool.num_rows:
            return pa.table({key: pa.array([], pa.int64()) for key in ("bc", "br", "cell", "hops")})
        own = _Pool(pool, wide, kind)
        own.walk(incoming)
        return pa.table({key: pa.array(v) for key, v in own.border(wide).items()})

    def finish(pool: pa.Table, incoming: pa.Table) -> pa.Table:
        if not pool.num_rows:
            return pa.table({key: pa.array([], pa.int64()) for key in ("col", "row", "dir")})
        own = _Pool(pool, wide, kind)
        own.walk(incoming)
        code = _onward(own.cells, own.hops, own.level, own.seed, own.flat, own.offset)
        return pa.table({"col": pa.array(own.cells % own.width + own.col0), "row": pa.array(own.cells // own.width + own.row0),
                         "dir": pa.array(code, mask=code == 0)})

    def per_pool(pools: DataFrame, incoming: DataFrame, step, schema: str) -> DataFrame:
        keys = ["bc", "br"]
        return spread(pools, *keys).groupBy(*keys).cogroup(spread(incoming, *keys).groupBy(*keys)).applyInArrow(step, schema)

    first = materialize(map_patches(flats, wide, pack, f"bc long, br long, cell long, hops_in long, {_Pool.SCHEMA}", MARGIN))
    pools = first.filter("cell is null").drop("cell", "hops_in")
    state = rounds.put("rim", first.filter("cell is not null").select(
        "bc", "br", "cell", F.col("hops_in").alias("hops"), F.lit(True).alias("moved")), watch="moved")
    while rounds.seen:
        active = state.filter("moved").select("bc", "br").distinct()
        heard = per_pool(pools.join(active, ["bc", "br"], "left_semi"), state.join(active, ["bc", "br"], "left_semi").drop(
            "moved"), again, rim)
        told = state.select("bc", "br", "cell", "hops", F.col("hops").alias("before")).unionByName(
            heard.withColumn("before", F.lit(None).cast("long")))
        state = rounds.put("rim", told.groupBy("bc", "br", "cell").agg(
            F.min("hops").alias("hops"), F.min("before").alias("before")
        ).select("bc", "br", "cell", "hops", (F.col("before").isNull() | (F.col("hops") < F.col("before"))).alias("moved")),
            watch="moved")
        rounds.sweep()
    return per_pool(pools, state.drop("moved"), finish, "col long, row long, dir long")


def _local_flow(cells: pd.DataFrame) -> pd.DataFrame:
    """Weight gathered by each cell inside the block, and where its local chain leaves.

    Rows without a ``next`` bring weight that enters the block at a cell.
    """
    entering = cells[cells["next"] == NOWHERE]
    cells = cells[cells["next"] != NOWHERE].sort_values("cell_id", ignore_index=True)
    cell_id, nxt = cells["cell_id"].to_numpy(), cells["next"].to_numpy()
    weight = cells["weight"].to_numpy().copy()
    at = np.minimum(np.searchsorted(cell_id, entering["cell_id"].to_numpy()), len(cell_id) - 1)
    here = cell_id[at] == entering["cell_id"].to_numpy() if len(cell_id) else np.zeros(0, dtype=bool)
    np.add.at(weight, at[here], entering["weight"].to_numpy()[here])
    pointer = kernels.local_pointers(cell_id, nxt)
    cells["total"] = kernels.accumulate(pointer, weight)
    cells["exit"] = nxt[kernels.jump(pointer)]
    return cells[["col", "row", "cell_id", "next", "total", "exit"]]


def flow_accumulation(directions: DataFrame, grid: GridSpec) -> DataFrame:
    """Number of cells upstream of each cell, itself excluded: ``(col, row, acc)``.

    Blocks accumulate on their own; flow between blocks is summed on the forest of entry
    cells; a second pass over the blocks adds what enters.  Each pass is one shuffle of the
    cells: what enters travels to its block as a few more rows, not by a join.
    """
    dc = _first([(F.col("dir") == code, F.lit(dc)) for code, dc, _ in DIRECTIONS])
    dr = _first([(F.col("dir") == code, F.lit(dr)) for code, _, dr in DIRECTIONS])
    to_col, to_row = F.col("col") + dc, F.col("row") + dr
    # a step off the grid points to the cell itself: the chain ends there
    forest = directions.select(
        "col", "row", grid.cell_id().alias("cell_id"),
        F.when(grid.inside(to_col, to_row), grid.cell_id(to_col, to_row))
        .otherwise(grid.cell_id()).alias("next"),
        F.lit(1).cast("long").alias("weight"),
    )
    schema = "col long, row long, cell_id long, next long, total long, exit long"

    def pass_over(cells: DataFrame) -> DataFrame:
        return spread(with_block(cells, grid), "bc", "br").groupBy("bc", "br").applyInPandas(
            _local_flow, schema
        )

    local = materialize(pass_over(forest))
    handed = local.withColumn("exit", F.col("next")).filter(_crosses(grid)).groupBy(
        F.col("next").alias("cell_id")
    ).agg(F.sum("total").alias("weight"))
    rims = local.filter(grid.on_block_rim()).select("col", "row", "cell_id", "exit")
    entries = handed.join(rims, "cell_id").select(
        F.col("cell_id").alias("node"),
        F.when(_crosses(grid), F.col("exit")).alias("next"), "weight",
    )
    entering = subtree_sums(entries, Rounds(directions.sparkSession)).select(
        F.pmod("node", F.lit(grid.ncol)).alias("col"),
        F.floor(F.col("node") / grid.ncol).alias("row"),
        F.col("node").alias("cell_id"), F.lit(NOWHERE).cast("long").alias("next"),
        F.col("total").alias("weight"),
    )
    own = local.select("col", "row", "cell_id", "next", F.lit(1).cast("long").alias("weight"))
    return pass_over(own.union(entering)).select("col", "row", (F.col("total") - 1).alias("acc"))
