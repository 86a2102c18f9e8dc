"""Filling and flats on the graphs of block rims: loop sizes, rounds, and equal results for all block sizes."""

from collections import deque

import numpy as np
import pytest
from conftest import D8, as_map, cells_of, grid_for
from test_hydrology import neighbours, priority_flood, random_dem

from stratagrid.operators import hydrology, patches
from stratagrid.scratch import Rounds


def directions_by_hand(level):
    """Outward at the edge, else steepest drop, else fewest steps across the flat; least code."""
    step = {k: (dc, dr) for k, dc, dr in D8}
    rows, cols = level.shape
    code = {}
    for r in range(rows):
        for c in range(cols):
            if np.isnan(level[r, c]):
                continue
            around = [(k, n, ok) for k, n, ok in neighbours(level, c, r)]
            missing = {k for k, _, ok in around if not ok}
            if missing:
                code[c, r] = next(k for k in (16, 1, 64, 4, 2, 8, 32, 128) if k in missing)
                continue
            drops = [(-(level[r, c] - level[n[1], n[0]]) ** 2 * (1 if step[k][0] and step[k][1] else 2), k)
                     for k, n, _ in around if level[n[1], n[0]] < level[r, c]]
            code[c, r] = min(drops)[1] if drops else None
    hops = {at: 0 for at, k in code.items() if k}
    queue = deque(hops)
    while queue:
        c, r = queue.popleft()
        for _, n, ok in neighbours(level, c, r):
            if ok and n not in hops and level[n[1], n[0]] == level[r, c]:
                hops[n] = hops[c, r] + 1
                queue.append(n)
    for c, r in [at for at, k in code.items() if k is None]:
        code[c, r] = min((k for k, n, ok in neighbours(level, c, r) if ok and level[n[1], n[0]] == level[r, c]
                          and (c, r) in hops and hops.get(n) == hops[c, r] - 1), default=None)
    return code


@pytest.mark.parametrize("block", [5, 8, 64])
def test_fill_does_not_depend_on_blocks(spark, block):
    array = random_dem(7, 60, 0.03, (33, 41))
    assert as_map(hydrology.fill(cells_of(spark, array), grid_for(array, block)), "fill") == priority_flood(array)


def test_fill_of_fractions_and_empty_rasters(spark):
    array = random_dem(9, 300, 0.0, (17, 12)) / 8
    cells = cells_of(spark, array * 8).selectExpr("col", "row", "z / 8d as z")
    got = hydrology.fill(cells, grid_for(array, 5))
    assert dict(got.dtypes)["fill"] == "double"
    expected = priority_flood(array * 8)
    assert {k: v * 8 for k, v in as_map(got, "fill").items()} == expected
    assert hydrology.fill(cells.limit(0), grid_for(array, 5)).count() == 0


def test_loop_of_filling_follows_block_rims(spark):
    rng = np.random.default_rng(3)
    array = rng.integers(0, 10_000, (64, 64)).astype(float)
    nodes = {}
    for block in (8, 32):
        grid = grid_for(array, block)
        blocks = patches.map_patches(cells_of(spark, array), grid, hydrology._block_levels, (
            "kind int, bc long, br long, a long, b long, w long, cells binary, z binary, label binary, pits binary, "
            "tree_a binary, tree_b binary, tree_w binary"))
        edges = hydrology.rim_graph(blocks).collect()
        nodes[block] = {n for e in edges for n in (e["a"], e["b"])} - {hydrology.OUTSIDE}
        borders = 2 * (64 // block - 1) * 64 * 2  # cells on both sides of the inner borders
        assert len(nodes[block]) <= borders
    assert len(nodes[32]) * 2 < len(nodes[8])


@pytest.mark.parametrize("block,span", [(4, 1), (4, 2), (5, 8)])
@pytest.mark.parametrize("seed,levels,holes", [(2, 3, 0.0), (5, 2, 0.02)])
def test_directions_across_flats(spark, monkeypatch, block, span, seed, levels, holes):
    monkeypatch.setattr(hydrology, "SPAN", span)
    array = random_dem(seed, levels, holes, (30, 34))
    array[6:25, 5:29] = 1.0  # a flat over many blocks
    level = np.full(array.shape, np.nan)
    for (c, r), z in priority_flood(array).items():
        level[r, c] = z
    surface = cells_of(spark, level, "fill")
    assert as_map(hydrology.flow_direction(surface, grid_for(array, block)), "dir") == directions_by_hand(level)


def test_pits_without_a_way_out_have_no_direction(spark, monkeypatch):
    monkeypatch.setattr(hydrology, "SPAN", 1)
    array = np.full((14, 14), 5.0)
    array[4:10, 3:11] = 2.0  # a closed basin over several blocks
    got = as_map(hydrology.flow_direction(cells_of(spark, array, "fill"), grid_for(array, 4)), "dir")
    assert got == directions_by_hand(array)
    assert {at for at, code in got.items() if code is None} == {(c, r) for r in range(4, 10) for c in range(3, 11)}


def test_a_long_flat_takes_a_round_per_pool(spark, monkeypatch):
    array = np.full((5, 208), 9.0)
    array[2, 1:] = 3.0  # one flat through 52 blocks, open at its east end
    rounds = []
    put = Rounds.put
    monkeypatch.setattr(Rounds, "put", lambda self, name, *a, **k: (rounds.append(name), put(self, name, *a, **k))[1])
    got = as_map(hydrology.flow_direction(cells_of(spark, array, "fill"), grid_for(array, 4)), "dir")
    assert got == directions_by_hand(array)
    assert rounds.count("rim") <= 52 // hydrology.SPAN + 3
