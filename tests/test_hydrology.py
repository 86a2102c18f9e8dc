import heapq

import numpy as np
import pytest
from conftest import D8, as_map, cells_of, grid_for

from stratagrid.operators import hydrology


def neighbours(array, c, r):
    for code, dc, dr in D8:
        inside = 0 <= c + dc < array.shape[1] and 0 <= r + dr < array.shape[0]
        yield code, (c + dc, r + dr), inside and not np.isnan(array[r + dr, c + dc])


def priority_flood(array):
    cells = [(c, r) for r in range(array.shape[0]) for c in range(array.shape[1]) if not np.isnan(array[r, c])]
    level, heap = {}, []
    for c, r in cells:
        if not all(ok for _, _, ok in neighbours(array, c, r)):
            level[c, r] = int(array[r, c])
            heapq.heappush(heap, (level[c, r], c, r))
    while heap:
        z, c, r = heapq.heappop(heap)
        for _, n, ok in neighbours(array, c, r):
            if ok and n not in level:
                level[n] = max(z, int(array[n[1], n[0]]))
                heapq.heappush(heap, (level[n], *n))
    return level


def random_dem(seed, levels, holes=0.0, shape=(19, 21)):
    rng = np.random.default_rng(seed)
    array = rng.integers(0, levels, shape).astype(float)
    array[rng.random(shape) < holes] = np.nan
    return array


# noise, flats, flats with NoData, large flats; small blocks and one block
CASES = [(1, 500, 0.0, 5), (2, 5, 0.0, 64), (3, 5, 0.05, 5), (4, 2, 0.0, 5)]


@pytest.mark.parametrize("seed,levels,holes,block", CASES)
def test_terrain_against_priority_flood(spark, seed, levels, holes, block):
    array = random_dem(seed, levels, holes)
    grid = grid_for(array, block)
    filled = hydrology.fill(cells_of(spark, array), grid)
    level = as_map(filled, "fill")
    assert level == priority_flood(array)

    # directions: no pit, no cycle, steepest where something is lower
    directions = hydrology.flow_direction(filled, grid)
    code = as_map(directions, "dir")
    assert code.keys() == level.keys()
    step = {k: (dc, dr) for k, dc, dr in D8}
    down = {}
    for (c, r), k in code.items():
        dc, dr = step[k]
        target = (c + dc, r + dr)
        around = [(kk, n) for kk, n, ok in neighbours(array, c, r) if ok]
        if len(around) < 8:
            assert target not in level  # the edge drains outward
            continue
        lower = [(-(level[c, r] - level[n]) ** 2 * (1 if step[kk][0] and step[kk][1] else 2), kk)
                 for kk, n in around if level[n] < level[c, r]]
        assert level[target] <= level[c, r]
        if lower:
            assert k == min(lower)[1]
        down[c, r] = target

    # accumulation: every cell counts the cells that reach it
    count = dict.fromkeys(level, 0)
    for start in level:
        at, hops = start, 0
        while at in down:
            at, hops = down[at], hops + 1
            count[at] += 1
            assert hops <= len(level), "cycle"
    acc = as_map(hydrology.flow_accumulation(directions, grid), "acc")
    assert acc == count
    outlets = [p for p in level if p not in down]
    assert sum(acc[p] + 1 for p in outlets) == len(level)


def test_bowl_fills_to_its_lowest_rim(spark):
    array = np.array([[9, 9, 9, 9, 9], [9, 5, 5, 5, 9], [9, 5, 1, 5, 7], [9, 5, 5, 5, 9], [9, 9, 9, 9, 9]], float)
    level = as_map(hydrology.fill(cells_of(spark, array), grid_for(array)), "fill")
    assert level[2, 2] == 7 and level[1, 1] == 7 and level[0, 0] == 9


def test_two_pits_with_a_saddle(spark):
    array = np.array([[9, 9, 9, 9, 9], [9, 1, 6, 2, 9], [9, 9, 9, 9, 8]], float)
    level = as_map(hydrology.fill(cells_of(spark, array), grid_for(array, 2)), "fill")
    assert [level[c, 1] for c in (1, 2, 3)] == [8, 8, 8]


@pytest.mark.parametrize("block", [2, 64])
def test_flat_plain_drains_without_cycles(spark, block):
    array = np.full((6, 6), 3.0)
    code = as_map(hydrology.flow_direction(
        hydrology.fill(cells_of(spark, array), grid_for(array, block)), grid_for(array, block)
    ), "dir")
    # west and east columns outward, then north and south rows; inside, the least code wins
    assert code[0, 0] == 16 and code[5, 5] == 1 and code[2, 0] == 64 and code[2, 5] == 4
    assert code[1, 1] == 8 and code[4, 4] == 1 and code[2, 2] == 8


def test_basins_lead_to_pits(spark):
    array = random_dem(9, 50)
    basin = as_map(hydrology.basins(cells_of(spark, array), grid_for(array, 4)), "basin")
    for (c, r), pit in basin.items():
        pc, pr = pit % 21, pit // 21
        assert basin[pc, pr] == pit
        assert all(
            not ok or (array[n[1], n[0]], n[1] * 21 + n[0]) > (array[pr, pc], pit)
            for _, n, ok in neighbours(array, pc, pr)
        )


def test_fractional_elevations_and_nulls(spark):
    rng = np.random.default_rng(11)
    array = rng.random((9, 10)) * 10
    array[4, 4] = np.nan
    rows = [(c, r, None if np.isnan(array[r, c]) else float(array[r, c])) for r in range(9) for c in range(10)]
    dem = spark.createDataFrame(rows, "col long, row long, z double")
    filled = as_map(hydrology.fill(dem, grid_for(array, 4)), "z", "fill")
    assert (4, 4) not in filled
    for (c, r), (z, level) in filled.items():
        around = list(neighbours(array, c, r))
        assert z == array[r, c] and level >= z
        if len([1 for *_, ok in around if ok]) < 8:
            assert level == z
        else:  # no pit is left
            assert min(filled[n][1] for _, n, _ in around) <= level
