import numpy as np
import pytest
from conftest import cells_of, grid_for

from stratagrid.operators.components import components, group_components

FOUR = ((1, 0), (0, 1), (-1, 0), (0, -1))
EIGHT = FOUR + ((1, 1), (1, -1), (-1, 1), (-1, -1))


def flood(array, neighbours, by_value):
    """Least cell id of each region, by breadth-first search."""
    ncol = array.shape[1]
    todo = {(c, r) for r in range(array.shape[0]) for c in range(ncol) if not np.isnan(array[r, c])}
    label = {}
    for start in sorted(todo, key=lambda p: (p[1], p[0])):
        if start in label:
            continue
        stack, label[start] = [start], start[1] * ncol + start[0]
        while stack:
            c, r = stack.pop()
            for dc, dr in EIGHT if neighbours == 8 else FOUR:
                n = (c + dc, r + dr)
                if n in todo and n not in label and (not by_value or array[n[1], n[0]] == array[r, c]):
                    label[n] = label[start]
                    stack.append(n)
    return label


@pytest.mark.parametrize("block", [3, 8, 64])
@pytest.mark.parametrize("neighbours,by_value", [(8, False), (4, True)])
def test_components_equal_flood_fill_for_any_block(spark, block, neighbours, by_value):
    rng = np.random.default_rng(block)
    array = rng.integers(0, 3, (17, 23)).astype(float)
    array[rng.random(array.shape) < 0.45] = np.nan
    got = components(
        cells_of(spark, array), grid_for(array, block), value="z" if by_value else None, neighbours=neighbours
    )
    assert {(r.col, r.row): r.component for r in got.collect()} == flood(array, neighbours, by_value)


def test_long_snake_crosses_many_blocks(spark):
    array = np.full((15, 15), np.nan)
    array[::2, :] = 1
    array[1::4, -1] = 1
    array[3::4, 0] = 1
    got = components(cells_of(spark, array), grid_for(array, 2)).collect()
    assert {r.component for r in got} == {0} and len(got) == int(np.nansum(array))


def test_corner_contact(spark):
    array = np.array([[1, np.nan], [np.nan, 1]])
    cells, grid = cells_of(spark, array), grid_for(array)
    assert components(cells, grid, neighbours=8).select("component").distinct().count() == 1
    assert components(cells, grid, neighbours=4).select("component").distinct().count() == 2


def test_groups_do_not_touch_each_other(spark):
    rng = np.random.default_rng(5)
    rows, expected = [], {}
    for group in range(40):
        array = rng.integers(0, 2, (7, 9)).astype(float)
        array[rng.random(array.shape) < 0.3] = np.nan
        for (c, r), label in flood(array, 4, True).items():
            rows.append((group, c, r, int(array[r, c])))
            expected[group, c, r] = label
    df = spark.createDataFrame(rows, "id long, col long, row long, z long")
    grid = grid_for(np.zeros((7, 9)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")  # batches cut groups
    try:
        got = group_components(df, ["id"], grid, value="z").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.id, r.col, r.row): r.component for r in got} == expected
