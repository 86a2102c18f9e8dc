"""A mask of exploded buffer cells is never broadcast, however small the planner takes it to be."""

import pytest

from stratagrid.grid import GridSpec
from stratagrid.operators import vector
from stratagrid.queries import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("masks"))
    spark.range(2000).selectExpr(
        "id as o_orderkey", "id % 100 as o_custkey", "cast((id * 7919) % 500000 as double) as o_totalprice"
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(200).selectExpr("id as c_custkey", "'a name of some length' as c_name").write.parquet(
        f"{folder}/customer.parquet")
    return folder


@pytest.mark.parametrize("name", ["dark_cells", "darkest_regions", "dissolve_parts", "masked_cells"])
def test_buffers_under_a_raster_are_not_broadcast(spark, tables, name):
    assert "Broadcast" not in plan_of(QUERIES[name](spark, tables))


def test_extract_by_mask_keeps_every_cell_of_every_polygon(spark):
    grid = GridSpec(ncol=12, nrow=9)
    raster = spark.createDataFrame(
        [(c, r, 100 * r + c) for c in range(12) for r in range(9) if (c + r) % 5], "col long, row long, z long")
    points = spark.createDataFrame([(1, 3.5, -3.5), (2, 4.5, -3.5), (3, 0.5, -8.5), (3, 0.5, -8.5)],
                                   "id long, x double, y double")
    cells = vector.extract_by_mask(raster, vector.buffer_cells(points, 2.0, grid).select("id", "col", "row"))
    expected = [
        (i, c, r, 100 * r + c) for i, x, y in ((1, 3, 3), (2, 4, 3), (3, 0, 8), (3, 0, 8))
        for c in range(12) for r in range(9) if (c + r) % 5 and (c - x) ** 2 + (r - y) ** 2 <= 4]
    assert sorted(tuple(r) for r in cells.select("id", "col", "row", "z").collect()) == sorted(expected)
    assert "Broadcast" not in plan_of(cells)
