import datetime
import os
import random

from pyspark.sql import functions as F

from stratagrid.grid import GridSpec
from stratagrid.operators import ledger as led, raster
from stratagrid.plans.batch import plan_batch
from stratagrid.sources import tables


def test_scan_pushes_filter_and_columns_down(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_features(spark.range(100).selectExpr("id", "id * 2 as b", "id * 3 as c"), path)
    df = tables.scan(spark, path, ["id"], "b > 190")
    assert [r.id for r in df.orderBy("id").collect()] == [96, 97, 98, 99]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(b), GreaterThan(b,190)]" in plan
    assert "ReadSchema: struct<id:bigint,b:bigint>" in plan


def test_sheet_round_trip(spark, tmp_path):
    path = str(tmp_path / "sheet")
    points = spark.createDataFrame([(1, 0.5, -1.5), (2, 3.25, 4.0)], tables.POINT_SCHEMA)
    tables.write_sheet(points, path)
    assert sorted(tables.read_sheet(spark, path, ("Id", "X", "Y")).collect()) == sorted(points.collect())
    assert tables.read_sheet(spark, path).columns == ["Id"]


def test_lines_and_rasters_round_trip(spark, tmp_path):
    line = spark.sql("select 1L as id, array(named_struct('x', 1D, 'y', 2D), named_struct('x', 3D, 'y', 4D)) as line")
    tables.append_rows(line, str(tmp_path / "lines"))
    tables.append_rows(line, str(tmp_path / "lines"))
    assert spark.read.parquet(str(tmp_path / "lines")).count() == 2
    cells = spark.range(16).selectExpr("id % 4 as col", "id div 4 as row", "id as value")
    grid = GridSpec(ncol=4, nrow=4, block=1)
    tables.save_raster(cells, str(tmp_path / "raster"), grid, tile_blocks=2)
    assert sorted(d for d in os.listdir(tmp_path / "raster") if d.startswith("tile")) == ["tile_col=0", "tile_col=1"]
    back = tables.read_raster(spark, str(tmp_path / "raster"))
    assert sorted(r.value for r in back.filter("tile_col = 1 and tile_row = 1").collect()) == [10, 11, 14, 15]
    # few points: the scan is pruned by place and the raster is not exchanged
    points = spark.createDataFrame([(2.5, -2.5)], "x double, y double")
    near = raster.near_cells(back, points, 0.0, grid, tile_blocks=2)
    assert [r.value for r in near.collect()] == [10]
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "hashpartitioning" not in plan


def test_append_lines_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 2)], "a long, b long")
    b = spark.createDataFrame([(3, 4)], "b long, c long")
    assert sorted(map(tuple, tables.append_lines(a, b).collect()), key=str) == [(1, 2, None), (None, 3, 4)]


def test_ledger_starts_empty_and_grows(spark, tmp_path):
    path = str(tmp_path / "ledger")
    empty = tables.read_ledger(spark, path)
    assert empty.schema == tables.LEDGER_SCHEMA and empty.count() == 0
    assert led.next_ids(empty).first() == (1, 0)
    now = datetime.datetime(2024, 1, 2)
    rows = spark.createDataFrame(
        [(1, "a", "p", "store/a", 1, 7, 0.0, 0.0, now), (2, "b", "Invalid", "Invalid", 1, 8, 0.0, 0.0, now)],
        tables.LEDGER_SCHEMA,
    )
    tables.append_ledger(rows, path)
    ledger = tables.read_ledger(spark, path)
    assert led.next_ids(ledger).first() == (3, 1)
    assert [r.fid for r in led.latest_batch(ledger).collect()] == [1]
    assert [r.fid for r in led.valid(ledger).collect()] == [1]
    again = spark.createDataFrame([(1,), (5,)], "fid long")
    assert [r.fid for r in led.pending(again, ledger).collect()] == [5]


def test_null_status_is_not_valid(spark):
    rows = spark.createDataFrame([(1, None), (2, "Out of Bounds")], "fid long, ftp string")
    assert [r.fid for r in led.valid(rows).collect()] == [2]


def test_page_equals_sorted_slice(spark):
    rng = random.Random(3)
    dense = list(range(5000))
    sparse = rng.sample(range(10 ** 12), 3000) + list(range(10 ** 11, 10 ** 11 + 3000))
    for keys in (dense, sorted(set(sparse))):
        df = spark.createDataFrame([(k,) for k in rng.sample(keys, len(keys))], "id long").repartition(4)
        for skip, size in ((0, 5), (777, 100), (len(keys) - 3, 10), (len(keys), 10), (len(keys) * 2, 4)):
            got = [r.id for r in led.page(df, "id", skip, size).orderBy("id").collect()]
            assert got == sorted(keys)[skip:skip + size]
    assert led.page(spark.createDataFrame([], "id long"), "id", 0, 5).count() == 0


def test_plan_batch_numbers_on_and_marks_points_out_of_bounds(spark):
    candidates = spark.createDataFrame(
        [(i, i + 100, float(i) + 0.5, -0.5) for i in range(10)], "id long, main_file_id long, x double, y double"
    )
    ledger = spark.createDataFrame([(1, 4), (2, 4), (3, 5)], "fid long, processed long")
    tiles = spark.createDataFrame(
        [("b", "x/b.tif", 0.0, 5.0, -5.0, 0.0), ("a", "x/a.tif", 4.0, 6.0, -5.0, 0.0)],
        "tilename string, ascii_path string, xmin double, xmax double, ymin double, ymax double",
    )
    rows = plan_batch(candidates, ledger, tiles, 4, 3.0).orderBy("fid").collect()
    assert [(r.fid, r.processed, r.main_file_id, r.file_name) for r in rows] == [
        (4, 6, 103, "b"), (5, 6, 104, "a"), (6, 6, 105, "a"), (7, 6, 106, "Out of Bounds")
    ]
    assert rows[0].file_path == "shade/b_Hillshade.tif" and rows[0].ftp == "store/x/b.tif"
    assert rows[3].x_location is None
