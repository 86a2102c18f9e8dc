import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratagrid.functions import columns as fn
from stratagrid.operators import fields, lines


def test_map_fields_selects_renames_and_orders(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a long, b double, c string")
    out = fields.map_fields(df, "c NAME;a ID")
    assert out.columns == ["NAME", "ID"] and out.first() == ("x", 1)
    with pytest.raises(ValueError):
        fields.map_fields(df, "missing M")


def test_field_type(spark):
    df = spark.createDataFrame([], "Ident long, Shape_Leng double, v array<int>")
    assert fields.field_type(df, "SHAPE_LENG") == T.DoubleType()
    with pytest.raises(ValueError):
        fields.field_type(df, "none")
    with pytest.raises(ValueError):
        fields.field_type(df, "v")


def test_join_one_field_keeps_unmatched_values(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (3, 30)], "k long, v long")
    right = spark.createDataFrame([(2, 99), (3, 98)], "k2 long, v long")
    out = fields.join_one_field(left, "k", right, "k2", "v")
    assert sorted((r.k, r.v, r.matched) for r in out.collect()) == [
        (1, 10, False), (2, 99, True), (2, 99, True), (3, 98, True)
    ]
    assert fields.match_counts(out).first() == (3, 1)


def test_join_one_field_rejects_a_repeated_key(spark):
    left = spark.createDataFrame([(1, 10)], "k long, v long")
    right = spark.createDataFrame([(1, 5), (1, 6)], "k long, w long")
    with pytest.raises(PySparkException, match="not unique"):
        fields.join_one_field(left, "k", right, "k", "w").collect()


def test_average_rank_shares_ties(spark):
    df = spark.createDataFrame(
        [(1, 5.0), (1, 5.0), (2, 7.0), (2, 7.0), (2, 7.0), (3, 9.0), (3, 4.0)], "id long, area double"
    )
    ranks = df.withColumn("r", fn.average_rank(["id"], "area")).collect()
    assert sorted((r.id, r.r) for r in ranks) == [
        (1, 1.5), (1, 1.5), (2, 2.0), (2, 2.0), (2, 2.0), (3, 1.0), (3, 2.0)
    ]


def test_names(spark):
    df = spark.createDataFrame(
        [("Group_11_FID_20", "a/b/dem_1.tif"), ("Group_1_FID_0", "a/c.IMG"), ("Group_2_FID_3", "a/c.asc")],
        "name string, path string",
    )
    base = fn.base_name(F.col("path"))
    rows = df.select(
        fn.region_key(F.col("name")).alias("k"), base.alias("b"), fn.hillshade_name(base).alias("h"),
        fn.is_raster_file(base).alias("ok"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (11, "dem_1.tif", "dem_1_Hillshade.tif", True), (1, "c.IMG", "c.IMG", True), (2, "c.asc", "c.asc", False)
    ]


def test_snapping_follows_the_longer_axis_and_ties_go_vertical(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 5.0, 1.0, 9.0, 2.0), (0.0, 0.0, 5.0, 1.0, 2.0, 9.0), (0.0, 0.0, 5.0, 1.0, 3.0, 3.0)],
        "sx double, sy double, x double, y double, ex double, ey double",
    )
    lines_ = df.select(fn.snap_to_axis(*[F.col(c) for c in df.columns]).alias("v")).collect()
    assert [[tuple(p) for p in r.v] for r in lines_] == [
        [(0.0, 1.0), (5.0, 1.0), (9.0, 1.0)],
        [(5.0, 0.0), (5.0, 1.0), (5.0, 9.0)],
        [(5.0, 0.0), (5.0, 1.0), (5.0, 3.0)],
    ]


def test_reprojection(spark):
    df = spark.createDataFrame([(0.0, 0.0), (111319.49079327358, 111325.1428663851)], "x double, y double")
    lon, lat = fn.lon_lat(F.col("x"), F.col("y"), 3857)
    out = df.select(F.round(lon, 9), F.round(lat, 9)).collect()
    assert [tuple(r) for r in out] == [(0.0, 0.0), (1.0, 1.0)]
    with pytest.raises(ValueError):
        fn.lon_lat(F.col("x"), F.col("y"), 26914)


def test_threshold_rounds_half_to_even(spark):
    df = spark.createDataFrame(
        [(1, 0, 0), (1, 1, 1), (1, 2, 5), (2, 3, 0), (2, 4, 2), (2, 5, 3)], "id long, fid long, gridcode long"
    )
    kept = lines.below_threshold(df, 0.5).collect()
    # (5 - 0) * 0.5 = 2.5 -> 2 and (3 - 0) * 0.5 = 1.5 -> 2
    assert sorted((r.id, r.fid, r.threshold) for r in kept) == [(1, 0, 2), (1, 1, 2), (2, 3, 2), (2, 4, 2)]


def test_opposite_end(spark):
    structures = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0)], "id long, x double, y double")
    parts = spark.createDataFrame([
        (1, 10, True, 4.0, 0.0), (1, 11, False, -3.0, 0.0), (1, 12, False, -2.0, 0.0), (1, 13, False, 5.0, 0.0),
        (2, 20, True, 2.0, 0.0), (2, 21, False, 3.0, 0.0),
    ], "id long, part long, diss boolean, cx double, cy double")
    out = {r.id: (r.focus_x, r.end_x, r.found) for r in lines.opposite_end(parts, structures).collect()}
    # the focus never ends its own line; without a candidate the structure is the end
    assert out == {1: (4.0, -2.0, True), 2: (2.0, 0.0, False)}


def test_side_ranking_ties_go_right_and_above(spark):
    parts = spark.createDataFrame(
        [(1, 1, 0.0, 3.0, 0.0, 0.0), (1, 2, -1.0, 0.0, 0.0, 0.0), (1, 3, -5.0, -1.0, 0.0, 0.0)],
        "id long, part long, cx double, cy double, x double, y double",
    )
    got = sorted((r.side, r.side_rank, r.part) for r in lines.side_ranking(parts).collect())
    assert got == [("above", 1, 2), ("above", 2, 1), ("below", 1, 3), ("left", 1, 2), ("left", 2, 3), ("right", 1, 1)]


def test_darkest_takes_ties_in_region_order(spark):
    df = spark.createDataFrame([(1, 7, 3), (1, 5, 3), (1, 6, 1)], "id long, fid long, gridcode long")
    assert [r.fid for r in lines.darkest(df, ["id"], 2).orderBy("dark_rank").collect()] == [6, 5]
