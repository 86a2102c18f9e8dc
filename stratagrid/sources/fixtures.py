"""Terrain tables derived from the given parquet tables, whole tables every time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagrid.grid import GridSpec

WIDTH = 100  # columns of the derived raster
BLOCK = 64
TILE = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grid_of(spark: SparkSession, sf_dir: str) -> GridSpec:
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    return GridSpec(ncol=WIDTH, nrow=last // WIDTH + 1, block=BLOCK)


def dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevation raster: one cell per order."""
    return table(spark, sf_dir, "orders").select(
        F.pmod("o_orderkey", F.lit(WIDTH)).alias("col"),
        F.expr(f"o_orderkey div {WIDTH}").alias("row"),
        F.floor(F.col("o_totalprice") / 1000).cast("long").alias("z"),
    )


def inflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second raster on the same grid, used as the accumulation of the zonal queries."""
    return table(spark, sf_dir, "orders").select(
        F.pmod("o_orderkey", F.lit(WIDTH)).alias("col"),
        F.expr(f"o_orderkey div {WIDTH}").alias("row"),
        F.expr("o_custkey div 10").alias("fac"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone raster: elevation class (100 units) inside each 25 x 25 tile."""
    d = dem(spark, sf_dir)
    tile = F.expr(f"(row div {TILE}) * {WIDTH // TILE} + col div {TILE}")
    return d.select("col", "row", "z", (tile * 10 + F.expr("z div 100")).alias("zone"))


def structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure points: one per customer, at a cell centre."""
    cell = F.expr("c_custkey * 10 + (c_custkey * 7) % 10")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").alias("main_file_id"),
        F.pmod(cell, F.lit(WIDTH)).alias("col"),
        F.floor(cell / WIDTH).cast("long").alias("row"),
    ).select(
        "id", "main_file_id", "col", "row",
        (F.col("col") + 0.5).alias("x"), (-(F.col("row") + 0.5)).alias("y"),
    )


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road centre lines with a half-width: one straight segment per supplier."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("road_id"),
        F.expr("(s_suppkey * 3) div 2").alias("road_row"),
        F.expr("(s_suppkey % 5) * 20").alias("col0"),
        F.expr("cast((s_suppkey div 5) % 2 as double)").alias("half_width"),
    ).select(
        "road_id", "half_width",
        (F.col("col0") + 0.5).alias("ax"), (-(F.col("road_row") + 0.5)).alias("ay"),
        (F.col("col0") + 19.5).alias("bx"), (-(F.col("road_row") + 0.5)).alias("by"),
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile index: footprints that overlap by one cell; tiles without a summit are unpublished."""
    return dem(spark, sf_dir).groupBy(
        F.expr(f"row div {TILE}").alias("tile_row"), F.expr(f"col div {TILE}").alias("tile_col")
    ).agg(F.max("z").alias("summit")).filter("summit >= 498").select(
        F.concat_ws("_", "tile_row", "tile_col").alias("tilename"),
        F.concat(F.lit("public/lidar/dem"), F.concat_ws("_", "tile_row", "tile_col"),
                 F.when(F.col("summit") >= 499, ".tif").otherwise(".IMG")).alias("ascii_path"),
        (F.col("tile_col") * TILE).cast("double").alias("xmin"),
        (F.col("tile_col") * TILE + TILE + 1).cast("double").alias("xmax"),
        (-(F.col("tile_row") * TILE + TILE + 1)).cast("double").alias("ymin"),
        (-(F.col("tile_row") * TILE)).cast("double").alias("ymax"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of processed points: one row per event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("fid"),
        F.col("user_id").alias("main_file_id"),
        F.dayofmonth("ts").cast("long").alias("processed"),
        F.when(F.col("event_type") == "error", "Invalid")
        .when(F.col("event_type") == "signup", "Out of Bounds")
        .otherwise(F.concat(F.lit("store/"), "event_type")).alias("ftp"),
        F.concat(F.lit("dem"), F.expr("user_id div 4"), F.lit("_"), F.expr("user_id % 4"), F.lit(".tif")).alias("file_name"),
    )
