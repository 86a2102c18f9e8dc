"""Scans and sinks: feature tables, interchange sheets, rasters, lines, the ledger."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratagrid.grid import GridSpec, with_tile

LEDGER_SCHEMA = T.StructType([
    T.StructField("fid", T.LongType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("ftp", T.StringType()),
    T.StructField("processed", T.LongType()),
    T.StructField("main_file_id", T.LongType()),
    T.StructField("x_location", T.DoubleType()),
    T.StructField("y_location", T.DoubleType()),
    T.StructField("added", T.TimestampType()),
])
POINT_SCHEMA = T.StructType([
    T.StructField("Id", T.LongType()),
    T.StructField("X", T.DoubleType()),
    T.StructField("Y", T.DoubleType()),
])


def scan(spark: SparkSession, path: str, columns: list[str], where: str | None = None) -> DataFrame:
    """Read some columns of a feature table; ``where`` reaches the Parquet scan."""
    df = spark.read.parquet(path)
    return (df.filter(where) if where else df).select(*columns)


def table_state(spark: SparkSession, path: str) -> str:
    """Names, lengths and times of a table's files: another string once the table is rewritten."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(context._jsc.hadoopConfiguration())
    return ";".join(
        f"{s.getPath().getName()},{s.getLen()},{s.getModificationTime()}" for s in system.listStatus(target))


def write_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_sheet(points: DataFrame, path: str) -> None:
    """Write ``Id, X, Y`` for interchange, one CSV part per partition."""
    points.select("Id", "X", "Y").write.mode("overwrite").csv(path, header=True)


def read_sheet(spark: SparkSession, path: str, columns: tuple[str, ...] = ("Id",)) -> DataFrame:
    """Columns of a sheet found by the names in its header, in any order; a missing one raises."""
    sheet = spark.read.csv(path, header=True)
    missing = [c for c in columns if c not in sheet.columns]
    if missing:
        raise ValueError(f"sheet {path} lacks {missing}; it has {sheet.columns}")
    return sheet.select(*[F.col(f"`{c}`").cast(POINT_SCHEMA[c].dataType).alias(c) for c in columns])


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_lines(lines: DataFrame, more: DataFrame) -> DataFrame:
    """Both line tables under one schema; a column that one side lacks is null there."""
    return lines.unionByName(more, allowMissingColumns=True)


def save_raster(cells: DataFrame, path: str, grid: GridSpec, tile_blocks: int = 16) -> None:
    """Write a raster by place: partitioned by tiles ``tile_blocks`` blocks wide, sorted by row inside.

    Several tasks write a tile, one for each stripe of its block rows, so that a tile may be thousands
    of cells wide.  ``raster.near_cells`` reads only the tiles it needs.
    """
    placed = with_tile(cells, grid, tile_blocks)
    stripe = F.floor(F.col("row") / F.lit(grid.block))
    placed.repartition("tile_col", "tile_row", stripe).sortWithinPartitions("tile_col", "tile_row", "row", "col") \
        .write.mode("overwrite").partitionBy("tile_col", "tile_row").parquet(path)


def read_raster(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A raster saved by place, with its ``tile_col`` and ``tile_row``; ``schema`` is that of its cells."""
    if schema is None:
        return spark.read.parquet(path)
    placed = T.StructType([*schema, T.StructField("tile_col", T.IntegerType()), T.StructField("tile_row", T.IntegerType())])
    return spark.read.schema(placed).parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table; empty, with the fixed schema, when nothing has been written yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path).select(*LEDGER_SCHEMA.names)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def append_ledger(rows: DataFrame, path: str) -> None:
    """Add rows to the ledger, which is stored by batch."""
    rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA]) \
        .write.mode("append").partitionBy("processed").parquet(path)


def newest_batch(spark: SparkSession, path: str) -> int | None:
    """The greatest batch number of a stored ledger, from its folders alone; None for an empty one."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(context._jsc.hadoopConfiguration())
    if not system.exists(target):
        return None
    names = [s.getPath().getName() for s in system.listStatus(target) if s.isDirectory()]
    numbers = [n.removeprefix("processed=") for n in names if n.startswith("processed=")]
    return max((int(n) for n in numbers if n.lstrip("-").isdigit()), default=None)


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest batch of a stored ledger; of all its rows only these are read.

    Numbers grow from batch to batch, so ``ledger.next_ids`` of these rows is that of the whole ledger.
    """
    newest = newest_batch(spark, path)
    ledger = read_ledger(spark, path)
    return ledger.limit(0) if newest is None else ledger.filter(F.col("processed") == newest)
