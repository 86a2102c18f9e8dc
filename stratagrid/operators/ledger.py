"""The ledger of processed points and the batches planned from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratagrid.functions.columns import base_name, hillshade_name

BUCKETS = 4096


def next_ids(ledger: DataFrame) -> DataFrame:
    """First free point number and the last batch number; 1 and 0 for an empty ledger."""
    return ledger.agg(
        F.coalesce(F.max("fid") + 1, F.lit(1)).alias("next_fid"),
        F.coalesce(F.max("processed"), F.lit(0)).alias("last_batch"),
    )


def valid(ledger: DataFrame) -> DataFrame:
    """Rows whose status is known and not ``Invalid``; points out of bounds pass."""
    return ledger.filter(F.col("ftp") != "Invalid")


def latest_batch(ledger: DataFrame) -> DataFrame:
    """Valid rows of the newest batch."""
    newest = ledger.agg(F.max("processed")).scalar()
    return valid(ledger.filter(F.col("processed") == newest))


def pending(candidates: DataFrame, ledger: DataFrame, key: str = "fid") -> DataFrame:
    return candidates.join(ledger.select(key).distinct(), key, "left_anti")


def page(df: DataFrame, key: str, skip: int, size: int) -> DataFrame:
    """Rows ``skip .. skip + size - 1`` in order of an integral unique ``key``.

    The key at the first position is found by counting keys per bucket, each pass narrowing
    the range by a factor of ``BUCKETS``; only the page itself is ever sorted.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return df.limit(0)
    while low < high:
        width = (high - low) // BUCKETS + 1
        counts = df.filter(F.col(key).between(low, high)).groupBy(
            F.floor((F.col(key) - low) / width).cast("long").alias("bucket")
        ).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.orderBy("bucket"))  # at most BUCKETS rows
        found = counts.withColumn("upto", upto).filter(F.col("upto") > skip).orderBy("bucket").first()
        if found is None:
            return df.limit(0)
        skip -= found["upto"] - found["n"]
        low, high = low + found["bucket"] * width, min(high, low + (found["bucket"] + 1) * width - 1)
    if skip > 0:
        return df.limit(0)
    return df.filter(F.col(key) >= low).orderBy(key).limit(size)


def next_batch(candidates: DataFrame, ledger: DataFrame, batch_size: int) -> DataFrame:
    """The next unused candidates, numbered on from the ledger: adds ``fid`` and ``processed``."""
    next_fid, last_batch = next_ids(ledger).first()
    taken = page(candidates, "id", next_fid - 1, batch_size)
    number = F.row_number().over(Window.orderBy("id"))  # at most batch_size rows
    return taken.withColumn("fid", (number + F.lit(next_fid - 1)).cast("long")).withColumn(
        "processed", F.lit(last_batch + 1).cast("long")
    )


def status_rows(batch: DataFrame, located: DataFrame, store: str, shade_folder: str,
                added: Column | None = None) -> DataFrame:
    """Ledger rows of a batch: file name and path of the point's tile, or out of bounds.

    ``added`` is the time of insertion, by default now.
    """
    tile = located.select("id", "tilename", "ascii_path")
    missing = F.lit("Out of Bounds")
    hit = F.col("tilename").isNotNull()
    shade = F.concat(F.lit(shade_folder + "/"), hillshade_name(base_name(F.col("ascii_path"))))
    return batch.join(tile, "id", "left").select(
        "fid",
        F.when(hit, F.col("tilename")).otherwise(missing).alias("file_name"),
        F.when(hit, shade).otherwise(missing).alias("file_path"),
        F.when(hit, F.concat(F.lit(store + "/"), "ascii_path")).otherwise(missing).alias("ftp"),
        "processed", "main_file_id",
        F.when(hit, F.col("x")).alias("x_location"),
        F.when(hit, F.col("y")).alias("y_location"),
        (F.current_timestamp() if added is None else added).alias("added"),
    )
