"""A ledger stored by batch: the newest batch and the next numbers come from one partition."""

import glob

from pyspark.sql import functions as F

from stratagrid.operators import ledger as led
from stratagrid.sources import tables


def rows(spark, batches):
    empty = spark.createDataFrame([], tables.LEDGER_SCHEMA)
    some = [(fid, batch, "Invalid" if fid % 5 == 0 else "store") for batch, fids in batches.items() for fid in fids]
    return empty.select("fid", "processed", "ftp").union(
        spark.createDataFrame(some, "fid long, processed long, ftp string")).select(
        *[F.col(f.name) if f.name in ("fid", "processed", "ftp") else F.lit(None).cast(f.dataType).alias(f.name)
          for f in tables.LEDGER_SCHEMA])


def test_newest_batch_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert tables.newest_batch(spark, path) is None and tables.read_newest(spark, path).count() == 0
    tables.append_ledger(rows(spark, {1: range(1, 8), 2: range(8, 15), 9: range(15, 19)}), path)
    tables.append_ledger(rows(spark, {10: range(19, 26)}), path)
    whole = tables.read_ledger(spark, path)
    assert whole.columns == tables.LEDGER_SCHEMA.names and whole.count() == 25
    expected = sorted(led.latest_batch(whole).select("fid").collect()), led.next_ids(whole).first()
    # the files of all other batches can no longer be read
    for old in glob.glob(f"{path}/processed=[129]/*.parquet"):
        with open(old, "wb") as out:
            out.write(b"gone")
    newest = tables.read_newest(spark, path)
    assert "PartitionFilters: [isnotnull(processed" in newest._jdf.queryExecution().toString()
    assert sorted(led.valid(newest).select("fid").collect()) == expected[0]
    assert led.next_ids(newest).first() == expected[1] == (26, 10)
    assert led.next_batch(spark.range(1, 100), newest, 3).select("fid", "processed").collect() == [(26, 11), (27, 11), (28, 11)]
