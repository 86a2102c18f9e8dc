"""Scratch tables where executors are on other machines than the driver."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from stratagrid import scratch
from stratagrid.queries import QUERIES


@pytest.fixture
def mount(spark, monkeypatch, tmp_path):
    """The session takes itself for a cluster's, whose shared folder is a mount: its scheme is ``file``."""
    folder = f"file://{tmp_path}/shared"
    monkeypatch.setattr(spark.sparkContext, "master", "spark://far:7077")
    monkeypatch.setattr(scratch, "_configured", lambda spark: folder)
    return folder


def test_a_shared_mount_is_taken(spark, mount):
    table = scratch.materialize(spark.range(5))
    assert table.count() == 5 and "/shared/" in table.inputFiles()[0]


def test_the_mount_is_tried_once(spark, mount, monkeypatch):
    tried = []
    monkeypatch.setattr(scratch, "_is_shared", lambda spark, folder: not tried.append(folder))
    assert [scratch.scratch_dir(spark) for _ in range(3)] == [mount] * 3 and tried == [mount]


def test_a_disk_of_each_machine_is_refused(spark, mount, monkeypatch, tmp_path):
    plain = DataFrameWriter.parquet

    def elsewhere(self, path, *args, **kwargs):
        plain(self, f"{tmp_path}/other-machine", *args, **kwargs)
        Path(path.removeprefix("file://")).mkdir(parents=True)

    monkeypatch.setattr(DataFrameWriter, "parquet", elsewhere)
    with pytest.raises(RuntimeError, match="own disk"):
        scratch.scratch_dir(spark)
    assert not list(Path(f"{tmp_path}/shared").iterdir())


def test_without_a_setting_a_cluster_takes_its_warehouse(spark, mount, monkeypatch):
    monkeypatch.setattr(scratch, "_configured", lambda spark: None)
    monkeypatch.setattr(scratch, "_is_shared", lambda spark, folder: True)
    assert scratch.scratch_dir(spark) == f"{spark.conf.get('spark.sql.warehouse.dir')}/stratagrid-scratch"


@pytest.mark.parametrize("name, rows", [
    ("features_written", 40), ("copied_selection", None), ("buffer_parts", None), ("ledger_newest_stored", 2),
    ("near_table", None), ("fill_mask", None)])
def test_queries_run_on_a_shared_mount(spark, mount, tmp_path, name, rows):
    made = {
        "customer": ([(i,) for i in range(40)], "c_custkey long"),
        "supplier": ([(i,) for i in range(5)], "s_suppkey long"),
        "orders": ([(i, i % 40, 1000.0 * (i * 37 % 500)) for i in range(400)],
                   "o_orderkey long, o_custkey long, o_totalprice double"),
        "events": ([(i, i, datetime(2024, 1, 1 + i // 2), "click") for i in range(6)],
                   "event_id long, user_id long, ts timestamp, event_type string"),
    }
    for table, (values, kinds) in made.items():
        spark.createDataFrame(values, kinds).write.parquet(f"{tmp_path}/in/{table}.parquet")
    got = QUERIES[name](spark, f"{tmp_path}/in").count()
    assert got == rows if rows is not None else got > 0
