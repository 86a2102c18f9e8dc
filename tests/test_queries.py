"""Registered queries against their SQL on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from stratagrid.oracles import ORACLES
from stratagrid.queries import QUERIES

SF = "/root/testdata/sf0.001"
# those that no other test covers end to end
NAMES = [
    "plan_batch", "ledger_append_rows", "classify_structures", "tile_manifest", "buffer_parts",
    "min_points_dedup", "side_lines", "snapped_lines", "dissolve_parts", "sink_points",
    "flow_path_lines", "road_crossing_lines", "isolated_lines", "ledger_batch_append", "value_at_saved_point",
]


def value(v):
    return round(v, 6) + 0.0 if isinstance(v, float) else v


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("customer", "supplier", "orders", "events"):
        duck.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = sorted((tuple(map(value, r)) for r in cursor.fetchall()), key=repr)
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(map(value, r)) for r in df.select(*columns).collect()), key=repr) == expected


PLANNED = [
    "road_join_count", "point_tile", "points_in_tiles", "points_out_of_bounds", "buffer_erased", "hillshade",
    "zonal_max", "pour_points", "window_cells", "masked_cells", "join_one_field", "ledger_pending",
]


def test_plans_have_no_nested_loops_even_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in PLANNED:
            plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
            for bad in ("NestedLoop", "Cartesian", "Broadcast"):
                assert bad not in plan, (name, bad)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_read_only_what_they_need(spark):
    plan = entry.queries()["hillshade"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet [o_orderkey" in plan and "o_custkey" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
