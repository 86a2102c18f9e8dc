"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every result is produced in full (``noop`` sink), after one query that only starts the JVM and its
workers (``warm_up``).  The saved terrain rasters start empty: ``fill_dem`` pays for the fill,
``flow_direction`` for the directions, and so on; a later query reads what an earlier one saved.
``cold`` adds to a terrain query what the earlier ones have paid for it.
"""

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from stratagrid.queries import QUERIES  # noqa: E402

HEADLINE = [
    "road_join_count", "point_tile", "plan_batch", "buffer_erased", "buffer_parts", "top2_parts",
    "hillshade", "zonal_table", "near_table", "region_group", "value_regions", "fill_dem",
    "flow_direction", "flow_accumulation", "sink_points", "cost_distance", "flow_path_lines",
    "road_crossing_lines", "isolated_lines",
]
#: the headline queries whose saved rasters a query reads
TERRAIN = {
    "flow_direction": ["fill_dem"], "flow_accumulation": ["fill_dem", "flow_direction"],
    "sink_points": ["fill_dem", "flow_direction", "flow_accumulation"],
    "flow_path_lines": ["fill_dem", "flow_direction", "flow_accumulation"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("stratagrid-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.time()
    QUERIES["buffer_parts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    warm_up, seconds = round(time.time() - start, 3), {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    cold = {name: round(sum(seconds.get(n, 0) for n in needs) + seconds[name], 3)
            for name, needs in TERRAIN.items() if name in seconds}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None, "cpus": int(cpus),
        "warm_up": warm_up, "cold": cold,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
