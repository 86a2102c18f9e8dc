import os
import sys

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratagrid.grid import GridSpec  # noqa: E402
from stratagrid.ship import ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("stratagrid-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


def grid_for(array, block=64, **kwargs):
    return GridSpec(ncol=array.shape[1], nrow=array.shape[0], block=block, **kwargs)


def cells_of(spark, array, name="z"):
    """A raster DataFrame; NaN cells are left out."""
    rows = [
        (int(c), int(r), int(array[r, c]))
        for r in range(array.shape[0]) for c in range(array.shape[1]) if not np.isnan(float(array[r, c]))
    ]
    return spark.createDataFrame(rows, f"col long, row long, {name} long")


def as_map(df, *names):
    """``{(col, row): value(s)}`` of a raster DataFrame."""
    out = {}
    for r in df.select("col", "row", *names).collect():
        out[(r["col"], r["row"])] = r[names[0]] if len(names) == 1 else tuple(r[n] for n in names)
    return out


D8 = ((1, 1, 0), (2, 1, 1), (4, 0, 1), (8, -1, 1), (16, -1, 0), (32, -1, -1), (64, 0, -1), (128, 1, -1))
