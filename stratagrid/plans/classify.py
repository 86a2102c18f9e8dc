"""On-road / off-road classification of structures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagrid.operators.joins import join_count


def classify(structures: DataFrame, roads: DataFrame, size: float) -> DataFrame:
    """Every structure with its ``join_count`` and ``on_road``."""
    return join_count(structures, roads, size).withColumn("on_road", F.col("join_count") > 0)


def on_road(structures: DataFrame, roads: DataFrame, size: float) -> DataFrame:
    return classify(structures, roads, size).filter("on_road").drop("on_road")


def off_road(structures: DataFrame, roads: DataFrame, size: float) -> DataFrame:
    return classify(structures, roads, size).filter("not on_road").drop("on_road")
