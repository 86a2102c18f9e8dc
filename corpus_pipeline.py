"""A training corpus from raw documents, one operator after another.

Quality resampling, exact dedup, near-duplicate join, mixing of sources, packing.  Every stage takes
all that its predecessor kept and returns the columns of ``documents``; the last returns the pieces of
the packed sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagrid.llm import exact, jaccard, mixing, packing, resample
from stratagrid.scratch import scratch_dir
from stratagrid.ship import ship_package


#: Chunks whose ids a worker keeps: the workers of the earlier stages stay alive beside it.
TOKEN_CACHE = 1 << 16


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling towards the labelled good ones; rejected ones go."""
    ship_package(spark)
    ratios = resample.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return resample.resample(docs, ratios, with_numbers=False)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the greatest id."""
    return exact.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents, the one with the least id."""
    ship_package(spark)
    return jaccard.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the amounts of the mix: up to three rows each, with the words taken."""
    mixed = mixing.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed token sequences."""
    ship_package(spark)
    return packing.pack(docs, cache=TOKEN_CACHE)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: Hash-drawn noise, permutations and tokens have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again by the next."""
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
