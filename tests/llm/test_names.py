"""Operators that give the caller's columns back keep them whatever their names, and long texts stay linear."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratagrid.llm import exact, jaccard, mixing, resample

NAMES = ["own", "suspect", "digest", "keep", "_digest", "_keep", "_suspect", "_d", "_t", "_stays", "_key", "_may_go",
         "stays", "key", "mark_id", "mark_hash", "may_go", "text_hash", "row", "rows", "place", "places", "turn", "counts",
         "taken", "_s", "_r", "_p", "_e", "_row", "_text", "_places", "place_id", "place_source", "place_row", "size",
         "log_weight", "gumbel_key", "n", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, "a"), (2, base, "a"), (3, base + " more", "b"), (4, "short", "b"), (5, None, None),
            (6, " ".join(f"v{i}" for i in range(200)), "b"), (None, "nobody", "a")]
    named = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return named.select("*", *[F.concat(F.lit(f"{n}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("x"))).alias(n)
                               for n in NAMES])


def intact(df, columns):
    assert df.columns == columns
    rows = df.collect()
    for r in rows:
        for n in NAMES:
            assert r[n] == f"{n}-{'x' if r['doc_id'] is None else r['doc_id']}"
    return sorted(str(r["doc_id"]) for r in rows)


def test_names_of_exact_dedup(docs):
    assert intact(exact.drop_exact_duplicates(docs), docs.columns) == ["2", "3", "4", "5", "6", "None"]


def test_names_of_near_dedup(docs):
    assert intact(jaccard.keep_one_of_each(docs), docs.columns) == ["1", "4", "5", "6", "None"]


def test_names_of_the_mix(docs):
    mixed = mixing.mixed_documents(docs)
    kept = set(intact(mixed, docs.columns))
    assert kept and kept <= {"1", "2", "3", "4", "6", "None"}


def test_names_of_the_quality_stage(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    intact(corpus_pipeline.quality(spark, docs, str(tmp_path)), docs.columns)
    ratios = resample.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    numbered = resample.resample(docs, ratios, k=3)
    assert numbered.columns == [c for c in docs.columns if c not in ("log_weight", "gumbel_key")] + ["log_weight", "gumbel_key"]
    assert dict(numbered.dtypes)["log_weight"] == "double"


def test_long_documents_mix_in_linear_time(spark):
    def seconds(words):
        docs = spark.createDataFrame([(1, "w " * words, "a"), (2, "v " * (words // 7), "b"), (3, "u " * 50, "c")],
                                     "doc_id long, text string, source string")
        start = time.time()
        mixing.mixed_documents(docs).write.format("noop").mode("overwrite").save()
        return time.time() - start

    seconds(1000)
    assert seconds(2_000_000) < 60
