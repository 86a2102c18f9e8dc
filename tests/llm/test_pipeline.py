"""The pipeline's stages on the smallest tables, each against a brute-force version on its own input."""

from collections import defaultdict

import numpy as np
import pytest
from test_operators import components_of, ids_of, split, water_level

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        out[name] = docs = spark.read.parquet(f"{folder}/{name}")
    return out


def test_all_but_the_last_return_documents(stages):
    columns = stages["documents"].columns
    assert all(stages[name].columns == columns for name, _ in corpus_pipeline.STAGES[:-1])


def test_quality_keeps_good_and_drops_bad(spark, stages):
    kept = {r.doc_id for r in stages["quality"].collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good, bad = {r.doc_id for r in labels if r.quality == 1}, {r.doc_id for r in labels if r.quality == 0}
    assert good <= kept and not bad & kept


def test_dedup_stages_keep_one_of_each(stages):
    rows = [(r.doc_id, r.text) for r in stages["quality"].collect()]
    last = {}
    for d, t in rows:
        last[t] = max(d, last.get(t, d))
    kept = [(r.doc_id, r.text) for r in stages["exact_dedup"].collect()]
    assert sorted(kept) == sorted((d, t) for t, d in last.items())
    assert sorted(r.doc_id for r in stages["near_dedup"].collect()) == sorted(
        {c for _, _, c in components_of(kept)})


def test_mix_and_packing(stages):
    sizes, taken, tokens = defaultdict(int), defaultdict(int), 0
    for r in stages["near_dedup"].collect():
        sizes[r.source] += len(split(r.text))
    for r in stages["mix_sources"].collect():
        taken[r.source] += len(split(r.text))
        tokens += len(ids_of(r.text, 1))
        assert r.n_chars == len(r.text)
    for source, target in water_level(sizes, (5, 2, 1), 3).items():
        assert abs(taken[source] - target) <= 0.03 * target + 128
    assert sum(r.length for r in stages["pack"].collect()) == tokens


def test_the_last_stage_holds_the_corpus(stages):
    """The packed ids are those of the mixed texts, also where several rows have one doc_id."""
    ids = lambda rows: np.bincount(np.concatenate(rows))
    packed = ids([np.frombuffer(r.ids, "<u4") for r in stages["pack"].collect()])
    assert packed.tolist() == ids([ids_of(r.text, 1) for r in stages["mix_sources"].collect()]).tolist()


def test_run_is_the_stages(spark, stages):
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect()))
    assert len(got) > 0 and sum(g[2] for g in got) == sum(r.length for r in stages["pack"].collect())
