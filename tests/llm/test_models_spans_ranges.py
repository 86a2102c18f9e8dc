"""Importance models, license spans, token ranges and crowds of equal rows, against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stratagrid.llm import bitpack, licenses, mixing, resample, substrings, words

MASK = (1 << 64) - 1


def prose(rng, n, vocabulary=200):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---------------------------------------------------------------- quality: n-grams, ratios, weights

def scramble(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def word_hash(word):
    return int(words.word_hashes(pa.array([word]), lower=True)[0][0])


def kind(byte):
    for number, some in ((1, range(65, 91)), (2, range(48, 58)), (3, b",;:"), (4, b".?")):
        if byte in some:
            return number
    return 5 if 33 <= byte < 128 and not chr(byte).isalnum() else 0


def ngrams(text):
    """The buckets of a text, word by word: families apart."""
    out, last, last_shape = [], 0x1FFF, 0x1FFF
    for word in split(text):
        raw, h = word.encode(), word_hash(word)
        length = 0 if len(raw) < 3 else 1 if len(raw) < 6 else 2 if len(raw) < 10 else 3 if len(raw) < 16 else 4
        shape = ((h == last) | kind(raw[0]) << 1 | kind(raw[min(1, len(raw) - 1)]) << 4 | kind(raw[-1]) << 7 | length << 10)
        both = (last_shape << 13 | shape) * 2654435761 & 0xFFFFFFFF
        out += [h >> 48, (scramble(h + last * 0x9E3779B97F4A7C15 & MASK) >> 48) + 65536, (both >> 16) + 2 * 65536]
        last, last_shape = h, shape
    return out


def test_ratios_and_weights_equal_brute_force(spark):
    rng = random.Random(17)
    bits = ["The", "the", "cat,", "sat.", "12", "é", "a", "internationalisation", "No!", "日本", "x" * 20, "b\x0bc"]
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randrange(0, 40)))) for i in range(120)]
    rows += [(None, "The cat, sat."), (200, None), (201, " \n"), (3, "a second text of id 3"), (202, "e" * 9000 + " a a")]
    labels = [(i, i % 3 % 2) for i in range(0, 120)] + [(None, 1), (202, 1), (202, 1), (777, 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ratios = resample.fit(table, spark.createDataFrame(labels, "doc_id long, quality int"))
    good = {d for d, q in labels if q == 1 and d is not None}
    raw, target = Counter(), Counter()
    for d, text in rows:
        raw.update(ngrams(text))
        if d in good:
            target.update(ngrams(text))
    share = sum(target.values()) / sum(raw.values())
    want = np.zeros(3 * 65536)
    for bucket, n in raw.items():
        want[bucket] = math.log((target[bucket] + 10) / (n * share + 10))
    assert np.allclose(ratios, want, atol=1e-12) and len(raw) > 100
    got = table.select("doc_id", "text", resample.log_weight(table.text, ratios).alias("w")).collect()
    for r in got:
        grams = ngrams(r.text)
        assert r.w is None if not grams else r.w == pytest.approx(sum(want[g] for g in grams), abs=1e-9)


def test_words_tell_what_shapes_cannot(spark):
    """Good and bad texts of the same shapes: only the words differ."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rng.randrange(30):02d}x" for _ in range(60))) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    kept = {r.doc_id for r in resample.resample(table, resample.fit(table, labels)).collect()}
    assert kept == set(range(1, 400, 2))


# ---------------------------------------------------------------- license spans

def test_license_spans(spark):
    gpl = next(t for t, label in licenses.TEMPLATES if t.startswith("licensed under the gnu"))
    number = len(licenses.BASE_PHRASES) + [t for t, _ in licenses.TEMPLATES].index(gpl)
    rows = [(1, "x y " + gpl + " z under the mit license"), (2, None), (None, "cc by nc cc by nc"), (3, ""),
            (4, "Licensed under the new GNU General Public License!")]
    table = spark.createDataFrame([(*r, "l") for r in rows], "doc_id long, text string, label string").repartition(2)
    got = {r.doc_id: r for r in licenses.license_spans(table).collect()}
    assert len(got) == 5 and got[2].spans == got[3].spans == [] and got[2].best == 0.0
    spans = lambda d: [(s.first_word, s.last_word, s.label, s.phrase, s.base, s.diagonal, round(s.coverage, 3))
                       for s in got[d].spans]
    assert spans(1) == [(2, 8, "gpl", number, False, 2, 1.0), (10, 13, "mit", 0, True, 10, 1.0)]
    assert spans(None) == [(0, 2, "cc-by-nc", 2, True, 0, 1.0), (3, 5, "cc-by-nc", 2, True, 3, 1.0)]
    # a word put in: the diagonals 0 and 1 are one span, all words of the template are under it
    assert spans(4) == [(0, 7, "gpl", number, False, 0, 1.0)]
    assert licenses.license_spans(table.limit(0)).count() == 0


# ---------------------------------------------------------------- ids by position

@pytest.mark.parametrize("block_ids", [40, 700])
def test_ranges_of_a_token_file(spark, block_ids):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(0, 60))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or one task writes it all
    try:
        path = bitpack.token_file(docs, block_ids=block_ids)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(
        bitpack.read_tokens(spark, path).collect(), key=lambda r: r.start)])
    shards = spark.read.parquet(path).select("shard").distinct().count()
    assert shards > 1
    for begin, end in [(0, 1), (0, len(whole)), (len(whole) - 1, len(whole) + 50), (17, 18), (5, 5),
                       (len(whole), len(whole) + 9), *[sorted(rng.sample(range(len(whole)), 2)) for _ in range(3)]]:
        got = sorted(bitpack.read_range(spark, path, begin, end).collect(), key=lambda r: r.start)
        at = begin
        for r in got:
            assert r.start == at and len(r.ids) == 4 * r.n_ids
            at += r.n_ids
        assert b"".join(r.ids for r in got) == whole[begin:end].astype("<u4").tobytes()
    plan = bitpack.read_range(spark, path, 17, 18)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(shard" in plan and "LessThanOrEqual(shard" in plan
    nothing = bitpack.token_file(docs.limit(0))
    assert bitpack.read_range(spark, nothing, 0, 10).count() == 0


# ---------------------------------------------------------------- crowds of equal rows

def test_mix_of_many_equal_rows(spark, monkeypatch):
    """Thousands of rows without id or text, and of one id and text: each keeps its place in the stream."""
    monkeypatch.setattr(mixing, "COPIES", 64)
    monkeypatch.setattr(mixing, "CHUNK", 2)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    rng = random.Random(2)
    rows = [(None, None, "a")] * 3000 + [(None, "three equal words", "a")] * 1500 + [(7, "one two", "b")] * 700
    rows += [(100 + i, prose(rng, rng.randrange(0, 30)), ("a", "b", None)[i % 3]) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(table, block_words=16).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((d, s, len(split(t))) for d, t, s in rows)
    streams, taken = defaultdict(list), defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
        if r.size:
            streams[r.source].append((r.start, r.size))
        else:
            assert r.taken == 0 and r.times == []
    for source, pieces in streams.items():  # the stream of a source has no gap and no overlap
        at = 0
        for start, size in sorted(pieces):
            assert start == at
            at += size
    again = mixing.mix(table.repartition(2), block_words=16).collect()
    assert Counter((r.doc_id, r.start, r.taken) for r in got if r.size) == Counter(
        (r.doc_id, r.start, r.taken) for r in again if r.size)
    words_of = defaultdict(int)
    for r in mixing.mixed_documents(table, block_words=16).collect():
        words_of[r.source] += len(split(r.text))
    assert {s: n for s, n in taken.items() if n} == dict(words_of)


def test_windows_of_many_rows_without_id(spark):
    """Rows without id come after all others and share one id: theirs go where an id has them, else stay."""
    rng = random.Random(9)
    passage, own = prose(rng, 70), prose(rng, 65)
    rows = [(None, f"{prose(rng, rng.randrange(0, 9))} {passage} {own}") for _ in range(2000)] + [(5, passage), (9, passage)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = substrings.drop_repeated_windows(table).collect()
    gone = {r.doc_id: r.n_removed for r in got if r.doc_id is not None}
    assert gone == {5: 0, 9: 70}
    without = [r for r in got if r.doc_id is None]
    assert len(without) == 2000 and all(r.n_removed == 70 and r.kept_text.endswith(own) for r in without)


def test_texts_without_removals_are_not_shuffled(spark):
    rng = random.Random(10)
    table = spark.createDataFrame([(i, prose(rng, 80)) for i in range(40)], "doc_id long, text string").repartition(3)
    plan = substrings.drop_repeated_windows(table)
    assert plan.filter("n_removed > 0").count() == 0
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in text and text.count("Join") == 1


def test_a_text_that_repeats_a_window_sends_it_once(spark, monkeypatch):
    """Texts of one line over and over: their windows are few, their places are many."""
    monkeypatch.setattr(substrings, "CROWD", 10)
    monkeypatch.setattr(substrings, "HOT_KEYS", 100_000)
    rng = random.Random(12)
    line = prose(rng, 7)
    rows = [(i, f"{prose(rng, rng.randrange(0, 30))} " + f"{line} " * rng.randrange(20, 120)) for i in range(30)]
    rows += [(None, f"{line} " * 40), (40, "x " * 400), (41, "y x " + "x " * 300), (42, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substrings.drop_repeated_windows(table).collect()
    first = {}
    place = lambda d: (d is None, d or 0)
    lists = [(d, split(t)) for d, t in rows]
    for d, w in lists:
        for i in range(len(w) - 49):
            key = tuple(w[i:i + 50])
            first[key] = min(first.get(key, place(d)), place(d))
    want = Counter()
    for d, w in lists:
        gone = {j for i in range(len(w) - 49) if first[tuple(w[i:i + 50])] < place(d) for j in range(i, i + 50)}
        want[d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == want
