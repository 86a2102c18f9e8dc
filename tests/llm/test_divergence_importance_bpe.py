"""Source divergence, importance resampling and byte-level BPE against brute force on small hostile tables."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stratagrid.llm import bpe, byteterms, divergence, importance, queries

DOCS = ("doc_id long, text string, lang string, source string, term string, `group` int, p int, rest string, row long, "
        "score string, n_words string, weight int, measures int, part int, ids int, decoded string, rank int")
EXTRA = ("t", 1, 2, "r", 7, "s", "n", 3, 4, 5, 6, "d", 8)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def letters(text):
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered(text))


def letters_digits(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = []
    for i in range(90):
        n = rng.choice([0, 3, 25, 40, 200])
        words = " ".join(f"{rng.choice('abcdé日')}{'xyz'[rng.randrange(3)]}{rng.randrange(6)}" for _ in range(n))
        # one source holds a third of all rows
        source = "hot" if i % 3 == 0 else rng.choice(["s1", "s2", None, "", "Ü"])
        out.append((i, words, rng.choice(["de", "en", None]), source))
    out += [(3, out[3][1], "en", "hot")] * 40 + [(None, out[4][1] or "x", "en", "s1")] * 3
    out += [(200, None, "en", "nothing"), (201, "", "xx", "a"), (202, "1 2 3 \x00", "xx", "b"),
            (203, "alone once", "yy", "a"), (204, "Ab-aB_AB\n" * 4000, "en", "s2"), (205, "x1y " * 30, "en", "s1"),
            (206, "x1y " * 30, "en", "s1")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCS).repartition(5)


# ---------------------------------------------------------------- source divergence

def audit_by_hand(rows, min_docs=3, top=200):
    per_group, in_docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = letters(text)
        per_group[lang, source].update(words)
        in_docs[lang].update(set(words))
    out = Counter()
    for lang in {g[0] for g in per_group}:
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        groups = {s: c for (l, s), c in per_group.items() if l == lang}
        groups[None] = sum(groups.values(), Counter())

        def rates(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        rate = {s: rates(c) for s, c in groups.items()}
        for source in set(groups) - {None}:
            p = rate[source]
            pairs = [(o, sum((p[t] - rate[o][t]) ** 2 // rate[o][t] for t in kept)) for o in groups if o not in (None, source)]
            terms = [(t, (p[t] - rate[None][t]) ** 2 // rate[None][t]) for t in kept
                     if groups[source][t] and p[t] > rate[None][t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out.update((lang, source, part, item, value, n + 1) for n, (item, value) in enumerate(items[:most]))
    return out


def audited(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return Counter(tuple(r) for r in df.collect())


def test_divergence(docs, rows):
    assert audited(divergence.audit(docs)) == audit_by_hand(rows)
    assert audited(divergence.audit(docs, min_docs=1, top_terms=2)) == audit_by_hand(rows, 1, 2)


def test_divergence_flushes_and_salts(docs, rows, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH", 3)
    monkeypatch.setattr(divergence, "_ROWS", 2)
    import stratagrid.scratch as scratch
    monkeypatch.setattr(scratch, "TASK_BYTES", 0)
    assert audited(divergence.audit(docs)) == audit_by_hand(rows)


def test_divergence_of_empty_tables(spark, docs):
    assert divergence.audit(docs.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None, None, None), (2, None, None, "b")],
                                    "doc_id long, text string, lang string, source string")
    assert audited(divergence.audit(nothing)) == Counter([("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)])


def test_rates_beyond_64_bits(spark):
    big = 3 * 10 ** 12
    df = spark.createDataFrame([(big, 7 * big, 10)], "c long, n long, v long")
    got = df.select(divergence._rate(F.col("c"), F.col("n"), F.col("v")).alias("p")).first()["p"]
    assert got == 1 + 1_000_000_000 * (big + 1) // (7 * big + 10)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aZ09 _\n\x1c\x85é日-'")), max_size=40), st.integers(1, 9))
def test_words_by_stretches(text, stretch):
    old, byteterms.STRETCH = byteterms.STRETCH, stretch
    try:
        for table, expected in ((byteterms.LETTERS, letters), (byteterms.LETTERS_DIGITS, letters_digits)):
            got = [w.decode() for part in byteterms.words(text.encode(), table) for w in part]
            assert got == expected(text)
        runs = Counter()
        for _, found in importance.buckets(text.encode()):
            runs.update(found.tolist())
        assert runs == Counter(zlib.crc32(f.encode()) % 10000 for f in features(text))
    finally:
        byteterms.STRETCH = old


# ---------------------------------------------------------------- importance resampling

def features(text):
    words = letters_digits(text)
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def resample_by_hand(rows, targets, percent=5, min_words=20):
    raw, target = Counter(), Counter()
    for row in rows:
        raw.update(zlib.crc32(f.encode()) % 10000 for f in features(row[1]))
    for text in targets:
        target.update(zlib.crc32(f.encode()) % 10000 for f in features(text))
    s_all, t_all = sum(raw.values()) + 10000, sum(target.values()) + 10000
    gain = {b: math.floor(1000 * math.log((target[b] + 1) * s_all / ((raw[b] + 1) * t_all))) for b in range(10000)}
    out = []
    for doc_id, text, *_ in rows:
        found = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(letters_digits(text)), len(found), weight, score))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = defaultdict(list)
    for n, row in enumerate(able[:len(able) * percent // 100]):
        rank[row].append(n + 1)
    return Counter((*r, rank[r].pop() if rank[r] else None) for r in out)


TARGETS = ["ax1 bx2 ay3 " * 5, None, "", "x1y x1y"]


@pytest.fixture(scope="module")
def targets(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TARGETS)], "item_id long, text string")


@pytest.mark.parametrize("percent", [5, 37, 100])
def test_resampling(docs, rows, targets, percent, monkeypatch):
    monkeypatch.setattr(importance, "PIVOTS", 3)
    got = importance.resample(docs, targets, percent=percent, keep=("lang", "score", "row", "measures"))
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank", "lang"]
    assert Counter(tuple(r)[:6] for r in got.collect()) == resample_by_hand(rows, TARGETS, percent)


def test_resampling_of_empty_tables(spark, docs, targets):
    assert importance.resample(docs.limit(0), targets).count() == 0
    got = importance.resample(docs.filter("doc_id < 5"), targets.limit(0), percent=50)
    assert got.filter("rank is not null").count() == got.filter("n_words >= 20").count() // 2


def test_kth_key_finds_every_rank(spark, monkeypatch):
    monkeypatch.setattr(importance, "PIVOTS", 2)
    rng = random.Random(2)
    rows = [(rng.randrange(4), rng.choice([None, 1, 2]), i) for i in range(24)]
    table = spark.createDataFrame(rows, "score long, doc_id long, row long").cache()
    order = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    for k in (1, 2, 11, 23, 24):
        key = importance._key(*map(F.col, importance.KEY))
        drawn = table.filter(key <= importance.kth_key(table, k)).collect()
        assert sorted(map(tuple, drawn), key=str) == sorted(order[:k], key=str)
    table.unpersist()


def test_resampling_by_names_of_text_ids(spark, targets):
    rows = [("", "w " * 30), ("b", "w " * 30), (None, "w " * 30), ("b", "w " * 30)]
    named = spark.createDataFrame(rows, "url string, body string")
    got = importance.resample(named, targets, doc_id="url", text="body", percent=75)
    assert got.count() == 4 and sorted(r["rank"] for r in got.filter("rank is not null").collect()) == [1, 2, 3]


# ---------------------------------------------------------------- byte-level BPE

def library(path=None):
    import tiktoken
    path, pattern = bpe.rank_file(path, None)
    ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_round_trip(spark, docs, rows):
    whole = library()
    got = Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in bpe.round_trip(docs).collect())
    assert got == Counter((r[0], tuple(whole.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in rows)
    assert bpe.round_trip(docs.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'st1!  \n\t　\x1c\x85é日")), max_size=80))
def test_cuts_are_safe(text):
    codec, whole = bpe.codec(*bpe.rank_file(None, None)), library_once()
    old = bpe.STRETCH, bpe._RUN
    bpe.STRETCH, bpe._RUN = 3, re.compile(f"[{bpe._WHITE}]{{4,}}")
    try:
        ids = codec.encode(text)
    finally:
        bpe.STRETCH, bpe._RUN = old
    assert ids == whole.encode_ordinary(text) and codec.decode(ids) == text.encode()


_whole = []


def library_once():
    if not _whole:
        _whole.append(library())
    return _whole[0]


def test_very_long_texts():
    codec = bpe.codec(*bpe.rank_file(None, None))
    for text in (" " * 3_000_000 + "b", "x" + "\n" * 2_000_000, "a" * 2_000_000, "日" * 500_000, "ab c\n" * 400_000):
        assert codec.decode(codec.encode(text)) == text.encode()
    shorter = "one two  three\n\n four's 55 " * 20_000
    assert codec.encode(shorter) == library_once().encode_ordinary(shorter)


def test_raw_bytes_of_partial_characters(spark):
    ids = library_once().encode_ordinary("日")
    assert len(ids) > 1 or library_once().decode_bytes(ids) == "日".encode()
    cut = spark.createDataFrame([(ids[:1],), ([],), (None,)], "ids array<int>")
    got = [bytes(r["b"]) for r in cut.select(bpe.decode(F.col("ids")).alias("b")).collect()]
    assert got == [library_once().decode_bytes(ids[:1]), b"", b""]


def test_query_of_the_round_trip(spark, tmp_path, docs, rows):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    whole = library_once()
    expected = Counter()
    for doc_id, text, *_ in rows:
        ids = whole.encode_ordinary(text or "")
        expected[doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                 hashlib.sha256((text or "").encode()).hexdigest()] += 1
    got = queries.op13_bpe_round_trip(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == expected
