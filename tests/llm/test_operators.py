"""Every training-data operator against a brute-force version on small hostile tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from stratagrid.llm import (bitpack, exact, jaccard, licenses, mixing, packing, resample, substrings, tokens,
                            urls, vafile, words)

DOCS = "doc_id long, text string, source string, rank int, n long, target string"


def prose(rng, n, vocabulary=200):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [prose(rng, n) for n in (3, 5, 60, 120, 400, 90, 700)]
    near = base[3].split()
    near[7] = "changed"
    some = base + [base[3], base[3], " ".join(near), base[2].upper(), base[5] + " " + base[2], None, "", " \n\t ",
                   "one", "One", "x " * 3000, prose(rng, 80) + "\n" + " ".join(base[4].split()[100:170]),
                   "é à 日本 " * 30, "a\x0bb\x0cc\rd"]
    rows = [(i, t, ("b", "a", None)[i % 3], 1, 2, "z") for i, t in enumerate(some)]
    return rows + [rows[3], (None, base[3], "a", 1, 1, ""), (None, "one", "a", 1, 1, ""), (4, "another text", "b", 1, 1, "")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def split(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# ---------------------------------------------------------------- packing

def ids_of(text, end):
    encode = tokens.encoder(tokens.vocabulary_path(None)).tokenizer.encode
    return np.array(encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.mark.parametrize("capacity,open_windows", [(64, 4), (2048, 64)])
def test_packing_loses_no_id_and_leaves_no_gap(docs, texts, capacity, open_windows):
    pieces = packing.pack(docs, capacity=capacity, open_windows=open_windows, cut_gap=4).collect()
    whole = Counter((t[0], len(ids_of(t[1], 1))) for t in texts)
    assert Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0) == whole
    possible = defaultdict(list)
    for t in texts:
        possible[t[0]].append(ids_of(t[1], 1))
    for p in pieces:
        assert any(len(i) == p.doc_tokens and zlib.crc32(i[p.start:p.start + p.length].tobytes()) == p.ids_crc32
                   for i in possible[p.doc_id])
    assert sum(p.length for p in pieces) == sum(n * c for (_, n), c in whole.items())
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    assert len(sequences) <= 1.3 * sum(p.length for p in pieces) / capacity + 4


def test_packed_sequences_hold_the_ids(docs, texts):
    """Windows that a task fills and windows of leftovers that meet later, both with their ids."""
    pieces = packing.pack(docs, capacity=64, open_windows=4, cut_gap=4).collect()
    possible = defaultdict(list)
    for t in texts:
        possible[t[0]].append(ids_of(t[1], 1))
    sequences, total = defaultdict(bytes), 0
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert any(len(i) == p.doc_tokens and i[p.start:p.start + p.length].tobytes() == p.ids
                   for i in possible[p.doc_id])
        assert len(sequences[p.sequence_id]) == 4 * p.offset
        sequences[p.sequence_id] += p.ids
    assert all(len(s) <= 4 * 64 for s in sequences.values())
    assert Counter(np.frombuffer(b"".join(sequences.values()), "<u4").tolist()) == Counter(
        i for t in texts for i in ids_of(t[1], 1).tolist())


def test_packing_an_empty_table(spark):
    assert packing.pack(empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "a", "B", "'s", "é", "!?", "12", "\t", "\x1c", "　", "<|endoftext|>"]),
                max_size=20))
def test_chunked_encoding_equals_the_whole(parts):
    text = "".join(parts)
    own = tokens.encoder(tokens.vocabulary_path(None))
    assert np.frombuffer(own.encode(text), "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


_fresh = {}  # tokenizers as the library loads them


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([" ", "\n", "a", "'s", "é", "!?", "<|endoftext|>", "<|endof", "text|>"]), max_size=12))
def test_added_tokens_are_encoded_as_the_library_does(parts):
    from tokenizers import Tokenizer

    path, text = tokens.vocabulary_path(None), "a <|endoftext|> b" + "".join(parts)
    fresh = _fresh.get(path) or _fresh.setdefault(path, Tokenizer.from_file(path))
    for t in (text, "".join(parts)):
        assert np.frombuffer(tokens.encoder(path).encode(t), "<u4").tolist() == fresh.encode(t, add_special_tokens=False).ids
    assert np.frombuffer(tokens.encoder(path).encode("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]


# ---------------------------------------------------------------- token files

@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.data())
def test_bit_packing_round_trip(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2 ** bits - 1), max_size=50)), np.uint32)
    payload = bitpack.pack_ids(ids, bits)
    assert len(payload) == -(-len(ids) * bits // 8)
    first = data.draw(st.integers(0, len(ids)))
    n = data.draw(st.integers(0, len(ids) - first))
    assert bitpack.unpack_ids(payload, bits, first, n).tolist() == ids[first:first + n].tolist()


def test_token_file_holds_all_ids_in_order(spark, docs, texts):
    path = bitpack.token_file(docs, block_ids=500)
    got = sorted(bitpack.read_tokens(spark, path).collect(), key=lambda r: r.start)
    order = sorted(texts, key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or ""))
    at = 0
    for row, t in zip(got, order, strict=True):
        ids = ids_of(t[1], 0)
        assert (row.doc_id, row.start, row.n_tokens) == (t[0], at, len(ids)) and row.ids == ids.tobytes()
        at += len(ids)
    assert bitpack.read_tokens(spark, bitpack.token_file(empty(spark))).count() == 0


# ---------------------------------------------------------------- top-k

def test_top_k_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(-3, 4)) / 8 for _ in range(6)], 1) for i in range(400)]
    rows += [(1000, None, 1), (1001, [1.0, None], 1), (1002, [float("nan")] * 6, 1), (1003, [math.inf] * 6, 1),
             (1050, [0.5, 0.5], 1), (None, [1.0] * 6, 1), (1100, [], 1), (7, rows[7][1], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int").repartition(4)
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = Counter()
    for q, x in ok:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q)[:5]
            expected.update((q, n + 1, i, -s) for n, (s, i) in enumerate(scored))
    assert rows_of(vafile.top_k(table), "query_id", "rank", "vec_id", "score") == expected
    assert vafile.top_k(table.limit(0)).count() == 0


# ---------------------------------------------------------------- exact dedup

def test_exact_duplicates(docs, texts, spark):
    groups = defaultdict(list)
    for t in texts:
        groups[t[1] or ""].append(t[0])
    for digest_all in (True, False):
        got = exact.exact_duplicates(docs, digest_all=digest_all).collect()
        want = Counter()
        for body, ids in groups.items():
            keep = max((i for i in ids if i is not None), default=None)
            want.update((i, keep, len(ids)) for i in ids)
        assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)
        digests = Counter(hashlib.sha256((t[1] or "").encode()).hexdigest() for t in texts)
        if digest_all:
            assert Counter(r.text_sha256 for r in got) == digests
    left = exact.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert Counter(r.text or "" for r in left.collect()) == Counter(list(groups))
    assert exact.exact_duplicates(empty(spark)).count() == 0 == exact.drop_exact_duplicates(empty(spark)).count()


# ---------------------------------------------------------------- quality

def test_resampling_keeps_good_text_of_unseen_words(spark):
    rng = random.Random(8)
    good = lambda: ". ".join(prose(rng, 8, 10_000).capitalize() for _ in range(rng.randrange(2, 30)))
    bad = lambda: " ".join(f"W{rng.randrange(9999)}!!" for _ in range(rng.randrange(8, 90)))
    rows = [(i, bad() if i % 5 == 0 else good(), 3) for i in range(600)] + [(600, None, 1), (601, "", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, log_weight int").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(300)] + [(None, 1)], "doc_id long, quality int")
    ratios = resample.fit(table, labels)
    kept = {r.doc_id for r in resample.resample(table, ratios).collect()}
    held_out = range(300, 600)
    assert sum((i in kept) == (i % 5 > 0) for i in held_out) >= 0.99 * len(held_out)
    assert kept == {r.doc_id for r in resample.resample(table.repartition(5), ratios).collect()}
    assert not kept & {600, 601}
    assert len(resample.resample(table, ratios, k=100).collect()) == 100
    assert resample.resample(table.limit(0), resample.fit(table.limit(0), labels)).count() == 0


def test_gumbel_top_k_draws_by_weight(spark):
    """With weights 1:2:4 the first draw follows their shares."""
    from pyspark.sql import functions as F

    noise = resample.gumbel(3, F.col("id"), F.col("w"))
    first = spark.range(6000).crossJoin(spark.createDataFrame([(1,), (2,), (4,)], "w int")).select(
        "id", "w", (F.log(F.col("w").cast("double")) + noise).alias("key")).groupBy("id").agg(
        F.max_by("w", "key").alias("w")).groupBy("w").count().collect()
    share = {r["w"]: r["count"] / 6000 for r in first}
    assert all(abs(share[w] - w / 7) < 0.03 for w in (1, 2, 4))


@pytest.mark.parametrize("k", [1, 2, 57, 500, 1000])
def test_kth_greatest(spark, k):
    rng = random.Random(k)
    values = [rng.choice([rng.gauss(0, 1), -1e6, 3.0]) for _ in range(1000)]
    table = spark.createDataFrame([(v,) for v in values], "v double")
    assert resample.kth_greatest(table, "v", k) == sorted(values, reverse=True)[k - 1]


# ---------------------------------------------------------------- mixing

def water_level(sizes, weights, most):
    total = sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped, free = {}, set(), float(total)
    while True:
        open_ = [s for s in order if s not in capped]
        share = {s: free * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = float(most * sizes[s])
            free -= target[s]
            capped.add(s)


def test_mix_meets_its_targets(spark):
    rng = random.Random(9)
    shares = {"a": 40, "b": 3, "c": 400, None: 90, "é": 30, "empty": 1}
    rows = [(i, None if s == "empty" else prose(rng, rng.randrange(0, 200)), s)
            for i, s in enumerate(rng.choices(list(shares), list(shares.values()), k=700))]
    rows += [rows[0], rows[0], (None, "x y", "c"), (5000, prose(rng, 20_000), "a")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(table, block_words=16).collect()
    size = [len(split(t)) for _, t, _ in rows]
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(
        (d, s, n) for (d, _, s), n in zip(rows, size))
    sizes = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        sizes[s] += n
    want = water_level(sizes, (5, 2, 1), 3)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, target in want.items():
        assert abs(taken[s] - target) <= 0.02 * target + 32
    again = mixing.mix(table.repartition(2), block_words=16).collect()
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again)
    assert mixing.mix(empty(spark)).count() == 0

    mixed = mixing.mixed_documents(table, block_words=16).collect()
    words_of = defaultdict(int)
    for r in mixed:
        words_of[r.source] += len(split(r.text))
    assert {s: n for s, n in taken.items() if n} == dict(words_of)
    original = {d: t for d, t, _ in rows}
    assert all(set(split(r.text)) <= set(split(original[r.doc_id])) for r in mixed)


def test_mix_agrees_on_copies_with_other_ids(spark):
    rng = random.Random(14)
    rows = [(i, "a copy of one text with nine words in it", "a") for i in range(300)]
    rows += [(i, prose(rng, rng.randrange(1, 40)), "ab"[i % 2]) for i in range(300, 450)]
    again = []
    for n in (1, 3, 7):
        rng.shuffle(rows)
        table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(n)
        again.append(rows_of(mixing.mix(table, block_words=16), "doc_id", "source", "size", "start", "taken"))
    assert sum(again[0].values()) == len(rows) and again[0] == again[1] == again[2]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permuted_is_one_to_one(spark, n):
    from pyspark.sql import functions as F

    out = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(7))).collect()]
    assert sorted(out) == list(range(n)) and (n < 64 or out != sorted(out))


# ---------------------------------------------------------------- urls

def test_url_filter(spark):
    listed = [None, "", "no scheme", "http://EXAMPLE.org/es/x", "https://a.b.example.org/en/12?q", "https://org/", "x://org",
              "http://notorg/", "http://shop.com/fr/poker", "http://shop.com/de/", "http://a.net/porn", "http://a.net/porno",
              "http://a.net/Casino-Poker#x", "http://casino.net/casino", "//x://y.net?u=http://z.org/", "a://", "://com/de/é"]
    pages = spark.createDataFrame([(i, u, "t") for i, u in enumerate(listed)] + [(None, listed[3], "t")],
                                  "page_id long, url string, rule string")
    got = {r.page_id: r for r in urls.filter_urls(pages).collect()}
    assert len(got) == len(listed) + 1
    for i, url in enumerate(listed):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
        path = m[2] if m else ""
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        low = (url or "").lower()
        has = lambda t: re.findall(rf"(?<![a-z0-9]){t}(?![a-z0-9])", low)
        bad = any(has(t) for t in urls.STRICT) or sum(bool(has(t)) for t in urls.SOFT) >= 2
        r = got[i]
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == (max(fits)[1:] if fits else (None, "block" if bad else "allow"))
    assert urls.filter_urls(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- licenses

def test_license_scan(spark):
    mit = licenses.TEMPLATES[0][0]
    changed = mit.split()
    del changed[9]
    rows = [(0, "Released UNDER the MIT-license. under the mit license"), (1, "Apache License, Version 2.0"),
            (2, "licensed under CC BY-NC 4.0."), (3, None), (4, ""), (5, "no license at all " * 200),
            (6, "é " * 50 + mit.capitalize()), (7, " ".join(changed)), (8, "under the mit"), (9, "cc by nc cc by nc"),
            (0, "a second text cc by nc"), (None, "cc by nc"), (10, "This work is licensed under the GNU General Public License")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(2)
    got = licenses.scan_licenses(table).collect()
    want = Counter()
    for d, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        at = [(i, label) for phrase, label in licenses.BASE_PHRASES for i in range(len(w))
              if w[i:i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in at]
        want[d, len(w), len(at), min(starts, default=None), max(starts, default=None),
             ",".join(sorted({x for _, x in at}))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    labels = {r.doc_id: r for r in got if r.doc_id in (6, 7, 8, 10)}
    assert labels[6].labels == "mit" and labels[6].score == 1.0
    assert labels[7].labels == "mit" and 0.6 <= labels[7].score < 1.0
    assert labels[8].labels == "" and labels[10].labels == "gpl"
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert licenses.scan_licenses(table.limit(0)).count() == 0


# ---------------------------------------------------------------- similar documents

def shingles(text):
    w = split(text, lower=True)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components_of(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    name = {r: min((d for d in ids if d is not None), default=None) for r, ids in least.items()}
    return Counter((d, len(sets[i]), name[find(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("cells", [None, 1 << 15])
def test_similar_components(docs, texts, cells):
    got = jaccard.similar_components(docs, cells=cells)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == components_of([t[:2] for t in texts])


def test_components_of_chains_and_crowds(spark):
    """Copies that drift apart step by step, and a crowd about one text: links must not be lost."""
    rng = random.Random(12)
    rows, text = [], [f"c{i}" for i in range(120)]
    for i in range(30):
        rows.append((1000 - i, " ".join(text)))
        text = list(text)
        text[rng.randrange(120)] = f"drift{i}"
    crowd = [f"k{i}" for i in range(200)]
    for i in range(80):
        changed = list(crowd)
        for _ in range(rng.randrange(0, 5)):
            changed[rng.randrange(200)] = f"n{rng.randrange(9)}"
        rows.append((i, " ".join(changed)))
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(jaccard.similar_components(table), "doc_id", "n_shingles", "component_id") == components_of(rows)
    kept = jaccard.keep_one_of_each(table).collect()
    assert {r.doc_id for r in kept} == {c for _, _, c in components_of(rows)}


def test_one_row_of_each_group_stays(spark):
    """Groups without ids, with one id on different texts, and with a row repeated; lone rows stay."""
    rng = random.Random(33)
    base = [prose(rng, 150, 5000) for _ in range(5)]
    near = lambda t, n: t + "".join(f" more{i}" for i in range(n))
    rows = [(None, base[0]), (None, near(base[0], 1)), (None, near(base[0], 2)), (None, base[0]),
            (5, base[1]), (5, near(base[1], 1)), (9, near(base[1], 2)), (None, near(base[1], 3)),
            (5, base[2]), (7, near(base[2], 1)), (8, base[3]), (8, base[3]), (None, base[4]), (6, None), (6, ""), (6, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in jaccard.keep_one_of_each(table).collect()]
    group = lambda t: next((b for b in base if t and t.startswith(b)), "")
    assert Counter((d, group(t)) for d, t in kept) == Counter(
        [(None, base[0]), (5, base[1]), (5, base[2]), (8, base[3]), (None, base[4]), (6, ""), (6, ""), (6, "")])


def test_similar_components_of_nothing(spark):
    assert jaccard.similar_components(empty(spark)).count() == 0
    assert jaccard.keep_one_of_each(empty(spark)).columns == empty(spark).columns


# ---------------------------------------------------------------- repeated windows

def cut(rows, width):
    first = {}
    key = lambda d: (d is None, d or 0)
    lists = [split(t) for _, t in rows]
    for (d, _), w in zip(rows, lists):
        for i in range(len(w) - width + 1):
            k = tuple(w[i:i + width])
            first[k] = min(first.get(k, key(d)), key(d))
    out = Counter()
    for (d, _), w in zip(rows, lists):
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < key(d):
                gone |= set(range(i, i + width))
        out[d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    return out


@pytest.mark.parametrize("width,cells", [(50, None), (50, 1 << 15), (6, None), (10, 1 << 15)])
def test_repeated_windows(docs, texts, width, cells):
    got = substrings.drop_repeated_windows(docs, width=width, cells=cells)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_text") == cut([t[:2] for t in texts], width)


def test_a_passage_in_most_documents(spark, monkeypatch):
    """Windows that reach beyond a common passage share its anchors: they are dealt out one by one."""
    monkeypatch.setattr(substrings, "CROWD", 10)
    monkeypatch.setattr(substrings, "HOT_KEYS", 100_000)
    rng = random.Random(21)
    passage = prose(rng, 70)
    rows = [(i, f"{prose(rng, rng.randrange(5, 40))} {passage} {prose(rng, rng.randrange(5, 40))}") for i in range(150)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substrings.drop_repeated_windows(table)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_text") == cut(rows, 50)


def test_repeated_windows_of_nothing(spark):
    assert substrings.drop_repeated_windows(empty(spark)).count() == 0


# ---------------------------------------------------------------- helpers

def test_word_hashes_tell_words_apart():
    column = pa.array(["a b  c", None, "", "  xx\tyy\n", "A b " + "e" * 9000, "e" * 9000 + "f", " "])
    hashes, first = words.word_hashes(column)
    expected = [w for t in column.to_pylist() for w in split(t)]
    assert np.diff(first).tolist() == [len(split(t)) for t in column.to_pylist()]
    assert len(set(hashes.tolist())) == len(set(expected)) and len(hashes) == len(expected)
    lowered, _ = words.word_hashes(column, lower=True)
    assert lowered[0] == lowered[5] and hashes[0] != hashes[5]


def test_a_very_long_word_leaves_its_neighbours_hashes():
    alone, _ = words.word_hashes(pa.array(["a b", "c" * 4096]))
    beside, _ = words.word_hashes(pa.array(["a b", "c" * 4096, "e" * 9000]))
    assert alone.tolist() == beside[:3].tolist()
    far, _ = words.word_hashes(pa.array(["e" * 4096 + "f" * 4096, "f" * 4096 + "e" * 4096, "e" * 8192]))
    assert len(set(far.tolist())) == 3


def test_copies_of_a_very_long_words_neighbours(spark):
    """Rows beside a word of 9,000 bytes, and their copies and near copies in another partition."""
    rng = random.Random(31)
    left = [(i, prose(rng, 120, 5000)) for i in range(12)] + [(12, "e" * 9000)]
    near = [(d + 100, t.replace(" ", " new ", 1)) for d, t in left[:6]]
    rows = left + near + [(d + 200, t) for d, t in left[6:12]]
    table = spark.createDataFrame(spark.sparkContext.parallelize(left, 1), "doc_id long, text string").unionByName(
        spark.createDataFrame(spark.sparkContext.parallelize(rows[len(left):], 1), "doc_id long, text string"))
    got = jaccard.similar_components(table)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == components_of(rows)
    cut_rows = substrings.drop_repeated_windows(table)
    assert rows_of(cut_rows, "doc_id", "n_words", "n_removed", "kept_text") == cut(rows, 50)
