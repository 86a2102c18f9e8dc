"""One registered query per operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagrid.llm import (bitpack, bpe, divergence, exact, importance, jaccard, licenses, mixing, packing, resample,
                            substrings, urls, vafile)
from stratagrid.ship import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = resample.fit(docs, table(spark, sf_dir, "labels"))
    return resample.resample(docs, ratios).drop("text")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = bitpack.token_file(table(spark, sf_dir, "documents"))
    return bitpack.read_tokens(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents")).drop("text_hash")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.drop_repeated_windows(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return bpe.round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_top_k": op2_top_k,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality": op4_quality,
    "op5_mix_sources": op5_mix_sources,
    "op6_url_filter": op6_url_filter,
    "op7_license_scan": op7_license_scan,
    "op8_token_file": op8_token_file,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_bpe_round_trip": op13_bpe_round_trip,
}

_OP2 = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings where vec_id is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(generate_series(1, least(len(q.e), len(c.e))),
  lambda i: q.e[i] * c.e[i])) as bigint) as score from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
"""

_OP3 = """
with t as (select doc_id, coalesce(text, '') as body from documents),
g as (select body, max(doc_id) as keep_id, count(*) as group_size from t group by body)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t.body) as text_sha256
from t join g on t.body = g.body
"""

_TERM = "(^|[^a-z0-9]){}($|[^a-z0-9])"


def _strict_count(term: str) -> str:
    # the right border is looked at again as the next hit's left border
    return f"len(regexp_extract_all(replace(low, '{term}', '{term}' || chr(1)), '(^|[^a-z0-9]){term}\\x01($|[^a-z0-9])'))"


def _op6_sql() -> str:
    lower = f"translate(coalesce(url, ''), '{urls.UPPER}', '{urls.LOWER}')"
    soft = " + ".join(f"cast(regexp_matches(low, '{_TERM.format(t)}') as bigint)" for t in urls.SOFT)
    strict = " + ".join(f"cast({_strict_count(t)} as bigint)" for t in urls.STRICT)
    ranked = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = "(host = '{0}' or ends_with(host, '.{0}')) and starts_with(path, '{1}')"
    cases = " ".join(f"when {fits.format(h, p)} then '{h + p}'" for _, h, p in ranked)
    verdicts = " ".join(f"when {fits.format(h, p)} then '{v}'" for v, h, p in ranked)
    return f"""
with p as (select page_id, {lower} as low,
  translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), '{urls.UPPER}', '{urls.LOWER}') as host,
  coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') as path from pages),
c as (select *, {strict} as strict_hits, {soft} as soft_terms from p)
select page_id, host, path, case {cases} end as rule,
  case {verdicts} when strict_hits > 0 or soft_terms >= {urls.SOFT_HITS} then 'block' else 'allow' end as verdict,
  strict_hits, soft_terms from c
"""


_OP10 = """
with t as (select doc_id, row_number() over () as r,
  list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words from documents),
w as (select doc_id, r, i, array_to_string(words[i:i + 49], ' ') as body
      from (select *, unnest(generate_series(1, len(words) - 49)) as i from t where len(words) >= 50)),
m as (select *, min(doc_id) over (partition by body) as least from w),
g as (select distinct r, i + j as p from m, generate_series(0, 49) s(j)
      where least < doc_id or (doc_id is null and least is not null)),
e as (select doc_id, r, unnest(words) as word, unnest(generate_series(1, len(words))) as p from t),
k as (select r, string_agg(word, ' ' order by p) as body, count(*) as n from e anti join g using (r, p) group by r)
select doc_id, len(words) as n_words, len(words) - coalesce(n, 0) as n_removed,
  sha256(coalesce(body, '')) as kept_sha256 from t left join k using (r)
"""

def _op7_sql() -> str:
    phrases = [(*p, True) for p in licenses.BASE_PHRASES] + [(*p, False) for p in licenses.TEMPLATES]
    grams = ", ".join(
        f"({n}, '{label}', {base}, {len(w)}, {t}, '{' '.join(w[t:t + 3])}')"
        for n, (phrase, label, base) in enumerate(phrases) for w in [phrase.split()] for t in range(len(w) - 2))
    return f"""
with d as (select row_number() over () as r, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as words from documents),
q(template, label, base, n, t, gram) as (values {grams}),
g as (select r, i - 1 as pos, array_to_string(words[i:i + 2], ' ') as gram
      from (select r, words, unnest(generate_series(1, len(words) - 2)) as i from d where len(words) > 2)),
v as (select r, template, label, base, n, t, pos - t as diagonal from g join q using (gram)),
a as (select distinct r, template, base, diagonal from v),
l as (select *, case when base or lag(diagonal) over w is null or diagonal - lag(diagonal) over w > 2 then 1 else 0 end as new
      from a window w as (partition by r, template order by diagonal)),
s as (select *, sum(new) over (partition by r, template order by diagonal) as span from l),
c as (select v.r, v.template, v.label, v.base, v.n, span, min(v.diagonal) as first_diagonal,
        count(distinct v.t) as matched, len(list_distinct(flatten(list([v.t, v.t + 1, v.t + 2])))) as covered
      from v join s on s.r = v.r and s.template = v.template and s.diagonal = v.diagonal group by 1, 2, 3, 4, 5, 6),
k as (select *, base and matched = n - 2 as whole, covered / n::double as coverage from c),
f as (select r, count(*) filter (whole) as n_base, min(first_diagonal) filter (whole) as first_word,
        max(first_diagonal) filter (whole) as last_word,
        list_sort(list(distinct label) filter (whole)) as base_labels,
        list_sort(list(distinct label) filter (whole or (not base and coverage >= 0.6))) as labels,
        max(coverage) as score from k group by r)
select doc_id, len(words) as n_words, coalesce(n_base, 0) as n_base, cast(first_word as bigint) as first_word,
  cast(last_word as bigint) as last_word, coalesce(array_to_string(base_labels, ','), '') as base_labels,
  coalesce(array_to_string(labels, ','), '') as labels, coalesce(score, 0.0::double) as score
from d left join f using (r)
"""


_OP9 = """
with recursive t as (select doc_id, row_number() over () as r, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words from documents),
s as (select distinct r, gram from (select r, unnest(case when len(words) >= 5
    then list_transform(generate_series(1, len(words) - 4), lambda i: array_to_string(words[i:i + 4], ' '))
    when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as gram from t)),
n as (select r, count(*) as n from s group by r),
p as (select a.r as a, b.r as b, count(*) as inter from s a join s b on a.gram = b.gram and a.r <> b.r group by 1, 2),
l as (select a, b from p join n x on x.r = a join n y on y.r = b where 100 * inter >= 80 * (x.n + y.n - inter)),
c as (select r, r as to_r from t union select c.r, l.b from c join l on l.a = c.to_r),
m as (select c.r, min(t.doc_id) as component_id from c join t on t.r = c.to_r group by c.r),
e as (select r, list_sort(list(gram)) as grams from s group by r),
z as (select e.r, count(*) over (partition by grams) as set_size from e)
select doc_id, coalesce(n, 0) as n_shingles, component_id, coalesce(set_size, 1) as set_size
from t join m using (r) left join n using (r) left join z using (r)
"""

_OP11 = """
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
  list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as words from documents),
w as (select lang, source, r, term, count(*) as c from (select lang, source, r, unnest(words) as term from d) group by all),
k as (select lang, term, sum(c) as lang_count from w group by lang, term having count(*) >= 3),
l as (select lang, count(*) as v, sum(lang_count) as n from k group by lang),
c as (select lang, source, term, sum(c) as c from w semi join k using (lang, term) group by all),
g as (select distinct lang, source from d),
n as (select lang, source, sum(c) as n from c group by all),
p as (select g.lang, g.source, k.term, coalesce(c, 0) as c,
    1 + (1000000000::hugeint * (coalesce(c, 0) + 1)::hugeint) // (coalesce(n.n, 0) + v)::hugeint as p,
    1 + (1000000000::hugeint * (lang_count + 1)::hugeint) // (l.n + v)::hugeint as lang_p
  from g join k on k.lang = g.lang join l on l.lang = g.lang
  left join c on c.lang = g.lang and c.source = g.source and c.term = k.term
  left join n on n.lang = g.lang and n.source = g.source),
f as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
x as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
  union all select lang, source, 'term', term, cast(((p - lang_p) * (p - lang_p)) // lang_p as bigint)
  from p where c > 0 and p > lang_p),
o as (select *, cast(row_number() over (partition by lang, source, part order by value desc, encode(item)) as integer) as rank from x)
select * from o where part = 'pair' or rank <= 200
"""

# the checksum of a run's bytes by the reversed polynomial, one table entry a byte
_OP12 = f"""
with recursive bits(n, c, step) as (select i, i, 0 from range(256) t(i)
  union all select n, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, step + 1 from bits where step < 8),
crc as (select list(c order by n) as t from bits where step = 8),
d as (select row_number() over () as r, doc_id, true as raw, text from documents
  union all select -row_number() over (), null, false, text from benchmark),
w as (select r, doc_id, raw, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as words from d),
f as (select r, raw, unnest(flatten(list_transform([0, 1, 2], lambda k: list_transform(
    generate_series(1, len(words) - k), lambda i: array_to_string(words[i:i + k], ' '))))) as feature from w),
n as (select r, raw, feature, count(*) as c from f group by all),
b as materialized (select feature, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
      regexp_extract_all(hex(encode(feature)), '..'), lambda x: cast('0x' || x as bigint))),
      lambda c, x: xor(t[xor(c & 255, x) + 1], c >> 8)), 4294967295) % {importance.BUCKETS} as bucket
    from (select distinct feature from n), crc),
m as (select r, raw, bucket, sum(c)::bigint as c from n join b using (feature) group by all),
a as (select i as bucket, coalesce(s, 0) as s, coalesce(t, 0) as t from range({importance.BUCKETS}) q(i) left join (
    select bucket, sum(c) filter (raw) as s, sum(c) filter (not raw) as t from m group by bucket) on bucket = i),
z as (select bucket, cast(floor(1000 * ln((t + 1)::double * (sum(s) over () + {importance.BUCKETS})::double
    / ((s + 1)::double * (sum(t) over () + {importance.BUCKETS})::double))) as bigint) as gain from a),
e as (select r, sum(c)::bigint as n_features, sum(c * gain)::bigint as weight from m join z using (bucket) where raw group by r),
g as (select r, doc_id, len(words) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    cast('0x' || sha256('{importance.SEED}:' || coalesce(doc_id::varchar, ''))[1:8] as bigint) as h
  from w left join e using (r) where raw),
s as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score from g),
k as (select r, row_number() over (order by score desc, doc_id nulls last, r) as rank,
    {importance.PERCENT} * count(*) over () // 100 as k from s where n_words >= {importance.MIN_WORDS})
select doc_id, n_features, weight, score, case when rank <= k then rank end as rank from s left join k using (r)
"""

ORACLES: dict[str, str] = {"op2_top_k": _OP2, "op3_exact_dedup": _OP3, "op6_url_filter": _op6_sql(), "op7_license_scan": _op7_sql(),
                           "op9_jaccard_join": _OP9, "op10_substring_dedup": _OP10,
                           "op11_source_divergence": _OP11, "op12_importance_resampling": _OP12}
