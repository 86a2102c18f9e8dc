"""How far the sources of a language differ in their terms.

``bytes.translate`` lowers letters and blanks separators in one pass, ``bytes.split`` gives the terms and
a ``Counter`` per document their frequencies.  A task folds its documents by language and source before
it sends them, so a hot source is never one group: rows are keyed by term too.  The rest is sparse: terms
that a source lacks all have one rate, so a pair of sources needs only a histogram of the rates of each
and a correction for the terms that both have.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratagrid.llm.byteterms import LETTERS, words
from stratagrid.scratch import lookup, materialize

MIN_DOCS, TOP_TERMS = 3, 200
FLUSH = 200_000  # (group, term) entries that a task holds at most, give or take one document's terms
_ROWS = 50_000  # rows of an Arrow batch that is sent
_COUNTS = "lang string, source string, term binary, docs long, count long"


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``(lang, source, term, docs, count)``: documents that hold a term and its occurrences in them.

    Every language and source that occurs also has a row with a null term, whose ``docs`` counts its
    documents.  Null languages, sources and texts are empty; repeated rows count each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        sizes: Counter = Counter()
        held = 0
        for batch in batches:
            for i in range(batch.num_rows):
                group = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                in_document: Counter = Counter()
                for stretch in words(batch.column(2)[i].as_py(), LETTERS):
                    in_document.update(stretch)
                if group not in groups:
                    groups[group] = Counter(), Counter()
                documents, occurrences = groups[group]
                before = len(documents)
                documents.update(in_document.keys())
                occurrences.update(in_document)
                sizes[group] += 1
                held += len(documents) - before
                if held >= FLUSH:
                    yield from _batches(groups, sizes)
                    groups, sizes, held = {}, Counter(), 0
        yield from _batches(groups, sizes)

    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    sent = read.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(count, _COUNTS)
    return sent.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("count"))


def _batches(groups: dict[tuple, tuple[Counter, Counter]], sizes: Counter) -> Iterator[pa.RecordBatch]:
    for (lang, source), (documents, occurrences) in groups.items():
        terms: list[bytes | None] = [None, *documents]
        docs = [sizes[lang, source], *documents.values()]
        counts = [0, *map(occurrences.__getitem__, documents)]
        for at in range(0, len(terms), _ROWS):
            part = slice(at, at + _ROWS)
            n = len(terms[part])
            yield pa.record_batch(
                [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                 pa.array(terms[part], pa.binary()), pa.array(docs[part], pa.int64()),
                 pa.array(counts[part], pa.int64())], ["lang", "source", "term", "docs", "count"])


def _rate(count: Column, total: Column, terms: Column) -> Column:
    """Smoothed share of a term in billionths, exact beyond 64 bits; null without any kept term."""
    wide = (count + 1).cast("decimal(19,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.when(terms > 0, F.call_function("div", wide, (total + terms).cast("decimal(19,0)")) + 1)


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
          min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: sources that differ most, and the terms that tell a source.

    A language keeps the terms in at least ``min_docs`` of its documents.  Part ``pair`` has every other
    source of the language, part ``term`` the ``top_terms`` terms above the language's own rate.  Ranks
    start at 1, greatest value first, ties by item.  Null languages, sources and texts count as empty; a
    source without terms, or a language that keeps none, still has its pairs; an empty table gives no
    row.  Other columns are ignored.
    """
    counts = materialize(term_counts(docs, lang, source, text))
    kept = counts.filter("term is not null").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("lang_count")
    ).filter(F.col("docs") >= min_docs).drop("docs")
    common = materialize(counts.filter("term is not null").join(kept, ["lang", "term"]).select(
        F.struct("lang", "source").alias("group"), "term", "count", "lang_count"))

    totals = common.groupBy("group").agg(F.sum("count").alias("n"))
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_count").alias("lang_n"))
    groups = counts.filter("term is null").select(F.struct("lang", "source").alias("group"), "lang", "source")
    none = F.lit(0).cast("long")
    groups = materialize(groups.join(totals, "group", "left").join(languages, "lang", "left").select(
        "group", "lang", "source", F.coalesce("n", none).alias("n"), F.coalesce("terms", none).alias("terms"),
        F.coalesce("lang_n", none).alias("lang_n")
    ).withColumn("rest", _rate(none, F.col("n"), F.col("terms"))))

    # one source may hold a third of all terms: its rows are looked up with salts
    rated = lookup(common, groups, "group", "term").select(
        "group", "lang", "source", "term", "rest", _rate(F.col("count"), F.col("n"), F.col("terms")).alias("p"),
        _rate(F.col("lang_count"), F.col("lang_n"), F.col("terms")).alias("lang_p"))
    rated = materialize(rated)
    return _pairs(rated, groups).unionByName(_terms(rated, top_terms)).select(
        "lang", "source", "part", "item", "value", "rank")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                       F.row_number().over(order).alias("rank"))


def _terms(rated: DataFrame, top_terms: int) -> DataFrame:
    above = rated.filter("p > lang_p").select(
        "lang", "source", F.col("term").alias("item"), _excess(F.col("p"), F.col("lang_p")).alias("value"))
    return _ranked(above, "term").filter(F.col("rank") <= top_terms)


def _pairs(rated: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of a language with the summed excess over all kept terms."""
    exact = "decimal(38,0)"
    other = groups.select("lang", F.col("source").alias("item"), F.col("rest").alias("item_rest"))
    p, q, rest, item_rest = F.col("p"), F.col("q"), F.col("rest"), F.col("item_rest")
    flat = _excess(rest, item_rest)
    # as if no source had any kept term
    base = groups.join(other, "lang").filter("source <> item").select(
        "lang", "source", "item",
        F.coalesce(F.col("terms").cast("decimal(19,0)") * flat.cast("decimal(19,0)"), F.lit(0)).cast(exact).alias("value"))
    # the terms that one of two sources has, as if the other lacked them
    histogram = rated.groupBy("lang", "source", "p", "rest").agg(F.count(F.lit(1)).alias("many"))
    one = histogram.join(other, "lang").filter("source <> item")
    many = F.col("many").cast("decimal(19,0)")
    own = one.select("lang", "source", "item",
                     (many * (_excess(p, item_rest) - flat).cast("decimal(19,0)")).cast(exact).alias("value"))
    theirs = one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                        (many * (_excess(item_rest, p) - _excess(item_rest, rest)).cast("decimal(19,0)"))
                        .cast(exact).alias("value"))
    # what that gets wrong for terms that both have
    mate = rated.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"),
                        F.col("rest").alias("item_rest"))
    both = rated.join(mate, ["lang", "term"]).filter("source <> item").select(
        "lang", "source", "item",
        (_excess(p, q).cast(exact) - _excess(p, item_rest) - _excess(rest, q) + flat).cast(exact).alias("value"))
    parts = [side.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             for side in (base, own, theirs, both)]
    summed = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).groupBy(
        "lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    return _ranked(summed, "pair")
