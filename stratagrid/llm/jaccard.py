"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

1. A sketch counts in how many documents each shingle occurs.  The global order puts shingles of one
   document first, then shared ones by hash, and crowded ones last, by count and hash; any such order is
   exact.  This one fills the prefixes of most documents with shingles that no other document has, and
   keeps boilerplate out of the prefixes of copies.
2. Equal shingle sets are one node, so copies are never compared.  A node sends its prefix shingles
   that may be shared.  Every list of nodes with a common prefix shingle first meets its leaders, in two
   rounds; then, and only where a list still holds several components, pairs across components are made.
   Pairs within a component are not needed for components, which are the whole result.
3. A pair must pass the length filter, the positional filter (shingles left after the common one) and
   the suffix filter (shingles per section of the order bound the overlap) before its two sets are
   intersected, once per pair.  Only the sets of nodes in such pairs are ever built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagrid.llm.carried import carry, given_back
from stratagrid.llm import sketch
from stratagrid.llm.keyset import key_set
from stratagrid.llm.lean import lean
from stratagrid.llm.words import mix, rolling, slices, word_hashes
from stratagrid.operators.graph import connect
from stratagrid.scratch import Rounds, materialize

SHINGLE = 5
PERCENT = 80
LED_ROUNDS = 2  # rounds in which a list only meets its leaders, before pairs across components
SECTIONS = 128
MOST = (1 << 15) - 1  # a section that is counted no further bounds nothing
_A, _B = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def _sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of every text with at least one word."""
    for begin, end in slices(texts):
        hashes, first = word_hashes(texts.slice(begin, end - begin), lower=True)
        grams = rolling(hashes, width)
        for row in range(end - begin):
            a, b = first[row], first[row + 1]
            if b - a >= width:
                yield begin + row, np.unique(grams[a:b - width + 1])
            elif b > a:  # the whole sequence is its only shingle
                yield begin + row, mix(rolling(hashes[a:b], int(b - a)) + _B)


def _prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def _nodes(docs: DataFrame, width: int, percent: int, repeated) -> DataFrame:
    """Per document: set size, node (the set's 128-bit signature), and once for each set and task the
    section counts and the prefix shingles that other documents may have."""

    @lean
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        estimate = repeated.value
        seen: set[bytes] = set()
        for batch in batches:
            n = len(batch)
            size, nodes, sections = np.zeros(n, np.int64), [None] * n, [None] * n
            share = np.zeros(n)
            lengths, sent, shared_grams, places = np.zeros(n, np.int64), np.zeros(n, bool), [], []
            for row, grams in _sets(batch.column("body"), width):
                size[row] = len(grams)
                node = np.array([mix(grams ^ _A).sum(), mix(grams ^ _B).sum()], np.uint64).tobytes()
                nodes[row] = node
                if node in seen:  # a copy: its set has been sent from here
                    continue
                seen.add(node)
                often = estimate(grams)
                take = _prefix_length(len(grams), percent)
                rare = int(len(grams) - often.sum())
                if rare >= take:
                    continue
                shared = grams[often]
                shared = shared[np.argsort(estimate.crowd(shared), kind="stable")[:take - rare]]
                sent[row], lengths[row] = True, len(shared)
                shared_grams.append(shared.view(np.int64))
                places.append(np.arange(rare, take, dtype=np.int32))
                sections[row] = np.bincount((grams >> np.uint64(57)).astype(np.int64), minlength=SECTIONS).clip(max=MOST)
                share[row] = often.mean()
            flat = pa.StructArray.from_arrays([
                pa.array(np.concatenate(shared_grams) if places else np.zeros(0, np.int64)),
                pa.array(np.concatenate(places) if places else np.zeros(0, np.int32))], ["gram", "place"])
            prefix = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), flat)
            yield pa.record_batch([
                batch.column("doc_id"), batch.column("text_hash"), pa.array(size), pa.array(nodes, pa.binary()),
                pa.array(sections, pa.list_(pa.int16())), pa.array(share), prefix,
            ], ["doc_id", "text_hash", "n", "node", "sections", "share", "prefix"])

    return docs.mapInArrow(describe, "doc_id long, text_hash long, n long, node binary, sections array<smallint>, "
                                     "share double, prefix array<struct<gram: long, place: int>>")


def _needed(percent: int) -> Column:
    """Least overlap of two sets of sizes ``n_a`` and ``n_b``: ceil(t / (1 + t) * (n_a + n_b))."""
    total = (F.col("n_a") + F.col("n_b")) * percent
    return F.floor((total + (100 + percent - 1)) / (100 + percent))


def _near(percent: int) -> Column:
    """The length and positional filters of a prefix match."""
    length = (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    left = F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b"))
    return length & (left >= _needed(percent))


def _ordered() -> list[Column]:
    """A pair with its lesser node first."""
    swap = F.col("a") > F.col("b")
    return [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x)
            for x, y in (("a", "b"), ("b", "a"), ("n_a", "n_b"), ("n_b", "n_a"))]


def _filtered(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct ``a < b`` of the prefix matches that pass the length and positional filters."""
    return pairs.filter(_near(percent)).select(*_ordered()[:2]).distinct()


def _suffix_bound() -> Column:
    """Greatest overlap that the section counts ``s_a`` and ``s_b`` allow; without bound where one is cut off."""
    least = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: F.least(x, y).cast("long")), F.lit(0).cast("long"),
                        lambda x, y: x + y)
    return F.when(F.greatest(F.array_max("s_a"), F.array_max("s_b")) < MOST, least).otherwise(
        F.least("n_a", "n_b"))


def _suffix_filtered(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"),
                                  F.col("sections").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(_suffix_bound() >= _needed(percent)).select("a", "b", "n_a", "n_b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    side = lambda x: sets.select(F.col("node").alias(x), F.col("grams").alias(f"g_{x}"))
    met = pairs.join(side("b"), "b").join(side("a"), "a").withColumn(
        "both", F.size(F.array_intersect("g_a", "g_b")))
    return met.filter(F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * percent).select("a", "b")


def similar_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE,
                       percent: int = PERCENT, cells: int | None = None, crowd: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, set_size``.

    Two documents link when their sets of ``width``-word shingles (A-Z lower-cased, words split at ASCII
    white space) have ``100 * intersection >= percent * union``; ``component_id`` is the least id that
    links reach, the row itself included (null only where no row reached has an id).  With fewer words
    the whole sequence is the one shingle.  A null or wordless text has an empty set and no links.
    ``set_size`` counts the rows with the same set.  Other columns are ignored.
    """
    return _components(docs, doc_id, text, width, percent, cells, crowd).drop("first_hash")


def _components(docs: DataFrame, doc_id: str, text: str, width: int, percent: int, cells: int | None,
                crowd: int | None = None) -> DataFrame:
    """``similar_components`` and ``first_hash``: the least text hash of the component's row of least id."""
    spark = docs.sparkSession
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                        F.coalesce(F.col(text), F.lit("")).alias("body"))

    def grams_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        return (grams for _, grams in _sets(batch.column(0), width))

    expected = sketch.text_size(docs, text) / 6
    repeated = sketch.repeated_keys(keyed.select("body"), grams_of, cells or sketch.cells_for(2 * expected),
                                    crowd=crowd or sketch.crowd_for(expected))
    described = materialize(_nodes(keyed, width, percent, spark.sparkContext.broadcast(repeated)))
    some = described.filter("n > 0")
    classes = materialize(some.groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("least"), F.count(F.lit(1)).alias("set_size")))
    sending = some.filter("sections is not null").groupBy("node").agg(
        F.first("n").alias("n"), F.first("sections").alias("sections"), F.first("prefix").alias("prefix"),
        F.first("share").alias("share"),
        F.min(F.struct("doc_id", "text_hash")).alias("owner"))
    sending = materialize(sending)
    nodes = sending.select("node", "n", "sections")
    lists = sending.select("node", "n", "share", F.explode("prefix").alias("p")).select(
        F.col("p.gram").alias("gram"), "node", "n", "share", F.col("p.place").alias("place"),
        F.col("node").alias("root"))
    counted = materialize(lists)
    several = counted.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("gram")
    lists = materialize(counted.join(materialize(several), "gram", "left_semi"))
    # only nodes that share a list can need their sets
    wanted = materialize(lists.select("node").distinct().join(sending.select("node", "owner"), "node").select("owner"))
    sets = _gram_sets(keyed, wanted, width)
    links = tried = members = None
    for turn in range(LED_ROUNDS):
        pairs = _filtered(_led(lists, turn), percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        chosen = materialize(_suffix_filtered(pairs, nodes, percent))
        found = materialize(_verified(chosen, sets, percent))
        tried = chosen.select("a", "b") if tried is None else tried.unionByName(chosen.select("a", "b"))
        links = found if links is None else links.unionByName(found)
        members = connect(links, Rounds(spark))
        lists = _mixed(lists, members)
    # lists that still hold several components: all pairs across them.  One side of such a pair lies
    # outside the list's largest component, so the crowd is never paired with itself
    sizes = lists.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("m"))
    crowd = materialize(sizes.groupBy("gram").agg(F.max_by("root", F.struct("m", "root")).alias("crowd")))
    one, two = (lists.select("gram", *[F.col(c).alias(f"{d}_{x}" if d else x) for c, d in (
        ("node", ""), ("n", "n"), ("place", "p"), ("root", "r"))]) for x in ("a", "b"))
    few = one.join(crowd, "gram").filter("r_a <> crowd").drop("crowd")
    # the section counts travel with the lists, so that all three filters hold back pairs in the join
    sections = lambda x: nodes.select(F.col("node").alias(x), F.col("sections").alias(f"s_{x}"))
    few, two = materialize(few.join(sections("a"), "a")), materialize(two.join(sections("b"), "b"))
    met = few.join(two, "gram").filter(F.col("r_a") != F.col("r_b")).filter(_near(percent)).filter(
        _suffix_bound() >= _needed(percent))
    across = met.select(*_ordered()).distinct()
    rest = materialize(across.join(tried, ["a", "b"], "left_anti"))
    more = materialize(_verified(rest, sets, percent))
    if not more.isEmpty():
        members = connect(links.unionByName(more), Rounds(spark))
    rooted = materialize(classes.join(members, "node", "left").select(
        "node", "least", "set_size", F.coalesce("root", "node").alias("root")))
    least = materialize(rooted.groupBy("root").agg(F.min("least").alias("first")))
    named = materialize(rooted.join(least, "root").select(
        "node", F.col("first.doc_id").alias("component_id"), F.col("first.text_hash").alias("first_hash"), "set_size"))
    # a document without words has no node and keeps its own id
    return described.select("doc_id", "n", "node", "text_hash").join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("set_size", F.lit(1)).cast("long").alias("set_size"), "text_hash", "first_hash")


def _led(lists: DataFrame, turn: int) -> DataFrame:
    """Each node of a list with the list's leaders of another component.

    First the node with the greatest share of shingles that others have, the likely original of copies,
    and one drawn by hash; then the likely originals of the first and the last component of the list.
    """
    entry = F.struct("node", "n", "place", "root")
    if turn:
        first, second = F.struct("root", "share"), F.struct("root", -F.col("share"))
    else:
        first, second = F.struct("share", "node"), F.struct(F.xxhash64("node"), "node")
    heads = materialize(lists.groupBy("gram").agg(
        F.max_by(entry, first).alias("x"), F.min_by(entry, second).alias("y")))
    return lists.join(heads, "gram").select(
        F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("place").alias("p_a"), "root",
        F.explode(F.array("x", "y")).alias("h")
    ).filter("root <> h.root").select(
        "a", "n_a", "p_a", F.col("h.node").alias("b"), F.col("h.n").alias("n_b"), F.col("h.place").alias("p_b"))


def _mixed(lists: DataFrame, members: DataFrame) -> DataFrame:
    """The lists that hold several components, with every node's root."""
    named = members.select("node", F.col("root").alias("_root"))
    placed = materialize(lists.join(named, "node", "left").withColumn(
        "root", F.coalesce("_root", "root")).drop("_root"))
    several = placed.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    return materialize(placed.join(materialize(several.select("gram")), "gram", "left_semi"))


def _gram_sets(keyed: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node, grams`` of the nodes that may be needed, built from the document that owns each.

    A bitmap of the wanted documents keeps most others out of the join that finds them.
    """

    @lean
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("body")):
                nodes, sets = [], []
                for _, grams in _sets(batch.column("body").slice(begin, end - begin), width):
                    nodes.append(np.array([mix(grams ^ _A).sum(), mix(grams ^ _B).sum()], np.uint64).tobytes())
                    sets.append(grams.view(np.int64))
                yield pa.record_batch([pa.array(nodes, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                                      ["node", "grams"])

    key = F.xxhash64("doc_id", "text_hash")
    named = wanted.select(F.col("owner.doc_id").alias("owner_id"), F.col("owner.text_hash").alias("owner_hash"))
    named = named.withColumn("key", F.xxhash64("owner_id", "owner_hash"))
    maybe = keyed.withColumn("key", key).filter(key_set(named, "key").may_hold(F.col("key")))
    # by id and text hash, not by the hash of both: no owner may hide another
    owners = maybe.join(named.drop("key"), F.col("doc_id").eqNullSafe(F.col("owner_id")) & (
        F.col("text_hash") == F.col("owner_hash")), "left_semi").dropDuplicates(["doc_id", "text_hash"]).select("body")
    return materialize(owners.mapInArrow(build, "node binary, grams array<long>"))


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE,
                     percent: int = PERCENT) -> DataFrame:
    """One row of each component, with all its columns: of least id (null last), then of least text hash.

    Rows without words stay.  Documents whose id cannot be among those that go pass without a shuffle.
    Columns may have any names.
    """
    found = materialize(_components(docs, doc_id, text, width, percent, None).filter("n_shingles > 0").groupBy(
        "doc_id", "text_hash", (F.col("doc_id").eqNullSafe(F.col("component_id")) & (
            F.col("text_hash") == F.col("first_hash"))).alias("stays")).agg(F.count(F.lit(1)).alias("rows")))
    # rows that go, and rows that repeat the one that stays
    marks = materialize(found.filter("not stays or rows > 1").select(
        F.xxhash64("doc_id", "text_hash").alias("key"), F.col("doc_id").alias("mark_id"),
        F.col("text_hash").alias("mark_hash"), "stays"))
    rows = carry(docs, doc_id=F.col(doc_id).cast("long"), text_hash=F.xxhash64(F.col(text)))
    marked = rows.withColumn("may_go", key_set(marks, "key").may_hold(F.xxhash64("doc_id", "text_hash")))
    unsure = marked.filter("may_go").join(marks, F.col("doc_id").eqNullSafe(F.col("mark_id")) & (
        F.col("text_hash") == F.col("mark_hash")), "left")
    once = unsure.filter("stays").dropDuplicates(["mark_id", "mark_hash"])
    parts = [marked.filter("not may_go"), unsure.filter("stays is null"), once]
    first, *rest = [part.select(*given_back(marked)) for part in parts]
    return first.unionByName(rest[0]).unionByName(rest[1])
