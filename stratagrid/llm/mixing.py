"""Mix sources to target weights by block.  DataFrame functions only.

Each source's documents form one word stream, cut into blocks of ``block_words`` words.  Output
shards draw multinomial source counts; the running draw of a source is mapped through a pseudorandom
permutation of its block indices (one per pass over the source), and blocks are joined by index.

Draws beyond a source's share are not taken and one last set of shards makes up what is missing, so
that each source ends at its share; a source is passed over at most ``max_repeats`` times.

Nothing windows over a source, which may hold a third of all rows: equal rows are counted first, stream
positions come from bucket sums (a bucket holds about ``BUCKET_ROWS`` different rows), and running sums of
buckets and shards are made in two levels (``CHUNK``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratagrid.llm.carried import carry, given_back
from stratagrid.scratch import lookup, materialize

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 512
SHUFFLE_ROUNDS = 12
DEAL_DRAWS = 1 << 16  # draws that a task unfolds
CHUNK = 4096  # numbers that a window over a source sums at once
COPIES = 4096  # equal rows that go as one


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_repeats: int) -> DataFrame:
    """``source, source_size, target`` from rows ``(source, size)``.

    Sources in code-point order, null last, take the weights in turn.  Shares of the total by weight
    are capped at ``max_repeats`` times a source's size and the excess is reshared by weight: with
    sources in order of cap per weight, those before the water level are capped, and the level follows
    from running sums.  One row per source, so the windows are over the source list only.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = totals.select("source", "source_size", rank.alias("sid"), weight.alias("w"))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats))).withColumn(
        "ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    # this source and all after it stay below their caps when the level here does not pass its ratio
    leveled = ranked.withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "sid", "level"))).over(everything)
    return leveled.withColumn("water", first["level"]).select(
        "sid", "source", "source_size",
        F.coalesce(F.least("cap", F.col("water") * F.col("w")), F.col("cap")).alias("target"),
    )


def permuted(index: Column, size: Column, seed: Column) -> Column:
    """A pseudorandom permutation of ``0 .. size - 1``: each round swaps or keeps index pairs.

    Every round mirrors the index at a keyed point and a hash bit of the pair decides whether the
    two change places, so each round, and the whole, is one-to-one for any size.
    """
    def swap_or_not(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(seed, r), size) - x, size)
        bit = F.pmod(F.xxhash64(seed, r, F.greatest(x, mirror)), F.lit(2))
        return F.when(bit == 1, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(SHUFFLE_ROUNDS)), index.cast("long"), swap_or_not)


def _ahead(sums: DataFrame, at: str, value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same ``sid`` with a lesser ``at``.

    A window holds ``CHUNK`` numbers, or one row per ``CHUNK`` of them.
    """
    chunked = sums.withColumn("chunk", F.floor(F.col(at) / CHUNK))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inner = F.sum(value).over(before(Window.partitionBy("sid", "chunk").orderBy(at)))
    chunks = chunked.groupBy("sid", "chunk").agg(F.sum(value).alias("all"))
    base = F.sum("all").over(before(Window.partitionBy("sid").orderBy("chunk")))
    chunks = chunks.select("sid", "chunk", F.coalesce(base, F.lit(0)).alias("chunk_base"))
    return chunked.withColumn("inner", F.coalesce(inner, F.lit(0))).join(chunks, ["sid", "chunk"]).withColumn(
        name, F.col("chunk_base") + F.col("inner")).drop("chunk", "inner", "chunk_base")


def _positions(rows: DataFrame) -> DataFrame:
    """Adds ``start``: a row for each of ``copies``, with the words of the row's source before it.

    Rows are in an order of hashed buckets.  ``COPIES`` equal rows go as one and unfold at the end, so that
    no two rows tie and copies, however many, fill no bucket.
    """
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES)))
    stepped = rows.withColumn("step", step).withColumn(
        "copies", F.least(F.lit(COPIES), F.col("copies") - F.col("step") * COPIES)).withColumn(
        "words", F.col("size") * F.col("copies"))
    buckets = max(1, stepped.count() // BUCKET_ROWS)
    bucketed = stepped.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "row", "step"), F.lit(buckets)))
    sums = bucketed.groupBy("sid", "bucket").agg(F.sum("words").alias("words"))
    base = materialize(_ahead(sums, "bucket", "words", "base").select("sid", "bucket", "base"))
    order = Window.partitionBy("sid", "bucket").orderBy("row", "doc_id", "step")
    inner = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = bucketed.withColumn("inner", F.coalesce(inner, F.lit(0))).join(base, ["sid", "bucket"])
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return placed.withColumn("copy", copy).withColumn(
        "start", F.col("base") + F.col("inner") + F.col("copy") * F.col("size")).drop(
        "base", "inner", "step", "words", "copies", "copy", "bucket")


def block_draws(targets: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """``sid, block, times``: how often the mix takes each block.

    ``targets`` has ``sid, source_size, target``.  Each slot of a shard draws its source with the
    targets' probabilities, which makes the counts of a shard multinomial.
    """
    blocks = F.ceil(F.col("source_size") / block_words)
    wanted = F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long")
    plan = targets.filter("source_size > 0").withColumn("blocks", blocks).withColumn("wanted", wanted)
    order = Window.orderBy("sid")
    upto = F.sum("wanted").over(order.rowsBetween(Window.unboundedPreceding, 0))
    plan = materialize(plan.select("sid", "blocks", "wanted", upto.alias("upto")))
    total = plan.agg(F.coalesce(F.max("upto"), F.lit(0))).first()[0]
    shards = -(-total // shard_slots)
    spark = targets.sparkSession
    slots = spark.range(total).select(
        F.floor(F.col("id") / shard_slots).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(max(total, 1))).alias("u"),
    )
    sources = plan.withColumn("from", F.col("upto") - F.col("wanted"))
    steps = sources.filter("wanted > 0").select("sid", "from", "upto")
    drawn = _by_interval(slots, steps, total).groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n"))
    runs = _ahead(drawn, "shard", "n", "first").join(plan.select("sid", "blocks", "wanted"), "sid")
    runs = runs.withColumn("last", F.least(F.col("first") + F.col("n"), "wanted")).filter("first < last")
    runs = materialize(runs.select("sid", "blocks", "first", "last", "shard"))
    had = runs.groupBy("sid").agg(F.max("last").alias("had"))
    rest = plan.join(had, "sid", "left").select(
        "sid", "blocks", F.coalesce("had", F.lit(0)).alias("first"), F.col("wanted").alias("last"),
        F.lit(shards).cast("long").alias("shard")).filter("first < last")
    # few rows hold many draws: deal them out before they unfold
    draws = runs.unionByName(rest).repartition(1 + total // DEAL_DRAWS, "sid", "shard").select("sid", "blocks", F.explode(
        F.sequence(F.col("first"), F.col("last") - 1)).alias("draw"))
    turn = F.floor(F.col("draw") / F.col("blocks"))
    index = F.col("draw") - turn * F.col("blocks")
    picked = draws.select("sid", permuted(
        index, F.col("blocks"), F.xxhash64(F.lit(seed), F.col("sid"), turn)).alias("block"))
    return picked.groupBy("sid", "block").agg(F.count(F.lit(1)).cast("int").alias("times"))


def _by_interval(slots: DataFrame, steps: DataFrame, total: int) -> DataFrame:
    """Give each ``u`` the source whose half-open interval holds it.

    Intervals are cut at the borders of at most 1,024 equal cells, so that cell equality finds them:
    there are at most as many pieces as sources and cells together.
    """
    width = max(1, -(-total // 1024))
    pieces = steps.select("*", F.explode(F.sequence(
        F.floor(F.col("from") / width), F.floor((F.col("upto") - 1) / width))).alias("cell"))
    return slots.withColumn("cell", F.floor(F.col("u") / width)).join(pieces, "cell").filter(
        "u >= from and u < upto")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_repeats: int = 3, block_words: int = 64,
        shard_slots: int = 16384, seed: int = 17) -> DataFrame:
    """``doc_id, source, row, size, source_size, target, taken, start, times`` for every row of ``docs``.

    ``row`` is the text's hash; ``times`` lists ``(block, n)`` for the blocks of the row's source that
    the row reaches into.  A null text has no words; a null source is a source of its own, the last.
    Equal rows each take their own place.  Reruns over the same files agree.  An empty table gives an
    empty result, and a table without words takes nothing.
    """
    rows = materialize(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("row")
    ).groupBy("doc_id", "source", "size", "row").agg(F.count(F.lit(1)).alias("copies")))
    targets = materialize(source_targets(
        rows.select("source", (F.col("size") * F.col("copies")).alias("size")), weights, max_repeats))
    # one row per source; null-safe, so that documents without a source find theirs
    sided = rows.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "r.*", "t.sid", "t.source_size", "t.target")
    placed = materialize(_positions(sided))
    times = materialize(block_draws(targets, block_words, shard_slots, seed))
    size, start = F.col("size"), F.col("start")
    end = start + size
    reach = placed.filter(size > 0).withColumn("block", F.explode(F.sequence(
        F.floor(start / block_words), F.floor((end - 1) / block_words))))
    overlap = F.least(end, (F.col("block") + 1) * block_words) - F.greatest(start, F.col("block") * block_words)
    hit = reach.join(times, ["sid", "block"], "left").withColumn("n", F.coalesce("times", F.lit(0)))
    of_row = ["doc_id", "source", "row", "size", "source_size", "target"]
    found = hit.groupBy(*of_row, "start").agg(
        F.sum(overlap * F.col("n")).cast("long").alias("taken"), F.collect_list(F.struct("block", "n")).alias("times"))
    # rows without words, which may be many, meet no block
    empty = placed.filter(size == 0).select(
        *of_row, "start", F.lit(0).cast("long").alias("taken"), F.array().cast(found.schema["times"].dataType).alias("times"))
    return found.unionByName(empty).select(*of_row, "taken", "start", "times")


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                    block_words: int = 64, **options) -> DataFrame:
    """The mix as documents: the columns of ``docs``, one row per document and pass that takes words of it.

    Pass ``e`` holds the words of the blocks taken at least ``e`` times.  A document that a pass takes
    whole keeps its text; otherwise the words taken are joined by one space.  Rows that repeat an id,
    source and text count as copies of one row and come back with its other columns; columns may have
    any names.
    """
    plan = mix(docs, doc_id, text, source, block_words=block_words, **options).filter("taken > 0")
    # a document's blocks follow each other, so their counts are found by position
    counts = F.transform(F.sort_array("times"), lambda t: t.n).alias("counts")
    # one text for id, source and text hash; a null id or source differs from every other
    key = F.concat_ws("|", "row", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(
        F.concat(F.lit("s"), F.col("source")), F.lit("")))
    places = materialize(plan.select(key.alias("key"), "start", counts))
    rows = carry(docs, doc_id=F.col(doc_id).cast("long"), source=F.col(source).cast("string"),
                 row=F.xxhash64(F.col(text)), text=F.col(text))
    rows = rows.select("own", "text", key.alias("key")).dropDuplicates(["key"])
    # many places may want one text: those of a hot key are dealt out
    passes = lookup(places, rows, "key", "start").select(
        "own", "text", "start", "counts", F.explode(F.sequence(F.lit(1), F.array_max("counts"))).alias("turn"))
    first_block = F.floor(F.col("start") / block_words)
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    some = F.array_join(F.filter(words, lambda w, i: F.get(
        F.col("counts"), (F.floor((F.col("start") + i) / block_words) - first_block).cast("int")
    ) >= F.col("turn")), " ")
    out = passes.select("own", F.when(F.array_min("counts") >= F.col("turn"), F.col("text")).otherwise(some).alias("taken"))
    return out.select(*[F.col("taken").alias(text) if c == text else given
                        for c, given in zip(docs.columns, given_back(out))])
