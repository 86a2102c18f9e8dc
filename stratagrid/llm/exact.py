"""Exact dedup by progressive refinement: length, prefix hash, full hash.  DataFrame functions only.

Level one and two are one combinable count over narrow keys ``(length, prefix hash)``: a key that two
rows share implies a shared length.  The keys that survive are folded into a bitmap of at most
``keyset.MAX_BITS`` bits, a bound whatever the input.  The second scan hashes the full text only where
the bitmap has the row's key.  A bit set by another key costs one hash and never changes a result, so
no text is ever shuffled and no group is ever collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagrid.llm.carried import carry, given_back
from stratagrid.llm.keyset import key_set
from stratagrid.scratch import materialize

PREFIX_CHARS = 64


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _key(text: Column) -> Column:
    return F.xxhash64(F.octet_length(text), F.xxhash64(F.substring(text, 1, PREFIX_CHARS)))


def suspects(docs: DataFrame, text: str = "text") -> Column:
    """Scan lengths and prefixes; a column that is false only for texts that no other row can equal."""
    t = _text(text)
    keys = docs.select(
        F.octet_length(t).alias("length"), F.xxhash64(F.substring(t, 1, PREFIX_CHARS)).alias("prefix")
    )
    shared = materialize(
        keys.groupBy("length", "prefix").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(F.xxhash64("length", "prefix").alias("key"))
    )
    return key_set(shared, "key").may_hold(_key(t))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     digest_all: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are equal when their texts are identical; a null text counts as empty.  Of equal rows the
    one with the greatest id stays (a null id is least; of rows that repeat the id, one stays).
    ``text_sha256`` is null for a row that is proven unique without its full hash, unless
    ``digest_all`` asks for it.  An empty table gives an empty result; other columns are ignored.
    """
    t, flag = _text(text), suspects(docs, text)
    digest = F.sha2(t, 256)
    rows = materialize(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), flag.alias("suspect"),
        (digest if digest_all else F.when(flag, digest)).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row"),
    ))
    groups = materialize(
        rows.filter("suspect").groupBy("text_sha256").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("keep")
        ).filter("n > 1").select("text_sha256", "n", F.col("keep.doc_id").alias("keep_id"),
                                 F.col("keep.row").alias("keep_row"))
    )
    # the group table was written and read back, so adaptive execution can split a hot group's rows
    grouped = F.col("n").isNotNull()
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id", F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (~grouped | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that no other can equal pass straight through; only suspects are hashed and meet in a join.
    Columns may have any names.
    """
    marked = carry(docs, doc_id=F.col(doc_id), text=_text(text), suspect=suspects(docs, text))
    hashed = marked.filter("suspect").select("own", "doc_id", F.sha2("text", 256).alias("digest"))
    last = materialize(hashed.groupBy("digest").agg(F.max("doc_id").alias("keep")))
    staying = hashed.join(last, "digest").filter(F.col("doc_id").eqNullSafe(F.col("keep"))).dropDuplicates(["digest"])
    passing = marked.filter("not suspect").select("own")
    return passing.select(*given_back(passing)).unionByName(staying.select(*given_back(passing)))
