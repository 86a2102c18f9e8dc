"""A bitmap over hashed keys, small enough to travel inside a plan; false positives only.

Its size follows the number of keys up to ``max_bits``, a fixed bound; beyond it more keys share a bit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_BITS = 32768  # bits in one page of Spark's bitmap functions
MAX_BITS = 1 << 25


@dataclass(frozen=True)
class KeySet:
    bits: int
    pages: bytes

    def may_hold(self, key: Column) -> Column:
        """False only for keys that are not in the set; ``key`` is a 64-bit hash."""
        position = F.pmod(key, F.lit(self.bits))
        byte = F.substring(F.lit(self.pages), (position / 8).cast("int") + 1, F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        bit = F.pmod(position, F.lit(8)).cast("int")
        return F.call_function("shiftright", value, bit).bitwiseAND(F.lit(1)) == 1


def key_set(keys: DataFrame, column: str, max_bits: int = MAX_BITS) -> KeySet:
    """Fold a written table of 64-bit hashes into a bitmap."""
    bits = PAGE_BITS
    while bits < min(max_bits, 16 * keys.count()):
        bits *= 2
    position = F.pmod(column, F.lit(bits))
    pages = keys.select(position.alias("p")).groupBy((F.col("p") / PAGE_BITS).cast("int").alias("page")).agg(
        F.bitmap_construct_agg(F.pmod("p", F.lit(PAGE_BITS))).alias("map")
    ).collect()  # at most max_bits / PAGE_BITS pages of 4 KiB
    out = bytearray(bits // 8)
    for page, page_map in pages:
        out[page * PAGE_BITS // 8:(page + 1) * PAGE_BITS // 8] = page_map
    return KeySet(bits, bytes(out))
