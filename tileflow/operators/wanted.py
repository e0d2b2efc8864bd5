"""A filter of tiles by request, applied where the tiles are scanned.

The ids of the wanted images become a Bloom filter, one row of a scalar subquery that Spark
runs before the scan.  Of a table stored by image it selects the folders that are read, of any
other the rows that move.  Its size does not follow the number of requests: more ids than it
was sized for let more tiles through, never fewer, and a join with the requests decides in
the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of the filter (128 KiB): some 100,000 ids at a hundredth of false positives.
FILTER_BITS = 1 << 20
_BLOCK = 64


def _block(h: Column, bits: int) -> Column:
    return F.pmod(h, F.lit(bits // _BLOCK)).cast("int")


def _mask(h: Column) -> Column:
    """Four bits of a block, from the upper half of the hash."""
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                    F.call_function("shiftrightunsigned", h, F.lit(k)).bitwiseAND(F.lit(63)).cast("int"))
    return bit(34).bitwiseOR(bit(40)).bitwiseOR(bit(46)).bitwiseOR(bit(52))


def wanted_filter(ids: DataFrame, columns=("img_id",), bits: int = FILTER_BITS) -> Column:
    """A condition on ``columns`` that every key in the same columns of ``ids`` meets, and few others.

    ``ids`` may hold any number of rows and is read once; keys with a null meet nothing.
    """
    if bits < _BLOCK or bits & (bits - 1):
        raise ValueError("the bits of a filter are a power of two, 64 at least")
    h = F.xxhash64(*columns)
    for c in columns:
        ids = ids.where(F.col(c).isNotNull())
    empty = ids.sparkSession.range(bits // _BLOCK).select(F.col("id").cast("int").alias("block"), F.lit(0).cast("bigint").alias("mask"))
    marks = ids.select(_block(h, bits).alias("block"), _mask(h).alias("mask"))
    # every block once, so that the sorted list is the filter itself
    blocks = marks.union(empty).groupBy("block").agg(F.bit_or("mask").alias("mask"))
    masks = blocks.agg(F.sort_array(F.collect_list(F.struct("block", "mask"))).getField("mask").alias("masks")).scalar()
    return F.get(masks, _block(h, bits)).bitwiseAND(_mask(h)) == _mask(h)
