"""Element by element comparison of two mosaics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .wanted import FILTER_BITS, wanted_filter


def strategy_diff(left: DataFrame, right: DataFrame, keys=("img_id", "z", "x", "y"),
                  only_different: bool = False) -> DataFrame:
    """Per tile key: is it on both sides, and how many pixels differ.

    ``side`` is ``both``, ``left`` or ``right``; ``n_diff`` counts unequal pixels (every
    pixel of a tile that only one side has, and every pixel past the end of the shorter
    one).  Pixels are walked only for unequal tiles.
    """
    a = left.select(*keys, F.col("pixels").alias("_a"), F.lit(True).alias("_in_a"))
    b = right.select(*keys, F.col("pixels").alias("_b"), F.lit(True).alias("_in_b"))
    both = F.least(F.array_size("_a"), F.array_size("_b"))
    head = lambda c: F.slice(c, F.lit(1), both)
    unequal = F.aggregate(
        F.zip_with(head("_a"), head("_b"), lambda p, q: F.when(p.eqNullSafe(q), 0).otherwise(1)),
        F.abs(F.array_size("_a") - F.array_size("_b")), lambda acc, v: acc + v)
    out = a.join(b, list(keys), "full_outer").select(
        *keys,
        F.when(F.col("_in_b").isNull(), "left").when(F.col("_in_a").isNull(), "right")
        .otherwise("both").alias("side"),
        F.when(F.col("_in_b").isNull(), F.array_size("_a"))
        .when(F.col("_in_a").isNull(), F.array_size("_b"))
        .when(F.col("_a").eqNullSafe(F.col("_b")), 0)
        .otherwise(unequal).cast("bigint").alias("n_diff"))
    return out.where("side <> 'both' or n_diff > 0") if only_different else out


def tile_digest(pixels: str = "pixels") -> Column:
    """128 bits of hash of a tile, by which two tiles are told apart without their pixels."""
    # hashes pass over nulls, so their places are hashed beside the values
    nulls = F.transform(pixels, lambda p: p.isNull())
    part = lambda seed: F.xxhash64(F.lit(seed), F.array_size(pixels), F.col(pixels), nulls)
    return F.struct(part(0).alias("a"), part(1).alias("b"))


def stored_diff(left: DataFrame, right: DataFrame, keys=("img_id", "z", "x", "y"),
                only_different: bool = False, bits: int = FILTER_BITS) -> DataFrame:
    """:func:`strategy_diff` of two stored mosaics that are nearly equal, by digests first.

    Digests are made where the tiles are read, and they alone are shuffled.  The pixels of
    a tile move only if its digests differ: a filter of these keys, of ``bits`` bits, is
    applied to both sides at the scan.  Both mosaics are scanned twice, so a mosaic that is
    not stored would be built twice.  Keys must not repeat on a side.
    """
    keys = list(keys)
    light = lambda df, name: df.select(*keys, F.struct(tile_digest().alias("digest"), F.array_size("pixels").alias("n")).alias(name))
    pairs = light(left, "_a").join(light(right, "_b"), keys, "full_outer")
    side = F.when(F.col("_b").isNull(), "left").when(F.col("_a").isNull(), "right").otherwise("both")
    same = F.col("_a.digest").eqNullSafe(F.col("_b.digest"))
    n_diff = (F.when(F.col("_b").isNull(), F.col("_a.n")).when(F.col("_a").isNull(), F.col("_b.n"))
              .when(same, 0).cast("bigint"))
    told = pairs.select(*keys, side.alias("side"), n_diff.alias("n_diff"))
    unequal = told.where("side = 'both' and n_diff is null").select(*keys)
    near = lambda df: df.select(*keys, "pixels").where(wanted_filter(unequal, keys, bits))
    walked = strategy_diff(near(left), near(right), keys).where("side = 'both' and n_diff > 0")
    known = told.where("n_diff is not null" + (" and (side <> 'both' or n_diff > 0)" if only_different else ""))
    return known.unionByName(walked)
