"""Tiles gathered per image, in lists of bounded length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def group_tiles(tiles: DataFrame, key: str, part: Column, order=("x", "y")) -> DataFrame:
    """Group the tiles of every ``key`` as sorted lists, one list per ``part``.

    One image may hold most of all tiles, so its list is cut in parts; ``part`` must
    bound how many tiles share a value (see :func:`tile_part`).
    """
    rest = [c for c in tiles.columns if c not in (key, *order)]
    item = F.struct(*order, *rest)
    return (tiles.groupBy(key, part.alias("part"))
            .agg(F.sort_array(F.collect_list(item)).alias("tiles"))
            .withColumn("n_tiles", F.array_size("tiles").cast("bigint")))


def tile_part(x: Column, y: Column, n_rows: int, size: int) -> Column:
    """Number of the run of ``size`` tiles a tile index falls in, in x-then-y order."""
    at = (x * n_rows + y).cast("bigint")
    return F.call_function("div", at, F.lit(size)).cast("bigint")
