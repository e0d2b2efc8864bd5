"""The fragment pipeline: index targets, backward neighbours, sums per target and request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.attach import attach_tiles
from ..operators.combine import sum_tiles
from ..operators.expand import backward_neighbours, expand_index_grid, spread
from ..sources.requests import request_weights

# The inclusive bounds of the index grid, and the length and value of a
# constant fragment and of a constant full tile.
LAST_X, LAST_Y = 1, 6000
FRAGMENT_LENGTH, FRAGMENT_VALUE, FULL_VALUE = 10, 1, -1


def constant_fragment() -> Column:
    return F.array_repeat(F.lit(FRAGMENT_VALUE), FRAGMENT_LENGTH)


def constant_full_tile() -> Column:
    return F.array_repeat(F.lit(FULL_VALUE), FRAGMENT_LENGTH)


def fragment_pairs(requests: DataFrame, last_x: int = LAST_X, last_y: int = LAST_Y,
                   partitions: int | None = None) -> DataFrame:
    """Every (request, target, source) of the requested images, repeated requests once."""
    targets = expand_index_grid(request_weights(requests), last_x, last_y, partitions=partitions)
    return backward_neighbours(targets)


SOURCE_KEY = ("source_img_id", "z", "sx", "sy")


def read_once(pairs: DataFrame, tiles, partitions: int | None = None, on_missing: str = "skip",
              length: int | None = None) -> DataFrame:
    """Pairs of a target and a source with the source's ``pixels``, each source read once.

    The distinct sources are read (by id, or from a tile table) spread over tasks, and
    joined to the pairs that use them; a source of very many targets is a join key that
    adaptive execution splits.
    """
    sources = pairs.select(*SOURCE_KEY).distinct().repartition(partitions or spread(pairs), *SOURCE_KEY)
    read = attach_tiles(sources, tiles, SOURCE_KEY, on_missing, length, shuffle=True)
    return pairs.join(read.hint("merge"), list(SOURCE_KEY))


def fragment_pipeline(requests: DataFrame, last_x: int = LAST_X, last_y: int = LAST_Y,
                      fragment: Column | None = None, truncate: bool = True,
                      partitions: int | None = None, tiles=None, **missing) -> DataFrame:
    """One summed tile per (request, target).

    ``fragment`` gives the pixels of one pair and may use its key columns and, if there are
    ``tiles`` (a table or a reader), the ``pixels`` of its source, which are the fragment
    unless another is given.  Fragments of unequal length are cut to the shortest unless
    ``truncate`` is off.  ``missing`` are the options of :func:`read_once` for tables.
    """
    length = FRAGMENT_LENGTH if fragment is None and tiles is None else None
    pairs = fragment_pairs(requests, last_x, last_y, partitions)
    if tiles is not None:
        pairs = read_once(pairs, tiles, partitions, **missing)
    if fragment is None:
        fragment = constant_fragment() if tiles is None else F.col("pixels")
    pairs = pairs.withColumn("pixels", fragment)
    return sum_tiles(pairs, ["request", "img_id", "z", "x", "y"], truncate=truncate,
                     element=lambda v: v * F.col("weight"), length=length)


def request_mosaic(tiles: DataFrame, key: str = "request", truncate: bool = True,
                   length: int | None = None) -> DataFrame:
    """All tiles of a request added up to one.  Combined before the shuffle, so a
    request with most of the tiles costs its task one row per other task."""
    return sum_tiles(tiles, [key], truncate=truncate, length=length)
