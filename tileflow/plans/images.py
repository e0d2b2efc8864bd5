"""Light keys with a heavy image column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.pixels import brightest_point, reshape_tile, tile_mean
from ..operators.attach import attach_tiles
from ..sources.tiles import TILE_KEY


def image_table(keys: DataFrame, tiles, height: int, width: int | Column | None = None,
                on_missing: str = "skip", length: int | None = None) -> DataFrame:
    """The key table with an ``Image`` column (rows of pixels) for every key.

    Filters on the keys run before the image is touched, and a query that does not
    select ``Image`` never reads it.
    """
    rows = attach_tiles(keys, tiles, TILE_KEY, on_missing, length)
    image = reshape_tile(F.col("pixels"), height, height if width is None else width)
    return rows.withColumn("Image", image).drop("pixels")


def with_tile_stats(images: DataFrame, image: str = "Image") -> DataFrame:
    """Add ``MeanPoint`` and ``BrightestPoint`` of the image column."""
    return images.withColumns({"MeanPoint": tile_mean(F.col(image)),
                               "BrightestPoint": brightest_point(F.col(image))})
