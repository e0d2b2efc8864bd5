"""A zone map: statistics of every tile, kept beside the tiles.

Filters on statistics are answered from the map, and only qualifying tiles are fetched: the
folders of their images are read, and their rows alone are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.tiles import TILE_KEY
from .wanted import FILTER_BITS, wanted_filter


def zone_map(tiles: DataFrame) -> DataFrame:
    """img_id, z, x, y, ``n_pixels``, ``least``, ``most``, ``mean`` and ``brightest``, the place of
    the first largest pixel.  Null pixels count nowhere; a tile without pixels has nulls."""
    known = F.array_compact("pixels")
    total = F.aggregate(known, F.lit(0.0), lambda a, v: a + v.cast("double"))
    most = F.array_max("pixels")
    place = F.nullif(F.array_position("pixels", most), F.lit(0)) - 1
    return tiles.select(*TILE_KEY, F.array_size(known).alias("n_pixels"), F.array_min("pixels").alias("least"),
                        most.alias("most"), F.try_divide(total, F.array_size(known)).alias("mean"),
                        place.cast("int").alias("brightest"))


def write_zone_map(tiles: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Writes the zone map of a tile table: some 60 bytes a tile."""
    zone_map(tiles).write.mode(mode).parquet(path)


def read_zone_map(spark, path: str, pixel_type: str = "int") -> DataFrame:
    return spark.read.schema(f"img_id string, z bigint, x bigint, y bigint, n_pixels int, least {pixel_type}, "
                             f"most {pixel_type}, mean double, brightest int").parquet(path)


def tiles_where(tiles: DataFrame, zones: DataFrame, condition, bits: int = FILTER_BITS) -> DataFrame:
    """The tiles whose statistics meet ``condition``, with these statistics.

    ``zones`` is the stored zone map of ``tiles``.  Of tiles stored by image only the images that
    qualify are opened; other tiles are left out at the scan by a filter of the keys.
    """
    wanted = zones.where(condition if isinstance(condition, Column) else F.expr(condition))
    near = tiles.where(wanted_filter(wanted, ["img_id"], bits)).where(wanted_filter(wanted, TILE_KEY, bits))
    return near.join(wanted, TILE_KEY)
