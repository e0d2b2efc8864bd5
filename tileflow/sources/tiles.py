"""Tile tables: ``img_id string, z bigint, x bigint, y bigint, pixels``.

``pixels`` is a flat ``array<number>`` or, for heavy tiles, ``binary``.  A *reader* is
the other way to get pixels: a function from the four key columns to a pixel column,
for tiles that are computed or fetched by id and not listed in a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TILE_KEY = ["img_id", "z", "x", "y"]


def read_tiles(spark: SparkSession, path, pixel_type="array<int>") -> DataFrame:
    """A stored tile table.  The schema is given, so an image id such as 007 stays text."""
    schema = f"img_id string, z bigint, x bigint, y bigint, pixels {pixel_type}"
    return spark.read.schema(schema).parquet(path)


def read_tile_files(spark: SparkSession, path, z=-1,
                    pattern=r"([^/]+)/(\d+)_(\d+)\.[^./]+$") -> DataFrame:
    """Raw tiles kept one per file; ``pattern`` finds image id, x and y in the file path.

    The content column is read only for files that survive filters on the key.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    part = lambda group: F.regexp_extract("path", pattern, group)
    return (files.where(F.col("path").rlike(pattern))
            .select(part(1).alias("img_id"), F.lit(z).cast("bigint").alias("z"),
                    part(2).cast("bigint").alias("x"), part(3).cast("bigint").alias("y"),
                    F.col("content").alias("pixels")))


def tiles_from_vectors(df: DataFrame, id_col: str, vector_col: str, per_axis: int = 10,
                       scale: int = 127, z: int = -1) -> DataFrame:
    """Read numbered vectors as the tiles of square images, x before y.

    Tile coordinates are indexes (a grid of tile size 1); each value is scaled and
    truncated toward zero.
    """
    n, side = F.col(id_col), F.lit(per_axis)
    place = n % (side * side)
    div = lambda a, b: F.call_function("div", a, b).cast("bigint")
    return df.select(
        div(n, side * side).cast("string").alias("img_id"),
        F.lit(z).cast("bigint").alias("z"),
        div(place, side).alias("x"),
        (place % side).cast("bigint").alias("y"),
        F.transform(vector_col, lambda v: (v.cast("double") * scale).cast("int")).alias("pixels"))


def synthetic_reader(length: int, seed: Column | None = None):
    """A reader that computes ``length`` pixels in -127..127 from the tile's place."""
    seed = F.lit(0) if seed is None else seed

    def read(img_id, z, x, y) -> Column:
        # Multipliers that spread neighbouring places over the pixel range.
        base = x.cast("bigint") * 7919 + y.cast("bigint") * 104729 + seed.cast("bigint")
        pixel = lambda i: (F.pmod(base + i.cast("bigint") * 1299709, F.lit(255)) - 127).cast("int")
        return F.transform(F.sequence(F.lit(0), F.lit(length - 1)), pixel)

    return read


def synthetic_tiles(ids: DataFrame, length: int, seed: Column | None = None) -> DataFrame:
    """A tile for every key of ``ids``, computed where the key is."""
    return ids.withColumn("pixels", synthetic_reader(length, seed)(*[F.col(c) for c in TILE_KEY]))
