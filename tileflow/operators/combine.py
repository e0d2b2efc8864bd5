"""Element-wise sum of tiles, as a real aggregate.

Two ways to the same sums:

* ``lanes``: cut every tile in runs of 16 pixels, one column per pixel of the run, and
  sum the columns.  Stays in generated code, combines before the shuffle, spills, and a
  hot key spreads over its runs.
* ``long``: one row per pixel.  Same guarantees, about four times slower.

The NumPy way over neighbourhoods is in :mod:`tileflow.operators.halo`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from ..functions.pixels import int_div

# 16 columns keep the generated update under the size the JVM still compiles; 32 do not.
LANES = 16
METHODS = ("lanes", "long")


def sum_type(df: DataFrame, pixels: str = "pixels") -> str:
    """Type of the sums: whole pixels add up in bigint, real ones in double."""
    kind = df.schema[pixels].dataType
    real = isinstance(kind, ArrayType) and isinstance(kind.elementType, (DoubleType, FloatType))
    return "double" if real else "bigint"


def _same_length(value: Column, truncate: bool) -> Column:
    if truncate:
        return value
    failed = F.raise_error(F.lit("tiles of one sum differ in length"))
    return F.when(F.col("_max") != F.col("_min"), failed).otherwise(value)


def _whole(pixel: Column, kind: str) -> Column:
    """A null pixel counts as 0."""
    return F.coalesce(pixel.cast(kind), F.lit(0).cast(kind))


def at_most(pixels, length: int, size: Column | None = None) -> Column:
    """The tile; fails the query on one of more than ``length`` pixels."""
    size = F.array_size(pixels) if size is None else size
    too_long = F.raise_error(F.lit(f"a tile has more than {length} pixels"))
    return F.when(size > length, too_long).otherwise(F.col(pixels))


def lane_rows(df: DataFrame, keys, kind: str, pixels: str = "pixels", element=lambda v: v) -> DataFrame:
    """Tiles cut in runs of 16 pixels: keys, ``_run``, ``_min`` and ``_max`` (both the size of the
    tile) and a column per pixel."""
    size = F.array_size(pixels)
    # the outer form: a plain explode would let the optimizer test size(pixels) early
    # and compute a read column twice
    runs = F.sequence(F.lit(0), int_div(size - 1, F.lit(LANES)))
    cut = df.select(*df.columns, size.alias("_size"), F.explode_outer(runs).alias("_run"))
    pixel = lambda k: F.get(pixels, F.col("_run") * LANES + k)
    return cut.where("_run is not null").select(
        *keys, "_run", F.col("_size").alias("_min"), F.col("_size").alias("_max"),
        *[_whole(element(pixel(k)), kind).alias(f"_p{k}") for k in range(LANES)])


def pixel_rows(df: DataFrame, keys, kind: str, pixels: str = "pixels", element=lambda v: v) -> DataFrame:
    """The same with a row for every pixel."""
    out = df.select(*df.columns, F.array_size(pixels).alias("_size"),
                    F.posexplode_outer(pixels).alias("_pos", "_value"))
    # an empty tile keeps one row, so that its length still takes part in the check
    out = out.where("_pos is not null or _size = 0")
    return out.select(*keys, F.coalesce("_pos", F.lit(0)).alias("_run"), F.col("_size").alias("_min"),
                      F.col("_size").alias("_max"), _whole(element(F.col("_value")), kind).alias("_p0"))


def add_rows(rows: DataFrame, keys) -> DataFrame:
    """Sums of such rows by key and run."""
    pixels = [c for c in rows.columns if c.startswith("_p")]
    return rows.groupBy(*keys, "_run").agg(
        F.min("_min").alias("_min"), F.max("_max").alias("_max"), *[F.sum(c).alias(c) for c in pixels])


def whole_tiles(sums: DataFrame, keys, output: str = "tiles", truncate: bool = False) -> DataFrame:
    """Tiles, or rows of their pixels, from the sums of their runs."""
    lanes = [c for c in sums.columns if c.startswith("_p")]
    pieces = sums.select(*keys, "_run", "_min", "_max", F.array(*lanes).alias("_piece"))
    if output == "long" and not truncate:
        rows = pieces.select(*keys, "_run", "_min", "_max",
                             F.posexplode("_piece").alias("_pos", "s"))
        at = F.col("_run") * len(lanes) + F.col("_pos")
        return (rows.where(at < _same_length(F.col("_min"), False))
                .select(*keys, at.cast("bigint").alias("i"), "s"))
    # a tile's pieces are as bounded as the tile itself
    whole = pieces.groupBy(*keys).agg(
        F.min("_min").alias("_min"), F.max("_max").alias("_max"),
        F.sort_array(F.collect_list(F.struct("_run", "_piece"))).alias("_pieces"))
    tile = F.slice(F.flatten("_pieces._piece"), F.lit(1), _same_length(F.col("_min"), truncate))
    tiles = whole.select(*keys, tile.alias("pixels"))
    return to_long(tiles) if output == "long" else tiles


def _short_sums(df, keys, pixels, element, kind, length):
    """Tiles of at most ``length`` pixels: a single run, so one shuffle gives whole tiles."""
    size = F.array_size(pixels)
    lanes = df.select(*keys, size.alias("_size"), *[
        _whole(element(F.get(pixels, F.lit(k))), kind).alias(f"_p{k}") for k in range(length)])
    sums = lanes.groupBy(*keys).agg(
        F.min("_size").alias("_min"), F.max("_size").alias("_max"),
        *[F.sum(f"_p{k}").alias(f"_p{k}") for k in range(length)])
    # a key with null tiles only has no sizes
    return sums.where("_min is not null").select(
        *keys, "_min", "_max", F.array(*[f"_p{k}" for k in range(length)]).alias("_piece"))


def sum_tiles(df: DataFrame, keys, pixels: str = "pixels", method: str = "lanes",
              output: str = "tiles", element=None, truncate: bool = False,
              length: int | None = None) -> DataFrame:
    """Add up the flat tiles of every key, pixel by pixel.

    ``element`` maps each pixel before it is added (it may use other columns of ``df``).
    Tiles of one key must be equally long; with ``truncate`` the shortest decides.  A null
    pixel counts as 0.  ``output`` is ``"tiles"`` (keys, pixels) or ``"long"`` (keys, i, s).
    ``length`` states that no tile has more pixels, and a longer one fails the query; a
    ``length`` of at most 16 saves ``lanes`` a shuffle.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    keys = list(keys)
    kind = sum_type(df, pixels)
    element = element or (lambda v: v)
    if length is not None:
        df = df.withColumn(pixels, at_most(pixels, length))
    if method == "lanes" and length is not None and length <= LANES:
        sums = _short_sums(df, keys, pixels, element, kind, length)
        tile = F.slice("_piece", F.lit(1), _same_length(F.col("_min"), truncate))
        tiles = sums.select(*keys, tile.alias("pixels"))
        return to_long(tiles) if output == "long" else tiles
    rows = (lane_rows if method == "lanes" else pixel_rows)(df, keys, kind, pixels, element)
    return whole_tiles(add_rows(rows, keys), keys, output, truncate)


def to_long(tiles: DataFrame) -> DataFrame:
    """One row per pixel: the other columns, ``i`` and ``s``."""
    rest = [c for c in tiles.columns if c != "pixels"]
    return (tiles.select(*rest, F.posexplode_outer("pixels").alias("i", "s"))
            .where("i is not null").withColumn("i", F.col("i").cast("bigint")))
