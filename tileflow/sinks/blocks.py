"""Tile tables bucketed by image and block of outputs.

Every tile is stored in each block that uses it, ``(1 + 2n/block)^2`` copies, and all tiles of
a block lie in one bucket.  A mosaic of such a table sums where it reads: no pixel is
shuffled, however often it is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.pixels import BRIGHT_LIMIT, zero_above
from ..grid import TileGrid
from ..operators.combine import whole_tiles
from ..operators.halo import box_sums, broadcast_requests, place_in_blocks
from ..operators.wanted import FILTER_BITS, wanted_filter
from ..plans.mosaic import even_block, tiles_of_grid
from ..sources.requests import request_weights
from ..sources.tiles import TILE_KEY

BY = ["img_id", "bx", "by"]
_GRID = "tileflow.grid"


def _described(grid: TileGrid, block: int) -> str:
    return f"{grid} block={block}".replace("'", "")


def write_block_table(tiles: DataFrame, grid: TileGrid, name: str, buckets: int, block: int = 8,
                      path: str | None = None, mode: str = "errorifexists") -> None:
    """Saves the tiles that the grid reads as the table ``name``, in ``buckets`` buckets.

    Choose the buckets by the weight of the tiles: a bucket is a task.  ``path`` makes it an
    external table.  The grid and the block are kept as a property of the table.
    """
    block = even_block(grid, block)
    placed = place_in_blocks(tiles_of_grid(tiles, grid), grid, block)
    # dealt as the buckets are: a file for each
    writer = placed.repartition(buckets, *BY).write.mode(mode).bucketBy(buckets, *BY).sortBy(*BY)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    tiles.sparkSession.sql(f"alter table {name} set tblproperties ('{_GRID}' = '{_described(grid, block)}')")


def mosaic_of_blocks(spark: SparkSession, name: str, grid: TileGrid, requests: DataFrame | None = None,
                     method: str = "lanes", block: int = 8, limit=BRIGHT_LIMIT,
                     filter_bits: int = FILTER_BITS, broadcast_limit: int = 8 << 20) -> DataFrame:
    """The mosaic (img_id, z, x, y, pixels) of a table of :func:`write_block_table`.

    All stored images, or those requested, which are broadcast behind a check of their size.
    ``grid`` and ``block`` must be those of the table.  Sums are by ``lanes`` or ``long``.
    """
    block = even_block(grid, block)
    stored = {r.key: r.value for r in spark.sql(f"show tblproperties {name}").collect()}.get(_GRID)
    if stored != _described(grid, block):
        raise ValueError(f"table {name} was written for {stored}, not for {_described(grid, block)}")
    rows = spark.table(name)
    if requests is None:
        rows = rows.withColumn("weight", F.lit(1).cast("bigint"))
    else:
        weights = request_weights(requests)
        rows = rows.where(wanted_filter(weights, bits=filter_bits)).join(broadcast_requests(weights, broadcast_limit), "img_id")
    keys = ["img_id", "z", "bx", "by"]
    sums = box_sums(rows, grid, block, keys, method, lambda v: zero_above(v, limit) * F.col("weight"))
    return whole_tiles(sums, [*keys, "x", "y"]).select(*TILE_KEY, "pixels")
