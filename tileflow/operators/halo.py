"""Sums over tile neighbourhoods with few copies of each tile in the shuffle.

Sending a tile to each of the ``(2n+1)^2`` outputs that use it would shuffle nine
copies of all pixels for n = 1.  Instead the grid is cut in square blocks of outputs,
a tile travels once to every block it touches (one block inside, two at an edge, four
at a corner: ``(1 + 2n/block)^2`` copies), and the neighbourhood is laid out after the
shuffle, inside the block.  A block holds a bounded number of tiles, so one image with
most of the data is as many groups as it has blocks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType

from ..functions.pixels import BRIGHT_LIMIT, int_div, zero_above
from ..grid import TileGrid
from ..sources.tiles import TILE_KEY
from .block_sums import BLOCK_KEY, block_summer
from .combine import add_rows, at_most, lane_rows, pixel_rows, sum_tiles, sum_type, whole_tiles

BLOCK_METHODS = ("arrow", "lanes", "long")
REQUEST_JOINS = ("shuffle", "broadcast")
# Pixels of a run that heavy tiles are cut in, unless the caller names another.
RUN = 32768


def _index(at: str, step: int):
    """Tile index of an offset (tiles lie at whole multiples of the step)."""
    return int_div(F.col(at), F.lit(step))


def _block_of(index, block: int):
    """Block of an index that may be negative."""
    return int_div(index - F.pmod(index, F.lit(block)), F.lit(block))


def _block_range(at: str, step: int, n_size: int, n_targets: int, block: int):
    """Blocks of outputs along one axis that use the tile."""
    first = F.greatest(_index(at, step) - n_size, F.lit(0).cast("bigint"))
    last = F.least(_index(at, step) + n_size, F.lit(n_targets - 1).cast("bigint"))
    return F.sequence(int_div(first, F.lit(block)), int_div(last, F.lit(block)))


def place_in_blocks(sources: DataFrame, grid: TileGrid, block: int) -> DataFrame:
    """One row per tile and output block that uses it; adds ``bx`` and ``by``."""
    bx = _block_range("x", grid.tile_w, grid.n_size, grid.cols, block)
    by = _block_range("y", grid.tile_h, grid.n_size, grid.rows, block)
    return (sources.select("*", F.explode(bx).alias("bx"))
            .select("*", F.explode(by).alias("by")))


def with_own_block(tiles: DataFrame, grid: TileGrid, block: int) -> DataFrame:
    """Add ``bx`` and ``by``, the block the tile itself lies in."""
    return (tiles.withColumn("bx", _block_of(_index("x", grid.tile_w), block))
            .withColumn("by", _block_of(_index("y", grid.tile_h), block)))


def wanted_blocks(weights: DataFrame, grid: TileGrid, block: int, of_inputs: bool = False,
                  salt: int | None = None) -> DataFrame:
    """A row for every block, of inputs or of outputs, of every requested image, and for
    each of the ``salt`` groups that share it."""
    def axis(bounds):
        first, last = bounds[0] // block, max(bounds) // block
        return F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"))

    columns, rows = ((grid.source_cols, grid.source_rows) if of_inputs
                     else ((0, grid.cols - 1), (0, grid.rows - 1)))
    blocks = (weights.select("*", F.explode(axis(columns)).alias("bx"))
              .select("*", F.explode(axis(rows)).alias("by")))
    if salt is None:
        return blocks
    return blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("salt"))


def broadcast_requests(weights: DataFrame, limit: int) -> DataFrame:
    """The distinct requests as a broadcast side; a job over light rows checks their size."""
    size = weights.agg(F.sum(F.octet_length("img_id") + 8)).first()[0] or 0
    if size > limit:
        raise ValueError(f"the distinct requests have {size} bytes, over the {limit} that may be "
                         "broadcast: use request_join='shuffle'")
    return F.broadcast(weights.where("weight > 0"))


def cut_segments(tiles: DataFrame, segment: int | None, dtype: str | None = None,
                 length: int | None = None) -> DataFrame:
    """Cut heavy tiles in runs of ``segment`` pixels (``seg`` numbers them).

    A sum needs only equal pixel positions together, so every run is a group of its
    own, and no task has to hold whole heavy tiles.  Tiles are whole if no tile has more
    than ``RUN`` pixels or ``length`` says so; a longer tile fails the query.
    """
    binary = isinstance(tiles.schema["pixels"].dataType, BinaryType)
    size = F.length("pixels") if binary else F.array_size("pixels")
    width = np.dtype(dtype).itemsize if binary else 1
    if segment is None or length is not None:
        limit = RUN if length is None else length
        tiles = tiles.withColumn("pixels", at_most("pixels", limit, int_div(size, F.lit(width))))
    if segment is None:
        return tiles.withColumn("seg", F.lit(0))
    rest = [c for c in tiles.columns if c != "pixels"]
    run = segment * width
    last = int_div(size - 1, F.lit(run))
    cut = tiles.select("*", F.explode_outer(F.sequence(F.lit(0), last.cast("int"))).alias("seg"))
    start, width = F.col("seg") * run + 1, F.lit(run)
    piece = F.substring("pixels", start, width) if binary else F.slice("pixels", start, width)
    return cut.where("seg is not null").select(*rest, "seg", piece.alias("pixels"))


def join_segments(tiles: DataFrame, keys) -> DataFrame:
    """Put the runs of every tile back in order."""
    if isinstance(tiles.schema["pixels"].dataType, BinaryType):
        whole = F.expr("listagg(pixels) within group (order by seg)")
        return tiles.groupBy(*keys).agg(whole.alias("pixels"))
    runs = tiles.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("seg", "pixels"))).alias("_runs"))
    return runs.select(*keys, F.flatten("_runs.pixels").alias("pixels"))


def add_copies(tiles: DataFrame, limit, length: int | None = None) -> DataFrame:
    """Add up the copies of every tile, or of every run of it, in each of the groups of a salt.

    Combined before they move: a task meets as many rows of a tile as there are groups, however
    often the table lists it.  Pixels above ``limit`` count as 0; array pixels only.
    """
    keys = [*TILE_KEY, *(c for c in ("seg", "salt", "weight") if c in tiles.columns)]
    return sum_tiles(tiles, keys, element=lambda v: zero_above(v, limit), length=length)


def _users(at: str, step: int, n_size: int, n_targets: int, block: int | None, block_at: str):
    """Places along one axis whose outputs use the tile; inside its block if ``block`` is set."""
    low = [_index(at, step) - n_size, F.lit(0).cast("bigint")]
    high = [_index(at, step) + n_size, F.lit(n_targets - 1).cast("bigint")]
    if block:
        low.append(F.col(block_at) * block)
        high.append(F.col(block_at) * block + block - 1)
    return F.transform(F.sequence(F.greatest(*low), F.least(*high)), lambda i: i * step)


def box_sums(rows: DataFrame, grid: TileGrid, block: int | None, keys: list[str], method: str, element) -> DataFrame:
    """The sums over every output's neighbourhood, along x first and then along y.

    A square sum is a sum of sums: a run of pixels is added to ``2n + 1`` outputs in each of two
    passes, not to ``(2n + 1)^2`` in one.  ``keys`` name what sits in one partition together;
    the passes need no shuffle then.
    """
    kind = sum_type(rows)
    cut = (lane_rows if method == "lanes" else pixel_rows)(rows, [*keys, "x", "y"], kind, element=element)
    for at, step, n_targets, block_at in (("x", grid.tile_w, grid.cols, "bx"), ("y", grid.tile_h, grid.rows, "by")):
        rest = [c for c in cut.columns if c != at]
        users = F.explode(_users(at, step, grid.n_size, n_targets, block, block_at)).alias(at)
        cut = add_rows(cut.select(*rest, users), [*keys, "x", "y"])
    return cut


def _together(rows: DataFrame, by: list[str], wanted: DataFrame | None) -> DataFrame:
    """Rows of a block in one partition; of ``wanted`` blocks only, with their ``weight``.

    Rows move once: the wanted blocks are dealt by the same keys before they are joined.
    Both are explicit repartitions, which adaptive execution merges but never splits, nor
    reads in other pieces, so a block stays whole also if the join becomes a broadcast.
    """
    if wanted is None:
        return rows.repartition(*by)
    keys = [c for c in wanted.columns if c != "weight"]
    return rows.repartition(*keys).join(wanted.repartition(*keys).hint("merge"), keys)


def _sum_blocks(rows, grid, block, dtype, kind, wanted=None, **reaches) -> DataFrame:
    """Bring every block together and sum it with NumPy, one block after the other.

    A sorted stream and not one call per group: the calls would cost more than the sums
    of small tiles do.
    """
    schema = f"img_id string, z bigint, x bigint, y bigint, seg int, pixels {kind}"
    together = _together(rows, ["img_id", "bx", "by", "seg", "salt"], wanted)
    return (together.select(*BLOCK_KEY, "x", "y", "pixels").sortWithinPartitions(*BLOCK_KEY)
            .mapInArrow(block_summer(grid, block, dtype=dtype, **reaches), schema))


def sum_neighbourhoods(sources: DataFrame, grid: TileGrid, method: str = "arrow", block: int = 8,
                       segment: int | None = None, limit=BRIGHT_LIMIT,
                       dtype: str | None = None, length: int | None = None,
                       weights: DataFrame | None = None) -> DataFrame:
    """Threshold the source tiles and sum them over every output's neighbourhood.

    ``sources`` lists each input tile once, with the ``weight`` of its image, unless
    ``weights`` has the images wanted.  One shuffle moves the pixels, keyed by block.
    ``dtype`` gives the NumPy type of binary pixels.  Returns img_id, z, x, y, seg, pixels.
    """
    placed = place_in_blocks(cut_segments(sources, segment, dtype, length), grid, block).withColumn("salt", F.lit(0))
    wanted = None if weights is None else wanted_blocks(weights, grid, block)
    if method == "arrow":
        kind = "binary" if dtype else f"array<{sum_type(sources)}>"
        return _sum_blocks(placed, grid, block, dtype, kind, wanted, reach=grid.n_size,
                           source_halo=grid.n_size, out_halo=0, limit=limit)
    # a constant seg would hide from the sum that its keys are already together
    by = ["img_id", "bx", "by"] + (["seg"] if segment else [])
    element = lambda v: zero_above(v, limit) * F.col("weight")
    # the outputs of a block sit in its partition: the sums need no further shuffle
    keys = ["img_id", "z", "bx", "by", "seg"]
    sums = box_sums(_together(placed, by, wanted), grid, block, keys, method, element)
    return whole_tiles(sums, [*keys, "x", "y"]).drop("bx", "by")


def sum_neighbourhoods_by_parts(sources: DataFrame, grid: TileGrid, method: str = "arrow",
                                block: int = 8, segment: int | None = None, limit=BRIGHT_LIMIT,
                                dtype: str | None = None, length: int | None = None,
                                weights: DataFrame | None = None, salt: int = 1) -> DataFrame:
    """Same sums by partial results: first inside blocks of inputs, then across blocks.

    Every tile moves once, to the block of inputs it lies in, and is added to all
    outputs it reaches; only these partial sums, complete but for the rim of the block,
    move in the second shuffle.  The first sum of a block is shared among ``salt`` groups,
    by the column ``salt`` of ``sources``; the copies of a tile in a group are added up before
    they move (those of binary tiles are not).
    """
    cut = cut_segments(sources, segment, dtype, length)
    if salt != 1 and dtype is None:
        # every pixel once under the limit: what is left are sums
        cut, limit = add_copies(cut, limit, length if segment is None else segment), None
    rows = with_own_block(cut, grid, block)
    wanted = None if weights is None else wanted_blocks(
        weights, grid, block, of_inputs=True, salt=None if salt == 1 else salt)
    if method == "arrow":
        kind = "binary" if dtype else f"array<{sum_type(sources)}>"
        inside = _sum_blocks(rows, grid, block, dtype, kind, wanted, reach=grid.n_size, source_halo=0,
                             out_halo=grid.n_size, limit=limit)
        wide = ("float64" if np.dtype(dtype).kind == "f" else "int64") if dtype else None
        inside = with_own_block(inside, grid, block).withColumns(
            {"weight": F.lit(1), "salt": F.lit(0)})
        return _sum_blocks(inside, grid, block, wide, kind, reach=0, source_halo=0, out_halo=0)
    by = ["img_id", "bx", "by", "salt"] + (["seg"] if segment else [])
    element = lambda v: zero_above(v, limit) * F.col("weight")
    sums = box_sums(_together(rows, by, wanted), grid, None, ["img_id", "z", "seg", "bx", "by", "salt"], method, element)
    keys = ["img_id", "z", "seg", "x", "y"]
    return whole_tiles(add_rows(sums.drop("bx", "by", "salt"), keys), keys)
