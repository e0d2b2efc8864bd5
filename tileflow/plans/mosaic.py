"""The mosaic: requests to summed output tiles, by three strategies."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..functions.pixels import BRIGHT_LIMIT, zero_above
from ..grid import TileGrid
from ..operators.attach import assert_unique_tiles, attach_tiles
from ..operators.combine import sum_tiles, to_long
from ..operators.expand import expand_requests, grid_neighbours, source_ids, spread
from ..operators.halo import (BLOCK_METHODS, REQUEST_JOINS, RUN, broadcast_requests, join_segments,
                              sum_neighbourhoods, sum_neighbourhoods_by_parts)
from ..operators.wanted import FILTER_BITS, wanted_filter
from ..sources.requests import request_weights
from ..sources.tiles import TILE_KEY

STRATEGIES = ("naive", "grouped", "partial")
OUTPUTS = ("tiles", "segments", "long")


def tiles_of_grid(tiles: DataFrame, grid: TileGrid) -> DataFrame:
    """The tiles of a table that some output of the grid reads (filters reach the scan).
    Tiles without an image id belong to no image."""
    (x0, x1), (y0, y1) = grid.source_cols, grid.source_rows
    x, y = F.col("x"), F.col("y")
    return tiles.select(*TILE_KEY, "pixels").where(
        F.col("img_id").isNotNull() & (F.col("z") == grid.z)
        & (x >= x0 * grid.tile_w) & (x <= x1 * grid.tile_w) & (x % grid.tile_w == 0)
        & (y >= y0 * grid.tile_h) & (y <= y1 * grid.tile_h) & (y % grid.tile_h == 0))


def even_block(grid: TileGrid, block: int) -> int:
    """Block edge near ``block`` (at most half again as long) that cuts the grid evenly."""
    side = max(grid.cols, grid.rows)
    return -(-side // max(1, round(side / block)))


def _of_images(tiles: DataFrame, weights: DataFrame, ids: DataFrame, request_join: str, limit: int, bits: int) -> DataFrame:
    """The tiles of requested images (a few others may pass the filter), before a join that has
    to see every request.  ``ids`` are the requests as they came: a filter need not count them."""
    if request_join == "broadcast":
        return tiles.join(broadcast_requests(weights, limit).select("img_id"), "img_id", "left_semi")
    return tiles.where(wanted_filter(ids, bits=bits)) if bits else tiles


def read_sources(weights: DataFrame | None, tiles, grid: TileGrid, on_missing: str = "skip",
                 length: int | None = None, partitions: int | None = None, salt: int = 1,
                 request_join: str = "shuffle", broadcast_limit: int = 8 << 20,
                 filter_bits: int = FILTER_BITS, ids: DataFrame | None = None):
    """Every wanted input tile once with a ``salt``, and the requests still to be joined.

    Tiles carry the ``weight`` of their image unless the second value has it: requests
    that are joined by block, when the tiles are brought together.
    """
    # dealt at the scan, before any shuffle brings the copies of a tile together
    deal = (F.monotonically_increasing_id() % salt).cast("int") if salt != 1 else F.lit(0)
    salted = lambda df: df.withColumn("salt", deal)
    if weights is None:
        return salted(tiles_of_grid(tiles, grid)).withColumn("weight", F.lit(1).cast("bigint")), None
    if callable(tiles):
        ids = source_ids(weights, grid, partitions)
        # dealt by tile, not by tile column
        ids = ids.repartition(partitions or spread(ids), *TILE_KEY)
        return attach_tiles(ids, tiles, TILE_KEY).withColumn("salt", F.lit(0)), None
    stored, ids = tiles_of_grid(tiles, grid), weights if ids is None else ids
    if on_missing != "skip":
        stored = _of_images(stored, weights, ids, request_join, broadcast_limit, filter_bits)
        rows = attach_tiles(source_ids(weights, grid, partitions), salted(stored), TILE_KEY, on_missing, length,
                            shuffle=True, carry=("salt",))
        return rows.withColumn("salt", F.coalesce("salt", F.lit(0))), None
    if request_join == "broadcast":
        # the filter, true of every request, marks them as selective: of a table stored by
        # image only the wanted images are read
        return salted(stored.join(broadcast_requests(weights, broadcast_limit), "img_id")), None
    return salted(_of_images(stored, weights, ids, request_join, broadcast_limit, filter_bits)), weights.where("weight > 0")


def mosaic(requests: DataFrame | None, tiles, grid: TileGrid, strategy: str = "grouped",
           method: str | None = None, output: str = "tiles", limit=BRIGHT_LIMIT,
           on_missing: str = "skip", length: int | None = None, block: int = 8,
           segment: int | None = None, dtype: str | None = None,
           partitions: int | None = None, salt: int = 1, check_unique: bool = False,
           request_join: str = "shuffle", broadcast_limit: int = 8 << 20, shape=None,
           filter_bits: int = FILTER_BITS) -> DataFrame:
    """Build every output tile of every requested image (``None``: of every image stored).

    Each output is the pixel-wise sum of the input tiles around it, pixels above
    ``limit`` counted as 0.  An image requested k times has k-fold sums.

    strategy
        ``naive``    look the input up for every (output, input) pair, then sum;
        ``grouped``  read each input once, bring it to the blocks of outputs that use it;
        ``partial``  read each input once, sum inside blocks of inputs, then across.
    tiles
        a tile table, or a reader (see :mod:`tileflow.sources.tiles`).
    method
        how to add: ``arrow`` (NumPy per block, the default except for naive), ``lanes``
        (the default for naive) or ``long``.
    on_missing
        ``skip`` inputs the table lacks (``missing_tiles`` lists them), count them as
        ``zero`` (needs ``length``), or ``error``.
    length, shape
        the most pixels a tile has (a longer one fails the query), needed for tiles of more
        than 32,768; or the sizes of the axes of every tile, such as ``(2000, 2000, 4)``,
        which also adds them as the column ``shape``.
    block, segment
        outputs per block edge (evened out over the grid), and the pixels per separately
        summed run (default: 32,768 for tiles declared longer, else whole tiles).  A task
        needs about ``2 * (block + 2 n_size)^2 * min(segment, tile) * 8`` bytes: 52 MB for
        ``segment=32768``.
    request_join
        how tiles of a table meet the requests: ``shuffle`` filters them at the scan by the
        wanted ids (see ``filter_bits``) and joins what passes where a block comes together,
        at any number of requests; ``broadcast`` sends the distinct requests to
        all tasks, so that only tiles of wanted images move and, of a table stored by image,
        only those are read; over ``broadcast_limit`` bytes, measured first, it is an error.
    filter_bits
        bits of the filter of wanted ids, ten for every image asked for; too few let more
        tiles through and change no result; 0: no filter.
    dtype
        NumPy type of the pixels of a table with ``binary`` tiles (``arrow`` only; sums
        come back as binary int64, or float64 for real pixels).
    partitions
        tasks among which expansions and a reader's calls are spread (default: the
        session's shuffle partitions).
    salt
        for a tile table that lists a tile very often (the pixels of every copy count): any salt
        above 1 first adds up the copies of each tile, combined before they move; with ``partial``
        in that many groups, which then share a block.  The copies of binary tiles all move
        (``partial`` only), a group's to one task.
    check_unique
        first run a job over the key columns that fails if a tile is listed twice.
    output
        ``tiles`` (img_id, z, x, y, pixels), ``segments`` (the same by ``seg``, which
        saves a shuffle when ``segment`` is set) or ``long`` (img_id, z, x, y, i, s).
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if output not in OUTPUTS:
        raise ValueError(f"output must be one of {OUTPUTS}")
    method = method or ("lanes" if strategy == "naive" else "arrow")
    if method not in BLOCK_METHODS or (strategy == "naive" and method == "arrow"):
        raise ValueError(f"method {method!r} does not exist for strategy {strategy!r}")
    if check_unique and not callable(tiles):
        assert_unique_tiles(tiles)
    if salt != 1 and (strategy == "naive" or (strategy == "grouped" and dtype)):
        raise ValueError("a salt is for the partial strategy, or for grouped sums of array pixels")
    if request_join not in REQUEST_JOINS:
        raise ValueError(f"request_join must be one of {REQUEST_JOINS}")
    if shape is not None:
        length = math.prod(shape)
    if segment is None and length is not None and length > RUN and strategy != "naive":
        segment = RUN
    if requests is None and (strategy == "naive" or callable(tiles) or on_missing != "skip"):
        raise ValueError("all stored images: grouped or partial, from a table, skipping missing tiles")
    weights = None if requests is None else request_weights(requests)

    if strategy == "naive":
        if segment is not None or output == "segments":
            raise ValueError("the naive strategy does not cut tiles in segments")
        at = ("source_img_id", "z", "sx", "sy")
        pairs = grid_neighbours(expand_requests(weights, grid, partitions), grid)
        if callable(tiles):
            pairs = pairs.repartition(partitions or spread(pairs), *at)
        else:
            tiles = _of_images(tiles_of_grid(tiles, grid), weights, requests, request_join, broadcast_limit, filter_bits)
        rows = attach_tiles(pairs, tiles, at, on_missing, length, shuffle=True)
        # without z, one value: results then are dealt by what a later join of mosaics needs
        built = sum_tiles(rows, ["img_id", "x", "y"], method=method, output=output, length=length,
                          element=lambda v: zero_above(v, limit) * F.col("weight"))
        built = built.withColumn("z", F.lit(grid.z).cast("bigint"))
        return _shaped(built.select(*TILE_KEY, *(c for c in built.columns if c not in TILE_KEY)), shape, output)

    block = even_block(grid, block)
    sources, joined = read_sources(weights, tiles, grid, on_missing, length, partitions, salt,
                                   request_join, broadcast_limit, filter_bits, requests)
    if strategy == "grouped":
        if salt != 1:
            keys = [*TILE_KEY, *(c for c in ("weight",) if c in sources.columns)]
            sources = sum_tiles(sources, keys, element=lambda v: zero_above(v, limit), length=length)
            limit = None
        segments = sum_neighbourhoods(sources, grid, method, block, segment, limit, dtype, length, joined)
    else:
        segments = sum_neighbourhoods_by_parts(sources, grid, method, block, segment, limit,
                                               dtype, length, joined, 1 if callable(tiles) else salt)
    if output == "segments":
        return segments
    if output == "long" and dtype is None:
        # the place of a pixel follows from its segment: no need to join them first
        rows = to_long(segments)
        at = F.col("seg").cast("bigint") * (segment or 0) + F.col("i")
        return rows.withColumn("i", at).select(*TILE_KEY, "i", "s")
    if output == "long":
        raise ValueError("binary tiles have no long form; use array pixels")
    if segment is not None:
        return _shaped(join_segments(segments, TILE_KEY), shape, output)
    return _shaped(segments.drop("seg").select(*TILE_KEY, "pixels"), shape, output)


def mosaic_rectangle(requests: DataFrame | None, tiles, grid: TileGrid, xs: tuple[int, int],
                     ys: tuple[int, int], **options) -> DataFrame:
    """The output tiles whose offsets lie in both bounds, inclusive; ``options`` go to :func:`mosaic`.

    Only input tiles in reach of them take part: of a table written along a curve, few pages are
    read.  ``tiles`` is a tile table.
    """
    reach = lambda bounds, step: (bounds[0] - grid.n_size * step, bounds[1] + grid.n_size * step)
    near = tiles.where(F.col("x").between(*reach(xs, grid.tile_w)) & F.col("y").between(*reach(ys, grid.tile_h)))
    return mosaic(requests, near, grid, **options).where(F.col("x").between(*xs) & F.col("y").between(*ys))


def _shaped(tiles: DataFrame, shape, output: str) -> DataFrame:
    """With the column ``shape``, if it was declared; a tile of another size fails the query."""
    if shape is None or output != "tiles":
        return tiles
    size = F.array_size("pixels") if tiles.schema["pixels"].dataType.typeName() == "array" else F.length("pixels") / 8
    wrong = F.raise_error(F.lit(f"a tile is not of shape {tuple(shape)}"))
    sizes = F.array(*[F.lit(int(n)) for n in shape])
    return tiles.withColumn("shape", F.when(size == math.prod(shape), sizes).otherwise(wrong))
