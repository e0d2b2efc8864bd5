"""From requests to written images."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..grid import TileGrid
from ..sinks.images import TILES_PER_FILE, image_files, image_manifest, write_images
from .mosaic import mosaic


def write_mosaic(requests: DataFrame | None, tiles, grid: TileGrid, path: str,
                 layout: str = "per_image", strategy: str = "grouped", codec: str = "zstd",
                 tiles_per_file: int = TILES_PER_FILE, mode: str = "errorifexists",
                 write_id: str | None = None, **options) -> DataFrame:
    """Build the requested images (``None``: all stored) with any strategy, write them,
    return the manifest of this write.

    ``layout`` is ``per_image`` (sorted parts of ``tiles_per_file`` places, a file each),
    ``blocks`` (each task writes the blocks it has built, with no further shuffle) or ``curve``
    (for reads of rectangles).  With a
    ``write_id`` the manifest comes from the folder of this write alone; an append without
    one lists the files before and after.  ``options`` go to :func:`mosaic`.
    """
    built = mosaic(requests, tiles, grid, strategy, **options)
    spark = built.sparkSession
    before = image_files(spark, path) if mode == "append" and write_id is None else None
    n_tiles = write_images(built, path, layout=layout, grid=grid, codec=codec, tiles_per_file=tiles_per_file,
                           mode=mode, write_id=write_id)
    if write_id is not None and not n_tiles:
        # nothing was built: there is no folder to read
        return spark.createDataFrame([], "img_id string, part int, n_tiles bigint, path string")
    return image_manifest(spark, path, without=before, write_id=write_id)
