"""Images on disk: compressed Parquet, one directory per image."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.curve import morton
from ..grid import TileGrid

LAYOUTS = ("per_image", "blocks", "curve")
# Tiles of one file of the per-image layout, unless the caller names another number.
TILES_PER_FILE = 1024
# Tiles of one page of the curve layout: what a read of a rectangle can skip.
TILES_PER_PAGE = 64


def write_images(tiles: DataFrame, path: str, layout: str = "per_image",
                 grid: TileGrid | None = None, codec: str = "zstd",
                 tiles_per_file: int = TILES_PER_FILE, mode: str = "errorifexists",
                 write_id: str | None = None) -> int:
    """Write summed tiles (img_id, z, x, y, [seg,] pixels); returns how many were written.

    ``per_image`` writes a folder per image with numbered parts, each one file of the
    tiles, sorted by place, of ``tiles_per_file`` consecutive places of the grid: choose
    the number by the weight of a tile, since a task writes whole parts.  ``blocks`` writes
    what every task has, at once and without a shuffle.  ``curve`` deals the tiles of every
    image by ranges of a space-filling curve and sorts them along it, in short pages, so that
    a rectangle of an image is in few of them (:func:`read_rectangle`).

    ``write_id`` puts all files of this write in a folder of their own, ``write_id=...``, above
    the images.  Give one to every write of a table that is appended to: its manifest then
    reads that folder, however many files older writes have left.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    out, folders = tiles, ["img_id"]
    order = ["img_id", "x", "y"] + (["seg"] if "seg" in tiles.columns else [])
    if layout == "per_image":
        if grid is None:
            raise ValueError("the per_image layout needs the grid")
        place = F.floor(F.col("x") / grid.tile_w) * grid.rows + F.floor(F.col("y") / grid.tile_h)
        folders = ["img_id", "part"]
        out = out.withColumn("part", F.floor(place / tiles_per_file).cast("int")).repartition(*folders)
    if layout == "curve":
        if grid is None:
            raise ValueError("the curve layout needs the grid")
        out = out.withColumn("place", morton(F.floor(F.col("x") / grid.tile_w), F.floor(F.col("y") / grid.tile_h)))
        out, order = out.repartitionByRange("img_id", "place"), ["place", "seg"] if "seg" in tiles.columns else ["place"]
    # sorted by folder first: the writer then keeps one file open at a time
    order = [*folders, *(c for c in order if c not in folders)]
    if write_id is not None:
        out, folders = out.withColumn("write_id", F.lit(write_id)), ["write_id", *folders]
    written = Observation()
    pages = {"parquet.page.row.count.limit": TILES_PER_PAGE} if layout == "curve" else {}
    (out.sortWithinPartitions(*order).observe(written, F.count(F.lit(1)).alias("n_tiles"))
     .write.mode(mode).option("compression", codec).options(**pages).partitionBy(*folders).parquet(path))
    return written.get["n_tiles"]


def read_images(spark: SparkSession, path: str, pixel_type: str = "array<bigint>",
                segments: bool = False) -> DataFrame:
    """Read written images back.  A filter on ``img_id`` opens only those directories."""
    seg = "seg int, " if segments else ""
    schema = f"img_id string, z bigint, x bigint, y bigint, {seg}pixels {pixel_type}"
    columns = ["img_id", "z", "x", "y"] + (["seg"] if segments else []) + ["pixels"]
    return spark.read.schema(schema).parquet(path).select(*columns)


def read_rectangle(spark: SparkSession, path: str, img_id: str, xs: tuple[int, int], ys: tuple[int, int],
                   pixel_type: str = "array<bigint>") -> DataFrame:
    """The tiles of an image whose offsets lie in both bounds, inclusive.  Bounds reach the
    statistics of Parquet: pages without a place inside are not read, few of the ``curve`` layout."""
    inside = F.col("x").between(*xs) & F.col("y").between(*ys)
    return read_images(spark, path, pixel_type).where((F.col("img_id") == img_id) & inside)


def image_files(spark: SparkSession, path: str) -> DataFrame | None:
    """The files written so far, ``path`` (None if there is nothing), kept as a table in a hidden
    folder below ``path``, since reading them later would find newer files too."""
    try:
        files = spark.read.schema("x bigint").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    kept = f"{path.rstrip('/')}/_files-{uuid.uuid4().hex}"
    files.select(F.col("_metadata.file_path").alias("path")).distinct().write.parquet(kept)
    return spark.read.schema("path string").parquet(kept)


def image_manifest(spark: SparkSession, path: str, without: DataFrame | None = None,
                   write_id: str | None = None) -> DataFrame:
    """One row per written file: img_id, part (null in blocks), n_tiles, path.

    Reads no pixels.  With ``write_id`` only the folder of that write is listed; otherwise all
    files are, and those in ``without`` left out.
    """
    if write_id is not None:
        path = f"{path.rstrip('/')}/write_id={write_id}"
    files = spark.read.schema("img_id string, x bigint").parquet(path)
    found = (files.groupBy("img_id", F.col("_metadata.file_path").alias("path"))
             .agg(F.count(F.lit(1)).alias("n_tiles")))
    if without is not None:
        found = found.join(without, "path", "left_anti")
    part = F.regexp_extract("path", "/part=([0-9]+)/", 1)
    return found.select("img_id", F.when(part != "", part.cast("int")).alias("part"), "n_tiles", "path")
