"""Raw tiles kept one per file, as a data source that plans its own reads.

Files lie as ``<path>/<img_id>/<x>_<y>.<any>``.  The driver lists the image folders only;
tasks list the files of their images and open those that the filters on ``img_id``, ``z``, ``x``
and ``y`` leave.  The store is opened through ``pyarrow.fs``.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)

SCHEMA = "img_id string, z bigint, x bigint, y bigint, pixels binary"
# Bytes of tiles handed to Spark at a time.
BATCH_BYTES = 8 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

_TESTS = {EqualTo: lambda v, w: v == w, In: lambda v, w: v in w, GreaterThan: lambda v, w: v > w,
          GreaterThanOrEqual: lambda v, w: v >= w, LessThan: lambda v, w: v < w, LessThanOrEqual: lambda v, w: v <= w}


def open_folder(path: str):
    """A file system and a path in it, for a path or URI that Spark knows."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub("^s3a:", "s3:", re.sub("^file:/(?!/)", "file:///", path)))


@dataclass
class _Images(InputPartition):
    """Image folders of one task, and its share of their files."""

    names: list
    share: int
    shares: int


class _TileReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.z = options["path"], int(options.get("z", -1))
        self.shares, self.images = int(options.get("shares", 1)), int(options.get("images_per_task", 1))
        self.filters = []

    def pushFilters(self, filters):
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in ("img_id", "z", "x", "y"):
                self.filters.append((f.attribute[0], _TESTS[type(f)], tuple(f.value) if isinstance(f, In) else f.value))
            else:
                yield f

    def _pass(self, **key):
        return all(test(key[name], value) for name, test, value in self.filters if name in key)

    def partitions(self):
        fs, root = open_folder(self.path)
        names = sorted(e.base_name for e in fs.get_file_info(pafs.FileSelector(root)) if e.type == pafs.FileType.Directory)
        names = [n for n in names if self._pass(img_id=n, z=self.z)]
        groups = [names[i:i + self.images] for i in range(0, len(names), self.images)]
        return [_Images(g, k, self.shares) for g in groups for k in range(self.shares)] or [_Images([], 0, 1)]

    def read(self, partition):
        fs, root = open_folder(self.path)
        rows, size = [], 0
        for name in partition.names:
            for entry in fs.get_file_info(pafs.FileSelector(f"{root}/{name}")):
                found = re.fullmatch(r"(\d+)_(\d+)\.[^./]+", entry.base_name)
                if not found or zlib.crc32(entry.base_name.encode()) % partition.shares != partition.share:
                    continue
                x, y = int(found[1]), int(found[2])
                if not self._pass(x=x, y=y):
                    continue
                with fs.open_input_file(entry.path) as file:
                    rows.append((name, self.z, x, y, file.read()))
                size += len(rows[-1][-1])
                if size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows) -> pa.RecordBatch:
    img, z, x, y, pixels = zip(*rows)
    return pa.record_batch({"img_id": pa.array(img, pa.string()), "z": pa.array(z, pa.int64()), "x": pa.array(x, pa.int64()),
                            "y": pa.array(y, pa.int64()), "pixels": pa.array(pixels, pa.binary())})


class TileFiles(DataSource):
    """Options: ``path``, ``z`` of the tiles, ``images_per_task``, and ``shares``, the tasks that
    share the files of an image."""

    @classmethod
    def name(cls):
        return "tilefiles"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _TileReader(self.options)


def read_tile_source(spark: SparkSession, path: str, z: int = -1, images_per_task: int = 1, shares: int = 1) -> DataFrame:
    """The tiles below ``path`` (img_id, z, x, y, pixels as bytes), of which only those that
    filters on the key leave are opened.

    Switches the session's filter pushdown to Python sources on.
    """
    spark.dataSource.register(TileFiles)
    spark.conf.set(PUSHDOWN, "true")
    return (spark.read.format("tilefiles").option("path", path).option("z", str(z))
            .option("images_per_task", str(images_per_task)).option("shares", str(shares)).load())


def write_tile_files(tiles: DataFrame, path: str, suffix: str = "raw") -> int:
    """Writes every tile (``img_id, x, y`` and ``pixels`` as bytes) to a file of its own; returns
    how many.  A task that runs twice writes the same files."""
    def write(batches):
        fs, root = open_folder(path)
        for batch in batches:
            for row in batch.to_pylist():
                fs.create_dir(f"{root}/{row['img_id']}", recursive=True)
                with fs.open_output_stream(f"{root}/{row['img_id']}/{row['x']}_{row['y']}.{suffix}", compression=None) as file:
                    file.write(row["pixels"])
            yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})

    return tiles.select("img_id", "x", "y", "pixels").mapInArrow(write, "n bigint").agg(F.sum("n")).first()[0] or 0
