"""Requests decide what is read: the filter of wanted images at the tile scan."""

import pytest
from pyspark.sql import functions as F

from tests.plans import metrics
from tileflow import TileGrid, mosaic
from tileflow.operators import wanted_filter
from tileflow.sources import TILE_KEY, read_tiles, request_list

GRID = TileGrid(10, 10, 1, 1)
IMAGES = 400


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """400 images of 100 tiles, stored by image and as plain files."""
    root = tmp_path_factory.mktemp("tiles")
    tiles = spark.range(IMAGES * 100).select(
        F.concat(F.lit("i"), F.floor(F.col("id") / 100)).alias("img_id"), F.lit(-1).cast("bigint").alias("z"),
        F.floor(F.col("id") % 100 / 10).alias("x"), (F.col("id") % 10).alias("y"),
        F.array(*[F.hash("id", F.lit(k)) % 100 for k in range(4)]).alias("pixels"))
    tiles.write.parquet(f"{root}/flat")
    tiles.repartition(4, "img_id").write.partitionBy("img_id").parquet(f"{root}/by_image")
    return str(root)


def tile_scans(df):
    return [m for m in metrics(df) if m["name"].startswith("Scan parquet") and "pixels" in m["text"]]


@pytest.mark.parametrize("strategy, method", [("naive", "lanes"), ("grouped", "arrow"), ("grouped", "lanes"),
                                              ("partial", "arrow")])
def test_one_of_400_images(spark, stored, strategy, method):
    tiles = read_tiles(spark, f"{stored}/by_image")
    built = mosaic(request_list(spark, ["i17"]), tiles, GRID, strategy, method)
    (scan,) = tile_scans(built)
    assert scan["numFiles"] == 1 and scan["numOutputRows"] == 100
    want = mosaic(None, tiles.where("img_id = 'i17'"), GRID).collect()
    assert sorted(built.collect()) == sorted(want) and len(want) == 100


def test_only_wanted_tiles_are_shuffled(spark, stored):
    built = mosaic(request_list(spark, ["i17"]), read_tiles(spark, f"{stored}/flat"), GRID)
    (scan,) = tile_scans(built)
    moved = [m["shuffleRecordsWritten"] for m in metrics(built) if "shuffleRecordsWritten" in m and "pixels" in m["text"]]
    # 81 of its 100 tiles are inputs, some of two or four blocks
    assert moved and all(81 <= n <= 150 for n in moved)


@pytest.mark.parametrize("bits", [64, 1 << 10, 1 << 20])
def test_no_wanted_image_is_lost(spark, stored, bits):
    ids = spark.createDataFrame([(f"i{k}",) for k in range(0, IMAGES, 3)] + [(None,), ("none",)], "img_id string")
    tiles = spark.read.parquet(f"{stored}/by_image").select("img_id").distinct()
    passed = {r.img_id for r in tiles.where(wanted_filter(ids, bits=bits)).collect()}
    assert passed >= {f"i{k}" for k in range(0, IMAGES, 3)}
    assert bits < 1 << 20 or len(passed) == len(range(0, IMAGES, 3))


def test_full_filter_changes_no_result(spark, stored):
    tiles, ids = read_tiles(spark, f"{stored}/flat"), request_list(spark, [f"i{k}" for k in range(60)])
    built = [sorted(mosaic(ids, tiles, GRID, filter_bits=bits).collect()) for bits in (64, 1 << 20, 0)]
    assert built[0] == built[1] == built[2] and len(built[0]) == 6000


def test_nothing_is_wanted(spark, stored):
    empty = spark.createDataFrame([], "img_id string")
    assert mosaic(empty, read_tiles(spark, f"{stored}/flat"), GRID).isEmpty()
    with pytest.raises(ValueError):
        wanted_filter(empty, bits=100)


def test_left_joins_read_wanted_images_only(spark, stored):
    tiles = read_tiles(spark, f"{stored}/by_image")
    built = mosaic(request_list(spark, ["i3", "absent"]), tiles, GRID, on_missing="zero", length=4)
    (scan,) = tile_scans(built)
    assert scan["numFiles"] == 1 and built.where("img_id = 'absent'").count() == 100
