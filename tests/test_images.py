import numpy as np
import pytest
from pyspark.sql import functions as F

from tileflow import fragment_pipeline, image_table, request_mosaic, with_tile_stats
from tileflow.operators import to_long
from tileflow.sources import key_table, request_list, synthetic_reader, tile_key, tiles_from_vectors


def test_keys(spark):
    keys = key_table(spark.range(0, 101, 1, 20))
    assert keys.columns == ["img_id", "z", "x", "y", "type"]
    rows = keys.collect()
    assert len(rows) == 101 and all(r.x == r.y and r.img_id == "" and r.z == 0 and r.type == "in" for r in rows)


def test_tile_key_types(spark):
    key = spark.range(1).select(tile_key(F.lit("a"), F.lit(-1), F.lit(2), F.lit(3), F.lit("out")).alias("k"))
    assert key.schema["k"].dataType.simpleString() == (
        "struct<img_id:string,z:bigint,x:bigint,y:bigint,type:string>")


def test_image_table_and_stats(spark):
    images = with_tile_stats(image_table(key_table(spark.range(20)), synthetic_reader(12), 3, 4))
    assert images.columns[-3:] == ["Image", "MeanPoint", "BrightestPoint"]
    for r in images.collect():
        im = np.array(r.Image)
        want = [[(r.x * 7919 + r.y * 104729 + (4 * i + j) * 1299709) % 255 - 127 for j in range(4)]
                for i in range(3)]
        assert im.tolist() == want
        assert r.MeanPoint == pytest.approx(im.mean(), abs=1e-12)
        assert tuple(r.BrightestPoint) == tuple(int(v) for v in np.unravel_index(im.argmax(), im.shape))


def test_native_stats_equal_a_udf_twin(spark):
    images = image_table(key_table(spark.range(50)), synthetic_reader(64), 8)
    mean = F.udf(lambda im: float(np.mean(im)), "double")
    both = with_tile_stats(images).withColumn("twin", mean("Image"))
    assert all(r.MeanPoint == pytest.approx(r.twin, abs=1e-12) for r in both.collect())


def test_far_coordinates_do_not_overflow(spark):
    ids = spark.createDataFrame([("a", -1, 60000, 60000)], "img_id string, z bigint, x bigint, y bigint")
    row = ids.select(synthetic_reader(2)(F.col("img_id"), F.col("z"), F.col("x"), F.col("y"))).first()
    assert row[0] == [(60000 * (7919 + 104729) + i * 1299709) % 255 - 127 for i in range(2)]


def test_vectors_as_tiles(spark):
    df = spark.createDataFrame([(123, [0.5, -0.019, 0.999])], "n bigint, v array<float>")
    row = tiles_from_vectors(df, "n", "v").first()
    assert (row.img_id, row.z, row.x, row.y) == ("1", -1, 2, 3)
    assert row.pixels == [63, -2, 126]


def test_fragment_sums(spark):
    tiles = fragment_pipeline(request_list(spark, ["empty"]))
    assert tiles.count() == 12002
    assert {tuple(r.pixels) for r in tiles.select("pixels").distinct().collect()} == {(4,) * 10}
    assert [tuple(r) for r in request_mosaic(tiles).collect()] == [("empty", [48008] * 10)]


def test_fragment_requests_repeat_and_fragments_truncate(spark):
    size = F.when(F.col("sx") == -1, 2).otherwise(3).cast("int")
    fragment = F.transform(F.sequence(F.lit(1), size), lambda i: i.cast("bigint") + F.col("y"))
    tiles = fragment_pipeline(request_list(spark, ["a", "a", "b"]), 1, 2, fragment)
    got = {(r.request, r.x, r.y): r.pixels for r in tiles.collect()}
    for (req, x, y), pixels in got.items():
        times = 2 if req == "a" else 1
        assert pixels == [4 * times * (i + y) for i in range(1, 3 if x == 0 else 4)]
    assert len(got) == 12
    with pytest.raises(Exception, match="differ in length"):
        fragment_pipeline(request_list(spark, ["a"]), 1, 2, fragment, truncate=False).collect()
    shortest = request_mosaic(tiles.where("request = 'b'")).first().pixels
    assert len(shortest) == 2


def test_to_long(spark):
    df = spark.createDataFrame([("a", [5, 6]), ("b", [])], "k string, pixels array<int>")
    assert [tuple(r) for r in to_long(df).collect()] == [("a", 0, 5), ("a", 1, 6)]
