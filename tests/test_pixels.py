import numpy as np
import pytest
from pyspark.sql import functions as F

from tileflow.functions import (brightest_point, named_udf, quantise, reshape_tile, threshold,
                                tile_mean, tile_shape)
from tileflow.plans.fragments import constant_fragment, constant_full_tile


def one(spark, column, value, kind):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


@pytest.mark.parametrize("kind", ["int", "smallint", "tinyint", "bigint"])
def test_threshold_boundary(spark, kind):
    px = [-127, -1, 0, 19, 20, 21, 126]
    assert one(spark, threshold("v"), px, f"array<{kind}>") == [-127, -1, 0, 19, 20, 0, 0]


def test_threshold_other_limit(spark):
    assert one(spark, threshold("v", 0), [-1, 0, 1], "array<int>") == [-1, 0, 0]


def test_brightest_tie_and_mean(spark):
    image = [[1, 9, 3], [9, 2, 4]]
    assert tuple(one(spark, brightest_point(F.col("v")), image, "array<array<int>>")) == (0, 1)
    assert one(spark, tile_mean(F.col("v")), image, "array<array<int>>") == 28 / 6
    assert one(spark, tile_shape(F.col("v")), image, "array<array<int>>") == [2, 3]


def test_stats_match_numpy(spark):
    rng = np.random.default_rng(5)
    images = [rng.integers(-127, 127, (h, w)) for h, w in [(1, 1), (3, 7), (8, 8), (7, 2)]]
    df = spark.createDataFrame([(i, im.tolist()) for i, im in enumerate(images)],
                               "n int, v array<array<int>>")
    rows = df.select("n", tile_mean(F.col("v")).alias("m"),
                     brightest_point(F.col("v")).alias("b")).collect()
    for r in rows:
        im = images[r.n]
        assert r.m == pytest.approx(im.mean(), abs=1e-12)
        assert tuple(r.b) == tuple(int(v) for v in np.unravel_index(im.argmax(), im.shape))


def test_empty_image_has_no_mean(spark):
    assert one(spark, tile_mean(F.col("v")), [], "array<array<int>>") is None


def test_reshape(spark):
    flat = list(range(6))
    assert one(spark, reshape_tile(F.col("v"), 2, 3), flat, "array<int>") == [[0, 1, 2], [3, 4, 5]]


def test_quantise_truncates_toward_zero(spark):
    assert one(spark, quantise("v", "tinyint"), [1.9, -1.9, -0.5, 126.99], "array<double>") == [1, -1, 0, 126]


def test_constant_tiles(spark):
    row = spark.range(1).select(constant_fragment(), constant_full_tile()).first()
    assert row[0] == [1] * 10 and row[1] == [-1] * 10


@pytest.mark.parametrize("vectorized", [False, True])
def test_named_udf(spark, vectorized):
    scale = named_udf("Scale Value", lambda v, by: v * by, "double", vectorized, by=3.0)
    out = spark.createDataFrame([(2.0,)], "v double").select(scale("v"))
    assert "Scale Value" in out._jdf.queryExecution().toString()
    assert out.first()[0] == 6.0


def test_named_udf_bound_argument_wins(spark):
    pick = named_udf("pick", lambda v, other=0: other, "int", other=7)
    assert spark.createDataFrame([(1, 2)], "v int, o int").select(pick("v", other=F.col("o"))).first()[0] == 7
