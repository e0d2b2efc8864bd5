import numpy as np
import pytest
from pyspark.sql import functions as F

from tileflow.functions import zero_above
from tileflow.operators import group_tiles, strategy_diff, sum_tiles, to_long
from tileflow.operators.group import tile_part


def rows(df):
    return {r[0]: r[1] for r in df.collect()}


@pytest.mark.parametrize("method", ["lanes", "long"])
@pytest.mark.parametrize("length", [1, 15, 16, 17, 64, 100])
def test_sum_matches_numpy(spark, method, length):
    rng = np.random.default_rng(length)
    data = [(int(k), rng.integers(-127, 127, length).tolist()) for k in rng.integers(0, 4, 30)]
    df = spark.createDataFrame(data, "k int, pixels array<int>")
    want = {}
    for k, px in data:
        want[k] = want.get(k, 0) + np.where(np.array(px) > 20, 0, px)
    got = sum_tiles(df, ["k"], method=method, element=zero_above)
    assert rows(got) == {k: v.tolist() for k, v in want.items()}
    assert got.schema["pixels"].dataType.simpleString() == "array<bigint>"
    flat = sum_tiles(df, ["k"], method=method, element=zero_above, output="long")
    assert sorted(map(tuple, flat.collect())) == sorted(map(tuple, to_long(got).collect()))


@pytest.mark.parametrize("method", ["lanes", "long"])
@pytest.mark.parametrize("output", ["tiles", "long"])
def test_unequal_lengths_fail(spark, method, output):
    df = spark.createDataFrame([(1, [1] * 20), (1, [1] * 19)], "k int, pixels array<int>")
    with pytest.raises(Exception, match="differ in length"):
        sum_tiles(df, ["k"], method=method, output=output).collect()


@pytest.mark.parametrize("method", ["lanes", "long"])
@pytest.mark.parametrize("a, b", [(20, 19), (40, 3), (16, 32), (5, 0)])
def test_truncate_to_shortest(spark, method, a, b):
    df = spark.createDataFrame([(1, list(range(a))), (1, [1] * b)], "k int, pixels array<int>")
    want = [i + 1 for i in range(min(a, b))]
    assert rows(sum_tiles(df, ["k"], method=method, truncate=True)) == {1: want}
    flat = sum_tiles(df, ["k"], method=method, truncate=True, output="long").orderBy("i")
    assert [r.s for r in flat.collect()] == want


@pytest.mark.parametrize("method", ["lanes", "long"])
def test_null_tile_adds_nothing_and_empty_tiles_stay(spark, method):
    df = spark.createDataFrame([(1, [1, 2]), (1, None), (2, []), (3, None)], "k int, pixels array<int>")
    assert rows(sum_tiles(df, ["k"], method=method)) == {1: [1, 2], 2: []}


@pytest.mark.parametrize("length", [3, 10, 16])
@pytest.mark.parametrize("output", ["tiles", "long"])
def test_known_length_saves_a_shuffle(spark, length, output):
    data = [(1, [1, 30, -5]), (1, [4, 5, 6]), (2, []), (3, None)]
    df = spark.createDataFrame(data, "k int, pixels array<int>")
    short = sum_tiles(df, ["k"], element=zero_above, length=length, output=output)
    assert short._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(map(tuple, short.collect())) == sorted(
        map(tuple, sum_tiles(df, ["k"], element=zero_above, output=output).collect()))
    with pytest.raises(Exception, match="more than 2 pixels"):
        sum_tiles(df, ["k"], length=2).collect()
    unequal = df.union(spark.createDataFrame([(1, [7])], df.schema))
    assert rows(sum_tiles(unequal, ["k"], truncate=True, length=length))[1] == [12]
    with pytest.raises(Exception, match="differ in length"):
        sum_tiles(unequal, ["k"], length=length).collect()


def test_real_pixels(spark):
    df = spark.createDataFrame([(1, [0.5, 1.0]), (1, [0.25, 2.0])], "k int, pixels array<double>")
    assert rows(sum_tiles(df, ["k"])) == {1: [0.75, 3.0]}


def test_large_sums_do_not_wrap(spark):
    df = spark.createDataFrame([(1, [2**31 - 1])] * 3, "k int, pixels array<int>")
    assert rows(sum_tiles(df, ["k"])) == {1: [3 * (2**31 - 1)]}


def test_sum_combines_before_the_shuffle(spark):
    df = spark.range(8).select((F.col("id") % 2).alias("k"), F.array(F.lit(1)).alias("pixels"))
    for method in ("lanes", "long"):
        text = sum_tiles(df, ["k"], method=method)._jdf.queryExecution().executedPlan().toString()
        assert "partial_sum" in text and "Python" not in text


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        sum_tiles(spark.range(1), ["id"], method="fast")


def test_diff(spark):
    key = "img_id string, z bigint, x bigint, y bigint, pixels array<bigint>"
    a = spark.createDataFrame([("a", -1, 0, 0, [1, 2]), ("a", -1, 0, 1, [3, 4]), ("a", -1, 1, 0, [0])], key)
    b = spark.createDataFrame([("a", -1, 0, 0, [1, 2]), ("a", -1, 0, 1, [3, 5]), ("b", -1, 0, 0, [7, 7])], key)
    got = sorted(tuple(r) for r in strategy_diff(a, b).drop("z").collect())
    assert got == [("a", 0, 0, "both", 0), ("a", 0, 1, "both", 1), ("a", 1, 0, "left", 1),
                   ("b", 0, 0, "right", 2)]
    assert strategy_diff(a, b, only_different=True).count() == 3
    # a tile cut short differs in the pixels it lacks
    c = spark.createDataFrame([("a", -1, 0, 0, [1])], key)
    assert strategy_diff(a.where("x = 0 and y = 0"), c).first().n_diff == 1


def test_group_tiles_in_bounded_sorted_lists(spark):
    df = spark.range(50).select(F.lit("a").alias("img_id"), (F.col("id") % 5).alias("x"),
                                F.floor(F.col("id") / 5).alias("y"), F.array("id").alias("pixels"))
    groups = group_tiles(df, "img_id", tile_part(F.col("x"), F.col("y"), 10, 16))
    found = groups.orderBy("part").collect()
    assert [g.n_tiles for g in found] == [16, 16, 16, 2]
    order = [(t.x, t.y) for g in found for t in g.tiles]
    assert order == [(x, y) for x in range(5) for y in range(10)]
