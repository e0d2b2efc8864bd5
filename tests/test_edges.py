"""Edge values, equal for every strategy and method, and groups that a salt shares out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.plans import metrics
from tileflow import TileGrid, fragment_pairs, fragment_pipeline, mosaic
from tileflow.functions import named_udf, reshape_tile, tile_shape
from tileflow.operators import strategy_diff, sum_tiles
from tileflow.operators.halo import join_segments
from tileflow.plans.fragments import read_once
from tileflow.plans.mosaic import read_sources
from tileflow.sources import request_list, request_weights

WAYS = [("naive", "lanes"), ("naive", "long"), ("grouped", "arrow"), ("grouped", "lanes"),
        ("grouped", "long"), ("partial", "arrow"), ("partial", "lanes"), ("partial", "long")]
GRID = TileGrid(3, 3, 1, 1, clip="image")
JOINS = ["shuffle", "broadcast"]


def tiles(spark, rows, kind="double"):
    return spark.createDataFrame([(i, -1, x, y, p) for i, x, y, p in rows],
                                 f"img_id string, z bigint, x bigint, y bigint, pixels array<{kind}>")


def built(spark, table, strategy, method, **options):
    out = mosaic(request_list(spark, ["a"]), table, GRID, strategy, method, **options)
    return {(r.x, r.y): list(r.pixels) for r in out.collect()}


@pytest.mark.parametrize("join", JOINS)
@pytest.mark.parametrize("strategy, method", WAYS)
def test_nan_and_null_pixels(spark, strategy, method, join):
    table = tiles(spark, [("a", 1, 1, [1.0, math.nan, None, 25.0]), ("a", 0, 0, [2.0, 1.0, 3.0, 4.0]), (None, 1, 1, [9.0] * 4)])
    got = built(spark, table, strategy, method, request_join=join)
    assert got[2, 2][0] == 1.0 and math.isnan(got[2, 2][1]) and got[2, 2][2:] == [0.0, 0.0]
    assert got[0, 0][0] == 3.0 and math.isnan(got[0, 0][1]) and got[0, 0][2:] == [3.0, 4.0]


@pytest.mark.parametrize("method", ["arrow", "lanes", "long"])
def test_null_image_ids_belong_to_no_image(spark, method):
    table = tiles(spark, [("a", 1, 1, [1]), (None, 1, 1, [5])], "int")
    out = mosaic(None, table, GRID, method=method).collect()
    assert {r.img_id for r in out} == {"a"} and len(out) == 9


@pytest.mark.parametrize("strategy, method", WAYS)
def test_overflow_fails(spark, strategy, method):
    big = 1 << 62
    table = tiles(spark, [("a", x, 1, [big]) for x in range(3)], "bigint")
    with pytest.raises(Exception, match="(?i)overflow|exceed"):
        built(spark, table, strategy, method, limit=1 << 63 - 1)


@pytest.mark.parametrize("strategy, method", WAYS)
def test_longer_than_declared_fails(spark, strategy, method):
    table = tiles(spark, [("a", 1, 1, [1] * 9)], "int")
    assert len(built(spark, table, strategy, method, length=9)) == 9
    with pytest.raises(Exception, match="more than 8 pixels"):
        built(spark, table, strategy, method, length=8)


def test_long_tiles_are_cut_by_default(spark):
    table = tiles(spark, [("a", 1, 1, list(range(20)) * 4000)], "int")
    with pytest.raises(Exception, match="more than 32768 pixels"):
        built(spark, table, "grouped", "arrow")
    segments = mosaic(request_list(spark, ["a"]), table, GRID, length=80_000, output="segments")
    assert segments.select("seg").distinct().count() == 3
    whole = built(spark, table, "grouped", "arrow", length=80_000)
    assert len(whole) == 9 and whole[0, 0] == list(range(20)) * 4000
    short = mosaic(request_list(spark, ["a"]), table, GRID, length=100, output="segments")
    assert "seg" in short.columns  # declared short: one run, no joining shuffle


def test_runs_of_bytes_are_joined_in_order(spark):
    rows = [("a", -1, 0, 0, s, bytes([s % 256]) * 5) for s in range(300)]
    pieces = spark.createDataFrame(rows, "img_id string, z bigint, x bigint, y bigint, seg int, pixels binary").repartition(7)
    (only,) = join_segments(pieces, ["img_id", "z", "x", "y"]).collect()
    assert bytes(only.pixels) == b"".join(r[5] for r in rows)


@pytest.mark.parametrize("length, method", [(2, "lanes"), (20, "lanes"), (2, "long"), (20, "long")])
def test_one_rule_for_the_stated_length(spark, length, method):
    rows = spark.createDataFrame([("k", [1, 2]), ("k", [3, None])], "k string, pixels array<int>")
    assert sum_tiles(rows, ["k"], method=method, length=length).collect()[0].pixels == [4, 2]
    with pytest.raises(Exception, match="more than 1 pixels"):
        sum_tiles(rows, ["k"], method=method, length=1).collect()


def copies(spark, n=10_000):
    """One tile listed n times, beside a few others."""
    hot = spark.range(n).select(F.lit("a").alias("img_id"), F.lit(-1).cast("bigint").alias("z"), F.lit(1).cast("bigint").alias("x"),
                                F.lit(1).cast("bigint").alias("y"), F.array((F.col("id") % 30).cast("int"), F.lit(1)).alias("pixels"))
    return hot.union(tiles(spark, [("a", 0, 2, [5, 6]), ("b", 1, 1, [1, 1])], "int"))


@pytest.mark.parametrize("options", [dict(), dict(request_join="broadcast"), dict(on_missing="zero", length=2)])
@pytest.mark.parametrize("strategy, method, salt", [("partial", "arrow", 8), ("partial", "lanes", 8), ("grouped", "arrow", 2), ("grouped", "lanes", 2)])
def test_hot_tile(spark, strategy, method, salt, options):
    want = built(spark, copies(spark), "naive", "lanes")
    got = built(spark, copies(spark), strategy, method, salt=salt, **options)
    assert {k: v for k, v in got.items() if any(v)} == want


@pytest.mark.parametrize("options", [dict(), dict(request_join="broadcast"), dict(on_missing="error")])
def test_salt_is_dealt_before_copies_meet(spark, options):
    table = copies(spark).where("img_id = 'a'")
    if options.get("on_missing"):
        table = table.union(tiles(spark, [("a", x, y, [0, 0]) for x in range(3) for y in range(3)], "int"))
    rows, _ = read_sources(request_weights(request_list(spark, ["a"])), table, GRID, salt=8, **options)
    groups = rows.where("x = 1 and y = 1").groupBy("salt").count().collect()
    assert len(groups) == 8 and max(r["count"] for r in groups) < 1500


@pytest.mark.parametrize("method, options", [("arrow", dict()), ("arrow", dict(segment=1)), ("arrow", dict(length=2)), ("lanes", dict())])
def test_copies_are_added_up_before_they_move(spark, method, options):
    """What a block's task meets does not grow with the copies of a tile."""
    moved = []
    for n in (800, 4_000):
        out = mosaic(request_list(spark, ["a"]), copies(spark, n), GRID, "partial", method, salt=8, **options)
        moved.append(max(m.get("shuffleRecordsWritten", 0) for m in metrics(out)))
        assert moved[-1] < 800
    assert moved[0] == moved[1]


@pytest.mark.parametrize("method, options", [("arrow", dict()), ("arrow", dict(request_join="broadcast", limit=None)), ("arrow", dict(segment=2)), ("lanes", dict(length=5))])
def test_salt_keeps_the_sums_of_odd_tiles(spark, method, options):
    """Null and NaN pixels, null and listed-again tiles, an image asked for three times."""
    odd = [("a", 1, 1, [1.5, None, 25.0]), ("a", 1, 1, [math.nan, 2.0, -30.0]), ("a", 1, 1, None), ("a", 0, 2, [0.5, 0.25, 20.0]),
           ("a", 2, 2, None), ("b", 1, 1, [1.0, 1.0, 1.0]), (None, 1, 1, [9.0, 9.0, 9.0])]
    table = tiles(spark, odd * 5).repartition(3)
    reqs = request_list(spark, ["a", "c", "a", "a"])
    found = lambda df: sorted((r.img_id, r.x, r.y, [str(float(p)) for p in r.pixels]) for r in df.collect())
    limit = {k: options[k] for k in ("limit",) if k in options}
    want = found(mosaic(reqs, table, GRID, "naive", **limit))
    assert len(want) == 9
    assert found(mosaic(reqs, table, GRID, "partial", method, salt=4, **options)) == want


def test_salted_copies_that_differ_in_length_fail(spark):
    table = tiles(spark, [("a", 1, 1, [1] * 3), ("a", 1, 1, [1] * 2)], "int").repartition(1)
    with pytest.raises(Exception, match="differ in length"):
        built(spark, table, "partial", "arrow", salt=2)


def test_binary_copies_and_tiles_of_a_reader_take_a_salt(spark):
    rows = copies(spark, 100).where("img_id = 'a'").selectExpr("img_id", "z", "x", "y", "unhex(lpad(hex(pixels[0]), 2, '0')) as pixels")
    out = mosaic(request_list(spark, ["a"]), rows, GRID, "partial", dtype="int8", salt=8).collect()
    want = built(spark, copies(spark, 100), "naive", "lanes")
    assert {(r.x, r.y): np.frombuffer(r.pixels, "int64").tolist() for r in out} == {k: v[:1] for k, v in want.items()}
    reader = lambda img_id, z, x, y: F.array(x, y)
    assert built(spark, reader, "partial", "arrow", salt=8) == built(spark, reader, "naive", "lanes")


def test_salt_needs_a_strategy_that_takes_it(spark):
    with pytest.raises(ValueError):
        mosaic(request_list(spark, ["a"]), copies(spark), GRID, "naive", salt=2)
    with pytest.raises(ValueError):
        mosaic(request_list(spark, ["a"]), copies(spark), GRID, request_join="guess")


@pytest.mark.parametrize("left, right, n", [([1], [1, None], 1), ([1, None], [1], 1), ([1, None], [1, None], 0), ([1, 2, 3], [1, 5], 2), ([None], [2], 1)])
def test_difference_counts_the_tail(spark, left, right, n):
    frame = lambda p: tiles(spark, [("a", 0, 0, p)], "int")
    (row,) = strategy_diff(frame(left), frame(right)).collect()
    assert (row.side, row.n_diff) == ("both", n)
    assert strategy_diff(frame(left), frame(right), only_different=True).count() == (n > 0)


def test_bound_arguments_win(spark):
    rows = spark.createDataFrame([(3.0, 4.0)], "a double, b double")
    plain = named_udf("Blend", lambda a, b=1.0, c=1.0: a * b * c, "double", c=2.0)
    series = named_udf("Blend Series", lambda a, b=1.0, c=1.0: a * b * c, "double", vectorized=True, c=2.0)
    for call in (plain, series):
        assert rows.select(call("a", b=F.col("b"), c=F.col("b"))).first()[0] == 24.0
        assert rows.select(call("a")).first()[0] == 6.0


def test_shapes(spark):
    flat = spark.createDataFrame([(list(range(24)),)], "pixels array<int>")
    (row,) = flat.select(tile_shape(F.col("pixels"), width=4).alias("two"), tile_shape(F.col("pixels"), width=3, channels=4).alias("three"),
                         tile_shape(reshape_tile(F.col("pixels"), 2, 3, 4), channels=True).alias("nested"),
                         reshape_tile(F.col("pixels"), 2, 3, 4).alias("image")).collect()
    assert (row.two, row.three, row.nested) == ([6, 4], [2, 3, 4], [2, 3, 4])
    assert np.array(row.image).tolist() == np.arange(24).reshape(2, 3, 4).tolist()
    table = tiles(spark, [("a", 1, 1, list(range(12)))], "int")
    out = mosaic(request_list(spark, ["a"]), table, GRID, shape=(2, 3, 2))
    assert {tuple(r["shape"]) for r in out.collect()} == {(2, 3, 2)}
    with pytest.raises(Exception, match="not of shape"):
        mosaic(request_list(spark, ["a"]), table, GRID, shape=(4, 3, 2)).collect()


def test_fragments_of_tiles_read_every_source_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def read(x, y):
        reads.add(1)
        return [x, y, 1]

    call = F.udf(read, "array<bigint>")
    reader = lambda img_id, z, x, y: call(x, y)
    reqs = request_list(spark, ["empty"])
    got = {(r.x, r.y): list(r.pixels) for r in fragment_pipeline(reqs, 1, 600, tiles=reader, truncate=False).collect()}
    assert reads.value == 3 * 602 and len(got) == 2 * 601
    assert got[1, 5] == [0 + 0 + 1 + 1, 4 + 5 + 4 + 5, 4]
    assert read_once(fragment_pairs(reqs, 1, 2), reader).count() == 24


def test_large_pixels_of_many_batches_stay_within_bounds(spark):
    """The bound of a sum holds place by place: tiles that are not added together do not add up."""
    grid = TileGrid(16, 16, 1, 1)
    rows = [("a", -1, x, y, [2**55, -(2**55)]) for x in range(1, 17) for y in range(1, 17)]
    tiles = spark.createDataFrame(rows, "img_id string, z bigint, x bigint, y bigint, pixels array<bigint>")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        built = {m: sorted(mosaic(None, tiles, grid, method=m, limit=None, block=16).collect()) for m in ("arrow", "lanes")}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert built["arrow"] == built["lanes"] and built["arrow"][100].pixels == [9 * 2**55, -9 * 2**55]
