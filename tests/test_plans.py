"""What the plans must look like: reads, shuffles, filters, broadcasts."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tileflow import TileGrid, image_table, mosaic, with_tile_stats
from tileflow.operators import source_ids, strategy_diff
from tileflow.sources import (TILE_KEY, key_table, read_tiles, request_list, request_weights,
                              synthetic_reader)

GRID = TileGrid(600, 600, 60, 60)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pixel_shuffles(text):
    """Shuffles of rows that come from the tile scan."""
    tile_img = re.search(r"FileScan parquet \[.*?img_id#(\d+)", text).group(1)
    return len(re.findall(rf"Exchange \w+\([^)]*img_id#{tile_img}\b", text))


def counting_reader(spark, length, deterministic):
    """A reader in Python that counts its calls."""
    reads = spark.sparkContext.accumulator(0)

    def read(img_id, x, y):
        reads.add(1)
        return [(x + y + i) % 50 for i in range(length)]

    call = F.udf(read, "array<int>")
    if not deterministic:
        call = call.asNondeterministic()
    return reads, lambda img_id, z, x, y: call(img_id, x, y)


@pytest.mark.parametrize("deterministic", [True, False])
@pytest.mark.parametrize("strategy, method, per_image", [
    ("naive", "lanes", 729), ("naive", "long", 729), ("grouped", "arrow", 100),
    ("grouped", "lanes", 100), ("grouped", "long", 100), ("partial", "arrow", 100),
    ("partial", "lanes", 100)])
@pytest.mark.parametrize("output", ["tiles", "long"])
def test_reads(spark, strategy, method, per_image, output, deterministic):
    reads, reader = counting_reader(spark, 20, deterministic)
    built = mosaic(request_list(spark, ["test1", "test2"]), reader, GRID, strategy, method, output=output)
    assert len(built.collect()) == (200 if output == "tiles" else 4000)
    assert reads.value == 2 * per_image


def test_segments_read_once(spark):
    reads, reader = counting_reader(spark, 20, True)
    mosaic(request_list(spark, ["a"]), reader, GRID, segment=6).collect()
    assert reads.value == 100


def test_reading_is_spread_over_tasks(spark):
    tasks = F.udf(lambda x: [__import__("pyspark").TaskContext.get().partitionId()], "array<int>")
    reader = lambda img_id, z, x, y: tasks(x)
    from tileflow.plans.mosaic import read_sources
    rows, _ = read_sources(request_weights(request_list(spark, ["a"])), reader, GRID)
    assert rows.select(F.explode("pixels")).distinct().count() == 4


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tiles") / "tiles")
    ids = source_ids(request_weights(request_list(spark, [f"i{n}" for n in range(30)])), GRID)
    noise = F.transform(F.sequence(F.lit(1), F.lit(36)), lambda i: F.hash(*TILE_KEY, i) % 127)
    ids.select(*TILE_KEY, noise.alias("pixels")).write.partitionBy("img_id").parquet(path)
    return path


@contextmanager
def settings(spark, values):
    old = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("method", ["arrow", "lanes", "long"])
def test_grouped_moves_pixels_once(spark, stored, method):
    text = plan(mosaic(request_list(spark, ["i1", "i2"]), read_tiles(spark, stored), GRID, method=method,
                       request_join="broadcast"))
    # the few requests filter the tiles before they move
    assert "Inner, BuildRight" in text
    assert pixel_shuffles(text) == 1
    assert "PushedFilters: [" in text and "EqualTo(z,-1)" in text and "GreaterThanOrEqual(x,60)" in text


def test_all_images_need_no_join(spark, stored):
    text = plan(mosaic(None, read_tiles(spark, stored), GRID))
    assert "Join" not in text and pixel_shuffles(text) == 1


@pytest.mark.parametrize("strategy", ["grouped", "partial"])
@pytest.mark.parametrize("method", ["arrow", "lanes"])
def test_many_requests_are_joined_by_block(spark, stored, strategy, method):
    """By default nothing is broadcast, and the tiles meet the requests where blocks come together."""
    reqs, tiles = request_list(spark, ["i1", "i2", "i2"]), read_tiles(spark, stored)
    few = mosaic(reqs, tiles, GRID, strategy, method, block=4, request_join="broadcast").collect()
    many = mosaic(reqs, tiles, GRID, strategy, method, block=4)
    text = plan(many)
    # (the last sum of the partial lanes shuffles its runs and then its tiles)
    expected = 3 if (strategy, method) == ("partial", "lanes") else 1
    assert "SortMergeJoin" in text and "BroadcastHash" not in text
    assert pixel_shuffles(text) == expected
    # adaptive execution may turn the join into a broadcast of what it has measured: the
    # blocks must stay whole
    with settings(spark, {"spark.sql.adaptive.autoBroadcastJoinThreshold": "100m"}):
        assert sorted(many.collect()) == sorted(few)


def test_too_many_requests_for_a_broadcast(spark, stored):
    reqs, tiles = request_list(spark, ["i1", "i2"]), read_tiles(spark, stored)
    with pytest.raises(ValueError, match="request_join"):
        mosaic(reqs, tiles, GRID, request_join="broadcast", broadcast_limit=10)


@pytest.mark.parametrize("options", [dict(on_missing="zero", length=36), dict(on_missing="error"), dict(strategy="naive")])
def test_left_joins_are_pruned_and_never_broadcast(spark, stored, options):
    reqs, tiles = request_list(spark, ["i1"]), read_tiles(spark, stored)
    text = plan(mosaic(reqs, tiles, GRID, **options))
    assert "BroadcastHash" not in text and "GreaterThanOrEqual(x,60)" in text and "EqualTo(z,-1)" in text
    text = plan(mosaic(reqs, tiles, GRID, request_join="broadcast", **options))
    assert "dynamicpruning" in text and text.count("BroadcastHashJoin") == 1  # of the requests alone


def test_naive_never_broadcasts_pairs(spark, stored):
    text = plan(mosaic(request_list(spark, ["i1"]), read_tiles(spark, stored), GRID, "naive"))
    assert "SortMergeJoin" in text and "BroadcastHash" not in text


@pytest.mark.parametrize("strategy", ["grouped", "partial"])
def test_only_wanted_images_are_read(spark, stored, strategy):
    """A tile table stored by image: partitions are pruned by the requests at run time."""
    built = mosaic(request_list(spark, ["i1", "i2"]), read_tiles(spark, stored), GRID, strategy,
                   request_join="broadcast")
    assert "dynamicpruning" in plan(built)
    assert built.count() == 200


def test_partial_sums_before_the_last_shuffle(spark, stored):
    text = plan(mosaic(request_list(spark, ["i1"]), read_tiles(spark, stored), GRID, "partial", "lanes"))
    assert text.count("partial_sum") >= 2


def test_jvm_methods_use_no_python(spark, stored):
    for strategy in ("naive", "grouped", "partial"):
        text = plan(mosaic(request_list(spark, ["i1"]), read_tiles(spark, stored), GRID, strategy, "lanes"))
        assert "Python" not in text and "Arrow" not in text


def test_filter_runs_before_the_image(spark):
    keys = key_table(spark.range(0, 101, 1, 20))
    calls, reader = counting_reader(spark, 4, True)
    images = image_table(keys, reader, height=2)
    assert images.where("x > 99").count() == 1
    assert images.where("x = 27").count() == 1
    assert images.where("x > 88").where("y < 92").count() == 3
    assert calls.value == 0
    assert len(images.where("x > 99").collect()) == 1
    assert calls.value == 1


def test_key_only_query_skips_the_image(spark):
    images = with_tile_stats(image_table(key_table(spark.range(101)), synthetic_reader(4), 2))
    text = plan(images.where("x > 99").select("x"))
    assert "transform" not in text and "aggregate" not in text


def test_filter_reaches_the_tile_scan(spark, stored):
    keys = spark.range(0, 660, 60).select(F.lit("i1").alias("img_id"), F.lit(-1).cast("bigint").alias("z"),
                                          F.col("id").alias("x"), F.col("id").alias("y"))
    text = plan(image_table(keys, read_tiles(spark, stored), 6).where("x > 120"))
    assert "GreaterThan(x,120)" in text


def test_difference_of_mosaics_does_not_deal_the_naive_side_again(spark, stored):
    reqs, tiles = request_list(spark, ["i1"]), read_tiles(spark, stored)
    naive = plan(mosaic(reqs, tiles, GRID, "naive")).count("Exchange hashpartitioning")
    partial = plan(mosaic(reqs, tiles, GRID, "partial")).count("Exchange hashpartitioning")
    both = plan(strategy_diff(mosaic(reqs, tiles, GRID, "partial"), mosaic(reqs, tiles, GRID, "naive")))
    assert both.count("Exchange hashpartitioning") == naive + partial + 1
