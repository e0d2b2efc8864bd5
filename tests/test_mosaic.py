import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests import brute
from tileflow import TileGrid, mosaic
from tileflow.operators import (assert_unique_tiles, missing_tiles, source_ids, strategy_diff)
from tileflow.operators import block_sums
from tileflow.operators.halo import place_in_blocks
from tileflow.plans.mosaic import even_block
from tileflow.sources import (TILE_KEY, read_tile_files, request_list, request_weights,
                              synthetic_reader, synthetic_tiles)

TILES = "img_id string, z bigint, x bigint, y bigint, pixels array<int>"
WAYS = [("naive", "lanes"), ("naive", "long"), ("grouped", "arrow"), ("grouped", "lanes"),
        ("grouped", "long"), ("partial", "arrow"), ("partial", "lanes"), ("partial", "long")]


def table(spark, tiles, z=-1):
    return spark.createDataFrame([(i, z, x, y, list(map(int, v))) for (i, x, y), v in tiles.items()], TILES)


def collected(df):
    return {(r.img_id, r.x, r.y): list(r.pixels) for r in df.collect()}


def random_tiles(grid, images, length, seed=0, missing=0.0):
    rng = np.random.default_rng(seed)
    (x0, x1), (y0, y1) = grid.source_cols, grid.source_rows
    return {(i, x * grid.tile_w, y * grid.tile_h): rng.integers(-127, 127, length)
            for i in images for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)
            if rng.random() >= missing}


@pytest.mark.parametrize("strategy, method", WAYS)
@pytest.mark.parametrize("clip, n, block", [("origin", 1, 2), ("image", 1, 8), ("none", 2, 3)])
def test_every_way_matches_loops(spark, strategy, method, clip, n, block):
    grid = TileGrid(130, 80, 20, 20, n, clip=clip)
    tiles = random_tiles(grid, ["a", "b", "c"], 18, missing=0.2)
    built = mosaic(request_list(spark, ["a", "b", "a", "d"]), table(spark, tiles), grid,
                   strategy, method, block=block)
    assert built.columns == [*TILE_KEY, "pixels"]
    assert collected(built) == brute.mosaic(["a", "b", "a", "d"], tiles, grid)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cols=st.integers(1, 6), rows=st.integers(1, 6), n=st.integers(0, 2),
       images=st.lists(st.sampled_from("abc"), min_size=1, max_size=3), seed=st.integers(0, 99),
       block=st.integers(1, 4), way=st.sampled_from(WAYS))
def test_random_grids(spark, cols, rows, n, images, seed, block, way):
    grid = TileGrid(cols * 7, rows * 5, 7, 5, n)
    tiles = random_tiles(grid, sorted(set(images)), 5, seed, missing=0.1)
    if not tiles:
        return
    built = mosaic(request_list(spark, images), table(spark, tiles), grid, *way, block=block)
    assert collected(built) == brute.mosaic(images, tiles, grid)


def test_strategies_agree_on_keys_and_pixels(spark):
    grid = TileGrid(600, 600, 60, 60)
    reqs = request_list(spark, ["test1", "test2"])
    tiles = synthetic_tiles(source_ids(request_weights(reqs), grid), 36).select(*TILE_KEY, "pixels")
    naive = mosaic(reqs, tiles, grid, "naive")
    assert naive.count() == 200
    for strategy in ("grouped", "partial"):
        assert strategy_diff(mosaic(reqs, tiles, grid, strategy), naive, only_different=True).count() == 0


def test_target_without_input_vanishes(spark):
    grid = TileGrid(600, 600, 60, 60, n_size=0)
    reqs = request_list(spark, ["a"])
    for strategy in ("naive", "grouped", "partial"):
        assert mosaic(reqs, synthetic_reader(4), grid, strategy).count() == 81
    one_tile = TileGrid(60, 60, 60, 60, n_size=0)
    for strategy in ("naive", "grouped", "partial"):
        assert mosaic(reqs, synthetic_reader(4), one_tile, strategy).count() == 0


def test_repeated_request_doubles(spark):
    grid = TileGrid(6, 6, 2, 2)
    once = collected(mosaic(request_list(spark, ["a"]), synthetic_reader(3), grid))
    for strategy, method in WAYS:
        twice = collected(mosaic(request_list(spark, ["a", "a"]), synthetic_reader(3), grid, strategy, method))
        assert twice == {k: [2 * p for p in v] for k, v in once.items()}


@pytest.mark.parametrize("strategy, method", [w for w in WAYS if w[1] != "long"])
def test_long_output(spark, strategy, method):
    grid = TileGrid(6, 6, 2, 2)
    reqs = request_list(spark, ["a"])
    tiles = collected(mosaic(reqs, synthetic_reader(20), grid, strategy, method))
    flat = mosaic(reqs, synthetic_reader(20), grid, strategy, method, output="long")
    assert flat.columns == [*TILE_KEY, "i", "s"]
    assert {(r.img_id, r.x, r.y, r.i): r.s for r in flat.collect()} == {
        (*k, i): p for k, v in tiles.items() for i, p in enumerate(v)}


@pytest.mark.parametrize("strategy", ["grouped", "partial"])
@pytest.mark.parametrize("method", ["arrow", "lanes"])
@pytest.mark.parametrize("segment", [1, 7, 20])
def test_segments(spark, strategy, method, segment):
    grid = TileGrid(6, 8, 2, 2)
    tiles = random_tiles(grid, ["a"], 20)
    reqs, stored = request_list(spark, ["a"]), table(spark, tiles)
    want = brute.mosaic(["a"], tiles, grid)
    ways = dict(strategy=strategy, method=method, segment=segment, block=2)
    assert collected(mosaic(reqs, stored, grid, **ways)) == want
    pieces = mosaic(reqs, stored, grid, output="segments", **ways)
    assert pieces.count() == len(want) * -(-20 // segment)
    flat = mosaic(reqs, stored, grid, output="long", **ways)
    assert {(r.x, r.y, r.i): r.s for r in flat.collect()} == {
        (*k[1:], i): p for k, v in want.items() for i, p in enumerate(v)}


@pytest.mark.parametrize("strategy", ["grouped", "partial"])
@pytest.mark.parametrize("segment", [None, 6])
@pytest.mark.parametrize("dtype", ["int16", "int8", "float32"])
def test_binary_tiles_from_files(spark, tmp_path, strategy, segment, dtype):
    grid = TileGrid(6, 6, 2, 2)
    tiles = random_tiles(grid, ["img"], 16)
    (tmp_path / "img").mkdir()
    for (_, x, y), v in tiles.items():
        (tmp_path / "img" / f"{x}_{y}.raw").write_bytes(v.astype(dtype).tobytes())
    (tmp_path / "img" / "notes.txt").write_text("no tile")
    stored = read_tile_files(spark, str(tmp_path))
    built = mosaic(request_list(spark, ["img"]), stored, grid, strategy, dtype=dtype, segment=segment)
    wide = "float64" if dtype == "float32" else "int64"
    got = {(r.img_id, r.x, r.y): np.frombuffer(r.pixels, wide).tolist() for r in built.collect()}
    assert got == brute.mosaic(["img"], tiles, grid)


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "bigint", "double"])
@pytest.mark.parametrize("method", ["arrow", "lanes"])
def test_pixel_types(spark, kind, method):
    grid = TileGrid(6, 6, 2, 2)
    tiles = random_tiles(grid, ["a"], 5)
    stored = table(spark, tiles).withColumn("pixels", F.col("pixels").cast(f"array<{kind}>"))
    built = mosaic(request_list(spark, ["a"]), stored, grid, method=method)
    assert built.schema["pixels"].dataType.elementType.simpleString() == (
        "double" if kind == "double" else "bigint")
    assert collected(built) == brute.mosaic(["a"], tiles, grid)


def test_other_z_and_unaligned_tiles_are_not_read(spark):
    grid = TileGrid(6, 6, 2, 2)
    tiles = random_tiles(grid, ["a"], 3)
    extra = {("a", 3, 2): [9, 9, 9], ("a", 2, 5): [9, 9, 9], ("a", 0, 2): [9, 9, 9], ("a", 40, 2): [9, 9, 9]}
    stored = table(spark, tiles).union(table(spark, extra)).union(table(spark, tiles, z=4))
    for strategy in ("naive", "grouped", "partial"):
        assert collected(mosaic(request_list(spark, ["a"]), stored, grid, strategy)) == brute.mosaic(
            ["a"], tiles, grid)


@pytest.mark.parametrize("strategy, method", WAYS)
def test_missing_as_zero(spark, strategy, method):
    grid = TileGrid(6, 6, 2, 2)
    tiles = random_tiles(grid, ["a"], 4, missing=0.5)
    full = {k: tiles.get(k, np.zeros(4, int)) for k in random_tiles(grid, ["a"], 4)}
    built = mosaic(request_list(spark, ["a"]), table(spark, tiles), grid, strategy, method,
                   on_missing="zero", length=4)
    assert collected(built) == brute.mosaic(["a"], full, grid)


@pytest.mark.parametrize("strategy", ["naive", "grouped", "partial"])
def test_missing_as_error(spark, strategy):
    grid = TileGrid(6, 6, 2, 2)
    tiles = random_tiles(grid, ["a"], 4)
    reqs = request_list(spark, ["a"])
    build = lambda t: mosaic(reqs, table(spark, t), grid, strategy, on_missing="error")
    assert collected(build(tiles)) == brute.mosaic(["a"], tiles, grid)
    gone = tiles.popitem()[0]
    with pytest.raises(Exception, match=f"no tile a/-1/{gone[1]}/{gone[2]}"):
        build(tiles).collect()
    ids = source_ids(request_weights(reqs), grid).drop("weight")
    assert [tuple(r) for r in missing_tiles(ids, table(spark, tiles)).collect()] == [("a", -1, *gone[1:])]


def test_unequal_tiles_fail(spark):
    grid = TileGrid(4, 4, 2, 2)
    tiles = table(spark, {("a", 2, 2): [1, 2], ("a", 2, 4): [1]})
    for strategy, method in WAYS:
        with pytest.raises(Exception, match="differ in length"):
            mosaic(request_list(spark, ["a"]), tiles, grid, strategy, method).collect()


def test_null_tile_counts_as_missing(spark):
    grid = TileGrid(4, 4, 2, 2)
    tiles = spark.createDataFrame([("a", -1, 2, 2, [1, 30]), ("a", -1, 2, 4, None)], TILES)
    for strategy, method in WAYS:
        built = collected(mosaic(request_list(spark, ["a"]), tiles, grid, strategy, method))
        assert set(map(tuple, built.values())) == {(1, 0)} and len(built) == 4


def test_unique_check(spark):
    tiles = table(spark, {("a", 2, 2): [1]})
    assert_unique_tiles(tiles)
    with pytest.raises(ValueError, match="more than once"):
        assert_unique_tiles(tiles.union(tiles))
    with pytest.raises(ValueError, match="more than once"):
        mosaic(request_list(spark, ["a"]), tiles.union(tiles), TileGrid(4, 4, 2, 2), check_unique=True)


@pytest.mark.parametrize("method", ["arrow", "lanes"])
def test_copies_add_up_with_or_without_salt(spark, method):
    grid = TileGrid(8, 8, 2, 2)
    tiles = random_tiles(grid, ["a"], 5)
    once = table(spark, tiles)
    hot = once.where("x = 4 and y = 4")
    many = once.unionByName(hot.crossJoin(spark.range(0, 40, 1, 8)).drop("id"))
    reqs = request_list(spark, ["a"])
    want = collected(mosaic(reqs, many, grid, "naive"))
    assert want != collected(mosaic(reqs, once, grid))
    for ways in (dict(strategy="grouped"), dict(strategy="partial"), dict(strategy="partial", salt=5)):
        assert collected(mosaic(reqs, many, grid, method=method, block=2, **ways)) == want


@pytest.mark.parametrize("strategy", ["grouped", "partial"])
def test_all_stored_images(spark, strategy):
    grid = TileGrid(6, 6, 2, 2)
    tiles = random_tiles(grid, ["a", "b"], 5)
    assert collected(mosaic(None, table(spark, tiles), grid, strategy)) == brute.mosaic(["a", "b"], tiles, grid)
    with pytest.raises(ValueError):
        mosaic(None, synthetic_reader(2), grid)


def test_blocks_are_bounded(spark):
    """A huge image is many groups of bounded size, and copies stay few."""
    grid = TileGrid(60, 60, 1, 1)
    tiles = synthetic_tiles(source_ids(request_weights(request_list(spark, ["big"])), grid), 1)
    placed = place_in_blocks(tiles, grid, 8)
    assert placed.groupBy("bx", "by").count().agg(F.max("count")).first()[0] == 100
    assert placed.count() < 1.6 * tiles.count()


@pytest.mark.parametrize("strategy", ["grouped", "partial"])
def test_blocks_over_many_small_batches(spark, strategy, monkeypatch):
    monkeypatch.setattr(block_sums, "BATCH_BYTES", 200)
    monkeypatch.setattr(block_sums, "CACHE_PIXELS", 4)
    grid = TileGrid(12, 10, 2, 2)
    tiles = random_tiles(grid, ["a", "b", "c"], 11, missing=0.1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        built = mosaic(request_list(spark, ["a", "b", "b"]), table(spark, tiles), grid, strategy, block=3)
        assert collected(built) == brute.mosaic(["a", "b", "b"], tiles, grid)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("side, block, even", [(10, 8, 10), (30, 8, 8), (12, 8, 6), (100, 8, 9),
                                               (1, 8, 1), (5, 1, 1), (7, 3, 4), (13, 8, 7)])
def test_blocks_are_even(side, block, even):
    assert even_block(TileGrid(side, max(1, side // 2), 1, 1), block) == even <= 1.5 * max(block, 1)


def test_bad_arguments(spark):
    reqs, tiles, grid = request_list(spark, ["a"]), synthetic_reader(2), TileGrid(4, 4, 2, 2)
    for wrong in (dict(strategy="fast"), dict(method="fast"), dict(output="png"),
                  dict(strategy="naive", method="arrow"), dict(strategy="naive", segment=3)):
        with pytest.raises(ValueError):
            mosaic(reqs, tiles, grid, **wrong)
    with pytest.raises(ValueError):
        mosaic(reqs, table(spark, {("a", 2, 2): [1]}), grid, on_missing="zero")
