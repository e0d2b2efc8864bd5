import pytest
from pyspark.sql import functions as F

from tests import brute
from tileflow import TileGrid, fragment_pairs
from tileflow.operators import (backward_neighbours, build_items, check_input_type,
                                expand_index_grid, expand_requests, grid_neighbours,
                                source_fanout, source_ids)
from tileflow.sources import request_list, request_weights, requests


def tuples(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("size, tile, n, pairs, targets, sources", [
    (600, 60, 0, 81, 81, 81),
    (600, 60, 1, 729, 100, 100),
    (600, 60, 2, 1936, 100, 121),
    (60000, 2000, 1, 7569, 900, 900),
    (60000, 2000, 2, 20736, 900, 961),
])
def test_golden_counts(spark, size, tile, n, pairs, targets, sources):
    grid = TileGrid(size, size, tile, tile, n)
    reqs = request_list(spark, ["test1", "test2"])
    found = grid_neighbours(expand_requests(reqs, grid), grid)
    assert found.count() == 2 * pairs == 2 * grid.pairs_per_image
    assert found.select("img_id", "x", "y").distinct().count() == 2 * targets
    assert found.select("img_id", "sx", "sy").distinct().count() == 2 * sources
    assert grid.sources_per_image == sources


@pytest.mark.parametrize("clip", ["origin", "image", "none"])
@pytest.mark.parametrize("im, tile, n", [((5, 3), (1, 1), 1), ((130, 70), (60, 30), 2),
                                         ((4, 4), (4, 4), 1), ((90, 60), (30, 30), 0)])
def test_pairs_and_sources_match_loops(spark, clip, im, tile, n):
    grid = TileGrid(*im, *tile, n, clip=clip)
    reqs = request_list(spark, ["a"])
    found = grid_neighbours(expand_requests(reqs, grid), grid)
    want = brute.pairs("a", grid)
    assert tuples(found, "img_id", "x", "y", "sx", "sy") == sorted(want)
    assert grid.pairs_per_image == len(want)
    ids = source_ids(request_weights(reqs), grid)
    assert tuples(ids, "x", "y") == sorted({p[3:] for p in want})
    fan = {(r.x, r.y): (r.n_targets, {tuple(t) for t in r.targets})
           for r in source_fanout(reqs, grid).collect()}
    for (sx, sy), (count, users) in fan.items():
        assert users == {p[1:3] for p in want if p[3:] == (sx, sy)}
        assert count == len(users)
    assert len(fan) == grid.sources_per_image


def test_order_kind_and_z_of_targets(spark):
    rows = expand_requests(request_list(spark, ["a"]), TileGrid(120, 120, 60, 60)).collect()
    assert sorted((r.x, r.y) for r in rows) == [(0, 0), (0, 60), (60, 0), (60, 60)]
    assert {(r.request, r.img_id, r.z, r.type) for r in rows} == {("a", "a", -1, "out")}


def test_edge_tile_and_tile_count():
    grid = TileGrid(130, 60, 60, 60)
    assert (grid.cols, grid.rows, grid.tiles_per_image) == (3, 1, 2)


def test_downscale():
    half = TileGrid().downscale(2)
    assert (half.im_w, half.im_h, half.tile_w, half.tile_h) == (30000, 30000, 1000, 1000)
    assert half.tiles_per_image == TileGrid().tiles_per_image == 900


def test_bad_grid():
    with pytest.raises(ValueError):
        TileGrid(clip="far")
    with pytest.raises(ValueError):
        TileGrid(tile_w=0)


def test_items(spark):
    grid = TileGrid(600, 600, 60, 60)
    items = build_items(request_list(spark, ["a"]), grid, partitions=7)
    assert items.columns == ["request", "target_tile_id", "source_tile_id", "source_tile_data",
                             "out_tile_data"]
    assert items.count() == 729
    row = items.first()
    assert (row.target_tile_id.type, row.source_tile_id.type) == ("out", "in")
    assert row.source_tile_id.z == -1
    assert row.source_tile_data is None and row.out_tile_data is None
    assert check_input_type(items).count() == 729


def test_input_type_check_fails(spark):
    items = build_items(request_list(spark, ["a"]), TileGrid(120, 120, 60, 60))
    wrong = items.withColumn("source_tile_id",
                             F.col("source_tile_id").withField("type", F.lit("out")))
    with pytest.raises(Exception, match="not an input tile"):
        check_input_type(wrong).collect()


def test_request_record_is_unwrapped(spark):
    df = spark.createDataFrame([(("u1",),), (("u2",),)], "request struct<url:string>")
    assert tuples(requests(df, "request"), "img_id") == [("u1",), ("u2",)]


def test_index_grid_and_backward_pairs(spark):
    targets = expand_index_grid(request_list(spark, ["empty"]), 1, 6000)
    assert targets.count() == 12002
    pairs = backward_neighbours(targets)
    assert pairs.count() == 48008
    assert pairs.select("source_img_id", "sx", "sy").distinct().count() == 18006
    assert pairs.agg(F.min("sx"), F.min("sy"), F.max("sx"), F.max("sy")).first()[:] == (-1, -1, 1, 6000)
    assert pairs.first().source_img_id == "empty_old"


def tasks_with_rows(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


@pytest.mark.parametrize("make", [
    lambda r: expand_requests(r, TileGrid(600, 600, 6, 6)),
    lambda r: expand_requests(r, TileGrid(6, 6000, 6, 6)),
    lambda r: grid_neighbours(expand_requests(r, TileGrid(600, 600, 6, 6)), TileGrid(600, 600, 6, 6)),
    lambda r: build_items(r, TileGrid(600, 600, 6, 6)),
    lambda r: source_fanout(r, TileGrid(600, 600, 6, 6)),
    lambda r: fragment_pairs(r),
])
def test_one_image_expands_in_all_tasks(spark, make):
    """Also under adaptive execution, which judges rows by their bytes."""
    assert tasks_with_rows(make(request_list(spark, ["a"]))) == 4


def test_expansion_is_native_and_moves_keys_once(spark):
    grid = TileGrid(600, 600, 60, 60)
    plan = grid_neighbours(expand_requests(request_list(spark, ["a"]), grid), grid)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Python" not in text
