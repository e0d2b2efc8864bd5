
from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F

from tileflow import (TileGrid, fragment_pairs, fragment_pipeline, image_table, mosaic,
                      mosaic_rectangle, request_mosaic, with_tile_stats, write_mosaic)
from tileflow.functions import (flat_map, flat_map_by_key, flatten_tile, int_div, named_udf, quantise, reshape_tile, threshold,
                                tile_shape)
from tileflow.operators import (attach_tiles, build_items, check_input_type, expand_requests,
                                grid_neighbours, group_tiles, missing_tiles, source_fanout,
                                read_zone_map, source_ids, stored_diff, strategy_diff, sum_tiles, tiles_where,
                                to_long, write_zone_map)
from tileflow.operators.group import tile_part
from tileflow.plans.fragments import constant_full_tile
from tileflow.sinks import mosaic_of_blocks, read_images, read_rectangle, write_block_table, write_images
from tileflow.sources import (key_table, read_tile_source, request_weights, requests, synthetic_tiles,
                              tiles_from_vectors, write_tile_files)

SMOKE_DIR = "/root/testdata/sf0.001"

# Vectors are tiles of 8x8 pixels, 10x10 tiles to an image, addressed by tile index.
VECTORS = TileGrid(im_w=10, im_h=10, tile_w=1, tile_h=1)
# Images asked for by name: 600x600 pixels in tiles of 60x60.
NAMED = TileGrid(im_w=600, im_h=600, tile_w=60, tile_h=60)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vector_tiles(spark, sf_dir):
    return tiles_from_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def _vector_requests(spark, sf_dir):
    return requests(_vector_tiles(spark, sf_dir).select("img_id").distinct())


def _supplier_requests(spark, sf_dir):
    return requests(_table(spark, sf_dir, "supplier"), "s_name")


def _scratch(spark) -> str:
    """A new folder name in the place shared by all executors (in local mode: anywhere)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tileflow-")
    return f"{shared.rstrip('/')}/tileflow-{uuid.uuid4().hex}"


# --- light keys ---------------------------------------------------------------------


def q_expand_requests(spark, sf_dir):
    return expand_requests(_supplier_requests(spark, sf_dir), NAMED)


def _pairs(grid):
    def query(spark, sf_dir):
        targets = expand_requests(_supplier_requests(spark, sf_dir), grid)
        return grid_neighbours(targets, grid).select("img_id", "x", "y", "sx", "sy")

    return query


def q_backward_pairs(spark, sf_dir):
    pairs = fragment_pairs(_vector_requests(spark, sf_dir))
    return pairs.select("request", "z", "x", "y", "source_img_id", "sx", "sy")


def q_tiles_per_image(spark, sf_dir):
    full, half = TileGrid(), TileGrid(im_w=61000).downscale(2)
    reqs = _supplier_requests(spark, sf_dir)
    count = lambda grid, name: (expand_requests(reqs, grid).groupBy("img_id")
                                .agg(F.count(F.lit(1)).alias(name)))
    return (count(full, "n_tiles").join(count(half, "n_tiles_half"), "img_id")
            .withColumn("tiles_per_image", F.lit(full.tiles_per_image).cast("bigint"))
            .withColumn("tiles_per_image_half", F.lit(half.tiles_per_image).cast("bigint")))


def _flat_items(items):
    t, s = "target_tile_id", "source_tile_id"
    return items.select(
        "request", F.col(f"{t}.img_id").alias("t_img"), F.col(f"{t}.z").alias("t_z"),
        F.col(f"{t}.x").alias("t_x"), F.col(f"{t}.y").alias("t_y"),
        F.col(f"{t}.type").alias("t_type"), F.col(f"{s}.img_id").alias("s_img"),
        F.col(f"{s}.z").alias("s_z"), F.col(f"{s}.x").alias("s_x"), F.col(f"{s}.y").alias("s_y"),
        F.col(f"{s}.type").alias("s_type"),
        F.col("source_tile_data").isNull().alias("no_source_data"),
        F.col("out_tile_data").isNull().alias("no_out_data"))


def q_tile_items(spark, sf_dir):
    return _flat_items(build_items(_supplier_requests(spark, sf_dir), NAMED))


def q_source_fanout(spark, sf_dir):
    fan = source_fanout(_supplier_requests(spark, sf_dir), NAMED)
    return fan.select("img_id", "x", "y", "n_targets",
                      F.array_min("targets.x").alias("first_x"),
                      F.array_max("targets.y").alias("last_y"))


def q_repartitioned(spark, sf_dir):
    items = _flat_items(build_items(_supplier_requests(spark, sf_dir), NAMED, partitions=16))
    return items.groupBy("request").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("s_x").alias("sum_sx"),
        F.sum("t_y").alias("sum_ty"))


def q_missing_tiles(spark, sf_dir):
    ids = source_ids(request_weights(_vector_requests(spark, sf_dir)), VECTORS)
    return missing_tiles(ids.drop("weight"), _vector_tiles(spark, sf_dir))


# --- mosaics ------------------------------------------------------------------------


def _mosaic(strategy, method, **options):
    def query(spark, sf_dir):
        built = mosaic(_vector_requests(spark, sf_dir), _vector_tiles(spark, sf_dir), VECTORS,
                       strategy, method, output="long", **options)
        return built.select("img_id", "x", "y", "i", "s")

    return query


def q_grouped_sum_all(spark, sf_dir):
    """Every stored image: no join, the pixels move once."""
    return mosaic(None, _vector_tiles(spark, sf_dir), VECTORS, output="long").select(
        "img_id", "x", "y", "i", "s")


def q_few_requests_sum(spark, sf_dir):
    """Some of the stored images, asked for from a table that also names others."""
    regions = _table(spark, sf_dir, "region").where("r_name like 'A%'")
    return mosaic(requests(regions, "r_regionkey"), _vector_tiles(spark, sf_dir), VECTORS, output="long").select(
        "img_id", "x", "y", "i", "s")


def q_grouped_sum_n2(spark, sf_dir):
    grid = TileGrid(10, 10, 1, 1, n_size=2, clip="image")
    return mosaic(_vector_requests(spark, sf_dir), _vector_tiles(spark, sf_dir), grid,
                  output="long").select("img_id", "x", "y", "i", "s")


def q_grouped_sum_zero(spark, sf_dir):
    # a grid two tiles larger than the images: its rim has no input at all
    grid = TileGrid(12, 12, 1, 1)
    return mosaic(_vector_requests(spark, sf_dir), _vector_tiles(spark, sf_dir), grid,
                  output="long", on_missing="zero", length=64).select("img_id", "x", "y", "i", "s")


def _byte_tiles(spark, sf_dir):
    byte = lambda v: F.lpad(F.hex(v.cast("bigint").bitwiseAND(F.lit(255))), 2, "0")
    return _vector_tiles(spark, sf_dir).withColumn(
        "pixels", F.unhex(F.array_join(F.transform("pixels", byte), "")))


def q_grouped_sum_binary(spark, sf_dir):
    """Tiles as byte strings, summed in runs of 24 pixels that are put together again."""
    tiles = _byte_tiles(spark, sf_dir)
    built = mosaic(_vector_requests(spark, sf_dir), tiles, VECTORS, dtype="int8", segment=24, length=64)
    digits = built.select("img_id", "x", "y", F.hex("pixels").alias("h"),
                          F.explode(F.sequence(F.lit(0), int_div(F.length("pixels"), F.lit(8)) - 1)).alias("i"))
    # the lowest byte comes first
    value = F.conv(F.concat(*[F.substring("h", F.col("i") * 16 + k, F.lit(2)) for k in range(15, 0, -2)]), 16, -10)
    return digits.select("img_id", "x", "y", F.col("i").cast("bigint").alias("i"), value.cast("bigint").alias("s"))


def q_mosaic_shape(spark, sf_dir):
    """Tiles of 8 rows of 4 pixels with 2 channels keep their shape."""
    built = mosaic(_vector_requests(spark, sf_dir), _vector_tiles(spark, sf_dir), VECTORS, shape=(8, 4, 2))
    found = tile_shape(reshape_tile(F.col("pixels"), 8, 4, 2), channels=True)
    return built.select("img_id", "x", "y", *[F.col("shape")[k].alias(f"declared{k}") for k in range(3)],
                        *[found[k].alias(f"found{k}") for k in range(3)])


def _line_tiles(spark, sf_dir):
    """Few tiles, each listed thousands of times: one per order line."""
    line = F.col("l_linenumber").cast("bigint")
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("img_id"), F.lit(-1).cast("bigint").alias("z"), line.alias("x"),
        F.lit(0).cast("bigint").alias("y"), F.array(line, F.col("l_suppkey") % 30, -line).alias("pixels"))


def _hot_tiles(strategy, method):
    def query(spark, sf_dir):
        grid = TileGrid(9, 1, 1, 1, clip="image")
        flags = requests(_table(spark, sf_dir, "lineitem").select("l_returnflag").distinct(), "l_returnflag")
        built = mosaic(flags, _line_tiles(spark, sf_dir), grid, strategy, method, output="long", salt=8)
        return built.select("img_id", "x", "i", "s")

    return query


def q_repeated_requests(spark, sf_dir):
    reqs = _table(spark, sf_dir, "orders").select(
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("img_id"))
    return mosaic(requests(reqs), _vector_tiles(spark, sf_dir), VECTORS,
                  output="long").select("img_id", "x", "y", "i", "s")


def wide_tiles(spark, sf_dir):
    """Tiles of 64x64 pixels: the products of every two elements of a vector."""
    vectors = _table(spark, sf_dir, "embeddings")
    tiles = tiles_from_vectors(vectors, "vec_id", "embedding")
    whole = F.transform("pixels", lambda a: F.transform("pixels", lambda b: int_product(a, b)))
    return tiles.withColumn("pixels", F.flatten(whole))


def int_product(a, b):
    return F.call_function("div", a * b, F.lit(16)).cast("int")


def q_grouped_sum_wide(spark, sf_dir):
    tiles = mosaic(_vector_requests(spark, sf_dir), wide_tiles(spark, sf_dir), VECTORS)
    return tiles.select(
        "img_id", "x", "y", F.array_size("pixels").cast("bigint").alias("n_pixels"),
        F.array_min("pixels").alias("least"), F.array_max("pixels").alias("most"),
        F.aggregate("pixels", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("total"))


def q_strategy_diff(spark, sf_dir):
    build = lambda strategy: mosaic(_vector_requests(spark, sf_dir),
                                    _vector_tiles(spark, sf_dir), VECTORS, strategy)
    return strategy_diff(build("partial"), build("naive")).drop("z")


def q_strategy_diff_limits(spark, sf_dir):
    """Mosaics that do differ: another limit on one side, and a tile missing on the other."""
    reqs, tiles = _vector_requests(spark, sf_dir), _vector_tiles(spark, sf_dir)
    fewer = tiles.where("not (x = 9 and y >= 8)")
    left = mosaic(reqs, tiles.where("not (x <= 2 and y <= 2)"), VECTORS)
    return strategy_diff(left, mosaic(reqs, fewer, VECTORS, "partial", limit=60), only_different=True).drop("z")


def q_result_count(spark, sf_dir):
    built = mosaic(_vector_requests(spark, sf_dir), _vector_tiles(spark, sf_dir), VECTORS)
    return built.groupBy("img_id").agg(F.count(F.lit(1)).alias("n_tiles"))


def q_image_total(spark, sf_dir):
    built = mosaic(_vector_requests(spark, sf_dir), _vector_tiles(spark, sf_dir), VECTORS)
    return sum_tiles(built, ["img_id"], output="long")


def q_threshold(spark, sf_dir):
    tiles = _vector_tiles(spark, sf_dir).withColumn("pixels", threshold("pixels"))
    return to_long(tiles).select("img_id", "x", "y", "i", F.col("s").alias("v"))


def _vector_items(spark, sf_dir):
    items = build_items(_vector_requests(spark, sf_dir), VECTORS)
    at = [f"source_tile_id.{c}" for c in ("img_id", "z", "x", "y")]
    return (attach_tiles(items.drop("source_tile_data"), _vector_tiles(spark, sf_dir), at, shuffle=True)
            .withColumnRenamed("pixels", "source_tile_data"))


def q_partial_tiles(spark, sf_dir):
    items = (_vector_items(spark, sf_dir)
             .withColumn("out_tile_data", threshold("source_tile_data")).drop("source_tile_data"))
    return items.select(
        "request", F.col("target_tile_id.x").alias("x"), F.col("target_tile_id.y").alias("y"),
        F.col("source_tile_id.x").alias("sx"), F.col("source_tile_id.y").alias("sy"),
        F.posexplode_outer("out_tile_data").alias("i", "v")).withColumn("i", F.col("i").cast("bigint"))


def q_synthetic_pixels(spark, sf_dir):
    suppliers = _table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("img_id"), F.col("s_suppkey").alias("seed"))
    ids = source_ids(suppliers, NAMED)
    return to_long(synthetic_tiles(ids, 36, seed=F.col("seed"))).select(
        "img_id", "x", "y", "i", F.col("s").alias("v"))


def q_input_type_check(spark, sf_dir):
    items = check_input_type(build_items(_supplier_requests(spark, sf_dir), NAMED))
    return items.groupBy(F.col("source_tile_id.type").alias("type")).agg(
        F.count(F.lit(1)).alias("n_items"))


# --- fragments ----------------------------------------------------------------------


def q_fragment_pipeline(spark, sf_dir):
    tiles = fragment_pipeline(_vector_requests(spark, sf_dir))
    return to_long(tiles).select("request", "x", "y", "i", "s")


def q_fragment_tiles(spark, sf_dir):
    """The fragments of stored tiles of the earlier image, blanked where bright."""
    tiles = _vector_tiles(spark, sf_dir).withColumns(
        {"img_id": F.concat("img_id", F.lit("_old")), "z": F.lit(0).cast("bigint")})
    built = fragment_pipeline(_vector_requests(spark, sf_dir), 9, 9, fragment=threshold("pixels"), tiles=tiles)
    return to_long(built).select("request", "x", "y", "i", "s")


def q_fragment_truncate(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem")
    size = F.col("l_quantity").cast("int")
    fragment = F.transform(F.sequence(F.lit(1), size), lambda i: i * F.col("l_linenumber"))
    rows = lines.select("l_orderkey", fragment.alias("pixels"))
    return sum_tiles(rows, ["l_orderkey"], output="long", truncate=True)


def q_request_groups(spark, sf_dir):
    tiles = fragment_pipeline(_vector_requests(spark, sf_dir)).drop("img_id", "z")
    groups = group_tiles(tiles, "request", tile_part(F.col("x"), F.col("y"), 6001, 1024))
    total = F.aggregate(F.flatten("tiles.pixels"), F.lit(0).cast("bigint"), lambda a, v: a + v)
    first, last = F.get("tiles", F.lit(0)), F.element_at("tiles", -1)
    return groups.select("request", "part", "n_tiles",
                         first["x"].alias("first_x"), first["y"].alias("first_y"),
                         last["x"].alias("last_x"), last["y"].alias("last_y"),
                         total.alias("total"))


def q_request_mosaic(spark, sf_dir):
    return to_long(request_mosaic(fragment_pipeline(_vector_requests(spark, sf_dir)), length=10))


def q_constant_tile(spark, sf_dir):
    reqs = _supplier_requests(spark, sf_dir).withColumn("pixels", constant_full_tile())
    return to_long(reqs).select("img_id", "i", F.col("s").alias("v"))


# --- keys and images ----------------------------------------------------------------


def _keys(spark, sf_dir):
    return key_table(_table(spark, sf_dir, "embeddings"), "vec_id")


def q_keys_all(spark, sf_dir):
    return _keys(spark, sf_dir)


def _key_tiles(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    at = F.col("vec_id")
    pixels = quantise(F.transform("embedding", lambda v: v.cast("double") * 127))
    return vectors.select(F.lit("").alias("img_id"), F.lit(0).cast("bigint").alias("z"),
                          at.alias("x"), at.alias("y"), pixels.alias("pixels"))


def _images(spark, sf_dir):
    return image_table(_keys(spark, sf_dir), _key_tiles(spark, sf_dir), height=8)


def _image_pixels(images):
    return images.select("x", "y", F.posexplode_outer(flatten_tile("Image")).alias("i", "v")).select(
        "x", "y", F.col("i").cast("bigint").alias("i"), "v")


def q_filter_gt(spark, sf_dir):
    return _image_pixels(_images(spark, sf_dir).where("x > 99"))


def q_filter_eq(spark, sf_dir):
    return _image_pixels(_images(spark, sf_dir).where("x = 27"))


def q_filter_and(spark, sf_dir):
    images = with_tile_stats(_images(spark, sf_dir))
    return images.where("x > 88").where("y < 92").select("x", "y", "MeanPoint")


def q_keys_join(spark, sf_dir):
    found = _images(spark, sf_dir).where("x > 99").select("x", "y", "Image")
    joined = _keys(spark, sf_dir).join(found, ["x", "y"], "inner")
    return joined.select("img_id", "z", "x", "y", "type",
                         F.array_max(flatten_tile("Image")).alias("brightest"))


def q_mean_point(spark, sf_dir):
    return with_tile_stats(_images(spark, sf_dir)).select("x", "y", "MeanPoint")


def q_brightest_point(spark, sf_dir):
    return with_tile_stats(_images(spark, sf_dir)).select(
        "x", "y", F.col("BrightestPoint._1").alias("row"), F.col("BrightestPoint._2").alias("col"))


def q_tile_shape(spark, sf_dir):
    shape = tile_shape(F.col("Image"))
    return _images(spark, sf_dir).select("x", "y", shape[0].alias("height"), shape[1].alias("width"))


def q_reshape_tile(spark, sf_dir):
    tiles = _vector_tiles(spark, sf_dir).select(
        "img_id", "x", "y", F.posexplode(reshape_tile(F.col("pixels"), 4, 16)).alias("r", "line"))
    return tiles.select("img_id", "x", "y", "r", F.posexplode("line").alias("c", "v"))


def q_quantise(spark, sf_dir):
    scaled = F.transform("embedding", lambda v: v.cast("double") * 127)
    rows = _table(spark, sf_dir, "embeddings").select(
        "vec_id", quantise(scaled, "smallint").alias("pixels"))
    return rows.select("vec_id", F.posexplode("pixels").alias("i", "v")).withColumn(
        "v", F.col("v").cast("int"))


def q_column_types(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    names = orders.columns
    counted = orders.agg(F.count(F.lit(1)).alias("n_values"), *[F.first(F.typeof(c)).alias(c) for c in names])
    kinds = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("kind")) for c in names])
    return counted.where("n_values > 0").select(F.inline(kinds), "n_values")


def q_named_udf(spark, sf_dir):
    blend = named_udf("Blend Discount", lambda price, discount, factor: price * (1 - discount) * factor,
                      "double", vectorized=True, factor=2.0)
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", blend("l_extendedprice", "l_discount").alias("blended"))


# --- keyed verbs --------------------------------------------------------------------


def q_map_rows(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))


def q_map_values(spark, sf_dir):
    keyed = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return keyed.withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumnRenamed(
        "o_totalprice", "doubled")


def q_flat_map(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def q_flat_map_values(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("words"))
    long_words = F.filter("words", lambda w: F.length(w) > 14)
    return docs.select("doc_id", F.explode(long_words).alias("word"))


def q_group_by(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_suppkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.min("l_extendedprice").alias("least"), F.max("l_extendedprice").alias("most"))


# --- sinks --------------------------------------------------------------------------


def q_parquet_roundtrip(spark, sf_dir):
    path = _scratch(spark)
    write_mosaic(_vector_requests(spark, sf_dir), _vector_tiles(spark, sf_dir), VECTORS, path,
                 layout="blocks")
    return to_long(read_images(spark, path)).drop("z")


def q_parquet_roundtrip_all(spark, sf_dir):
    """Every stored image, written by image and read back."""
    path = _scratch(spark)
    write_mosaic(None, _vector_tiles(spark, sf_dir), VECTORS, path, tiles_per_file=30)
    return to_long(read_images(spark, path)).drop("z")


def q_image_manifest(spark, sf_dir):
    """Parts of 30 places each; the second write's manifest lists its own files only."""
    path, tiles = _scratch(spark), _vector_tiles(spark, sf_dir)
    write_mosaic(None, tiles.where("img_id = '0'"), VECTORS, path, tiles_per_file=30, write_id="first")
    manifest = write_mosaic(_vector_requests(spark, sf_dir), tiles, VECTORS, path, tiles_per_file=30, mode="append",
                            write_id="second")
    return manifest.groupBy("img_id", "part").agg(F.sum("n_tiles").alias("n_tiles"),
                                                  F.count(F.lit(1)).alias("n_files"))


def q_tile_files(spark, sf_dir):
    """Tiles written to a file each and read by the data source, which opens those asked for."""
    path = _scratch(spark)
    write_tile_files(_byte_tiles(spark, sf_dir), path)
    tiles = read_tile_source(spark, path, images_per_task=4).where("img_id <> '' and x >= 3 and x < 7 and y <= 5")
    digits = tiles.select("img_id", "x", "y", F.hex("pixels").alias("h"), F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i"))
    value = F.conv(F.substring("h", F.col("i") * 2 + 1, F.lit(2)), 16, 10).cast("int")
    return digits.select("img_id", "x", "y", F.col("i").cast("bigint").alias("i"),
                         F.when(value > 127, value - 256).otherwise(value).alias("v"))


def q_bucketed_sum(spark, sf_dir):
    """A table bucketed by image and block, of which a mosaic needs no shuffle."""
    name = f"blocks_{uuid.uuid4().hex}"
    write_block_table(_vector_tiles(spark, sf_dir), VECTORS, name, buckets=8, block=4, path=_scratch(spark))
    return to_long(mosaic_of_blocks(spark, name, VECTORS, block=4)).select("img_id", "x", "y", "i", "s")


def q_stored_diff(spark, sf_dir):
    """Two stored mosaics, of tiles that differ in image 0 alone, compared by digests first."""
    paths, tiles = (_scratch(spark), _scratch(spark)), _vector_tiles(spark, sf_dir)
    bright = F.transform("pixels", lambda v: F.when((F.col("img_id") == "0") & (v < -20), 0).otherwise(v))
    for path, pixels in zip(paths, (F.col("pixels"), bright)):
        write_mosaic(None, tiles.withColumn("pixels", pixels), VECTORS, path, layout="blocks")
    return stored_diff(*[read_images(spark, path) for path in paths]).drop("z")


def q_zone_map_tiles(spark, sf_dir):
    """Bright tiles, found in the zone map and fetched from a table stored by image."""
    tiles, stored, zones = _vector_tiles(spark, sf_dir), _scratch(spark), _scratch(spark)
    write_images(tiles, stored, "per_image", VECTORS)
    write_zone_map(tiles, zones)
    found = tiles_where(read_images(spark, stored, "array<int>"), read_zone_map(spark, zones), "most > 40 and mean > 0")
    return found.select("img_id", "x", "y", "most", "brightest", F.aggregate("pixels", F.lit(0).cast("bigint"),
                                                                             lambda a, v: a + v).alias("total"))


def q_rectangle_sum(spark, sf_dir):
    """A rectangle of every image, from tiles stored along a curve."""
    path = _scratch(spark)
    write_images(_vector_tiles(spark, sf_dir), path, "curve", VECTORS)
    built = mosaic_rectangle(None, read_images(spark, path, "array<int>"), VECTORS, (2, 5), (4, 8), output="long")
    return built.select("img_id", "x", "y", "i", "s")


def q_rectangle_tiles(spark, sf_dir):
    path = _scratch(spark)
    write_mosaic(_vector_requests(spark, sf_dir), _vector_tiles(spark, sf_dir), VECTORS, path, layout="curve")
    return to_long(read_rectangle(spark, path, "2", (2, 5), (4, 8))).drop("z")


def _lines(text):
    for pos, line in enumerate((text or "").split("\n")):
        if line:
            yield pos, line


def q_flat_map_udtf(spark, sf_dir):
    """A Python function that yields rows, as a table function in a lateral join."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return flat_map(docs, _lines, "pos int, line string", "text").select("doc_id", "pos", "line")


def _records(best, row):
    """Orders above all earlier ones of the customer, numbered."""
    n, most = best or (0, None)
    if most is None or row.o_totalprice > most:
        return (n + 1, row.o_totalprice), [(n + 1,)]
    return best, []


def q_flat_map_by_key(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return flat_map_by_key(orders, ["o_custkey"], _records, "record int", order=["o_orderkey"])


def entry(spark: SparkSession) -> DataFrame:
    """The grouped-read mosaic of all vector images, one row per pixel."""
    return q_grouped_sum_all(spark, SMOKE_DIR)


def library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name[2:]: f for name, f in globals().items() if name.startswith("q_")}
    found.update({
        "neighbour_pairs": _pairs(NAMED),
        "neighbour_pairs_n0": _pairs(TileGrid(600, 600, 60, 60, n_size=0)),
        "neighbour_pairs_n2": _pairs(TileGrid(600, 600, 60, 60, n_size=2)),
        "neighbour_pairs_inside": _pairs(TileGrid(600, 600, 60, 60, clip="image")),
        "naive_sum": _mosaic("naive", "lanes"),
        "grouped_sum": _mosaic("grouped", "lanes"),
        "grouped_sum_arrow": _mosaic("grouped", "arrow"),
        "grouped_sum_long": _mosaic("grouped", "long"),
        "grouped_sum_segments": _mosaic("grouped", "arrow", segment=24),
        "grouped_sum_broadcast": _mosaic("grouped", "arrow", request_join="broadcast"),
        "partial_sum_broadcast": _mosaic("partial", "lanes", request_join="broadcast"),
        "naive_sum_broadcast": _mosaic("naive", "lanes", request_join="broadcast"),
        "hot_tile_sum": _hot_tiles("grouped", "arrow"),
        "hot_tile_sum_partial": _hot_tiles("partial", "arrow"),
        "partial_sum": _mosaic("partial", "lanes"),
        "partial_sum_arrow": _mosaic("partial", "arrow"),
    })
    return found


# --- the same in SQL ----------------------------------------------------------------

_GRID = "range(0, 600, 60) gx(x), range(0, 600, 60) gy(y)"


def _sql_pairs(n, clip):
    reach = f"range({-n * 60}, {n * 60 + 1}, 60)"
    return f"""select s_name as img_id, x, y, x + dx as sx, y + dy as sy
        from supplier, {_GRID}, {reach} ox(dx), {reach} oy(dy) where {clip}"""


_POSITIVE = "x + dx > 0 and y + dy > 0"
_INSIDE = "x + dx between 0 and 599 and y + dy between 0 and 599"

_TILES = """t as (select cast(vec_id // 100 as varchar) as img_id, (vec_id % 100) // 10 as x,
        vec_id % 10 as y, embedding as e from embeddings),
    px as (select img_id, x, y, unnest(range(0, 64)) as i, e from t),
    pv as (select img_id, x, y, i, cast(trunc(cast(e[i + 1] as double) * 127) as integer) as v from px)"""


def _sql_mosaic(n=1, clip="x + dx > 0 and y + dy > 0"):
    reach = f"range({-n}, {n + 1})"
    return f"""with {_TILES},
    pr as (select img_id, x as tx, y as ty, x + dx as x, y + dy as y
           from t, {reach} ox(dx), {reach} oy(dy) where {clip}),
    mosaic as (select img_id, tx as x, ty as y, i,
                      cast(sum(case when v > 20 then 0 else v end) as bigint) as s
               from pr join pv using (img_id, x, y) group by all)"""


_MOSAIC = _sql_mosaic() + " select img_id, x, y, i, s from mosaic"

_FRAGMENTS = """with r as (select distinct cast(vec_id // 100 as varchar) as request from embeddings),
    targets as (select request, x, y from r, range(0, 2) gx(x), range(0, 6001) gy(y)),
    pairs as (select request, x, y, request || '_old' as source_img_id, x + dx as sx, y + dy as sy
              from targets, range(-1, 1) ox(dx), range(-1, 1) oy(dy)),
    sums as (select request, x, y, i, cast(sum(1) as bigint) as s
             from pairs, range(0, 10) g(i) group by all)"""

_IMAGES = """with pv as (select vec_id as x, vec_id as y, unnest(range(0, 64)) as i, embedding as e from embeddings),
    im as (select x, y, i, cast(trunc(cast(e[i + 1] as double) * 127) as integer) as v from pv)"""


_HOT = """with p as (select l_returnflag as img_id, l_linenumber as x, unnest([0, 1, 2]) as i,
        unnest([l_linenumber, l_suppkey % 30, -l_linenumber]) as v from lineitem)
    select img_id, cast(t.x as bigint) as x, cast(i as bigint) as i, cast(sum(case when v > 20 then 0 else v end) as bigint) as s
    from range(0, 9) t(x) join p on p.x between t.x - 1 and t.x + 1 group by all"""


def library_sql() -> dict[str, str]:
    items = f"""select img_id as request, img_id as t_img, cast(-1 as bigint) as t_z, x as t_x, y as t_y,
        'out' as t_type, img_id as s_img, cast(-1 as bigint) as s_z, sx as s_x, sy as s_y, 'in' as s_type,
        true as no_source_data, true as no_out_data from ({_sql_pairs(1, _POSITIVE)})"""
    mosaics = ["grouped_sum_all", "naive_sum", "grouped_sum", "grouped_sum_arrow", "grouped_sum_long",
               "grouped_sum_segments", "partial_sum", "partial_sum_arrow", "parquet_roundtrip",
               "grouped_sum_broadcast", "partial_sum_broadcast", "naive_sum_broadcast", "grouped_sum_binary",
               "parquet_roundtrip_all", "bucketed_sum"]
    return {name: _MOSAIC for name in mosaics} | {
        "expand_requests": f"""select s_name as request, s_name as img_id, cast(-1 as bigint) as z,
            x, y, 'out' as type from supplier, {_GRID}""",
        "neighbour_pairs": _sql_pairs(1, _POSITIVE),
        "neighbour_pairs_n0": _sql_pairs(0, _POSITIVE),
        "neighbour_pairs_n2": _sql_pairs(2, _POSITIVE),
        "neighbour_pairs_inside": _sql_pairs(1, _INSIDE),
        "backward_pairs": f"""{_FRAGMENTS} select request, cast(0 as bigint) as z, x, y,
            source_img_id, sx, sy from pairs""",
        "tiles_per_image": """with f as (select s_name as img_id, count(*) as n_tiles from supplier,
                range(0, 60000, 2000) gx(x), range(0, 60000, 2000) gy(y) group by all),
            h as (select s_name as img_id, count(*) as n_tiles_half from supplier,
                range(0, 30500, 1016) gx(x), range(0, 30000, 1000) gy(y) group by all)
            select img_id, n_tiles, n_tiles_half, cast(900 as bigint) as tiles_per_image,
                cast(floor(30500 * 30000 / (1016 * 1000.0)) as bigint) as tiles_per_image_half
            from f join h using (img_id)""",
        "tile_items": items,
        "source_fanout": f"""select img_id, sx as x, sy as y, count(*) as n_targets,
            min(x) as first_x, max(y) as last_y from ({_sql_pairs(1, _POSITIVE)}) group by img_id, sx, sy""",
        "repartitioned": f"""select request, count(*) as n_items, cast(sum(s_x) as bigint) as sum_sx,
            cast(sum(t_y) as bigint) as sum_ty from ({items}) group by request""",
        "missing_tiles": f"""with {_TILES}, r as (select distinct img_id from t)
            select img_id, cast(-1 as bigint) as z, x, y
            from r, range(1, 11) gx(x), range(1, 11) gy(y)
            where not exists (select 1 from t where t.img_id = r.img_id and t.x = gx.x and t.y = gy.y)""",
        "few_requests_sum": _sql_mosaic() + """ select img_id, x, y, i, s from mosaic
            where img_id in (select cast(r_regionkey as varchar) from region where r_name like 'A%')""",
        "grouped_sum_n2": _sql_mosaic(2, "true") + " select img_id, x, y, i, s from mosaic",
        "grouped_sum_zero": f"""with {_TILES},
            r as (select distinct img_id from t),
            g as (select img_id, x, y from r, range(0, 12) gx(x), range(0, 12) gy(y)),
            pr as (select img_id, x as tx, y as ty, x + dx as x, y + dy as y
                   from g, range(-1, 2) ox(dx), range(-1, 2) oy(dy) where {_POSITIVE}),
            al as (select * from pr, range(0, 64) k(i))
            select img_id, tx as x, ty as y, i,
                cast(sum(case when v > 20 then 0 else coalesce(v, 0) end) as bigint) as s
            from al left join pv using (img_id, x, y, i) group by all""",
        "repeated_requests": _sql_mosaic() + """, w as (
                select split_part(o_orderpriority, '-', 1) as img_id, count(*) as n from orders group by all)
            select img_id, x, y, i, cast(s * n as bigint) as s from mosaic join w using (img_id)""",
        "grouped_sum_wide": f"""with {_TILES},
            wide as (select a.img_id, a.x, a.y, a.i * 64 + b.i as i,
                         cast(trunc(a.v * b.v / 16.0) as integer) as v
                     from pv a join pv b using (img_id, x, y)),
            near as (select img_id, x as sx, y as sy, x - dx as x, y - dy as y
                     from t, range(-1, 2) ox(dx), range(-1, 2) oy(dy) where x > 0 and y > 0),
            sums as (select n.img_id, n.x, n.y, w.i, sum(case when v > 20 then 0 else v end) as s
                     from near n join wide w on w.img_id = n.img_id and w.x = n.sx and w.y = n.sy
                     where n.x between 0 and 9 and n.y between 0 and 9 group by all)
            select img_id, x, y, count(*) as n_pixels, cast(min(s) as bigint) as least,
                cast(max(s) as bigint) as most, cast(sum(s) as bigint) as total from sums group by all""",
        "strategy_diff": f"""with {_TILES} select img_id, x, y, 'both' as side, cast(0 as bigint) as n_diff from t""",
        "result_count": _sql_mosaic() + """ select img_id, count(distinct x * 10 + y) as n_tiles
            from mosaic group by img_id""",
        "image_total": _sql_mosaic() + " select img_id, i, cast(sum(s) as bigint) as s from mosaic group by all",
        "threshold": f"""with {_TILES} select img_id, x, y, i, case when v > 20 then 0 else v end as v from pv""",
        "partial_tiles": f"""with {_TILES}
            select pv.img_id as request, t.x, t.y, pv.x as sx, pv.y as sy, i,
                case when v > 20 then 0 else v end as v
            from t join pv on pv.img_id = t.img_id and abs(pv.x - t.x) <= 1 and abs(pv.y - t.y) <= 1
            where pv.x > 0 and pv.y > 0""",
        "synthetic_pixels": """select s_name as img_id, x, y, i,
                cast((x * 7919 + y * 104729 + s_suppkey + i * 1299709) % 255 - 127 as integer) as v
            from supplier, range(60, 601, 60) gx(x), range(60, 601, 60) gy(y), range(0, 36) g(i)""",
        "input_type_check": f"""select 'in' as type, count(*) as n_items from ({items})""",
        "fragment_pipeline": f"{_FRAGMENTS} select request, x, y, i, s from sums",
        "fragment_truncate": """with o as (select l_orderkey, min(cast(l_quantity as integer)) as n,
                sum(l_linenumber) as w from lineitem group by l_orderkey),
            e as (select l_orderkey, w, unnest(range(0, n)) as i from o)
            select l_orderkey, i, cast((i + 1) * w as bigint) as s from e""",
        "request_groups": f"""{_FRAGMENTS},
            tiles as (select request, x, y, sum(s) as total from sums group by all)
            select request, (x * 6001 + y) // 1024 as part, count(*) as n_tiles,
                min(x) as first_x, cast(min(x * 6001 + y) % 6001 as bigint) as first_y,
                max(x) as last_x, cast(max(x * 6001 + y) % 6001 as bigint) as last_y,
                cast(sum(total) as bigint) as total
            from tiles group by request, part""",
        "request_mosaic": f"{_FRAGMENTS} select request, i, cast(sum(s) as bigint) as s from sums group by all",
        "constant_tile": "select s_name as img_id, i, -1 as v from supplier, range(0, 10) g(i)",
        "keys_all": """select '' as img_id, cast(0 as bigint) as z, vec_id as x, vec_id as y, 'in' as type
            from embeddings""",
        "filter_gt": f"{_IMAGES} select x, y, i, v from im where x > 99",
        "filter_eq": f"{_IMAGES} select x, y, i, v from im where x = 27",
        "filter_and": f"""{_IMAGES} select x, y, sum(v) / 64.0::double as "MeanPoint"
            from im where x > 88 and y < 92 group by x, y""",
        "keys_join": f"""{_IMAGES} select '' as img_id, cast(0 as bigint) as z, x, y, 'in' as type,
            max(v) as brightest from im where x > 99 group by x, y""",
        "mean_point": f"""{_IMAGES} select x, y, sum(v) / 64.0::double as "MeanPoint" from im group by x, y""",
        "brightest_point": f"""{_IMAGES},
            top as (select x, y, max(v) as v from im group by x, y),
            place as (select x, y, min(i) as i from im join top using (x, y, v) group by x, y)
            select x, y, cast(i // 8 as integer) as row, cast(i % 8 as integer) as col from place""",
        "tile_shape": "select vec_id as x, vec_id as y, 8 as height, cast(len(embedding) // 8 as integer) as width from embeddings",
        "reshape_tile": f"""with {_TILES} select img_id, x, y, cast(i // 16 as integer) as r,
            cast(i % 16 as integer) as c, v from pv""",
        "quantise": f"""{_IMAGES} select x as vec_id, cast(i as integer) as i, v from im""",
        "column_types": """with k as (unpivot (
                select typeof(o_orderkey) as o_orderkey, typeof(o_custkey) as o_custkey,
                    typeof(o_orderstatus) as o_orderstatus, typeof(o_totalprice) as o_totalprice,
                    typeof(o_orderdate) as o_orderdate, typeof(o_orderpriority) as o_orderpriority
                from orders) on columns(*) into name name value kind)
            select name, case when kind = 'VARCHAR' then 'string'
                when kind like 'TIMESTAMP%TIME ZONE' then 'timestamp'
                when kind like 'TIMESTAMP%' then 'timestamp_ntz' else lower(kind) end as kind,
                count(*) as n_values from k group by all""",
        "named_udf": """select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * 2.0::double as blended
            from lineitem""",
        "map_rows": "select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) as revenue from lineitem",
        "map_values": "select o_custkey, o_orderkey, o_totalprice * 2 as doubled from orders",
        "flat_map": """with d as (select doc_id, string_split(text, chr(10)) as lines from documents)
            select doc_id, cast(unnest(range(0, len(lines))) as integer) as pos, unnest(lines) as line from d""",
        "flat_map_values": """with w as (select doc_id, unnest(string_split(text, ' ')) as word from documents)
            select doc_id, word from w where length(word) > 14""",
        "flat_map_udtf": """with d as (select doc_id, string_split(text, chr(10)) as lines from documents),
                l as (select doc_id, cast(unnest(range(0, len(lines))) as integer) as pos, unnest(lines) as line from d)
            select doc_id, pos, line from l where line <> ''""",
        "flat_map_by_key": """with b as (select o_custkey, o_orderkey, o_totalprice, max(o_totalprice) over (partition by o_custkey
                order by o_orderkey rows between unbounded preceding and 1 preceding) as most from orders)
            select o_custkey, o_orderkey, o_totalprice,
                cast(row_number() over (partition by o_custkey order by o_orderkey) as integer) as record
            from b where most is null or o_totalprice > most""",
        "tile_files": f"with {_TILES} select img_id, x, y, i, v from pv where x >= 3 and x < 7 and y <= 5",
        "zone_map_tiles": f"""with {_TILES},
            s as (select img_id, x, y, max(v) as most, avg(v) as mean, cast(sum(v) as bigint) as total from pv group by all)
            select s.img_id, s.x, s.y, most, cast(min(i) as integer) as brightest, total
            from s join pv on pv.img_id = s.img_id and pv.x = s.x and pv.y = s.y and pv.v = s.most
            where most > 40 and mean > 0 group by all""",
        "rectangle_sum": _sql_mosaic() + " select img_id, x, y, i, s from mosaic where x between 2 and 5 and y between 4 and 8",
        "rectangle_tiles": _sql_mosaic() + """ select img_id, x, y, i, s from mosaic
            where img_id = '2' and x between 2 and 5 and y between 4 and 8""",
        "stored_diff": f"""with {_TILES},
            pr as (select img_id, x as tx, y as ty, x + dx as x, y + dy as y
                   from t, range(-1, 2) ox(dx), range(-1, 2) oy(dy) where x + dx > 0 and y + dy > 0),
            m as (select img_id, tx as x, ty as y, i, sum(case when v > 20 then 0 else v end) as a,
                      sum(case when v > 20 or (img_id = '0' and v < -20) then 0 else v end) as b
                  from pr join pv using (img_id, x, y) group by all)
            select img_id, x, y, 'both' as side, count(*) filter (a <> b) as n_diff from m group by all""",
        "group_by": """select l_suppkey, l_returnflag, count(*) as n_lines,
            cast(sum(cast(l_quantity as bigint)) as bigint) as quantity,
            min(l_extendedprice) as least, max(l_extendedprice) as most from lineitem group by all""",
        "image_manifest": _sql_mosaic() + """ select img_id, cast((x * 10 + y) // 30 as integer) as part,
            count(distinct x * 10 + y) as n_tiles, cast(1 as bigint) as n_files from mosaic group by all""",
        "mosaic_shape": _sql_mosaic() + """ select distinct img_id, x, y, 8 as declared0, 4 as declared1, 2 as declared2,
            8 as found0, 4 as found1, 2 as found2 from mosaic""",
        "hot_tile_sum": _HOT, "hot_tile_sum_partial": _HOT,
        "strategy_diff_limits": f"""with {_TILES},
            pr as (select img_id, x as tx, y as ty, x + dx as x, y + dy as y
                   from t, range(-1, 2) ox(dx), range(-1, 2) oy(dy) where x + dx > 0 and y + dy > 0),
            a as (select img_id, tx as x, ty as y, i, sum(case when v > 20 then 0 else v end) as s from pr
                  join pv using (img_id, x, y) where not (x <= 2 and y <= 2) group by all),
            b as (select img_id, tx as x, ty as y, i, sum(case when v > 60 then 0 else v end) as s from pr
                  join pv using (img_id, x, y) where not (x = 9 and y >= 8) group by all),
            j as (select img_id, x, y, i, a.s as sa, b.s as sb from a full join b using (img_id, x, y, i)),
            k as (select img_id, x, y, case when count(sb) = 0 then 'left' when count(sa) = 0 then 'right' else 'both' end as side,
                  count(*) filter (sa is distinct from sb) as n_diff from j group by all)
            select img_id, x, y, side, n_diff from k where side <> 'both' or n_diff > 0""",
        "fragment_tiles": f"""with {_TILES},
            pr as (select img_id as request, gx.x as tx, gy.y as ty, gx.x + dx as x, gy.y + dy as y
                   from (select distinct img_id from t), range(0, 10) gx(x), range(0, 10) gy(y), range(-1, 1) ox(dx), range(-1, 1) oy(dy))
            select request, tx as x, ty as y, i, cast(sum(case when v > 20 then 0 else v end) as bigint) as s
            from pr join pv on pv.img_id = pr.request and pv.x = pr.x and pv.y = pr.y group by all""",
    }


# --- training-data operators, where their package is present -----------------------------


def _optional() -> tuple[dict, dict]:
    here = Path(__file__).resolve().parent
    if not ((here / "llm" / "queries.py").exists() and (here / "corpus_pipeline.py").exists()):
        return {}, {}
    # where they are present, a failing import is an error like any other
    from llm.queries import QUERIES, SQL

    import corpus_pipeline

    sql = dict(SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return library_queries() | _optional()[0]


def oracle_sql() -> dict[str, str]:
    return library_sql() | _optional()[1]
