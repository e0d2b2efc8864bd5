"""From requests to output tiles to the input tiles they need.

Everything here works on light keys.  An expansion makes many rows of few, so its first
half is dealt out to ``partitions`` tasks (default: the session's shuffle partitions) before
the second multiplies it; the rest are narrow generators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..grid import TileGrid
from ..sources.requests import request_weights


def _steps(first, last, step=1) -> Column:
    return F.sequence(*(F.lit(v).cast("bigint") for v in (first, last, step)))


def spread(df: DataFrame) -> int:
    """Tasks for rows that multiply or cost much, but weigh little: the shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _expand(reqs: DataFrame, z: int, xs: tuple, ys: tuple, kind: str,
            partitions: int | None = None) -> DataFrame:
    rest = [c for c in reqs.columns if c not in ("request", "img_id")]
    count = lambda first, last, step=1: (last - first) // step + 1
    # the longer axis first: its rows are dealt out, also if there is a single image
    (one, first), (two, second) = (("x", xs), ("y", ys)) if count(*xs) >= count(*ys) else (("y", ys), ("x", xs))
    out = reqs.select(F.col("img_id").alias("request"), "img_id", *rest,
                      F.lit(z).cast("bigint").alias("z"), F.explode(_steps(*first)).alias(one))
    # an explicit number: adaptive coalescing would judge these rows by their few bytes
    out = out.repartition(partitions or spread(reqs), "img_id", one)
    return (out.select("*", F.explode(_steps(*second)).alias(two))
            .select("request", "img_id", *rest, "z", "x", "y", F.lit(kind).alias("type")))


def expand_requests(reqs: DataFrame, grid: TileGrid, partitions: int | None = None) -> DataFrame:
    """Every output tile of every requested image, at pixel offsets."""
    return _expand(reqs, grid.z, (0, grid.im_w - 1, grid.tile_w),
                   (0, grid.im_h - 1, grid.tile_h), "out", partitions)


def expand_index_grid(reqs: DataFrame, last_x: int, last_y: int, z: int = 0,
                      partitions: int | None = None) -> DataFrame:
    """Every target of an index grid whose bounds 0..last_x and 0..last_y are inclusive."""
    return _expand(reqs, z, (0, last_x), (0, last_y), "out", partitions)


def neighbours(targets: DataFrame, offsets, step_x: int = 1, step_y: int = 1,
               source_img: Column | None = None) -> DataFrame:
    """Pair every target with the tiles at ``offsets`` on both axes, unclipped.

    Adds ``source_img_id``, ``sx`` and ``sy``.
    """
    around = lambda c, step: F.array(*[F.col(c) + d * step for d in offsets])
    img = F.col("img_id") if source_img is None else source_img
    return (targets.select("*", img.alias("source_img_id"),
                           F.explode(around("x", step_x)).alias("sx"))
            .select("*", F.explode(around("y", step_y)).alias("sy")))


def grid_neighbours(targets: DataFrame, grid: TileGrid) -> DataFrame:
    """Pair every output tile with the input tiles of its neighbourhood.

    A target left without any input has no pair and so drops out.
    """
    pairs = neighbours(targets, range(-grid.n_size, grid.n_size + 1), grid.tile_w, grid.tile_h)
    if grid.clip == "origin":
        return pairs.where("sx > 0 and sy > 0")
    if grid.clip == "image":
        return pairs.where((F.col("sx") >= 0) & (F.col("sy") >= 0)
                           & (F.col("sx") < grid.im_w) & (F.col("sy") < grid.im_h))
    return pairs


# Fixed value: what the id of the earlier image ends in.
EARLIER = "_old"


def backward_neighbours(targets: DataFrame, suffix: str = EARLIER) -> DataFrame:
    """Pair every target with the 2x2 tiles behind it in the earlier image."""
    return neighbours(targets, (-1, 0), source_img=F.concat("img_id", F.lit(suffix)))


def build_items(reqs: DataFrame, grid: TileGrid, partitions: int | None = None) -> DataFrame:
    """Working rows: request, target and source tile ids, and two pixel columns not yet filled."""
    pairs = grid_neighbours(expand_requests(reqs, grid, partitions), grid)
    key = lambda img, x, y, kind: F.struct(
        F.col(img).alias("img_id"), "z", F.col(x).alias("x"), F.col(y).alias("y"),
        F.lit(kind).alias("type"))
    return pairs.select(
        "request",
        key("img_id", "x", "y", "out").alias("target_tile_id"),
        key("source_img_id", "sx", "sy", "in").alias("source_tile_id"),
        F.lit(None).cast("array<int>").alias("source_tile_data"),
        F.lit(None).cast("array<bigint>").alias("out_tile_data"))


def source_ids(weights: DataFrame, grid: TileGrid, partitions: int | None = None) -> DataFrame:
    """Every input tile the images need, each exactly once.

    The neighbourhoods of a grid cover a rectangle, so the distinct inputs follow from
    its bounds and need no distinct over the pairs.
    """
    (x0, x1), (y0, y1) = grid.source_cols, grid.source_rows
    if x1 < x0 or y1 < y0:
        weights, x0, x1, y0, y1 = weights.where(F.lit(False)), 0, 0, 0, 0
    ids = _expand(weights, grid.z, (x0 * grid.tile_w, x1 * grid.tile_w, grid.tile_w),
                  (y0 * grid.tile_h, y1 * grid.tile_h, grid.tile_h), "in", partitions)
    return ids.drop("request", "type")


def source_fanout(reqs: DataFrame, grid: TileGrid, partitions: int | None = None) -> DataFrame:
    """Every distinct input tile with the output tiles that use it.

    ``targets`` holds at most the neighbourhood; ``n_targets`` also counts repeated
    requests.
    """
    def users(at, n_targets, step):
        last = F.lit((n_targets - 1) * step).cast("bigint")
        reach = grid.n_size * step
        return F.sequence(F.greatest(F.col(at) - reach, F.lit(0).cast("bigint")),
                          F.least(F.col(at) + reach, last), F.lit(step).cast("bigint"))

    ids = source_ids(request_weights(reqs), grid, partitions)
    tx = users("x", grid.cols, grid.tile_w)
    ty = users("y", grid.rows, grid.tile_h)
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    targets = F.flatten(F.transform(tx, lambda x: F.transform(ty, lambda y: point(x, y))))
    return (ids.withColumn("targets", targets)
            .withColumn("n_targets", F.array_size("targets") * F.col("weight"))
            .drop("weight"))
