"""Bring pixels to rows that name a tile."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.tiles import TILE_KEY

MISSING = ("skip", "zero", "error")


def _tile_name(columns):
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns])


def attach_tiles(rows: DataFrame, tiles, at=("img_id", "z", "x", "y"), on_missing: str = "skip",
                 length: int | None = None, shuffle: bool = False, carry=()) -> DataFrame:
    """Add ``pixels`` to every row, found by the four key columns named in ``at``.

    ``tiles`` is a tile table (joined on the key) or a reader (evaluated per row).  A
    tile the table lacks drops the row (``skip``), gives ``length`` zeros (``zero``) or
    fails the query (``error``).  ``shuffle`` rules out a broadcast: set it for
    rows made by an expansion, which the optimizer takes to be fewer than they are.
    ``carry`` names further columns of the table to bring along.
    """
    if on_missing not in MISSING:
        raise ValueError(f"on_missing must be one of {MISSING}")
    if callable(tiles):
        return rows.withColumn("pixels", tiles(*[F.col(c) for c in at]))
    if on_missing == "zero" and length is None:
        raise ValueError("on_missing='zero' needs the tile length")

    named = [f"_tile_{k}" for k in TILE_KEY]
    right = tiles.select(*[F.col(k).alias(n) for k, n in zip(TILE_KEY, named)], "pixels", *carry)
    match = [F.col(a) == F.col(n) for a, n in zip(at, named)]
    right = right.hint("merge") if shuffle else right
    out = rows.join(right, match, "inner" if on_missing == "skip" else "left")
    if on_missing == "zero":
        kind = tiles.schema["pixels"].dataType.simpleString()
        zeros = F.array_repeat(F.lit(0), length).cast(kind)
        out = out.withColumn("pixels", F.coalesce("pixels", zeros))
    elif on_missing == "error":
        failed = F.raise_error(F.concat(F.lit("no tile "), _tile_name(at)))
        out = out.withColumn("pixels", F.when(F.col("pixels").isNull(), failed)
                             .otherwise(F.col("pixels")))
    return out.drop(*named)


def missing_tiles(ids: DataFrame, tiles: DataFrame) -> DataFrame:
    """The wanted tile ids the table has no tile for (reads key columns only)."""
    return ids.join(tiles.select(*TILE_KEY), TILE_KEY, "left_anti")


def assert_unique_tiles(tiles: DataFrame) -> None:
    """Fail if a tile key is listed twice, which would count its pixels twice.

    Runs a job over the key columns; pixels are not read.
    """
    twice = tiles.groupBy(*TILE_KEY).count().where("count > 1").drop("count").first()
    if twice is not None:
        raise ValueError(f"tile listed more than once: {tuple(twice)}")


def check_input_type(items: DataFrame) -> DataFrame:
    """Pass items through; fail the query on one whose source is not an input tile."""
    kind = F.col("source_tile_id.type")
    failed = F.raise_error(F.concat(F.lit("not an input tile: "), kind)).cast("boolean")
    return items.where(F.when(kind.startswith("in"), F.lit(True)).otherwise(failed))
