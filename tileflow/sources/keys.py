"""Light key tables: tile ids without any pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def tile_key(img_id, z, x, y, kind) -> Column:
    """A tile id as one struct column."""
    return F.struct(img_id.cast("string").alias("img_id"), z.cast("bigint").alias("z"),
                    x.cast("bigint").alias("x"), y.cast("bigint").alias("y"),
                    kind.alias("type"))


def key_table(df: DataFrame, id_col: str = "id") -> DataFrame:
    """One input-tile key on the diagonal (x = y = id) for every row of ``df``."""
    at = F.col(id_col)
    return df.select(tile_key(F.lit(""), F.lit(0), at, at, F.lit("in")).alias("key")).select("key.*")
