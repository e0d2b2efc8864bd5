"""Requests: which images to build."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def request_list(spark: SparkSession, ids) -> DataFrame:
    """Requests from a short list of image ids held by the caller.

    Handed over in Arrow form, whose size the optimizer knows: it can then filter a large
    tile table by a broadcast of the requests and need not shuffle it first.
    """
    return spark.createDataFrame(pa.table({"img_id": pa.array(list(ids), pa.string())}))


def requests(df: DataFrame, id_col: str = "img_id") -> DataFrame:
    """Requests from any table; a one-field record such as ``struct<url>`` is unwrapped."""
    kind = df.schema[id_col].dataType
    column = F.col(id_col)
    if isinstance(kind, StructType):
        column = column[kind.names[0]]
    return df.select(column.cast("string").alias("img_id"))


def request_weights(reqs: DataFrame) -> DataFrame:
    """Distinct requests with the number of times each was made.

    Equal requests give equal tiles whose sums add up, so a request made k times is
    built once and scaled by k.  The count is combined before the shuffle, which keeps
    one much-repeated request from loading a single task.
    """
    return reqs.groupBy("img_id").agg(F.count(F.lit(1)).alias("weight"))
