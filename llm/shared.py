"""Tables written to the folder that all executors share, to cut lineage and reuse results."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a temporary folder in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local.setdefault("folder", "file://" + tempfile.mkdtemp(prefix="llm-"))
    return f"{folder.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def open_uri(uri: str):
    """A file system and a path in it, for a URI that Spark knows."""
    return pafs.FileSystem.from_uri(re.sub("^s3a:", "s3:", re.sub("^file:/(?!/)", "file:///", uri)))


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Rows that Spark hands to Python at once, in bytes.
BATCH_BYTES = "8m"


def quoted(column: str) -> Column:
    """A column by a name of any characters."""
    return F.col("`" + column.replace("`", "``") + "`")


def packed(columns) -> Column:
    """Columns of any names as one struct, ``row``, which later columns cannot clash with.
    The text is left out: it travels beside them, once."""
    rest = [c for c in columns if c != "text"] or ["text"]
    return F.struct(*map(quoted, rest)).alias("row")


def unpacked(column: str) -> Column:
    return F.col("text") if column == "text" else F.col("row").getField(column).alias(column)


def beside_row(rows: DataFrame, columns: str) -> StructType:
    """The schema of the packed ``row`` of ``rows`` and, after it, of ``columns``.  (As text it could
    not hold column names of any characters.)"""
    return StructType([rows.schema["row"], *StructType.fromDDL(columns).fields])


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session, and so what a Python task holds of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the length of a ``with`` block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read from there.

    A lost executor then costs a reread only, and the shuffle files behind the table are
    removed as soon as it is written.  Tables stay until the folder is cleared.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with setting(spark, _CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
