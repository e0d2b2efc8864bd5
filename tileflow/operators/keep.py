"""Light tables that are used more than once, held by the executors for as long as they are."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """``with kept(keys) as keys:`` computes the rows once and reads them from storage inside.

    For key tables and requests, not pixels.  All partitions are computed at the start, by a
    count; at the end, also after an error, the storage is released.  A partition that is
    lost with its executor is computed again.
    """
    df = df.persist(level)
    try:
        df.count()
        yield df
    finally:
        df.unpersist(blocking=True)
