"""Sorted groups inside Arrow streams, and connected components of a table of links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import saved


def tables_by_key(batches, keys: list[str]):
    """``(key values, table)`` of every run of equal keys in sorted batches."""
    waiting, at = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if waiting and key != at:
                yield at, pa.Table.from_batches(waiting)
                waiting = []
            at = key
            waiting.append(batch.slice(a, b - a))
    if waiting:
        yield at, pa.Table.from_batches(waiting)


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, label`` of every linked node: the least node of its connected component.

    Each round gives a node the least label among its neighbours, then the label of that
    label, so a path of length n takes about log n rounds.  Every round is written, which
    cuts the lineage; the driver sees only whether anything changed.
    """
    both = saved(links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct(), "links")
    labels = saved(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("least"))
        hooked = labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "least").alias("next"))
        # the root a label stood for learns of the smaller label too
        told = hooked.groupBy(F.col("label").alias("node")).agg(F.min("next").alias("told"))
        hooked = saved(hooked.join(told, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("next", F.coalesce("told", "next")).alias("next")), "labels")
        far = hooked.select(F.col("node").alias("_at"), F.col("next").alias("_far"))
        jumped = saved(hooked.join(far, hooked.next == far["_at"]).select(
            "node", "old", F.least("next", "_far").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label <> old").isEmpty():
            return labels
