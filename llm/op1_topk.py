"""Exact top-k inner products with Fagin's threshold algorithm.

Queries and candidates are dealt into blocks and shards; every pair of a block and a shard
is one task-sized piece of work, joined on the pair's number.  In a shard the candidates are
sorted once per dimension.  For a query, all lists are read from their better end together;
candidates met are scored in full, and reading stops when the best score an unseen candidate
could have (the query times the values at the reading positions) is below the kth score.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: Candidates of a shard and queries of a block.
SHARD_ROWS = 8192
BLOCK_ROWS = 4096
#: Entries read from every list before the first stop test; each further round doubles the depth.
FIRST_DEPTH = 32

SCALE, K, QUERY_STEP = 64, 20, 20


class SortedLists:
    """The vectors of a shard in the order of every dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable")  # ascending, a column per dimension

    def top(self, query_id: int, query: np.ndarray, k: int, first_depth: int = FIRST_DEPTH):
        """Places and scores of the k best rows with another id, ties to the smaller id."""
        n, used = len(self.ids), np.flatnonzero(query)
        if not len(used):  # every score is 0
            places = np.flatnonzero(self.ids != query_id)[:k]
            return places, np.zeros(len(places), self.vectors.dtype)
        falling = query[used] > 0
        seen = np.zeros(n, bool)
        places, scores = np.zeros(0, np.int64), np.zeros(0, self.vectors.dtype)
        done, depth = 0, min(first_depth, n)
        while True:
            parts = self.lists[n - depth:n - done][:, used[falling]], self.lists[done:depth][:, used[~falling]]
            met = np.zeros(n, bool)
            for part in parts:
                met[part.ravel()] = True
            met &= ~seen
            seen |= met
            fresh = np.flatnonzero(met)
            fresh = fresh[self.ids[fresh] != query_id]
            places = np.concatenate([places, fresh])
            scores = np.concatenate([scores, self.vectors[fresh] @ query])
            if len(places) > k:
                best = np.lexsort((places, -scores))[:k] if len(places) < 4 * k else self._best(places, scores, k)
                places, scores = places[best], scores[best]
            if depth == n or seen.all():
                return places, scores
            if len(places) >= k:
                edge = np.where(falling, n - depth, depth - 1)
                bound = query[used] @ self.vectors[self.lists[edge, used], used]
                if bound < scores.min():
                    return places, scores
            done, depth = depth, min(2 * depth, n)

    @staticmethod
    def _best(places, scores, k):
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        close = np.flatnonzero(scores >= kth)
        return close[np.lexsort((places[close], -scores[close]))[:k]]


def _vectors(table: pa.Table) -> np.ndarray:
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(table), -1) if len(table) else flat.reshape(0, 0)


def _search(k):
    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        ids, rows = candidates.column("vec_id").to_numpy(), _vectors(candidates)
        query_ids, asked = queries.column("vec_id").to_numpy(), _vectors(queries)
        out = []
        if len(ids) and len(query_ids):
            bound = np.abs(rows).max(initial=0).astype(float) * np.abs(asked).max(initial=0).astype(float)
            # doubles are exact while no sum can reach 2**53
            kind = np.float64 if bound * max(1, rows.shape[1]) < 2.0 ** 53 else np.int64
            lists = SortedLists(ids, rows.astype(kind))
            for query_id, query in zip(query_ids, asked.astype(kind)):
                places, scores = lists.top(query_id, query, k)
                out.append((np.full(len(places), query_id), lists.ids[places], scores.astype(np.int64)))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    return search


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector``: components as ``floor(scale * x)``; null vectors and ids, and vectors
    with a null or non-finite component, take no part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    component = lambda x: F.floor(x.cast("double") * scale)
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
                            & F.forall("embedding", finite)).select(
        "vec_id", F.transform("embedding", component).alias("vector"))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best inner products of every query.

    Both tables have ``vec_id, vector`` (arrays of whole numbers, not null).  Only vectors of
    equal length are compared; candidates of the query's own id take no part; ties go to the
    smaller vec_id.  A query row given twice is answered once; a candidate row given twice
    is two candidates.  Empty tables give no rows; fewer candidates than k give all of them.
    Scores beyond 64 bits wrap around.
    """
    size = F.size("vector").alias("length")
    queries = queries.select("vec_id", "vector", size).distinct()
    shards = max(1, math.ceil(candidates.count() / shard_rows))
    blocks = max(1, math.ceil(queries.count() / block_rows))
    deal = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n))
    left = (candidates.select("vec_id", "vector", size, deal(shards).alias("shard"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    right = (queries.select("*", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int").alias("block"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))))
    keys = ["shard", "block", "length"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _search(k), "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def q_op1_topk(spark, sf_dir):
    vectors = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors.where(F.col("vec_id") % QUERY_STEP == 0), vectors)


SQL = """
with v as (select vec_id, [cast(floor(cast(x as double) * 64) as bigint) for x in embedding] as v from embeddings
    where vec_id is not null and len(embedding) = len([x for x in embedding if isfinite(x)])),
s as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""
