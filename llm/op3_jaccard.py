"""Jaccard join of word n-gram sets by the chosen-path method.

A document is the set of its five-word shingles; documents with equal sets are one node.  A
set is embedded in min-wise hashed coordinates, each a shingle that two sets share with the
probability of their Jaccard similarity.  In each of several independent runs the nodes are
split by a coordinate, again and again while a bucket is large and still falls apart, each
time by a coordinate that the path so far selects and has not used.  Buckets that remain are searched by
brute force, in tiles of bounded size.  Runs are added until a pair at the threshold is met
with the target probability, given how deep the splitting went.

Pairs never become rows.  A pair belongs to the first run in which both nodes share a
bucket, which the nodes' own lists of buckets tell, so it is counted once.  A first pass
over small sketches finds which nodes of a bucket have partners; only for those are texts
brought in, and shingle sets compared exactly.  What leaves a tile is a count per node and
a spanning set of links; components of these links are the classes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .grouping import components, tables_by_key
from .shared import saved, small_batches
from .words import BLANK_SEPARATED, _mixed, chunks, random_values, run_hashes, words_of

SHINGLE = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
#: Coordinates of the embedding.
COORDINATES = 64
#: Buckets of at most this many nodes are split no further.
SMALL = 128
#: Nodes, and bytes of their texts, of the blocks that a larger bucket is dealt into; the
#: more, the less often a text is sent, as a bucket of b blocks sends each to b tiles.
TILE, TILE_BYTES = 512, 8 << 20
#: A bucket that keeps this share of the one it came from is split no further.
SIMILAR = 0.7
#: Deepest paths, and the runs that the target recall takes at that depth at the most.
MAX_DEPTH, MOST_RUNS = 12, 120
#: Depths whose paths are made at once, while a node's signature is at hand.
LOOKAHEAD = 4
FIRST_RUNS, MORE_RUNS = 8, 4
#: Standard deviations of the sketch estimate below the threshold that still go to the exact check.
MARGIN = 5.0

_MULTIPLIERS = random_values(COORDINATES, 3) | np.uint64(1)
_RUN_BITS = 56


def shingle_hashes(words, size: int):
    """Hashes of all shingles and their rows; a text of fewer words is one shingle."""
    count = np.diff(words.bounds)
    n = np.where(count > 0, np.maximum(count - size + 1, 1), 0)
    row = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + words.bounds[:-1][row]
    return run_hashes(words.hashes, start, np.minimum(start + size, words.bounds[1:][row])), row


def _sets(size):
    def describe(batches):
        for part in chunks(batches):
            hashes, row = shingle_hashes(words_of(part.column("text"), BLANK_SEPARATED), size)
            n = part.num_rows
            signature = np.zeros((n, COORDINATES), np.uint32)
            one, two, count = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.int64)
            if len(hashes):
                first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                having = row[first]
                for k, multiplier in enumerate(_MULTIPLIERS):
                    signature[having, k] = np.minimum.reduceat(hashes * multiplier, first) >> np.uint64(32)
                # the set's name: sums over distinct shingles, in any order
                h = hashes >> np.uint64(16)
                order = np.lexsort((h, row)) if n > 1 << 16 else np.argsort((row.astype(np.uint64) << np.uint64(48)) | h)
                h, r = h[order], row[order]
                fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])
                h, r = h[fresh], r[fresh]
                first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
                one[having] = np.add.reduceat(_mixed(h), first)
                two[having] = np.add.reduceat(_mixed(h ^ np.uint64(0x5851F42D4C957F2D)), first)
                count[having] = np.diff(np.append(first, len(h)))
            name = np.stack([one, two], axis=1).view(np.uint8).reshape(n, 16)
            names = pa.array([name[i].tobytes() if count[i] else None for i in range(n)], pa.binary())
            flat = pa.array(signature.view(np.int32).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * COORDINATES, COORDINATES, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "doc", "tie", "n_bytes")), names, lists],
                ["doc_id", "doc", "tie", "n_bytes", "node", "signature"])

    return describe


def identity() -> list:
    """A row's place: by doc_id, null last, then by a hash of its text."""
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64("text").alias("tie")]


def runs_needed(depth: int, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> int:
    """Runs after which a pair at the threshold has shared ``depth`` coordinates in one at least."""
    meet = threshold ** depth
    return 1 if meet >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _with_paths(rows: DataFrame, run, last, depth: int) -> DataFrame:
    """``node, n_bytes, parent`` and ``paths``, those of the next ``LOOKAHEAD`` depths after ``depth``: each
    named after the one before, first ``last``, and the coordinate that it draws."""
    rows = rows.select("node", "n_bytes", "parent", "signature", run.alias("_run"), last.alias("_p0"))
    for k in range(1, LOOKAHEAD + 1):
        # coordinates are shared out among the depths, anew in each run: none comes twice on a path
        drawn = F.floor(F.col("_run") / MAX_DEPTH) if depth + k == 1 else F.xxhash64(f"_p{k - 1}")
        place = (F.pmod(F.col("_run") + (depth + k - 1), F.lit(MAX_DEPTH))
                 + F.pmod(drawn, F.lit(COORDINATES // MAX_DEPTH)) * MAX_DEPTH)
        name = F.xxhash64(f"_p{k - 1}", F.element_at("signature", (place + 1).cast("int")))
        rows = rows.withColumn(f"_p{k}", F.shiftleft("_run", _RUN_BITS).bitwiseOR(name.bitwiseAND(F.lit((1 << _RUN_BITS) - 1))))
    return rows.select("node", "n_bytes", "parent", F.array(*[f"_p{k}" for k in range(1, LOOKAHEAD + 1)]).alias("paths"))


def _split(nodes: DataFrame, runs: range):
    """The buckets of some runs, ``node, path, n, bytes``, and the deepest path.  The run is the
    uppermost byte of a path."""
    rows = nodes.select("*", F.explode(F.array(*[F.lit(r).cast("bigint") for r in runs])).alias("run"),
                        F.lit(1 << 62).alias("parent"))
    rows = _with_paths(rows, F.col("run"), F.col("run"), 0)
    found, depth = [], 1
    while True:
        rows = rows.withColumn("path", F.element_at("paths", (depth - 1) % LOOKAHEAD + 1))
        size = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("bytes")).where("n > 1")
        rows = saved(rows.join(size, "path"), "buckets")
        done = (F.col("n") <= SMALL) | (F.col("n") >= SIMILAR * F.col("parent")) | F.lit(depth >= MAX_DEPTH)
        found.append(rows.where(done).select("node", "path", "n", "bytes"))
        rows = rows.where(~done).select("node", "n_bytes", "path", "paths", F.col("n").alias("parent"))
        if rows.isEmpty():
            break
        if depth % LOOKAHEAD == 0:
            rows = rows.drop("paths").join(nodes.select("node", "signature"), "node")
            rows = _with_paths(rows, F.shiftrightunsigned("path", _RUN_BITS), F.col("path"), depth)
        rows, depth = rows.drop("path"), depth + 1
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole, depth


def buckets(nodes: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """Buckets of all runs; runs are repeated until ``recall`` is reached at the depth met."""
    whole, depth = _split(nodes, range(FIRST_RUNS))
    done = FIRST_RUNS
    while done < (needed := runs_needed(depth, threshold, recall)):
        if needed > MOST_RUNS:
            raise ValueError(f"a recall of {recall} at depth {depth} takes more than {MOST_RUNS} runs")
        upto = min(max(done + MORE_RUNS, needed), MOST_RUNS)
        more, deeper = _split(nodes, range(done, upto))
        whole, depth, done = whole.union(more), max(depth, deeper), upto
    return whole


def _tiled(rows: DataFrame, tile: int, tile_bytes: int) -> DataFrame:
    """Deals the nodes of each bucket to blocks of about ``tile`` nodes and ``tile_bytes`` of
    text at most; a row for each pair of blocks (``low <= high``) that a node's is part of."""
    blocks = F.greatest(F.ceil(F.col("n") / tile), F.ceil(F.col("bytes") / tile_bytes)).cast("int")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.select("*", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")).drop("other")


def _candidates(path, low, high, part, sketches, lists, threshold):
    """Places (i, j) of pairs whose sketches come close and whose first common bucket is this
    one; in a tile of two blocks, pairs between the blocks."""
    own = np.arange(len(part))
    left, right = (own, own) if low == high else (own[part == low], own[part == high])
    least = COORDINATES * threshold - MARGIN * math.sqrt(COORDINATES * threshold * (1 - threshold))
    equal = np.zeros((len(left), len(right)), np.uint8)
    for k in range(COORDINATES):
        equal += sketches[left, k][:, None] == sketches[right, k]
    i, j = np.nonzero(equal >= least)
    if low == high:
        i, j = i[i < j], j[i < j]
    i, j = left[i], right[j]
    same = (lists[i] == lists[j]) & (lists[i] != 0)
    first = lists[i, same.argmax(axis=1)] if len(i) else lists[:0, 0]
    meet = (first == path) if len(i) else np.zeros(0, bool)
    return i[meet], j[meet]


def _tile_columns(table):
    n = len(table)
    sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(n, COORDINATES)
    flat = table.column("paths").combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(n), np.diff(flat.offsets.to_numpy()))
    run = values >> _RUN_BITS
    lists = np.zeros((n, int(run.max(initial=0)) + 1), np.int64)
    lists[row, run] = values
    return table.column("part").to_numpy(), sketches, lists


def _useful(threshold):
    """Of the rows of a tile, those that have a candidate in it."""
    def search(batches):
        for (path, low, high), table in tables_by_key(batches, ["path", "low", "high"]):
            if len(table) > 1:
                i, j = _candidates(path, low, high, *_tile_columns(table), threshold)
                if len(i):
                    yield from table.take(pa.array(np.unique(np.concatenate([i, j])))).to_batches()

    return search


def _shared_shingles(table, size):
    """Sizes of the shingle sets, and the matrix of how many each two have in common."""
    m, parts, done = len(table), [], 0
    for part in chunks(table.select(["text"]).combine_chunks().to_batches()):
        hashes, row = shingle_hashes(words_of(part.column("text"), BLANK_SEPARATED), size)
        parts.append((hashes, row + done))
        done += part.num_rows
    hashes, row = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(hashes, kind="stable")  # rows ascend within a hash
    h, r = hashes[order], row[order]
    fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])]) if len(h) else np.zeros(0, bool)
    h, r = h[fresh], r[fresh]
    sizes = np.bincount(r, minlength=m)
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    number = np.cumsum(new) - 1
    often = np.bincount(number, minlength=1) > 1
    keep = often[number] if len(number) else new
    r, number = r[keep], np.cumsum(new & keep)[keep] - 1 if keep.any() else number[keep]
    common = np.zeros((m, m), np.float32)
    width = 8192
    for start in range(0, int(number.max(initial=-1)) + 1, width):
        a, b = np.searchsorted(number, [start, start + width])
        member = np.zeros((m, width), np.float32)
        member[r[a:b], number[a:b] - start] = 1
        common += member @ member.T
    return sizes, common


def _verify(threshold, size):
    """Exact links of a tile: a count per node, and its root in the tile's graph."""
    def check(batches):
        for (path, low, high), table in tables_by_key(batches, ["path", "low", "high"]):
            table = _distinct_nodes(table)
            if len(table) < 2:
                continue
            i, j = _candidates(path, low, high, *_tile_columns(table), threshold)
            if not len(i):
                continue
            sizes, common = _shared_shingles(table, size)
            both = common[i, j].astype(np.float64)
            # s / (a + b - s) >= t without a division, exact for whole numbers up to rounding
            linked = both * (1 + threshold) >= threshold * (sizes[i] + sizes[j]) - 1e-9
            i, j = i[linked], j[linked]
            if not len(i):
                continue
            degree = np.bincount(i, minlength=len(table)) + np.bincount(j, minlength=len(table))
            root = np.arange(len(table))
            while True:
                low_root = np.minimum(root[i], root[j])
                before = root.copy()
                np.minimum.at(root, root[i], low_root)
                np.minimum.at(root, root[j], low_root)
                root = root[root]
                if (root == before).all():
                    break
            at = np.flatnonzero(degree)
            node = table.column("node")
            yield pa.RecordBatch.from_arrays(
                [node.take(pa.array(at)).combine_chunks(), node.take(pa.array(root[at])).combine_chunks(),
                 pa.array(degree[at].astype(np.int64))], ["node", "root", "links"])

    return check


def _distinct_nodes(table):
    seen, keep = set(), []
    for k, node in enumerate(table.column("node").to_pylist()):
        if node not in seen:
            seen.add(node)
            keep.append(k)
    return table if len(keep) == len(table) else table.take(pa.array(keep))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE,
                    recall: float = TARGET_RECALL, tile: int = TILE, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """``doc_id, doc, tie, class_id, n_links, kept`` for every row of ``docs``.

    ``kept`` marks the first document of each class.  ``class_id`` is the smallest doc_id of the class: documents of equal shingle sets, and
    all that links of similarity ``threshold`` or more join.  ``n_links`` counts the other
    shingle sets that the document's own is similar to.  Null texts and texts without words
    have no set: each is a class of its own, without links.  Texts of one to four words are
    one shingle.  Repeated rows are documents of one class.  A null doc_id is never a
    class_id unless the whole class has none.  An empty table gives no rows; other columns
    are not read.
    """
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", *identity(), "text")
    sized = texts.select("*", F.octet_length("text").cast("bigint").alias("n_bytes"))
    listed = saved(sized.mapInArrow(
        _sets(size), "doc_id bigint, doc bigint, tie bigint, n_bytes bigint, node binary, signature array<int>"), "sets")
    nodes = saved(listed.where("node is not null").groupBy("node").agg(
        F.min(F.struct("doc", "tie")).alias("first"), F.min("doc_id").alias("least_id"),
        F.max("n_bytes").alias("n_bytes"), F.first("signature").alias("signature")), "nodes")
    per_node = buckets(nodes.select("node", "n_bytes", "signature"), threshold, recall).groupBy("node").agg(
        F.collect_list(F.struct("path", "n", "bytes")).alias("in"))
    sketch = F.concat(*[F.unhex(F.lpad(F.hex(F.element_at("signature", k + 1).bitwiseAND(F.lit(255))), 2, "0"))
                        for k in range(COORDINATES)])
    member = per_node.join(nodes.select("node", "first", sketch.alias("sketch")), "node")
    member = member.select("node", "first", "sketch", F.col("in.path").alias("paths"), F.explode("in").alias("b"))
    member = saved(member.select("node", "first", "sketch", "paths", "b.*"), "members")
    keys, n = ["path", "low", "high"], int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda rows: rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    tiles = dealt(_tiled(member, tile, tile_bytes))
    useful = saved(tiles.mapInArrow(_useful(threshold), tiles.schema), "useful")
    wanted = useful.select("*", "first.*").drop("first")
    with_text = wanted.join(texts.select("doc", "tie", "text"), ["doc", "tie"])
    links = saved(dealt(with_text).mapInArrow(_verify(threshold, size), "node binary, root binary, links bigint"), "links")
    label = components(nodes.select("node"), links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degree = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("node", "first", "least_id").join(label, "node", "left").join(degree, "node", "left")
    named = saved(named.select("node", "first", "least_id", F.coalesce("label", "node").alias("label"),
                               F.coalesce("links", F.lit(0)).alias("links")), "named")
    classes = named.groupBy("label").agg(F.min("least_id").alias("class_id"), F.min("first").alias("kept"))
    named = saved(named.join(classes, "label").select("node", "class_id", "kept", "links"), "classes")
    alone = F.col("node").isNull()
    return listed.select("doc_id", "doc", "tie", "node").join(named, "node", "left").select(
        "doc_id", "doc", "tie", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"), (alone | (F.col("kept") == F.struct("doc", "tie"))).alias("kept"))


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that come first in their class; of rows equal in
    doc_id and text one stays."""
    kept = near_duplicates(docs, **options).where("kept").select("doc", "tie").distinct()
    rows = docs.select(F.struct("*").alias("row"), *identity()).join(kept, ["doc", "tie"])
    copy = F.row_number().over(Window.partitionBy("doc", "tie").orderBy("doc"))
    return rows.select("row", copy.alias("copy")).where("copy = 1").select("row.*")


def q_op3_jaccard(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "n_links")
