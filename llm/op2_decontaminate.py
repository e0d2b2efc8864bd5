"""Benchmark decontamination with suffix arrays of the training text.

Every task builds suffix arrays over the words of its own documents, one per Arrow batch (a
shard), and binary-searches the suffixes of the benchmark items in it.  Words that no item
has cannot be part of a match; only runs of known words that are long enough enter the
array, and only suffixes all of whose window's words are in the shard are searched.

Documents never move.  The benchmark is cut in blocks of a few megabytes, which tasks prepare
and write to the shared folder; a task reads one block at a time for each of its shards.
The driver holds the names of the blocks' files and no item.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from .shared import beside_row, open_uri, packed, saved, setting, small_batches, unpacked
from .words import ALPHANUMERIC, chunks, words_of

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
#: Benchmark text of a block, in bytes: a task needs about ten times as much for it, and more for
#: the part of it that a shard may hold.
BLOCK_BYTES = 4 << 20

_REPORT = "n_words bigint, hits array<bigint>, items array<string>, longest int, longest_item string, longest_at bigint"
_MASK = 0xFFFFFFFF


@dataclass
class TestBlock:
    """Items as numbers of their words, and the suffixes that begin with a whole window."""

    vocabulary: np.ndarray  # sorted hashes; word i has number i + 1
    tokens: np.ndarray  # all items, a 0 after each
    starts: np.ndarray  # of the suffixes
    lengths: np.ndarray  # of their windows
    owners: np.ndarray  # index of the item
    names: list[str]
    longest: int


def test_block(items: pa.Table, window: int = WINDOW) -> TestBlock | None:
    words = words_of(items.column("text").combine_chunks(), ALPHANUMERIC, lower=True)
    if not len(words.starts):
        return None
    vocabulary, numbers = np.unique(words.hashes, return_inverse=True)
    count = np.diff(words.bounds)
    row = words.row_of_word()
    tokens = np.zeros(len(numbers) + len(count), np.int64)
    place = np.arange(len(numbers)) + row
    tokens[place] = numbers + 1
    length = np.minimum(count, window)[row]
    left = words.bounds[1:][row] - np.arange(len(numbers))
    is_suffix = left >= length
    return TestBlock(vocabulary, tokens, place[is_suffix], length[is_suffix], row[is_suffix],
                     items.column("name").to_pylist(), int(count.max()))


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes in order of their first ``depth`` tokens at least."""
    _, rank = np.unique(tokens, return_inverse=True)
    done, n = 1, len(tokens)
    while done < depth and rank.max(initial=0) + 1 < n:
        follow = np.zeros(n, np.int64)
        follow[:-done or n] = rank[done:] + 1
        _, rank = np.unique(rank * np.int64(n + 1) + follow, return_inverse=True)
        done *= 2
    return np.argsort(rank, kind="stable")


def _possible(tokens, block):
    """The suffixes whose window has no word that is not among ``tokens``."""
    there = np.zeros(len(block.vocabulary) + 1, bool)
    there[tokens] = True
    missing = np.concatenate([[0], np.cumsum(~there[block.tokens])])
    return np.flatnonzero(missing[block.starts + block.lengths] == missing[block.starts])


def _ranges(tokens, order, block, chosen):
    """The part of the suffix array that begins with the window of each chosen suffix."""
    width = int(block.lengths[chosen].max(initial=1))
    column = np.arange(width)
    counts = column < block.lengths[chosen, None]
    padded = np.concatenate([tokens, np.full(width, -1)])
    test = np.concatenate([block.tokens, np.zeros(width, np.int64)])[block.starts[chosen, None] + column]
    bounds = []
    for after_equal in (False, True):
        low, high = np.zeros(len(test), np.int64), np.full(len(test), len(order))
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            found = padded[order[middle][:, None] + column]
            differs = (found != test[open_]) & counts[open_]
            first = differs.argmax(axis=1)
            at = np.arange(len(open_))
            sign = np.where(differs[at, first], np.sign(found[at, first] - test[open_, first]), 0)
            right = (sign < 0) | ((sign == 0) & after_equal)
            low[open_] = np.where(right, middle + 1, low[open_])
            high[open_] = np.where(right, high[open_], middle)
        bounds.append(low)
    return bounds


def _matches(batch, block):
    """Words per row, and each match: its row, start in the row, window length, suffix, full length."""
    n_words, parts, row0 = [], [], 0
    shortest = int(block.lengths.min())
    for part in chunks([batch]):
        words = words_of(part.column("text"), ALPHANUMERIC, lower=True)
        n_words.append(np.diff(words.bounds))
        at = np.minimum(np.searchsorted(block.vocabulary, words.hashes), len(block.vocabulary) - 1)
        known = block.vocabulary[at] == words.hashes
        edge = np.zeros(len(known) + 1, bool)
        edge[words.bounds] = True
        begins = known & (edge[:-1] | ~np.concatenate([[False], known[:-1]]))
        run = np.cumsum(begins) - 1
        lengths = np.bincount(run[known], minlength=1)
        keep = np.flatnonzero(known)
        keep = keep[lengths[run[keep]] >= shortest]
        row = words.row_of_word()[keep]
        parts.append((at[keep] + 1, row + row0, keep - words.bounds[row], run[keep]))
        row0 += part.num_rows
    n_words = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
    number, row, place, run = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 4
    if not len(number):
        return n_words, None
    # a 0 between runs: no match goes from one to the next
    new = np.zeros(len(number), np.int64)
    new[1:] = (run[1:] != run[:-1]) | (row[1:] != row[:-1])
    shifted = np.arange(len(number)) + np.cumsum(new)
    tokens = np.zeros(shifted[-1] + 2, np.int64)
    tokens[shifted] = number
    source = np.zeros(len(tokens), np.int64)
    source[shifted] = np.arange(len(number))
    order = suffix_array(tokens, block.longest)
    chosen = _possible(tokens[shifted], block)
    low, high = _ranges(tokens, order, block, chosen)
    suffix = np.repeat(chosen, high - low)
    within = np.arange(len(suffix)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    found = order[np.repeat(low, high - low) + within]
    # the full length of every match: on while both sides have the same word
    full = block.lengths[suffix].copy()
    pad = np.concatenate([tokens, [0]])
    open_ = np.arange(len(full))
    while open_.size:
        a = pad[np.minimum(found[open_] + full[open_], len(pad) - 1)]
        b = block.tokens[np.minimum(block.starts[suffix[open_]] + full[open_], len(block.tokens) - 1)]
        open_ = open_[(a == b) & (a > 0)]
        full[open_] += 1
    at = source[found]
    return n_words, (row[at], place[at], block.lengths[suffix], suffix, full)


def _merged(starts, ends):
    """Sorted disjoint spans of the given ones, as start * 2**32 + end."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return (starts[new] << 32) | ends[last]


def _prepared(window):
    """The rows of a block of items as one row, ``payload``: its pickled ``TestBlock``."""
    def prepare(items: pa.Table) -> pa.Table:
        block = test_block(items, window)
        found = [] if block is None else [pickle.dumps(vars(block), protocol=5)]
        return pa.table({"payload": pa.array(found, pa.binary())})

    return prepare


def _blocks_of(files):
    """The blocks in files of one such row, one in memory at a time; a lone block stays."""
    last = {}

    def blocks():
        for name in files:
            if name not in last:
                last.clear()
                fs, path = open_uri(name)
                with fs.open_input_file(path) as file:
                    last[name] = [TestBlock(**pickle.loads(payload)) for payload in
                                  pq.read_table(file, columns=["payload"]).column("payload").to_pylist()]
            yield from last[name]

    return blocks


def _match_blocks(files, with_text):
    def match(batches):
        blocks = _blocks_of(files)
        for batch in batches:
            n = batch.num_rows
            hits, items = [[] for _ in range(n)], [set() for _ in range(n)]
            longest, item, at, n_words = [0] * n, [None] * n, [None] * n, None
            for block in blocks():
                n_words, found = _matches(batch, block)
                if found is None:
                    continue
                row, place, length, suffix, full = found
                order = np.lexsort((place, row))
                row, place, length, suffix, full = (x[order] for x in (row, place, length, suffix, full))
                for i, a, b in zip(*np.unique(row, return_index=True), [*np.unique(row, return_index=True)[1][1:], len(row)]):
                    old = np.array(hits[i], np.int64)
                    hits[i] = _merged(np.concatenate([old >> 32, place[a:b]]),
                                      np.concatenate([old & _MASK, place[a:b] + length[a:b]])).tolist()
                    items[i].update(block.names[o] for o in np.unique(block.owners[suffix[a:b]]))
                    best = a + int(np.argmax(full[a:b]))
                    if full[best] > longest[i]:
                        longest[i], at[i] = int(full[best]), int(place[best])
                        item[i] = block.names[block.owners[suffix[best]]]
            if n_words is None:  # no item has a word
                n_words = np.concatenate([np.diff(words_of(p.column("text"), ALPHANUMERIC, lower=True).bounds) for p in chunks([batch])] or [[]])
            columns = [batch.column("row")] + ([batch.column("text")] if with_text else []) + [
                pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int64())),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(longest, pa.int32()),
                pa.array(item, pa.string()), pa.array(at, pa.int64())]
            names = ["row"] + (["text"] if with_text else []) + ["n_words", "hits", "items", "longest", "longest_item", "longest_at"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return match


def find_matches(docs: DataFrame, benchmark: DataFrame, columns: list[str], window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per document: ``row`` (a struct of ``columns``; ``text`` stands beside it if it is
    one of them), ``n_words``, ``hits`` (disjoint
    word spans, start * 2**32 + end), ``items`` (ids of items with a window in it, as strings),
    and the longest verbatim match: ``longest`` words of ``longest_item`` at word ``longest_at``.

    Null or empty texts have no words; items without words never match; a null item_id is
    the empty string; repeated items count once per id; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text").where(
        "length(text) > 0").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part = F.pmod(F.xxhash64("name", "text"), F.lit(max(1, math.ceil(size / block_bytes))))
    with setting(spark, "spark.sql.files.maxRecordsPerFile", "1"):  # a file for each block
        blocks = saved(items.withColumn("block", part).groupBy("block").applyInArrow(_prepared(window), "payload binary"),
                       "test-blocks")
    rows = docs.select(packed(columns), "text")
    with_text = "text" in columns
    return rows.mapInArrow(_match_blocks(blocks.inputFiles(), with_text),
                           beside_row(rows, ("text string, " if with_text else "") + _REPORT))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and the longest match."""
    found = find_matches(docs, benchmark, ["doc_id"], **options)
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"),
                        lambda n, x: n + x.bitwiseAND(F.lit(_MASK)) - F.shiftright(x, 32))
    return found.select(
        "row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), "longest", "longest_item", "longest_at")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that no benchmark window occurs in."""
    found = find_matches(docs, benchmark, docs.columns, **options)
    return found.where(F.size("hits") == 0).select(*map(unpacked, docs.columns))


def q_op2_decontaminate(spark, sf_dir):
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = r"""
with iw as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
il as (select item_id, w, least(len(w), 10) as k from iw where len(w) > 0),
ik as (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as i from il),
keys as (select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as key from ik),
dw as (select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
dk as (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from dw, (select distinct k from keys)),
found as (select doc_id, i, k, item_id from (select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as key from dk) d
    join keys using (k, key)),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from found) group by doc_id),
its as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
    from found group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join hit using (doc_id) left join its using (doc_id)
"""
