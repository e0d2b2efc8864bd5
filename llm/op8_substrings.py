"""Substring deduplication by an index of phrases between anchors, in place of a relative
Lempel-Ziv parsing: no document is factored greedily against blocks of the reference, no
longest factor is looked for.  A greedy parsing depends on where the factor before ended,
so it would send every document to every block; anchors depend on the text alone, so
lookups are joins.  The spans are the same: all windows that occur earlier.

The reference of a document is all text before it: documents of smaller id, and its own
earlier words.  A document is cut in phrases at anchors that its text alone decides (the
least hash of the five-word runs of a window, leftmost first), so equal passages are cut
alike wherever they stand and no document is compared with another.  The index holds, by
anchor, every phrase with the place it first occurs at, spread over the hash partitions of
a shuffle (the reference blocks).  A phrase that occurred before is a copy of one run of
reference words.  Where phrases of one anchor differ, at the boundaries of
factors, single windows are looked up instead.  Neighbouring copies of one run of the reference are
joined to factors, the duplicate spans.

A phrase is at most 16 windows, so index, lookups and skew handling work on about a row per
nine words.  Counts and first places are combined before their shuffle; lookups are joins
whose hot keys adaptive execution splits.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import beside_row, packed, saved, small_batches, unpacked
from .words import BLANK_SEPARATED, chunks, run_hashes, windows, words_of

#: Words of a window, and of the runs that anchors are chosen from.
WINDOW = 20
ANCHOR = 5

_SECOND = np.uint64(0x9FB21C651E98DF25)
_PLACE = ["doc", "tie", "at"]


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each start the place of the least of ``width`` values, the leftmost of equal ones."""
    place, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = place[:-step], place[step:]
        place = np.where(values[left] <= values[right], left, right)
        size += step
    return place


def _phrases(window, anchor):
    def cut(batches):
        for part in chunks(batches):
            words = words_of(part.column("text"), BLANK_SEPARATED)
            starts, rows = windows(words, window)
            if not len(starts):
                continue
            runs = np.arange(len(words.hashes) - anchor + 1)
            values = run_hashes(words.hashes, runs, runs + anchor)
            chosen = leftmost_minima(values, window - anchor + 1)[starts]
            new = np.ones(len(starts), bool)
            new[1:] = (chosen[1:] != chosen[:-1]) | (rows[1:] != rows[:-1])
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(starts)))
            begin, row = starts[first], rows[first]
            bodies = run_hashes(words.hashes, begin, begin + n + window - 1)
            doc = part.column("doc").to_numpy(zero_copy_only=False)
            tie = part.column("tie").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[chosen[first]].view(np.int64)), pa.array(bodies.view(np.int64)), pa.array(doc[row]),
                 pa.array(tie[row]), pa.array((begin - words.bounds[row]).astype(np.int32)), pa.array(n.astype(np.int32))],
                ["anchor", "body", *_PLACE, "n"])

    return cut


def _single_windows(window):
    def hashes(batches):
        for part in chunks(batches):
            words = words_of(part.column("text"), BLANK_SEPARATED)
            places = part.column("phrases")
            flat = places.flatten()
            n = flat.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
            row = np.repeat(row, n)
            first = np.repeat(flat.field("at").to_numpy(zero_copy_only=False).astype(np.int64), n)
            at = first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
            start = at + words.bounds[row]
            one = run_hashes(words.hashes, start, start + window)
            two = run_hashes(words.hashes, start, start + window, _SECOND)
            doc = part.column("doc").to_numpy(zero_copy_only=False)
            tie = part.column("tie").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(doc[row]), pa.array(tie[row]),
                 pa.array(at.astype(np.int32))], ["one", "two", *_PLACE])

    return hashes


def _identity(docs: DataFrame) -> list:
    """A document's place in the order: by doc_id, null last, then by its text."""
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("doc"),
            F.xxhash64("text").alias("tie")]


def _known_before(rows: DataFrame, keys: list[str], first: DataFrame) -> DataFrame:
    """``doc, tie, at, n`` of rows whose key occurs first at another place, and that place."""
    return (rows.join(first, keys)
            .where(F.struct(*_PLACE) != F.struct("first.doc", "first.tie", "first.at"))
            .select(*_PLACE, "n", F.col("first.doc").alias("source_doc"), F.col("first.at").alias("source_at")))


def repeated_phrases(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc, tie, at, n, source_doc, source_at``: the ``n`` windows of a document from word
    ``at`` on occurred earlier, from word ``source_at`` of ``source_doc`` on."""
    small_batches(docs.sparkSession)
    texts = docs.select(*_identity(docs), "text")
    phrases = texts.mapInArrow(_phrases(window, anchor), "anchor bigint, body bigint, doc bigint, tie bigint, at int, n int")
    shared = saved(phrases.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor"), "anchors")
    occurring = saved(phrases.join(shared, "anchor"), "phrases")
    place = F.min(F.struct(*_PLACE)).alias("first")
    distinct = saved(occurring.groupBy("anchor", "body").agg(place, F.max("n").alias("n")), "distinct-phrases")
    differing = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor")
    copies = _known_before(occurring, ["anchor", "body"], distinct.drop("n"))
    # factor boundaries: of phrases that differ around an anchor, look up single windows
    boundary = (distinct.join(differing, "anchor", "left_semi").select("first.*", "n")
                .groupBy("doc", "tie").agg(F.collect_list(F.struct("at", "n")).alias("phrases")))
    single = saved(texts.join(boundary, ["doc", "tie"]).mapInArrow(
        _single_windows(window), "one bigint, two bigint, doc bigint, tie bigint, at int"), "windows")
    first = saved(single.groupBy("one", "two").agg(place, F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"),
                  "first-windows")
    return saved(copies.union(_known_before(single.withColumn("n", F.lit(1)), ["one", "two"], first)), "repeats")


def _factors(window):
    """Joins phrases that copy one run of the reference, and removes the words of the factors."""
    def parse(batches):
        for batch in chunks(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            lists = batch.column("repeats")
            flat = lists.flatten()
            size = np.diff(lists.offsets.to_numpy()) if flat else np.zeros(batch.num_rows, np.int64)
            row = np.repeat(np.arange(batch.num_rows), size)
            at, n, doc, source = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64)
                                  for c in ("at", "n", "source_doc", "source_at"))
            order = np.lexsort((at, row))
            row, at, n, doc, source = (x[order] for x in (row, at, n, doc, source))
            new = np.ones(len(row), bool)
            new[1:] = ((row[1:] != row[:-1]) | (at[1:] > at[:-1] + n[:-1]) | (doc[1:] != doc[:-1])
                       | (source[1:] - at[1:] != source[:-1] - at[:-1]))
            first = np.flatnonzero(new)
            end = (np.maximum.reduceat(at + n, first) if len(first) else at) + window - 1
            row, at, doc, source = row[first], at[first], doc[first], source[first]
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            n_words, n_removed, kept, digests = [], [], [], []
            for i, text in enumerate(texts):
                words = (text or b"").split()
                a, b = cuts[i], cuts[i + 1]
                removed = 0
                if a < b:
                    depth = np.zeros(len(words) + 1, np.int32)
                    np.add.at(depth, at[a:b], 1)
                    np.add.at(depth, end[a:b], -1)
                    keep = np.cumsum(depth[:-1]) == 0
                    removed = int(len(words) - keep.sum())
                    left = b" ".join(compress(words, keep.tolist()))
                else:
                    left = b" ".join(words)
                kept.append(left if removed else text)
                digests.append(hashlib.sha256(left).hexdigest())
                n_words.append(len(words))
                n_removed.append(removed)
            spans = pa.StructArray.from_arrays(
                [pa.array(x.astype(np.int64)) for x in (at, end, doc, source)],
                names=["start", "end", "source_doc", "source_start"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), spans)],
                ["row", "n_words", "n_removed", "kept", "kept_sha256", "factors"])

    return parse


def parse(docs: DataFrame, columns: list[str], window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """A row per document: ``row`` (a struct of ``columns``, without the text), ``n_words``,
    ``n_removed``, ``kept`` (the text as it is, or if words are removed the others joined by
    one space), ``kept_sha256`` (of its words outside all duplicate spans, joined by one
    space) and ``factors`` (word spans ``start``, ``end`` and the earlier place they copy).

    Windows are judged on the input.  Null, empty and short texts (under a window) have no
    window and stay whole.  Rows that share a doc_id are documents in order of a hash of
    their text; rows equal in both are one document, so neither is the other's copy.  Null
    doc_ids come last.  An empty table gives no rows.  ``columns`` may have any names.
    """
    repeats = (repeated_phrases(docs, window, anchor).groupBy("doc", "tie")
               .agg(F.collect_list(F.struct("at", "n", "source_doc", "source_at")).alias("repeats")))
    rows = docs.select(packed(columns), "text", *_identity(docs)).join(repeats, ["doc", "tie"], "left")
    small_batches(docs.sparkSession)
    empty = F.array().cast("array<struct<at:int,n:int,source_doc:bigint,source_at:int>>")
    rows = rows.select("row", "text", F.coalesce("repeats", empty).alias("repeats"))
    return rows.mapInArrow(_factors(window), beside_row(
        rows, "n_words bigint, n_removed bigint, kept string, kept_sha256 string, "
        "factors array<struct<start:bigint,end:bigint,source_doc:bigint,source_start:bigint>>"))


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all columns, with duplicate spans cut out of ``text`` and ``n_chars`` counted
    anew.  Texts without such spans stay as they are; documents of which nothing is left go."""
    parsed = parse(docs, docs.columns, **options)
    cut = F.col("n_removed") > 0
    length = F.when(cut, F.length("kept").cast("bigint")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("kept").alias("text"), "n_chars": length.alias("n_chars")}
    columns = [new[c] if c in new else unpacked(c) for c in docs.columns]
    return parsed.where(~cut | (F.col("kept") != "")).select(*columns)


def q_op8_substrings(spark, sf_dir):
    parsed = parse(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
    return parsed.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


SQL = r"""
with d as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
k as (select doc_id, unnest(range(1, len(w) - 18)) as i, w from d),
h as (select doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) as key from k),
f as (select doc_id, i, row_number() over (partition by key order by doc_id, i) as nth from h),
r as (select distinct doc_id, unnest(range(i, i + 20)) as p from f where nth > 1),
l as (select doc_id, list(p) as gone from r group by doc_id),
o as (select d.doc_id, d.w, l.gone from d left join l using (doc_id)),
e as (select doc_id, w, gone, unnest(range(1, len(w) + 1)) as p from o),
s as (select e.doc_id, string_agg(w[e.p], ' ' order by e.p) as kept from e left join r on r.doc_id = e.doc_id and r.p = e.p
      where r.p is null group by e.doc_id)
select o.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
    sha256(coalesce(kept, '')) as kept_sha256
from o left join s using (doc_id)
"""
