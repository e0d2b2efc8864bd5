"""Phrase collocations per language, counted with stripes.

A stripe is a prefix with an associative counter of the words that follow it.  Pass n over
the texts builds the stripes of prefixes of n - 1 words: tasks count whole runs of text and
hand on partial stripes, which meet by prefix and are merged elementwise.  One merged stripe
gives the prefix's extensions with their counts, its total (what is cut off for being rare,
or ends a piece, is counted under no word) and the largest count of an extension, which
decides whether the prefix is subsumed.

A phrase is frequent only if its first and its last n - 1 words are, so pass n looks at
these alone.  They are recognised by a Bloom filter of bounded size: one that is too full
lets more through and changes no count.  Counting is by the words themselves, hashes only
choose what is looked at.  The stripes of the few prefixes that hold more than a set share of
all words are cut in slices by a hash of the next word, so that no task gets all that follows
"the".
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import saved, small_batches
from .words import run_hashes, random_values

MIN_COUNT = 30
MAX_WORDS = 4
#: A candidate goes if a longer one has this share of its count, in hundredths.
SUBSUMED = 80
SCALE = 2000000
TOP = 2000
#: A prefix with this part of all words has its stripe cut in slices (at most as many have it).
HOT_PART = 2048
#: Slices of such a stripe; of that of the empty prefix, which holds every word.
SLICES, FIRST_SLICES = 64, 1024
#: Bytes of text that a task counts at once, cut where pieces end.
RUN_BYTES = 8 << 20
#: Bits of a filter: 16 per phrase between these bounds (the upper one is 8 MiB).
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26

#: A part of a stripe: the next words, joined by spaces, and how often each follows.  An empty one
#: counts the prefixes that end a piece or go on to what is not frequent.
STRIPE = "lang string, prefix string, slice int, nexts string, counts array<int>"

_GAPS = [0x20, 0x09]
_PIECE_ENDS = [*b".,;:!?", *range(0x0A, 0x0E)]
_BYTE_VALUES = random_values(256, 11)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _among(values) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[values] = True
    return table


_ENDS = _among(_PIECE_ENDS)
_INSIDE = ~_among(_GAPS + _PIECE_ENDS)


@dataclass
class Run:
    """Words of a run of text: ``ids`` into ``words``, ``langs`` of every word as ids into
    ``names``, and whether the next word stands in the same piece."""

    ids: np.ndarray
    words: pa.Array
    hashes: np.ndarray
    langs: np.ndarray
    names: pa.Array
    lang_hashes: np.ndarray
    linked: np.ndarray


def _hashes(texts: pa.Array) -> np.ndarray:
    _, offsets, raw = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8)[:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return run_hashes(_BYTE_VALUES[data], offsets[:-1], offsets[1:])


def _cuts(data: np.ndarray, offsets: np.ndarray, limit: int) -> list[int]:
    """Places about ``limit`` bytes apart where a text begins or a piece ends."""
    found = [0]
    while len(data) - found[-1] > limit:
        at = found[-1] + limit
        text = offsets[np.searchsorted(offsets, at)]
        step = 1 << 12
        while at < text:
            ends = np.flatnonzero(_ENDS[data[at:min(at + step, text)]])
            if len(ends):
                text = at + ends[0]
            at, step = at + step, step * 2
        found.append(int(text))
    return found if found[-1] == len(data) else [*found, len(data)]


def runs_of(batches, limit: int = RUN_BYTES):
    """The words of ``lang, text`` batches, in runs of about ``limit`` bytes."""
    for batch in batches:
        texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
        langs = pc.fill_null(batch.column("lang").cast(pa.large_string()), "und").dictionary_encode()
        names, lang_of = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False)
        lang_hashes = _hashes(names)
        _, offsets, raw = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        whole = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        cuts = _cuts(whole, offsets, limit)
        for a, b in zip(cuts, cuts[1:]):
            run = _run(_LOWER[whole[a:b]], offsets - a, lang_of, names, lang_hashes)
            if run is not None:
                yield run


def _run(data: np.ndarray, offsets: np.ndarray, lang_of: np.ndarray, names: pa.Array, lang_hashes: np.ndarray) -> Run | None:
    """The words of a run, lower-cased; ``offsets`` says where the texts around it begin."""
    inside = _INSIDE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[np.searchsorted(offsets, 0):np.searchsorted(offsets, len(data))]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    if not len(starts):
        return None
    bounds = np.concatenate([[0], np.cumsum(np.add.reduceat(inside, starts, dtype=np.int64))])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data[inside]))
    words = words.dictionary_encode()
    docs = np.searchsorted(offsets, starts, side="right") - 1
    piece = np.searchsorted(np.flatnonzero(_ENDS[data]), starts)
    linked = np.zeros(len(starts), dtype=bool)
    linked[:-1] = (piece[1:] == piece[:-1]) & (docs[1:] == docs[:-1])
    return Run(words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary,
               _hashes(words.dictionary), lang_of[docs].astype(np.int64), names, lang_hashes, linked)


def _mixed_in(h: np.ndarray, value: np.ndarray) -> np.ndarray:
    h = (h ^ value) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def phrase_hashes(run: Run, n: int):
    """The hash of the n words from every place on, and whether they stand in one piece."""
    values = run.hashes[run.ids]
    h, whole = _mixed_in(run.lang_hashes[run.langs], values), np.ones(len(values), dtype=bool)
    for j in range(1, n):
        h[:-j] = _mixed_in(h[:-j], values[j:])
        whole[:-j] &= run.linked[j - 1:len(values) - 1]
        whole[-j:] = False
    return h, whole


def places(h: np.ndarray, n_blocks: int):
    """Block of every hash, and a mask of two bits in it."""
    one, six = np.uint64(1), np.uint64(63)
    block = (h >> np.uint64(12)) & np.uint64(n_blocks - 1)
    return block.astype(np.int64), (one << (h & six)) | (one << ((h >> np.uint64(6)) & six))


@dataclass
class Filter:
    """Bits of the hashes of frequent phrases, as 64-bit blocks; no false negatives."""

    blocks: np.ndarray

    def holds(self, h: np.ndarray) -> np.ndarray:
        block, mask = places(h, len(self.blocks))
        return (self.blocks[block] & mask) == mask


def frequent_filter(phrases: DataFrame, n: int, words: int):
    """The blocks of a ``Filter`` of the phrases (``lang, phrase, a``) of n words, and the hashes
    of those with a ``HOT_PART``-th of all ``words``.  Tasks make them; the driver gets at most
    ``MOST_BITS / 64`` blocks and ``HOT_PART`` hashes."""
    count = phrases.count()
    n_blocks = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * count).bit_length())) // 64

    def hashes(batches):
        for run in runs_of(batches):
            h, whole = phrase_hashes(run, n)
            yield h[whole]

    def marks(batches):
        for h in hashes(batches):
            block, mask = places(h, n_blocks)
            yield pa.record_batch({"block": block, "mask": mask.view(np.int64)})

    texts = phrases.select("lang", F.concat("phrase", F.lit(".")).alias("text"), "a")
    rows = texts.mapInArrow(marks, "block bigint, mask bigint").groupBy("block").agg(F.bit_or("mask").alias("mask")).toArrow()
    blocks = np.zeros(n_blocks, dtype=np.uint64)
    blocks[rows["block"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
    much = texts.where(F.col("a") > words / HOT_PART)
    hot = much.mapInArrow(lambda batches: (pa.record_batch({"h": h.view(np.int64)}) for h in hashes(batches)), "h bigint").toArrow()
    return blocks, hot["h"].to_numpy().view(np.uint64)


def _dense(keys: np.ndarray):
    found, codes = np.unique(keys, return_inverse=True)
    return codes


def _stripes_of(run: Run, n: int, frequent: Filter | None, hot: np.ndarray | None) -> pa.RecordBatch:
    """The stripes of all prefixes of n - 1 words in a run."""
    size = len(run.words)
    at = np.arange(len(run.ids))
    following, code, slices = run.ids, run.langs, np.full(len(at), FIRST_SLICES)
    if n > 1:
        h, whole = phrase_hashes(run, n - 1)
        whole[whole] = frequent.holds(h[whole])
        at = np.flatnonzero(whole)
        slices = np.where(np.isin(h[at], hot), SLICES, 1)
        goes_on = run.linked[at] & np.append(whole[1:], False)[at]
        following = np.full(len(at), size)
        following[goes_on] = run.ids[at[goes_on] + n - 1]
        code = code[at]
    for j in range(n - 1):
        code = _dense(code * size + run.ids[at + j])
    _, first, counts = np.unique(code * (size + 1) + following, return_index=True, return_counts=True)
    following, code, at, slices = following[first], code[first], at[first], slices[first]
    slice_of = np.zeros(len(first), dtype=np.int32)
    known = following < size
    slice_of[known] = (run.hashes[following[known]] >> np.uint64(33)).astype(np.int64) % slices[known]
    # the empty word first, as ids of words are below its own
    order = np.lexsort((-following, slice_of, code))
    following, code, at, counts, slice_of = (x[order] for x in (following, code, at, counts, slice_of))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (slice_of[1:] != slice_of[:-1])
    begin = np.flatnonzero(new)
    bounds = pa.array(np.append(begin, len(order)).astype(np.int32))
    nexts = pa.concat_arrays([run.words.cast(pa.string()), pa.array([""], pa.string())]).take(pa.array(following))
    parts = [run.words.take(pa.array(run.ids[at[begin] + j])) for j in range(n - 1)]
    prefix = (pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())).cast(pa.string()) if parts
              else pa.repeat(pa.scalar("", pa.string()), len(begin)))
    return pa.record_batch({"lang": run.names.take(pa.array(run.langs[at[begin]])).cast(pa.string()), "prefix": prefix,
                            "slice": pa.array(slice_of[begin]),
                            "nexts": pc.binary_join(pa.ListArray.from_arrays(bounds, nexts), " "),
                            "counts": pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int32)))})


def merged_stripes(texts: DataFrame, n: int, frequent=None, hot=None, least: int = MIN_COUNT) -> DataFrame:
    """``lang, prefix, slice, total, widest, extensions`` of every stripe of n - 1 words.

    ``frequent`` broadcasts the blocks of a ``Filter`` of phrases of n - 1 words, ``hot`` the
    hashes of those that hold much (none for n = 1).  ``extensions`` lists ``next, n`` of at
    least ``least``, ``widest`` is the largest n among them, and ``total`` counts the prefix
    wherever it stands.
    """
    def count(batches):
        for run in runs_of(batches):
            yield _stripes_of(run, n, frequent and Filter(frequent.value), hot and hot.value)

    by = ["lang", "prefix", "slice"]
    # dealt by stripe before the counters are opened: the sums below need no other shuffle
    partial = texts.mapInArrow(count, STRIPE).repartition(*by)
    entries = F.arrays_zip(F.split("nexts", " ", -1).alias("next"), F.col("counts").alias("n"))
    counts = partial.select(*by, F.inline(entries)).groupBy(*by, "next").agg(F.sum("n").alias("n"))
    kept = (F.col("next") != "") & (F.col("n") >= least)
    return counts.groupBy(*by).agg(
        F.sum("n").alias("total"), F.max(F.when(kept, F.col("n"))).alias("widest"),
        F.collect_list(F.when(kept, F.struct("next", "n"))).alias("extensions"))


def _rest(phrase: str) -> Column:
    """A phrase without its first word."""
    return F.expr(f"substr({phrase}, instr({phrase}, ' ') + 1)")


def candidates(docs: DataFrame, least: int = MIN_COUNT, max_words: int = MAX_WORDS):
    """The candidates of every length, and ``lang, n`` of every language.

    Candidates have ``lang, phrase, a``, ``heads`` and ``tails`` (counts of what stands before
    and after each cut) and ``longest``, the largest count of a candidate one word longer
    that holds them (null: none).
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select("lang", "text")
    stripes = saved(merged_stripes(texts, 1, least=least), "stripes")
    totals = stripes.groupBy("lang").agg(F.sum("total").alias("n"))
    words = totals.agg(F.sum("n")).first()[0] or 0
    none = F.array().cast("array<bigint>")
    last = stripes.select("lang", F.inline("extensions")).select(
        "lang", F.col("next").alias("phrase"), F.col("n").alias("a"), none.alias("heads"), none.alias("tails"))
    found = []
    for n in range(2, max_words + 1):
        blocks, hashes = frequent_filter(last, n - 1, words)
        frequent, hot = spark.sparkContext.broadcast(blocks), spark.sparkContext.broadcast(hashes)
        stripes = saved(merged_stripes(texts, n, frequent, hot, least), "stripes")
        frequent.destroy()
        hot.destroy()
        parents = stripes.groupBy("lang", "prefix").agg(F.sum("total").alias("total"), F.max("widest").alias("widest"))
        parents = parents.join(last.select("lang", F.col("phrase").alias("prefix"), "heads"), ["lang", "prefix"])
        parents = parents.select("lang", "prefix", "widest", F.array_append("heads", F.col("total")).alias("heads"))
        longer = (stripes.select("lang", "prefix", F.inline("extensions"))
                  .join(parents.drop("widest"), ["lang", "prefix"])
                  .select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.col("n").alias("a"), "heads")
                  .withColumn("rest", _rest("phrase")))
        ends = last.select("lang", F.col("phrase").alias("rest"), F.array_prepend("tails", F.col("a")).alias("tails"))
        longer = saved(longer.join(ends, ["lang", "rest"]), "phrases")
        if n > 2:
            found.append(_subsumed_by(last, parents, longer))
        last = longer.drop("rest")
    if max_words > 1:
        found.append(last.withColumn("longest", F.lit(None).cast("bigint")))
    return found, totals


def _subsumed_by(phrases: DataFrame, parents: DataFrame, longer: DataFrame) -> DataFrame:
    """Adds ``longest``: extensions to the right from the stripes, to the left by what is left
    of a longer phrase without its first word."""
    right = parents.where("widest is not null").select("lang", F.col("prefix").alias("phrase"), "widest")
    left = longer.groupBy("lang", F.col("rest").alias("phrase")).agg(F.max("a").alias("_left"))
    return (phrases.join(right, ["lang", "phrase"], "left").join(left, ["lang", "phrase"], "left")
            .select(*phrases.columns, F.greatest("widest", "_left").alias("longest")))


def collocations(docs: DataFrame, least: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 subsumed: int = SUBSUMED, scale: int = SCALE, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases.

    A-Z are lower-cased; pieces end at ``[.,;:!?\\x0A-\\x0D]``, words in them at spaces and
    tabs.  A phrase of 2 to ``max_words`` words with ``a >= least`` occurrences inside pieces,
    overlaps included, scores ``floor(scale * a / (l + r))`` at the cut that scores least (ties:
    the first), ``l`` and ``r`` counting what stands before and after the cut, all in decimals
    of 38 digits.  Dropped are those inside a longer candidate of at least ``subsumed``
    hundredths of their count.  Ties in score: larger a, then the phrase in UTF-8 order.

    Null text has no words, a null language is ``und``; repeated rows count each; a language
    without candidates, and an empty table, give no rows.  Other columns are not read.
    """
    lengths, totals = candidates(docs, least, max_words)
    if not lengths:
        raise ValueError("phrases have two words at least")
    rows = lengths[0]
    for more in lengths[1:]:
        rows = rows.unionByName(more)
    wide = lambda c: c.cast("decimal(20,0)")
    rows = rows.where(F.col("longest").isNull() | (wide(F.col("longest")) * 100 < wide(F.col("a")) * subsumed))
    cut = rows.select("lang", "phrase", "a", F.posexplode(F.arrays_zip("heads", "tails")).alias("k", "at"))
    score = F.expr(f"(cast(a as decimal(20,0)) * {int(scale)}) div (cast(at.heads as decimal(20,0)) + at.tails)")
    best = cut.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", F.col("at.heads").alias("l"),
                                                      F.col("at.tails").alias("r")).alias("cut"))
    best = best.groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut")).select("lang", "phrase", "a", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def q_op11_phrases(spark, sf_dir):
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
g as (select lang, unnest(flatten([[array_to_string(ws[i:i + k - 1], ' ') for i in range(1, len(ws) - k + 2)] for k in range(1, 5)])) as phrase from w),
f as (select lang, phrase, count(*) as a from g group by all having count(*) >= 30),
totals as (select lang, sum(len(ws)) as n from w group by lang),
c as (select *, string_split(phrase, ' ') as ws from f where contains(phrase, ' ')),
inner_parts as (
    select distinct lang, a, unnest(flatten([[array_to_string(ws[i:i + k - 1], ' ') for i in range(1, len(ws) - k + 2)]
                                           for k in range(2, len(ws))])) as part from c),
longest as (select lang, part, max(a) as m from inner_parts group by all),
kept as (select c.* from c left join longest o on o.lang = c.lang and o.part = c.phrase
         where o.m is null or 100::hugeint * o.m < 80::hugeint * c.a),
cuts as (select lang, phrase, a, k, array_to_string(ws[1:k], ' ') as head, array_to_string(ws[k + 1:], ' ') as tail
         from (select *, unnest(range(1, len(ws))) as k from kept)),
scored as (select t.lang, t.phrase, t.a, t.k, h.a as l, e.a as r, (2000000::hugeint * t.a) // (h.a + e.a) as score
    from cuts t join f h on h.lang = t.lang and h.phrase = t.head join f e on e.lang = t.lang and e.phrase = t.tail),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
    cast(n as bigint) as n, cast(score as bigint) as score from ranked join totals using (lang) where rank <= 2000
"""
