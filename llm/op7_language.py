"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained by backpropagation through time on a bounded sample of labelled
documents, a fixed number per language, chosen by a hash of the text; every other document
is read whole and labelled position by position.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import gru
from .shared import beside_row, packed, small_batches, unpacked
from .words import chunks, random_values

#: The bound of the sample: documents per language, segments per document, bytes per segment.
DOCS_PER_LANGUAGE = 500
SEGMENTS_PER_DOC = 8
SEGMENT = 128
MOST_LANGUAGES = 10_000
UNDETERMINED = "und"
#: Share of the way from an even score to 1 below which a text is of no known language.  Held-out
#: documents of sf0.1 (four languages) score 0.371 at least, one word of text among them; this is 0.348.
FLOOR = 0.13


def held_out(doc_id="doc_id"):
    """Whether a document is kept from training (a null id is: it has no remainder)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """``lang, text, hash``: all different texts of a language that has up to ``per_language``, else
    about that many; a chosen text comes with its copies, which share a hash.

    Texts are chosen by a hash against a limit that follows from their language's count of
    different hashes, without a sort or shuffle of texts.  The counts, a row per language,
    are broadcast; where there are more than ``MOST_LANGUAGES`` the join is a plain one.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
                       & (F.length("text") > 0)).select("lang", "text", F.xxhash64("text", F.lit(7)).alias("hash"))
    # copies share a hash: counting them would leave a language of few texts with none
    counts = known.select("lang", "hash").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    few = counts.limit(MOST_LANGUAGES + 1).collect()
    if len(few) <= MOST_LANGUAGES:
        counts = F.broadcast(docs.sparkSession.createDataFrame(few, "lang string, n bigint"))
    share = F.pmod("hash", F.lit(1 << 30)) / float(1 << 30)
    return known.join(counts, "lang").where(share * F.col("n") < per_language).select("lang", "text", "hash")


def cut_segments(sample: DataFrame) -> DataFrame:
    """``lang, hash, segments`` of every different text of the sample: up to ``SEGMENTS_PER_DOC``
    pieces of ``SEGMENT`` bytes, a kilobyte a text, at places that follow from its hash."""
    def cut(batches):
        for batch in batches:
            found = []
            for text, seed in zip(batch.column("text").to_pylist(), batch.column("hash").to_pylist()):
                data = np.frombuffer(text.encode(), np.uint8)
                n = min(SEGMENTS_PER_DOC, -(-len(data) // SEGMENT))
                places = random_values(n, seed & 0xFFFFFFFF) % np.uint64(max(0, len(data) - SEGMENT) + 1)
                # a short text repeats
                found.append([np.resize(data[int(p):int(p) + SEGMENT], SEGMENT).tobytes() for p in places])
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("hash"), pa.array(found, pa.list_(pa.binary()))],
                                             ["lang", "hash", "segments"])

    # copies share a hash: a text counts once, whatever its number of copies
    return sample.mapInArrow(cut, "lang string, hash bigint, segments array<binary>").dropDuplicates(["lang", "hash"])


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, **options) -> gru.Model | None:
    """A model of the languages of ``docs`` (``doc_id, lang, text``); None if there is none."""
    rows = cut_segments(training_sample(docs, per_language)).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["lang"], r["hash"]))
    labels = sorted({r["lang"] for r in rows})
    if not labels:
        return None
    segments = [np.frombuffer(piece, np.uint8) for r in rows for piece in r["segments"]]
    y = [labels.index(r["lang"]) for r in rows for _ in r["segments"]]
    y = np.array(y)
    # languages weigh alike: segments of rarer ones are repeated
    most = np.bincount(y).max()
    even = np.concatenate([np.resize(np.flatnonzero(y == k), most) for k in range(len(labels))])
    return gru.train(np.stack(segments)[even], y[even], labels, **options)


def _label(model, with_text):
    def label(batches):
        for part in chunks(batches):
            texts = pc.fill_null(part.column("text").cast(pa.large_string()), "")
            _, offsets, raw = texts.buffers()
            offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
            p = gru.label_texts(data[offsets[0]:offsets[-1]], offsets - offsets[0], model)
            best = p.argmax(axis=1)
            passed = ["row", "letters"] + (["text"] if with_text else [])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in passed), pa.array([model.labels[b] for b in best], pa.string()),
                 pa.array(np.clip(p[np.arange(len(best)), best], 0, 1))], [*passed, "lang_pred", "score"])

    return label


def identify(docs: DataFrame, columns: list[str], model: gru.Model | None) -> DataFrame:
    """``row`` (a struct of ``columns``), ``lang_pred``, ``score`` for every row of ``docs``,
    and ``text`` beside ``row`` if it is one of ``columns``.

    Null, empty and letterless texts are ``und`` with score 0, and so is everything without
    a model.  Equal texts get equal results; ``columns`` may have any names.
    """
    rows = docs.select(packed(columns), "text",
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    text = ["text"] if "text" in columns else []
    if model is None:
        return rows.select("row", *text, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    small_batches(docs.sparkSession)
    found = rows.mapInArrow(_label(model, bool(text)), beside_row(
        rows, "letters boolean, " + ("text string, " if text else "") + "lang_pred string, score double"))
    return found.select("row", *text, F.when(F.col("letters"), F.col("lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
                        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"))


def least_score(labels: int, floor: float = FLOOR) -> float:
    """The score that a document must reach: ``floor`` of the way from the even share to 1."""
    return 1 / labels + (1 - 1 / labels) * floor if labels > 1 else 0.0


def of_known_language(docs: DataFrame, floor: float = FLOOR, **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is recognised; a null ``lang`` is filled
    with the predicted one.

    Texts without a letter go, and those that the network scores below ``least_score``: like
    none of the languages more than like the others.  Where no language can be learned, only
    letterless texts go.
    """
    model = fit(docs, **options)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify(docs, docs.columns, model).where(
        (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score(len(model.labels), floor)))
    columns = [F.coalesce(F.col("row.lang"), F.col("lang_pred")).alias(c) if c == "lang" else unpacked(c) for c in docs.columns]
    return found.select(*columns)


def q_op7_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, ["doc_id"], fit(docs))
    return found.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "lang_pred", "score")
