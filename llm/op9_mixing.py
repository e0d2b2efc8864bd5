"""Mixing sources to target weights by weighted sampling without replacement.

Every source has a target in words.  A source is taken in epochs: whole passes over all its
documents first, then one partial pass.  The partial pass follows Efraimidis and Spirakis: a
document of quality weight q gets the key E / q, E exponential; documents are read in key
order until the words left are used up.  Keys come from a hash of the document, so reruns
agree.  The prefix sums that cut a pass off are built in two steps, sums of narrow key
ranges first, so no source has to be sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import quoted, saved

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
CYCLE = (5, 2, 1)
MAX_EPOCHS = 3
#: Key ranges per source whose sums are added before rows are; a range is sorted in one task.
RANGES = 4096
#: Quality weights of documents labelled good or bad; others weigh 1.
GOOD, BAD = 2.0, 0.5
#: Hexadecimal digits of MD5 that make the uniform number of a document.
DIGITS = 13


def source_targets(sizes: DataFrame, cycle=CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` of every source, from rows ``source, size``.

    Sources in code point order, null last, weigh ``cycle``, repeating, and share the sum of
    all sizes by weight.  A target stops at ``max_epochs`` times its source's size; what is
    left over is shared by weight among the others until none is above.  That ends where
    one level ``target / weight`` holds for all sources that are not full: full are those
    whose own limit per weight is below the level, so one pass in the order of these limits
    finds it.  The windows without a key run over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    at = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]),
                          ((F.row_number().over(at) - 1) % len(cycle) + 1).cast("int"))
    limit = (F.col("source_size") * max_epochs).cast("double")
    rows = per_source.select("*", weight.alias("weight"), limit.alias("limit"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.select(
        "*", ((F.sum("source_size").over(everything)
               - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
              / F.sum("weight").over(onward)).alias("level"))
    full = F.col("limit") <= F.col("weight") * F.col("level")
    rows = rows.select("*", full.alias("full"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return rows.select("source", "source_size", "limit", "weight", "full", level.alias("level")).select(
        "source", "source_size",
        F.when(F.col("full") | F.col("level").isNull(), F.col("limit"))
        .otherwise(F.col("weight") * F.col("level")).alias("target"))


def sample_key(identity: Column, quality: Column) -> Column:
    """E / q with E exponential, from the MD5 of the document; quality 0 or less comes last."""
    part = F.substring(F.md5(identity), 1, DIGITS)
    uniform = (F.conv(part, 16, 10).cast("double") + 1.0) / float(16 ** DIGITS)
    return F.when(quality > 0, -F.log(uniform) / quality).otherwise(F.lit(float("inf")))


def mix(docs: DataFrame, quality: DataFrame | None = None, seed: int = 0, cycle=CYCLE,
        max_epochs: int = MAX_EPOCHS, ranges: int = RANGES) -> DataFrame:
    """``doc_id, text_hash, source, size, source_size, target, epochs, part, taken`` per row.

    ``epochs`` counts whole passes over the text, ``part`` the words of its beginning taken
    once more (only the document where a source's last pass ends has a part that is neither
    0 nor its size); ``taken = epochs * size + part``.  A source's taken words are its
    target rounded down.  ``quality`` has ``doc_id`` and ``quality`` (0 or 1, repeated rows
    are averaged); documents without one weigh 1.

    Null text has size 0 and nothing taken; a null source is a source of its own; null and
    repeated doc_ids are rows like others (equal rows share a key and are taken in any
    order, which gives equal results); an empty table gives no rows.  Other columns of
    ``docs`` are not read.
    """
    sizes = docs.select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.coalesce("text", F.lit(""))).alias("_text"))
    weight = F.lit(1.0)
    if quality is not None:
        labelled = quality.groupBy("doc_id").agg(F.avg("quality").alias("_quality"))
        sizes = sizes.join(labelled, "doc_id", "left")
        weight = F.coalesce(BAD + (GOOD - BAD) * F.col("_quality"), F.lit(1.0))
    identity = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_text")
    sizes = sizes.select("doc_id", "source", "text_hash", "size", sample_key(identity, weight).alias("key"))
    # the share of keys below this one if all weighed 1: even ranges in key order
    spread = F.floor((1 - F.exp(-F.col("key"))) * ranges)
    sizes = saved(sizes.withColumn("range", F.least(spread, F.lit(ranges - 1)).cast("int")), "sizes")
    targets = saved(source_targets(sizes, cycle, max_epochs).withColumn("_source", _key("source")), "targets")
    keyed = sizes.withColumn("_source", _key("source"))
    per_range = keyed.groupBy("_source", "range").agg(F.sum("size").alias("words"))
    earlier = (Window.partitionBy("_source").orderBy("range")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_range.select("_source", "range",
                               F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    inside = (Window.partitionBy("_source", "range").orderBy("key", "doc_id", "text_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = (keyed.select("*", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("_inside"))
            .join(offsets, ["_source", "range"])
            .join(targets.drop("source"), "_source"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rows = rows.select("*", epochs.cast("bigint").alias("epochs"))
    left = (F.floor("target") - F.col("epochs") * F.col("source_size") - F.col("offset") - F.col("_inside"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("bigint")
    return rows.select("doc_id", "text_hash", "source", "size", "source_size", "target", "epochs",
                       part.alias("part"), (F.col("epochs") * F.col("size") + part).alias("taken"))


def mixed_documents(docs: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes anything of, all columns, with the struct
    ``mix`` of ``epochs``, ``part`` and ``taken``: the text is read ``epochs`` times, and its
    first ``part`` words once more.  Equal rows share out what is taken of them.  A column
    of ``docs`` that is called ``mix`` is replaced."""
    taken = (mix(docs, quality, **options).where("taken > 0").groupBy("doc_id", "text_hash")
             .agg(F.collect_list(F.struct("epochs", "part", "taken")).alias("mixes")))
    taken = taken.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), "text_hash", "mixes")
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns if c != "mix"]).alias("row"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
                       F.xxhash64("text").alias("text_hash")).join(taken, ["_id", "text_hash"])
    copy = F.row_number().over(Window.partitionBy("_id", "text_hash").orderBy("_id"))
    rows = rows.select("row", F.get("mixes", copy - 1).alias("mix")).where("mix is not null")
    return rows.select("row.*", "mix")


def _key(source: str) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def q_op9_mixing(spark, sf_dir):
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
with q as (select doc_id, avg(quality) as quality from labels group by doc_id),
s as (select d.doc_id, d.source, cast(coalesce(len(regexp_extract_all(d.text, '[^ 	-
]+')), 0) as bigint) as size,
        -ln((cast(('0x' || substr(md5(concat('0:', coalesce(cast(d.doc_id as varchar), ''), ':', md5(coalesce(d.text, '')))), 1, 13)) as bigint)
             + 1.0::double) / 4503599627370496.0::double) / coalesce(0.5::double + 1.5::double * q.quality, 1.0::double) as key
      from documents d left join q on q.doc_id = d.doc_id),
p as (select source, sum(size) as source_size, 3.0::double * sum(size) as lim,
        [5.0::double, 2.0::double, 1.0::double][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w
      from s group by source),
l as (select *, ((select sum(size) from s)::double
          - coalesce(sum(lim) over (order by lim / w, source nulls last rows between unbounded preceding and 1 preceding), 0.0::double))
          / sum(w) over (order by lim / w, source nulls last rows between current row and unbounded following) as level from p),
t as (select source, source_size, case when lim <= w * level then lim
        else w * (select max(level) from l where lim > w * level) end as target from l),
r as (select s.*, t.source_size, t.target, floor(t.target / t.source_size) as epochs,
        coalesce(sum(size) over (partition by s.source order by key, s.doc_id rows between unbounded preceding and 1 preceding), 0) as earlier
      from s join t on s.source is not distinct from t.source)
select doc_id, size, cast(source_size as bigint) as source_size, target,
    cast(epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - earlier)) as bigint) as taken from r
"""
