"""The corpus pipeline: from ``documents`` to a mix of sources, stage by stage.

Every stage works on what the one before kept and returns the columns of ``documents``; the
last adds how often the mix reads a document.  Between stages the table is written, so a
lost executor costs a stage at most.

In every stage null and empty texts, null and repeated ids, repeated rows and further columns
of any names are allowed, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm.op2_decontaminate import decontaminate
from llm.op3_jaccard import one_per_class
from llm.op7_language import of_known_language
from llm.op8_substrings import without_repeats
from llm.op9_mixing import mixed_documents
from llm.shared import saved


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, null and empty texts among them, or that the network
    scores about alike for all languages; missing languages are filled in.  Every row is judged
    by itself.  Without a language to learn only letterless texts go."""
    return of_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the first by doc_id (null last), then by
    a hash of the text; of rows equal in both one.  Texts without words are classes of their own."""
    return one_per_class(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur earlier are cut out of the texts; documents of which nothing is left go.
    Earlier is by doc_id (null last), then by a hash of the text; rows equal in both are one
    document.  Null, empty and short texts stay."""
    return without_repeats(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go; null and empty texts have none and stay."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix of sources takes, with how often it reads them, as the column ``mix``
    (a column of that name is replaced).  Texts without words are not taken; a null source is a
    source of its own; equal rows share out what is taken of them."""
    quality = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return mixed_documents(docs, quality)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("benchmark_passages", benchmark_passages),
          ("source_mix", source_mix)]

#: Classes of near copies are components of links, of candidates found with a recall under 1, and a trained
#: network rejects documents and fills missing languages: no SQL says either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
