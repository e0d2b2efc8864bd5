"""Stages of the pipeline on odd tables; the language stage, which trains, on an empty one."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

STAGES = dict(corpus_pipeline.STAGES)


def odd(make, words):
    text = " ".join(words[:60]) + "."
    rows = [(1, text), (1, text), (None, text), (None, None), (2, None), (3, ""), (4, " \n "), (2**61, " ".join(words[60:200])),
            (5, words[0] * 3000), (5, "un deux"), (6, " ".join(words[200:260]))]
    df = make(rows).withColumn("source", F.when(F.col("doc_id") > 3, "a"))
    for name in ("mix_", "doc", "tie", "epochs", "text_hash", "_id", "mixes", "a b", "ro`w"):
        df = df.withColumn(name, F.lit(7))
    return df


@pytest.mark.parametrize("name", [n for n in STAGES if n != "language_id"])
def test_stage_on_odd_rows(shared, make, words, data_dir, name):
    docs = odd(make, words)
    got = STAGES[name](shared, docs, data_dir)
    rows = got.collect()
    assert got.columns[:len(docs.columns)] == docs.columns
    assert all(r["a b"] == 7 and r.doc == 7 and r.kept == 1 for r in rows)
    before = {(r.doc_id, r.text) for r in docs.collect()}
    texts = {(r.doc_id, r.text) for r in rows}
    if name == "near_duplicates":
        first = next(t for i, t in before if i == 6)
        assert (6, first) in texts and len(rows) == len(texts) == 9 and sum(t is not None and t.startswith(next(
            u for i, u in before if i == 1)) for _, t in texts) == 1
    elif name == "repeated_passages":
        assert {i for i, t in texts if t is None} == {None, 2} and (3, "") in texts and (5, "un deux") in texts
        assert sum(i is None for i, _ in texts) == 1  # the copy with the null id is cut away whole
    elif name == "benchmark_passages":
        assert texts == before and len(rows) == 11
    else:
        assert all(r.mix.taken > 0 for r in rows) and {t for _, t in texts} <= {t for _, t in before if t and t.strip()}


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_on_an_empty_table(shared, make, data_dir, name):
    docs = make([])
    got = STAGES[name](shared, docs, data_dir)
    assert got.count() == 0 and got.columns[:len(docs.columns)] == docs.columns
