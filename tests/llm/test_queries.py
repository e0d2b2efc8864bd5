"""Registered queries against their SQL, and the pipeline against its stages' brute force."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from llm.queries import QUERIES, SQL

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_one_query_per_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(shared, data_dir, name):
    got = QUERIES[name](shared, data_dir)
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{data_dir}/{table}.parquet'")
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    columns = sorted(got.columns)
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    key = lambda row: tuple((v is None, v) for v in row)
    want = sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=key)
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == want


def test_jaccard_query_brute_force(shared, data_dir):
    from test_documents import brute_classes

    rows = [tuple(r) for r in shared.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op3_jaccard"](shared, data_dir).select("doc_id", "class_id", "n_links").collect()]
    assert sorted(got) == sorted(brute_classes(rows))


def test_html_query(shared, data_dir):
    import html
    import re

    got = {r.page_id: r for r in QUERIES["op4_html"](shared, data_dir).collect()}
    pages = shared.read.parquet(f"{data_dir}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        inner = re.search(r"(?s)<article>(.*)</article>", page.html)[1]
        text = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:h1|p|br)>", " ", inner))).split())
        assert got[page.page_id].text == text and got[page.page_id].n_chars == len(text)


def test_language_query(shared, data_dir):
    got = QUERIES["op7_language"](shared, data_dir).collect()
    lang = {r.doc_id: r.lang for r in shared.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.9 * len(held)


def test_pipeline_stages(shared, data_dir, tmp_path):
    """Every stage on what the one before kept, each checked against plain Python."""
    from test_documents import LOWER, SPLIT, brute_classes, brute_contamination

    docs = shared.read.parquet(f"{data_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(shared, docs, data_dir).write.parquet(f"{tmp_path}/{k}")
        docs = shared.read.parquet(f"{tmp_path}/{k}")
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before) and (docs.columns == columns or k == len(corpus_pipeline.STAGES) - 1)
        kept[name] = (before, after)
    before, after = kept["language_id"]
    assert set(after) == {i for i, r in before.items() if any(c.isalpha() for c in r.text or "")}
    before, after = kept["near_duplicates"]
    classes = brute_classes([(i, r.text) for i, r in before.items()])
    assert set(after) == {i for i, c, _ in classes if i == c}
    before, after = kept["repeated_passages"]
    seen = set()
    for i in sorted(before):
        w, gone = SPLIT.findall(before[i].text), set()
        for p in range(len(w) - 19):
            if (key := tuple(w[p:p + 20])) in seen:
                gone.update(range(p, p + 20))
            seen.add(key)
        left = " ".join(x for p, x in enumerate(w) if p not in gone) if gone else before[i].text
        assert (after[i].text if i in after else "") == left
        assert i not in after or after[i].n_chars == len(left) or not gone
    before, after = kept["benchmark_passages"]
    items = [(r.item_id, r.text) for r in shared.read.parquet(f"{data_dir}/benchmark.parquet").collect()]
    assert set(after) == {r[0] for r in brute_contamination([(i, r.text) for i, r in before.items()], items) if not r[5]}
    before, after = kept["source_mix"]
    words = {i: len(SPLIT.findall(r.text)) for i, r in before.items()}
    assert abs(sum(r.mix.taken for r in after.values()) - sum(words.values())) <= 25
    assert all(0 < r.mix.taken <= 3 * words[i] and r.mix.taken == r.mix.epochs * words[i] + r.mix.part for i, r in after.items())


def test_pipeline_run(shared, data_dir):
    assert corpus_pipeline.run(shared, data_dir).count() > 50
