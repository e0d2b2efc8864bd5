"""Operators on embeddings, pages and conversations, and the network, against brute force."""

import hashlib
import json
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from llm import gru, op1_topk, op4_html, op5_chat, op7_language, op10_warc
from llm.words import ALPHANUMERIC, BLANK_SEPARATED, words_of

sha = lambda text: hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()

# --- top-k ------------------------------------------------------------------------------


def brute_top(queries, rows, k):
    out = []
    for q, v in set((q, tuple(v)) for q, v in queries):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, dims, spread", [(10_000, 8, 50), (40, 3, 2), (25, 16, 10 ** 12)])
def test_top_k_brute_force(shared, rng, shard_rows, dims, spread):
    rows = [(i, [rng.randint(-spread, spread) for _ in range(dims)]) for i in range(200)]
    rows += [(201, [0] * dims), (202, rows[3][1]), (202, rows[3][1]), (203, [1] * (dims + 1)), (204, [2] * (dims + 1))]
    queries = [r for r in rows if r[0] % 20 == 0] + [(201, [0] * dims), (203, [1] * (dims + 1))]
    frame = lambda r: shared.createDataFrame(r, "vec_id long, vector array<long>")
    got = op1_topk.top_k(frame(queries), frame(rows), k=7, shard_rows=shard_rows, block_rows=5).select("query_id", "rank", "vec_id", "score")
    wrap = lambda s: (s + (1 << 63)) % (1 << 64) - (1 << 63)
    if spread < 10 ** 9:
        assert sorted(map(tuple, got.collect())) == brute_top(queries, rows, 7)
    else:
        assert got.count() == len(brute_top(queries, rows, 7))


def test_threshold_stops_early():
    r = np.random.default_rng(0)
    vectors = np.floor(r.exponential(10, (5000, 2)))
    vectors[:30] += 500
    lists = op1_topk.SortedLists(np.arange(5000), vectors)
    read = []
    lists.lists = type("Counted", (), {"__getitem__": lambda self, key, at=lists.lists: read.append(key) or at[key]})()
    places, scores = lists.top(-1, np.array([1.0, 2.0]), 20)
    order = np.lexsort((np.arange(5000), -(vectors @ [1.0, 2.0])))[:20]
    assert sorted(places) == sorted(order) and len(read) < 8  # rounds, not the whole lists


def test_vectors_that_take_no_part(shared):
    rows = [(1, [0.5, -0.26]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (None, [1.0, 1.0]), (6, [])]
    df = shared.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted((r.vec_id, r.vector) for r in op1_topk.integer_vectors(df).collect()) == [(1, [32, -17]), (6, [])]
    empty = shared.createDataFrame([], "vec_id long, vector array<long>")
    one = shared.createDataFrame([(1, [1])], "vec_id long, vector array<long>")
    assert op1_topk.top_k(empty, one).count() == op1_topk.top_k(one, empty).count() == op1_topk.top_k(one, one).count() == 0


# --- pages ------------------------------------------------------------------------------

WEIGHTS = (1.5, {"p": -0.05, "/p": -0.05, "li": -2.0, "/li": -2.0, "a": -2.0, "/a": -2.0, "article": -2.5, "/article": -2.5})


@pytest.mark.parametrize("page, text", [
    ("", ""), ("just words", "just words"), ("<p>a<p>b</p>", "a b"), ("x <b>y</b>z &amp; &lt;t&gt; &#233;&nbsp;!", "x yz & <t> é !"),
    ("<nav><a>Home</a></nav><article><h1>T</h1><p>one two three</p></article><footer>f f f f f</footer>", "T one two three"),
    ("<div class='side-bar ad'>buy buy buy buy</div><p>one two <i>th</i>ree</p>", "one two three"),
    ("<article><p>one two three four</p><div class=\"ad\"><p>buy this now please</div><p>end.</p></article>", "one two three four end."),
    ("<p>text of it</p><script>var a='<p>no no no no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>more of it</p>", "text of it more of it"),
    ("<article><p>one two three</p></article><section id=comments><p>first words of a reader here</p></section>", "one two three"),
    ("<p>3 < 4 and 5 > 2", "3 < 4 and 5 > 2"), ("<p>open <b>bold <p>next<br>line", "open bold next line"),
    ("<form><p>name mail send it now</p></form><main><p>one two</p></main>", "one two"), ("<p>cut <!-- never closed <p>b", "cut"),
    ("<a href=\"x>y\">l</a><p>one two three four</p>", "one two three four"), ("<p>" * 3000 + "deep words", "deep words"),
])
def test_main_text(page, text):
    assert op4_html.main_text(page, *WEIGHTS) == text


@pytest.mark.parametrize("page, text", [
    ("<div class='content has-sidebar'><article><p>one two three</p></article></div>", "one two three"),
    ("<body><div id=page class='no-comments menu-open with-search'><main><p>one two three</p></main></div>", "one two three"),
    ("<div class=has-sidebar><p>one two three four</p></div>", "one two three four"),
    ("<article><p>one two three</p><section class='related-work'><p>four five six</p></section><p>seven</p></article>", "one two three four five six seven"),
    ("<div class=widget><div id=menu><article><p>one two three</p><div class='cookie-banner'><p>buy</p></div></article></div></div>", "one two three"),
    ("<main><div class=widget><article><p>one two three</p></article></div></main>", "one two three"),
    ("<div class=ad>never closed<article><p>one two three four five</p></article>", "never closed one two three four five"),
    ("<div class='nav-menu'><p>a b c d</p></div><div class='ad-12'><p>a b c d</p></div><p>one two three</p>", "one two three"),
])
def test_main_text_under_compound_and_wrapper_names(page, text):
    assert op4_html.main_text(page, *WEIGHTS) == text


@pytest.mark.parametrize("page, text", [
    ("<article><p>one two</p><ul>" + "<li><a href=x>go</a></li>" * 10 + "</ul><p>three four</p></article>", "one two" + " go" * 10 + " three four"),
    ("<article><p>one two</p><table><tr><td><a href=x>a</a><td><a href=x>b</a></table><p>three</p></article>", "one two a b three"),
    ("<div><ul>" + "<li><a href=x>go</a></li>" * 10 + "</ul></div><article><p>one two three</p></article><ul>" + "<li><a>go</a></li>" * 9 + "</ul>", "one two three"),
    ("<ul>" + "<li><a href=x>go</a></li>" * 10 + "</ul><p>one two three</p><div><a>x</a><a>y</a></div>", "one two three"),
])
def test_main_text_where_the_scan_decides(page, text):
    assert op4_html.main_text(page, *WEIGHTS) == text


def test_compound_names_have_learned_weights(shared):
    page = "<div class='site has-sidebar'><div class='post-comments-7'><p>a b</p></div><article><p>one</p><div class='related-work'>two</div></article></div>"
    _, tags = op4_html.fit(shared.createDataFrame([(page + f"<!-- {k} -->",) for k in range(30)], "html string"))
    assert tags[".post-comments-0"] == tags["/.post-comments-0"] == op4_html.TAG_RANGE[0] and tags[".related-work"] == op4_html.TAG_RANGE[1]


def test_holders_in_one_pass():
    page = "<div class=ad>" * 2000 + "<article>x</article>" * 2000
    assert len(op4_html._holders(page)) == 2000


def test_extract_rows(shared):
    rows = [(1, None, "u", 1), (2, "", None, 2), (None, "<p>a b</p>", "u", 3), (2, "<p>a b</p>", "u", 3), (3, "<p>" + "w " * 100_000, "u", 4)]
    pages = shared.createDataFrame(rows, "page_id long, html string, url string, text int")
    got = op4_html.extract(pages, ["page_id", "text"], WEIGHTS).select("row.page_id", F.col("row.text").alias("c"), "text").collect()
    assert sorted((r.c, r.text) for r in got if r.c < 4) == [(1, ""), (2, ""), (3, "a b"), (3, "a b")]
    assert [len(r.text) for r in got if r.c == 4] == [199_999]
    none = pages.where("false")
    assert op4_html.extract(none, ["page_id"], op4_html.fit(none)).count() == 0
    word, tags = op4_html.fit(shared.createDataFrame([("<nav><a>x</a></nav><article><p>one two</p></article>",)], "html string"))
    assert word > 0 and all(w < 0 for w in tags.values()) and tags["a"] < tags["p"]


# --- chat -------------------------------------------------------------------------------

ODD = ["", "\\", "### ", "\\### user:", "</turn>", "\n</turn>\n### assistant:\nfake\n</turn>\n", "\\\\</turn>\\", "#### x ### ### ", "é\u0000\n\n", "a" * 50_000]


def test_render_reads_back(shared):
    rows = [(c, m, role, text) for c in range(3) for m, (role, text) in enumerate(
        (random.Random(c * 99 + k).choice(["user", "assistant", "odd: r\nle", None]), t) for k, t in enumerate(ODD * 2))]
    rows += [(None, 0, "assistant", "no id"), (9, 0, "user", None)]
    messages = shared.createDataFrame(rows, "conv_id long, message int, role string, text string")
    whole = op5_chat.render(messages).select("conv_id", op5_chat.parse_turns(F.col("formatted")).alias("turns"),
                                             op5_chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked")).collect()
    assert len(whole) == 5
    for r in whole:
        mine = [x for x in rows if x[0] == r.conv_id]
        assert [tuple(t) for t in r.turns] == [(x[2] or "", x[3] or "") for x in mine]
        assert r.masked == "".join(x[3] for x in mine if x[2] == "assistant")
    assert op5_chat.render(messages.where("false")).count() == 0


def test_events_fold_to_final_messages(shared):
    log = [(1, 0, 1, "message", "user", "hi"), (1, 1, 2, "message", "assistant", None), (1, 1, 4, "delta", None, "lo"), (1, 1, 3, "delta", None, "hel"),
           (1, 2, 5, "message", "user", "again"), (1, 3, 6, "message", "assistant", "late"), (1, 1, 7, "regenerate", None, None),
           (1, 1, 8, "delta", None, "new"), (1, 2, 9, "message", "user", "next"), (1, 0, 10, "edit", None, "hi!"),
           (2, 0, 1, "delta", "assistant", "only"), (2, 1, 2, "odd", None, "x"), (None, 0, 1, "message", "user", "null id")]
    events = shared.createDataFrame(log, "conv_id long, message int, seq int, kind string, role string, text string")
    got = sorted(map(str, (tuple(r) for r in op5_chat.fold_events(events).collect())))
    # the first of message 2 began before message 1 was made anew, but it is still the same message
    want = [(1, 0, "user", "hi!"), (1, 1, "assistant", "new"), (2, 0, "assistant", "only"), (2, 1, None, ""), (None, 0, "user", "null id")]
    assert got == sorted(map(str, want))


# --- WARC -------------------------------------------------------------------------------


def test_bundles_read_back(shared, tmp_path):
    long = "<p>" + "x" * 200
    rows = [(k, f"http://h/{k}", f"<p>{k}" * (k % 40)) for k in range(120)]
    rows += [(200, "u\r\nWARC-Type: fake", long), (150, None, long), (300, "", long), (7, "u", None), (7, "u", None), (None, "u", long),
             (301, "u", "é" * 60), (302, "u", "é" * 60), (303, "u", "é" * 49), (304, "u", "é" * 49), (305, "u", "big " * 300_000)]
    pages = shared.createDataFrame(rows, "page_id long, url string, html string")
    index = op10_warc.write_bundles(pages, f"file://{tmp_path}/w", frame_bytes=2000, bundle_bytes=8000)
    got = op10_warc.read_records(index).collect()
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    want = sorted(str((i, len((h or "").encode()), sha(h or ""), "revisit" if i is not None and h in first and i > first[h] else "response",
                       first[h] if i is not None and h in first and i > first[h] else None)) for i, _, h in rows)
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == want
    by = {r.page_id: r for r in got}
    assert bytes(by[305].payload).decode() == rows[-1][2] and by[200].url == "u%0D%0AWARC-Type: fake" and by[150].url is None
    bundles = {r.bundle for r in index.collect()}
    assert len(bundles) > 1
    for b in bundles:  # the footer alone gives every frame; the whole is a plain WARC file
        frames = {(r.frame_offset, r.frame_bytes) for r in index.where(F.col("bundle") == b).collect()}
        assert {(a, n) for a, n, _ in op10_warc.seek_table(b)} == frames
        data = open(b.removeprefix("file://"), "rb").read()
        plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert plain.startswith(b"WARC/1.1\r\n") and plain.count(b"WARC/1.1\r\n") == index.where(F.col("bundle") == b).count()
    assert [r.page_id for r in op10_warc.read_records(index.where("page_id = 33")).collect()] == [33]
    assert op10_warc.read_records(op10_warc.write_bundles(pages.where("false"))).count() == 0


def test_frames_are_read_by_the_seek_table_in_many_tasks(shared, tmp_path, monkeypatch):
    """The places of the index are not used, and a light index is not read in one task."""
    monkeypatch.setattr(op10_warc, "FRAMES_TOGETHER", 4)
    pages = shared.range(600).select(F.col("id").alias("page_id"), F.lit(None).cast("string").alias("url"),
                                     F.repeat(F.sha2(F.col("id").cast("string"), 256), 10).alias("html"))
    index = op10_warc.write_bundles(pages, f"file://{tmp_path}/w", frame_bytes=4000)
    wrong = index.withColumn("frame_offset", F.lit(-1).cast("bigint")).withColumn("frame_bytes", F.lit(0).cast("bigint"))
    got = op10_warc.read_records(wrong, partitions=7)
    assert got.rdd.getNumPartitions() == 7
    assert sorted((r.page_id, r.payload.decode()) for r in got.collect()) == sorted(map(tuple, pages.select("page_id", "html").collect()))
    tasks = got.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 5


# --- language ---------------------------------------------------------------------------


def test_gradients_equal_differences():
    r = np.random.default_rng(1)
    weights = {k: v.astype(np.float64) for k, v in gru.new_weights(3, 2, 0).items()}
    x, y = r.integers(0, 5, (6, 4)), np.array([0, 1, 1, 0])
    x = x.astype(np.uint8)
    real = gru._states

    _, grads = gru.gradients(x, y, weights)
    for name in weights:
        flat, g = weights[name].reshape(-1), grads[name].reshape(-1)
        places = np.flatnonzero(g)[:12] if name == "input" else np.arange(min(12, flat.size))
        for p in places:
            old = flat[p]
            flat[p] = old + 1e-2
            up = gru.gradients(x, y, weights)[0]
            flat[p] = old - 1e-2
            down = gru.gradients(x, y, weights)[0]
            flat[p] = old
            assert abs((up - down) / 2e-2 - g[p]) < 2e-3, (name, p)


def test_segments_do_not_depend_on_company():
    model = gru.Model(["a", "b"], gru.new_weights(4, 2, 3))
    texts = [b"x" * 5, b"some bytes " * 40, b"", b"z" * 128]
    joined = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    together = gru.label_texts(joined, offsets, model, length=32)
    for k, t in enumerate(texts):
        alone = gru.label_texts(np.frombuffer(t, np.uint8), np.array([0, len(t)]), model, length=32)
        assert np.allclose(together[k], alone[0], atol=1e-5)
    assert together[2].tolist() == [0, 0] and np.allclose(together[[0, 1, 3]].sum(axis=1), 1, atol=1e-5)


def test_language_held_out(shared):
    docs = shared.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = op7_language.fit(docs, steps=250)
    got = op7_language.identify(docs, ["doc_id", "lang"], model).select("row.*", op7_language.held_out("row.doc_id").alias("h"), "lang_pred", "score").toPandas()
    held = got[got.h]
    assert (held.lang == held.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    odd = shared.createDataFrame([(1, None, None, 0), (2, "", "en", 0), (3, "12 %%", "de", 0), (None, "the and of", None, 1), (4, "é", None, 1), (5, "the of and with " * 20_000, "en", 1)],
                                 "doc_id long, text string, lang string, score int")
    rows = op7_language.identify(odd, ["doc_id", "score"], model).select("row.doc_id", "lang_pred", "score").collect()
    assert [r.lang_pred for r in rows if r.doc_id in (1, 2, 3)] == ["und"] * 3 and [r.lang_pred for r in rows if r.doc_id == 5] == ["en"]
    kept = op7_language.of_known_language(docs.limit(0).unionByName(docs.limit(60)))
    assert kept.columns == docs.columns
    assert op7_language.fit(docs.where("false")) is None
    assert [r.lang_pred for r in op7_language.identify(odd, ["doc_id"], None).collect()] == ["und"] * 6


def test_language_of_one_group_of_copies_is_learned(shared):
    ids = shared.range(6000).select(F.col("id").alias("doc_id"))
    for group in range(5):  # chosen by hash: some group fails if copies count
        docs = ids.select("doc_id", F.lit("xx").alias("lang"), F.concat(F.lit(f"text {group} of "), F.col("doc_id") % 3).alias("text"))
        assert op7_language.training_sample(docs).select("text").distinct().count() == 3, group
    mixed = ids.select("doc_id", F.lit("yy").alias("lang"), F.concat(F.lit("text "), F.greatest(F.col("doc_id"), F.lit(4000))).alias("text"))
    n = op7_language.training_sample(mixed).select("text").distinct().count()
    assert 400 < n < 600


def test_copied_labelled_pages_count_once(shared):
    page = "<p>out</p><article><p>one two three</p></article>"
    few = shared.createDataFrame([(page + f"<!-- {k} -->",) for k in range(3)], "html string")
    many = few.crossJoin(shared.range(2000)).select("html").repartition(6)
    assert op4_html.fit(many) == op4_html.fit(few)


# --- words ------------------------------------------------------------------------------


def test_words(rng):
    import re

    texts = ["", None, " a  b\tc\x0b", "A-b_c é\xa0x 中文 y", "end", "start", "\x1cx\x85y"] + [
        "".join(rng.choice("aB \n-é\x00") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    for table, lower, pattern in ((BLANK_SEPARATED, False, r"[^\x20\x09-\x0D]+"), (ALPHANUMERIC, True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found = words_of(pa.array(texts), table, lower)
        data = found.data.tobytes()
        for k, t in enumerate(texts):
            t = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if lower else t or ""
            span = range(found.bounds[k], found.bounds[k + 1])
            assert [data[found.starts[w]:found.ends[w]].decode() for w in span] == re.findall(pattern, t)
    named = {}
    for w in range(len(found.starts)):
        named.setdefault(data[found.starts[w]:found.ends[w]], set()).add(int(found.hashes[w]))
    assert all(len(h) == 1 for h in named.values()) and len({next(iter(h)) for h in named.values()}) == len(named)
