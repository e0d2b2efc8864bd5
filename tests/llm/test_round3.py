"""Operators 11 to 13 against plain Python, and their edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import op11_phrases, op12_quality, op13_merkle
from llm.op11_phrases import collocations, merged_stripes
from llm.op12_quality import clean_documents, judged, line_rule
from llm.op13_merkle import manifest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs_of(spark, rows, **clashing):
    """Rows of ``(doc_id, text, lang, source)``, and columns whose names the operators use."""
    df = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], DOC)
    for name in ("prefix", "slice", "n", "row", "quality", "kept", "tree", "pos", "digest", "up_block", "rank"):
        df = df.withColumn(name, F.lit("x"))
    return df


# --- 11 ------------------------------------------------------------------------------------


def brute_phrases(rows, least=30, subsumed=80, top=2000, longest=4):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    found = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in often.items():
            for size in range(2, len(p)):
                gone |= {p[i:i + size] for i in range(len(p) - size + 1) if 100 * a >= subsumed * counts[p[i:i + size]]}
        rows_ = []
        for p, a in often.items():
            if p not in gone:
                score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def phrases(df, **options):
    return sorted(map(tuple, collocations(df, **options).collect()))


@pytest.fixture(scope="module")
def talk():
    r = np.random.default_rng(3)
    vocabulary = ["the", "THE", "of", "New", "York", "élan", "ĳ", "a", "b", "c|d", "x y"]
    rows = []
    for i in range(400):
        words = [vocabulary[k] for k in r.integers(0, len(vocabulary), r.integers(0, 80))]
        text = "".join(w + str(r.choice([" "] * 9 + ["  ", "\t", ", ", ".", "\n", "!? "])) for w in words)
        rows.append((i % 50, text, [None, "en", "en", "und"][i % 4], "s"))
    return rows + [(None, None, "en", "s"), (1, "", None, None), (2, " \t,,. ", "en", "s"), (3, "alone", "zz", "s")]


def test_phrases_brute_force(shared, talk):
    want = brute_phrases(talk)
    assert len(want) > 40 and phrases(docs_of(shared, talk)) == want


def test_phrases_repeats_overlap_and_longest_words(shared):
    rows = [(1, "la " * 200, "en", "s"), (1, "la " * 200, "en", "s"), (2, ("w" * 70000 + " end ") * 31, "en", "s"),
            (3, "a b c d e. " * 40, "fr", "s"), (4, "c d. " * 100, "fr", "s")]
    assert phrases(docs_of(shared, rows)) == brute_phrases(rows)


def test_phrases_options_and_ties(shared, talk):
    for options in ({"least": 5, "subsumed": 50}, {"least": 2, "top": 7}, {"least": 3, "max_words": 2}):
        brute = {("longest" if k == "max_words" else k): v for k, v in options.items()}
        assert phrases(docs_of(shared, talk), **options) == brute_phrases(talk, **brute)


@pytest.mark.parametrize("bits, part", [(64, 2048), (1 << 16, 3), (64, 1 << 30)])
def test_full_filter_and_hot_prefixes_change_nothing(shared, talk, monkeypatch, bits, part):
    monkeypatch.setattr(op11_phrases, "LEAST_BITS", 64)
    monkeypatch.setattr(op11_phrases, "MOST_BITS", bits)
    monkeypatch.setattr(op11_phrases, "HOT_PART", part)
    assert phrases(docs_of(shared, talk)) == brute_phrases(talk)


@pytest.mark.parametrize("limit", [1, 7, 100])
def test_runs_are_cut_between_pieces(shared, talk, limit):
    import pyarrow as pa

    batch = pa.record_batch({"lang": pa.array([r[2] for r in talk], pa.string()), "text": pa.array([r[1] for r in talk], pa.string())})
    count = lambda n: Counter(" ".join(run.words[int(i)].as_py() for i in run.ids[k:k + 2]) for run in op11_phrases.runs_of([batch.slice(5)], n)
                              for k in np.flatnonzero(run.linked))
    assert count(limit) == count(1 << 20) and count(limit)


def test_stripe_totals_count_every_occurrence(shared):
    rows = [(1, "a b. a b. a c. a. b a", "en", "s")]
    stripes = merged_stripes(docs_of(shared, rows).select("lang", "text"), 1, least=1)
    words = {e["next"]: e["n"] for r in stripes.collect() for e in r.extensions}
    assert words == {"a": 5, "b": 3, "c": 1}
    (cands,), totals = op11_phrases.candidates(docs_of(shared, rows), least=2, max_words=2)
    assert [(r.phrase, r.a, r.heads, r.tails) for r in cands.collect()] == [("a b", 2, [5], [3])]
    assert totals.first().n == 9


def test_no_phrases(shared):
    assert phrases(docs_of(shared, [])) == [] and phrases(docs_of(shared, [(1, None, "en", "s")])) == []
    with pytest.raises(ValueError):
        collocations(docs_of(shared, [(1, "a", "en", "s")]), max_words=1)


# --- 12 ------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


GOOD = "This is a plain sentence with some words. Another one follows it here."
MENU = "Home | News | About | Contact | More | Login"
ODD = [None, "", " \t\n", "one", GOOD, "\n".join([GOOD, GOOD, "", MENU]), "\n".join([GOOD] + [MENU] * 6), "la " * 50,
       "a b c d e x a b c d e y z 1 2 3 4 5 6 7 8 9", "w" * 200000 + " " + GOOD, "  ".join(["ü"] * 12) + " é\x1c#",
       "a b c d e f g h i j k l m n o p\r\nq r s t.\x0b\x0c", "Cookie policy: this site uses cookies and scripts.\n" + GOOD,
       "\n".join(["buy### now*** the%%% best&&& thing$$$ ever###"] * 1 + [GOOD]), "no end here at all in this long line of words",
       "a b c d e a b c d e f", "x y\n" * 30, "a b c d a b c d a b c d a b"]


def test_base_figures_brute_force(shared):
    r = np.random.default_rng(5)
    texts = ODD + [" ".join(r.choice(list("abcd"), r.integers(1, 120))) + r.choice([".", "\n", " |"]) for _ in range(60)]
    rows = [(i // 2, t, "en", "s") for i, t in enumerate(texts)]
    got = judged(docs_of(shared, rows)).select("row.text", "quality.*").collect()
    assert len(got) == len(rows)
    for q in got:
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == brute_base(q.text)
        assert not (q.kept and q.base_failed)


def test_equal_hashes_do_not_make_windows_equal(shared, monkeypatch):
    """All windows share a hash: only their text tells them apart."""
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    rows = [(i, t, "en", "s") for i, t in enumerate(ODD)]
    for q in judged(docs_of(shared, rows)).select("row.text", "quality.*").collect():
        assert q.n_repeat_words == brute_base(q.text)[4]


@pytest.mark.parametrize("line, rule", [
    ("", None), (" \t", None), (GOOD, None), ("Done.", None), ('He said "stop!"', None), ("Was it so?) ", None),
    ("Alles gut。", None), ("All Rights Reserved.", "boilerplate"), ("We use COOKIES here. " + "word " * 50 + "end.", None),
    ("home", "navigation"), ("  Read More ", "navigation"), (MENU, "navigation"), ("By |", "navigation"),
    ("a | b of many other words that follow here and end well.", None), ("x### y*** z%%% done.", "symbols"),
    ("a heading without an end", "punctuation"), ("version 1.5 of", "punctuation")])
def test_line_rules(shared, line, rule):
    assert shared.createDataFrame([(line,)], "l string").select(line_rule(F.col("l"))).first()[0] == rule


def test_documents_lose_lines_first(shared):
    text = "\n".join([GOOD, MENU, "", GOOD.upper()])
    df = docs_of(shared, [(1, text, "en", "s"), (1, text, "en", "s"), (2, "\n".join([GOOD, MENU, "Shop > Sale > Jobs > Terms > Help"]), "en", None), (None, GOOD, None, None)])
    kept = clean_documents(df)
    assert kept.columns == df.columns
    rows = sorted(kept.collect(), key=str)
    assert [r.text for r in rows] == ["\n".join([GOOD, "", GOOD.upper()])] * 2 + [GOOD]
    assert all(r.n_chars == len(r.text) and r.tree == "x" for r in rows)
    failed = judged(df).where("row.doc_id = 2").select("quality.*").first()
    assert failed.failed.navigation == 2 and not failed.base_failed and not failed.kept
    assert clean_documents(df, most_lost=90).count() == 4
    assert judged(docs_of(shared, [])).count() == 0


def test_quality_is_native(shared):
    plan = judged(docs_of(shared, [(1, GOOD, "en", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


# --- 13 ------------------------------------------------------------------------------------


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(leaves):
    """Levels from the leaves to the one node left."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i:i + 16])) for i in range(0, len(below), 16)])
    return levels


def brute_manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, t, lang, s: h("".join(map(field, (i, s, lang, None if t is None else len(t), t))))
    by = defaultdict(list)
    for i, t, lang, s in rows:
        hit = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        changed = h("".join(map(field, (i, s, lang, None if t is None else len(t), t and t.translate(LOWER))))) if hit else None
        by[s].append((i is not None, i or 0, leaf(i, t, lang, s), changed, i))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([r[2] for r in sorted(by[s], key=lambda r: r[:3])]) for s in order}
    top = brute_tree([trees[s][-1][0] for s in order]) if order else None
    found = []
    for place, s in enumerate(order):
        for at, (_, _, digest, changed, i) in enumerate(sorted(by[s], key=lambda r: r[:3])):
            node, proof = changed or digest, ""
            for levels, k in ((trees[s], at), (top, place)):
                for level in levels[:-1]:
                    run = level[k // 16 * 16:k // 16 * 16 + 16]
                    left, right = "".join(run[:k % 16]), "".join(run[k % 16 + 1:])
                    node, proof, k = h(left + node + right), proof + left + right, k // 16
            found.append((i, digest, trees[s][-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return sorted(found, key=str)


def proved(df, **options):
    rows = manifest(df, **options).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted(map(tuple, rows), key=str)


def test_manifest_brute_force(shared):
    r = np.random.default_rng(1)
    rows = [(int(r.integers(0, 3000)), f"Text {k}" * int(k % 3), [None, "en"][k % 2], "hot") for k in range(4700)]
    rows += [(k, "T", "en", f"s{k % 40}") for k in range(400)] + [(2**60 + k, None, None, None) for k in range(17)]
    rows += [(None, "nobody", "en", "hot"), (None, None, None, "é"), (5, "twice", "en", "s1"), (5, "twice", "en", "s1"), (7, "", "", "")]
    want = brute_manifest(rows)
    assert proved(docs_of(shared, rows)) == want and sum(not w[-1] for w in want) > 500


def test_small_superblocks_need_more_tiers(shared, monkeypatch):
    """Superblocks of 16 nodes: several tiers of sources and of subroots."""
    monkeypatch.setattr(op13_merkle, "DEPTH", 1)
    monkeypatch.setattr(op13_merkle, "BLOCK", 16)
    rows = [(k, f"Ab{k}", "en", "hot") for k in range(700)] + [(k, "Cd", "en", f"s{k}") for k in range(300)]
    assert proved(docs_of(shared, rows)) == brute_manifest(rows)


@pytest.mark.parametrize("rows", [
    [], [(1, "Alone", "en", "s")], [(k, "X", None, None) for k in range(16)], [(k, "X", None, None) for k in range(17)],
    [(1, "same", "en", "s")] * 40, [(k, None, None, f"{k}") for k in range(20)]])
def test_odd_sizes(shared, rows):
    assert proved(docs_of(shared, rows)) == brute_manifest(rows)


def test_proofs_fold_to_the_root(shared):
    rows = [(k, f"t{k}", "en", "ab"[k % 2]) for k in range(50)]
    for r in manifest(docs_of(shared, rows), proofs=True).collect():
        node = r.leaf
        for left, right in zip(r.lefts, r.rights):
            node = h(left + node + right)
        assert node == r.root and r.verified == (r.folded_root == r.root)
    # texts without capitals: tampering changes nothing
    assert all(r[-1] for r in proved(docs_of(shared, rows)))


# --- 3: paths whose coordinates do not repeat ------------------------------------------------


def shingled(words, size=5):
    return frozenset(tuple(words[p:p + size]) for p in range(len(words) - size + 1))


def test_dissimilar_sets_leave_no_large_bucket(shared, monkeypatch):
    """Sets that share a tenth of their shingles: every bucket is split until it is small."""
    from llm import op3_jaccard

    monkeypatch.setattr(op3_jaccard, "SMALL", 24)
    monkeypatch.setattr(op3_jaccard, "FIRST_RUNS", 4)
    r = np.random.default_rng(4)
    # signatures whose coordinates agree with probability 0.15 for any two
    signature = np.where(r.random((3000, 64)) < 0.4, 1, r.integers(10, 2**30, (3000, 64)))
    nodes = shared.createDataFrame([(k.to_bytes(4, "big"), 100, row.tolist()) for k, row in enumerate(signature)],
                                   "node binary, n_bytes bigint, signature array<int>")
    found, depth = op3_jaccard._split(nodes, range(4))
    assert depth < op3_jaccard.MAX_DEPTH
    assert found.agg(F.max("n")).first()[0] <= 24


def test_recall_of_pairs_just_above_the_threshold(shared, monkeypatch):
    """Planted pairs of similarity 0.80 to 0.85, in buckets that are split many times."""
    from llm import op3_jaccard

    monkeypatch.setattr(op3_jaccard, "SMALL", 16)
    r = np.random.default_rng(6)
    rows, pairs = [], []
    for k in range(150):
        words = [f"w{r.integers(0, 10**6)}" for _ in range(120)]
        other = list(words)
        for p in (30 + k % 3, 70 + k % 7):
            other[p] = "x"
        a, b = shingled(words), shingled(other)
        if 0.8 <= len(a & b) / len(a | b) <= 0.86:
            pairs.append((2 * k, 2 * k + 1))
        rows += [(2 * k, " ".join(words), "en", "s"), (2 * k + 1, " ".join(other), "en", "s")]
    got = {q.doc_id: q.class_id for q in op3_jaccard.near_duplicates(docs_of(shared, rows)).select("doc_id", "class_id").collect()}
    caught = sum(got[a] == got[b] for a, b in pairs)
    assert len(pairs) > 100 and caught >= 0.95 * len(pairs)


# --- 2: blocks of the benchmark ---------------------------------------------------------------


def test_only_possible_suffixes_are_searched():
    import pyarrow as pa

    from llm.op2_decontaminate import _possible, test_block

    items = pa.table({"name": ["a", "b"], "text": ["one two three four five", "six seven"]})
    block = test_block(items, 3)
    number = lambda text: 1 + np.searchsorted(block.vocabulary, test_block(pa.table({"name": ["x"], "text": [text]}), 1).vocabulary)
    starts = lambda text: block.starts[_possible(number(text), block)].tolist()
    assert starts("one two three") == [0] and starts("two three four five") == [1, 2] and starts("six seven") == [6] and starts("six one two") == []


def test_items_do_not_pass_the_driver(shared, monkeypatch):
    from pyspark.sql import DataFrame

    from llm import op2_decontaminate

    monkeypatch.setattr(DataFrame, "toArrow", lambda self: pytest.fail("items on the driver"))
    text = " ".join(f"word{k}" for k in range(40))
    bench = shared.createDataFrame([(k, text if k % 2 else f"other {k} " * 20) for k in range(50)] * 2, "item_id long, text string")
    docs = docs_of(shared, [(1, "before " + text + " after", "en", "s"), (2, "word1 word2 word3", "en", "s"), (3, None, "en", "s")])
    for block_bytes in (1 << 22, 500):
        got = {r.doc_id: r for r in op2_decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect()}
        assert (got[1].n_hit, got[1].n_items, got[1].longest, got[1].longest_at) == (40, 25, 40, 1)
        assert (got[2].n_hit, got[2].n_words, got[3].n_words) == (0, 3, 0)


# --- 7: what the network rejects ---------------------------------------------------------------


def test_unsure_documents_are_rejected(shared, monkeypatch):
    from llm import gru, op7_language

    rows = [(1, "some text", None, "s"), (2, "12 34", "en", "s"), (3, None, "en", "s"), (3, "some text", "fr", "s")]
    docs = docs_of(shared, rows)
    kept = lambda **options: sorted((r.doc_id, r.lang) for r in op7_language.of_known_language(docs, **options).collect())
    weights = {k: 0 * v for k, v in gru.new_weights(2, 4, 0).items()}
    even = gru.Model(["de", "en", "es", "fr"], weights)
    monkeypatch.setattr(op7_language, "fit", lambda docs, **options: even)
    assert kept() == [] and kept(floor=0.0) == [(1, "de"), (3, "fr")]
    sure = gru.Model(even.labels, weights | {"bias": np.array([0, 5, 0, 0], np.float32)})
    monkeypatch.setattr(op7_language, "fit", lambda docs, **options: sure)
    assert kept() == [(1, "en"), (3, "fr")]
    monkeypatch.setattr(op7_language, "fit", lambda docs, **options: None)
    assert kept() == [(1, None), (3, "fr")]
    assert op7_language.least_score(1) == 0 and abs(op7_language.least_score(4) - 0.3475) < 1e-9
