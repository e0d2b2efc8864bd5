"""Quality rules, lines first, with built-in functions only.

Every line of a text is judged by itself: boilerplate, navigation and punctuation rules.
Lines that fail are taken out, and a document that loses more than ``MOST_LOST`` hundredths of
its words goes.  Beside this stand the base figures of the whole text: words, symbols,
repeated lines and words in repeated windows.

A row is handled where it lies: nothing is shuffled, so no key can be hot.  Values used more
than once are bound as lambda variables (``_let``); an expression repeated in a plan would be
computed as often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import quoted

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5
LEAST_WORDS = 10
#: Hundredths of the words that may stand in repeated windows, and that lines may cost.
MOST_REPEATED = 20
MOST_LOST = 50
#: Words of a line that boilerplate phrases condemn; longer lines hold text beside them.
BOILERPLATE_WORDS = 40

# fixed values: what the rules look for, in lines whose A-Z are lower-cased
BOILERPLATE = ("all rights reserved", "copyright", "cookie", "javascript", "lorem ipsum", "privacy policy",
               "terms of use", "terms of service", "licensed under", "released under", "sign up", "subscribe",
               "click here")
NAVIGATION = ("home", "menu", "search", "login", "log in", "sign in", "next", "previous", "back to top",
              "read more", "share", "contact", "about us", "skip to content")
SEPARATOR = r"(?:^|[\x20\x09-\x0D])(?:[|/>»›·•]|&gt;)(?=[\x20\x09-\x0D]|\z)"
SENTENCE_END = r"""[.!?…。！？]["'”’»)\]]*(?:[\x20\x09-\x0D]|\z)"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_EDGE = r"[\x20\x09-\x0D]*"
_BOILERPLATE = "(?:" + "|".join(BOILERPLATE) + ")"
# what any separator holds: a line without it is not searched for words that are separators
_SEPARATING = r"[|/>»›·•;]"
_NAVIGATION = rf"\A{_EDGE}(?:" + "|".join(NAVIGATION) + rf"){_EDGE}\z"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def line_rule(line: Column) -> Column:
    """The rule that a line fails, or null.  Lines without a word fail none.

    ``boilerplate``  a phrase of ``BOILERPLATE`` in a line of up to ``BOILERPLATE_WORDS`` words
    ``navigation``   a line that is an entry of ``NAVIGATION``, or separators standing alone
                     are a quarter of its words
    ``symbols``      more than one of ``#*$%&|<>`` for every two words
    ``punctuation``  no sentence ends in the line
    """
    def phrases(lower):
        found = F.contains(lower, F.lit(BOILERPLATE[0]))
        for phrase in BOILERPLATE[1:]:
            found = found | F.contains(lower, F.lit(phrase))
        return F.when(found, "boilerplate").when(F.rlike(lower, F.lit(_NAVIGATION)), "navigation")

    def rule(words):
        short = F.when(words <= BOILERPLATE_WORDS, _let(F.translate(line, _UPPER, _LOWER), phrases))
        separated = F.rlike(line, F.lit(_SEPARATING)) & (_count(line, SEPARATOR) * 4 >= words)
        other = (F.when(separated, "navigation")
                 .when(_count(line, SYMBOL) * 2 > words, "symbols")
                 .when(~F.rlike(line, F.lit(SENTENCE_END)), "punctuation"))
        return F.when(words > 0, F.coalesce(short, other))

    return _let(_count(line, WORD), rule)


def _window(words: Column, at: Column):
    return [F.get(words, at + j) for j in range(WINDOW)]


def _again(entries: Column, field: str) -> Column:
    """The places ``p`` of sorted entries that share ``field`` with the one before or after."""
    return _let(entries, lambda s: F.array_compact(F.transform(s, lambda x, k: F.when(
        (x[field] == F.get(s, k - 1)[field]) | (x[field] == F.get(s, k + 1)[field]), x["p"]))))


def _covered(words: Column, hashes: Column) -> Column:
    """Words inside windows that occur twice or more.  Windows of equal hashes are compared as text."""
    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    text = lambda p: F.array_join(F.slice(words, p + 1, WINDOW), " ")
    by_text = F.sort_array(F.transform(_again(by_hash, "h"), lambda p: F.struct(text(p).alias("t"), p.alias("p"))))
    adds = lambda q: F.transform(q, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(p - F.get(q, k - 1), F.lit(WINDOW))))
    return F.aggregate(_let(F.sort_array(_again(by_text, "t")), adds), F.lit(0), lambda a, x: a + x)


def repeated_words(words: Column) -> Column:
    """Words in windows of ``WINDOW`` words found twice or more in an array, first included.

    Different hashes prove different windows; only a text with equal ones is sorted.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*_window(words, i)))
    covered = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(words, h)).otherwise(0))
    return F.when(F.size(words) > WINDOW, covered).otherwise(0)


def judged(docs: DataFrame, most_lost: int = MOST_LOST) -> DataFrame:
    """``docs`` as the struct ``row``, with the struct ``quality`` of every document:

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of the whole text,
    ``base_failed``, ``failed`` (how many lines fail each rule), ``n_kept_words``,
    ``kept_text`` (the lines left) and ``kept``.

    Null text is empty: it has no words and fails the base rules.  Blank lines fail no rule
    and stay.  Repeated rows are judged alike, each row by itself; doc_id is not read and may
    be null or repeated; other columns are only carried along, so their names cannot clash.
    """
    text = F.coalesce("text", F.lit(""))

    def of_words(words):
        return F.struct(F.size(words).cast("bigint").alias("n_words"),
                        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
                        repeated_words(words).cast("bigint").alias("n_repeat_words"))

    def of_lines(lines):
        repeated = lambda full: F.size(full) - F.size(F.array_distinct(full))
        left = lambda rules: F.array_join(F.filter(lines, lambda line, k: F.get(rules, k) == ""), "\n")
        count = lambda rules, rule: F.size(F.filter(rules, lambda r: r == rule)).alias(rule)
        rules = F.transform(lines, lambda line: F.coalesce(line_rule(line), F.lit("")))
        return F.struct(
            _let(F.filter(lines, lambda line: F.rlike(line, F.lit(WORD))), repeated).cast("bigint").alias("n_dup_lines"),
            _let(rules, lambda r: F.struct(left(r).alias("kept_text"), F.struct(
                *[count(r, name) for name in ("boilerplate", "navigation", "symbols", "punctuation")]).alias("failed")))
            .alias("lines"))

    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"),
                       _let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words).alias("w"),
                       _let(F.split(text, "\n", -1), of_lines).alias("l"),
                       _count(text, SYMBOL).cast("bigint").alias("n_symbols"))
    rows = rows.select("row", "w.*", "n_symbols", "l.n_dup_lines", "l.lines.*",
                       _count(F.col("l.lines.kept_text"), WORD).cast("bigint").alias("n_kept_words"))
    base = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    lost = (F.col("n_words") - F.col("n_kept_words")) * 100 > F.col("n_words") * most_lost
    return rows.select("row", F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "failed",
        "n_kept_words", "kept_text", (~base & ~lost).alias("kept")).alias("quality"))


def clean_documents(docs: DataFrame, most_lost: int = MOST_LOST) -> DataFrame:
    """The documents kept, all columns, without the lines that fail; ``n_chars``, where there
    is such a column, counts what is left."""
    rows = judged(docs, most_lost).where("quality.kept")
    column = lambda c: F.col("row").getField(c)
    left = {"text": F.col("quality.kept_text"), "n_chars": F.length("quality.kept_text").cast("bigint")}
    return rows.select(*[left.get(c, column(c)).alias(c) for c in docs.columns])


def q_op12_quality(spark, sf_dir):
    rows = judged(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return rows.select("row.doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_kept_words", "kept")])


SQL = rf"""
with d as (select row_number() over () as id, doc_id, coalesce(text, '') as t from documents),
p as (select id, doc_id, t, regexp_extract_all(t, '{WORD}') as ws, string_split(t, chr(10)) as ls from d),
win as (select id, unnest(range(len(ws) - 4)) as pos, ws from p where len(ws) >= 5),
key as (select id, pos, array_to_string(ws[pos + 1:pos + 5], ' ') as w from win),
again as (select id, pos from key qualify count(*) over (partition by id, w) > 1),
cover as (select id, sum(least(5, coalesce(pos - before, 5))) as n
          from (select id, pos, lag(pos) over (partition by id order by pos) as before from again) group by id),
line as (select id, unnest(ls) as l, unnest(range(len(ls))) as k from p),
low as (select id, l, k, len(regexp_extract_all(l, '{WORD}')) as n, translate(l, '{_UPPER}', '{_LOWER}') as s from line),
good as (select id, sum(n) as n from low where not (n > 0 and (
        (n <= {BOILERPLATE_WORDS} and regexp_matches(s, '{_BOILERPLATE}'))
        or regexp_matches(s, '{_NAVIGATION}')
        or len(regexp_extract_all(regexp_replace(s, '([\x20\x09-\x0D])', '\1\1', 'g'), '{SEPARATOR.replace("(?=", "(?:")}')) * 4 >= n
        or len(regexp_extract_all(s, '{SYMBOL}')) * 2 > n
        or not regexp_matches(s, '{SENTENCE_END.replace("'", "''")}'))) group by id),
b as (select id, doc_id, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
        cast(len(regexp_extract_all(t, '{SYMBOL}')) as bigint) as n_symbols,
        cast(len([l for l in ls if regexp_matches(l, '{WORD}')])
             - len(list_distinct([l for l in ls if regexp_matches(l, '{WORD}')])) as bigint) as n_dup_lines,
        cast(coalesce(cover.n, 0) as bigint) as n_repeat_words, cast(coalesce(good.n, 0) as bigint) as n_kept_words
      from p left join cover using (id) left join good using (id)),
f as (select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed from b)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_kept_words,
    not base_failed and (n_words - n_kept_words) * 100 <= n_words * {MOST_LOST} as kept from f
"""
