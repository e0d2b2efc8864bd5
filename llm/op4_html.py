"""Main text of web pages as the best-scoring run of tokens.

A page is a sequence of words and tags.  Words score positive, tags negative; the main text
is the contiguous run with the highest sum, found in one linear scan.  The weights are
log-odds counted on pages that label their own text with an ``article`` or ``main`` element:
how often a tag stands inside such an element and how often outside.  Inside such an element
tags weigh the least, so lists, links and tables do not cut its text.  Elements that are
never main text (menus, forms, adverts, scripts, reader comments and the like) give no
words, wherever they stand.  A class or id makes an element one of these if all its words
are listed (``ad``, ``cookie-banner``) and no ``article`` or ``main`` stands inside, as does a
form (some pages stand in one); a name with a listed word as a part (``has-sidebar``) is a tag
of its own, with a weight as any.

Time is linear in the page: every open element is counted by its name, so a closing tag that
ends nothing is known without a search.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import beside_row, small_batches

#: The bound of the sample that weights are counted on, in labelled pages.
SAMPLE_PAGES = 2000
#: Bounds of the weights, and the weight of a tag that no labelled page has.
WORD_RANGE = (0.5, 2.0)
TAG_RANGE = (-2.5, -0.05)
UNSEEN_TAG = -0.3

# fixed values: element and class names of HTML practice
RAW = "script style noscript template textarea title svg math iframe object canvas select option audio video"
ASIDE = "aside button dialog head"  # leave no mark on the run they stand in
FORMS = "form fieldset"  # nor do these, unless they hold the main text
FRAME = "nav header footer menu"  # of the page; their tags count
VOID = "area base br col embed hr img input link meta param source track wbr"
INLINE = ("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
          "span strike strong sub sup time tt u var wbr")
LABELLED = ("article", "main")
CLASSES = ("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
           "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
           "comment comments disqus respond reply replies sidebar widget menu nav navbar navigation breadcrumb breadcrumbs "
           "masthead footer related recommended recommendations share sharing social pagination pager login search skip")
ROLES = "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form"
CLOSED_BY_BLOCK = {"p"}
CLOSES_ITSELF = {"li", "dt", "dd", "tr", "td", "th", "p", "option"}

_sets = {name: frozenset(text.split()) for name, text in
         dict(raw=RAW, aside=ASIDE, forms=FORMS, frame=FRAME, void=VOID, inline=INLINE, classes=CLASSES, roles=ROLES).items()}
_raw = "|".join(sorted(_sets["raw"]))
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_raw})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>",
    re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[a-z]+|[0-9]+")
_NUMBER = re.compile(r"[0-9]+")
_HEADINGS = frozenset(f"h{k}" for k in range(1, 7))


def _dropped(name: str, attributes: str) -> tuple[str, tuple[str, ...]]:
    """``frame`` or ``aside`` if an element is never main text, ``named`` if its class or id
    says so or it is a form, else empty; and its classes and ids with a listed word, as ``.name``."""
    if name in _sets["frame"]:
        return "frame", ()
    if name in _sets["aside"]:
        return "aside", ()
    kind, marks = "named" if name in _sets["forms"] else "", []
    if attributes and name not in ("body", "html", *LABELLED):
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), (a or b or c).lower()
            if key in ("class", "id") and not _sets["classes"].isdisjoint(_PART.findall(value)):
                for one in value.split():
                    parts = [x for x in _PART.findall(one) if x.isalpha()]
                    if not _sets["classes"].isdisjoint(parts):
                        marks.append("." + _NUMBER.sub("0", one)[:38])
                        if _sets["classes"].issuperset(parts):
                            kind = "named"
            if key == "role" and value.strip() in _sets["roles"] or key == "hidden" or key == "aria-hidden" and value == "true":
                return "aside", ()
    return kind, tuple(dict.fromkeys(marks))


class _Open:
    """The elements that are open: a stack, and how many there are of every name and kind.

    A closing tag is searched for only if its element is open, and the search passes over
    elements that it ends: a page of n tags takes n steps in all.
    """

    def __init__(self):
        self.stack, self.names = [], defaultdict(int)
        self.labelled = self.headings = self.asides = self.frames = 0

    def _count(self, name: str, kind: str, by: int) -> None:
        self.names[name] += by
        self.labelled += by * (name in LABELLED)
        self.headings += by * (name in _HEADINGS)
        self.asides += by * (kind == "aside")
        self.frames += by * (kind == "frame")

    def push(self, name: str, kind: str, rest) -> None:
        self.stack.append((name, kind, rest))
        self._count(name, kind, 1)

    def place(self, name: str) -> int | None:
        """The place of the element that a closing tag ends."""
        if not self.names[name]:
            return None
        return next(k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k][0] == name)

    def cut(self, n: int) -> list:
        """Ends the elements from the n-th on, and returns them."""
        ended = self.stack[n:]
        del self.stack[n:]
        for name, kind, _ in ended:
            self._count(name, kind, -1)
        return ended


def _ends_last(stack: list, name: str) -> bool:
    """Whether an opening tag ends the last open element."""
    return bool(stack) and name not in _sets["inline"] and (stack[-1][0] in CLOSED_BY_BLOCK or stack[-1][0] == name) \
        and stack[-1][0] in CLOSES_ITSELF


def _holders(page: str) -> set[int]:
    """Where the elements begin that an ``article`` or ``main`` stands in."""
    opened, found = _Open(), set()
    for match in TOKEN.finditer(page):
        name = (match[3] or match[6] or "").lower()
        if not name:
            continue
        if match[2] or match[5]:
            if (k := opened.place(name)) is not None:
                opened.cut(k)
            continue
        if _ends_last(opened.stack, name):
            opened.cut(len(opened.stack) - 1)
        if name in LABELLED:
            for _, _, place in reversed(opened.stack):
                if place in found:  # and so are all around it
                    break
                found.add(place)
        if name not in _sets["void"]:
            opened.push(name, "", match.start())
    return found


def tokens(page: str):
    """``(kind, value, labelled)`` in page order: ``text`` (characters of main-text candidates),
    ``break`` (between blocks), ``tag`` (name, or ``.name`` of a class or id; after ``/`` if closing)."""
    opened, at, holders = _Open(), 0, None  # elements with their kind of drop and their marks

    def text(piece):
        dropped = opened.asides + opened.frames
        heading = dropped == 1 and opened.frames and opened.names["header"] and opened.labelled and opened.headings
        if piece and (not dropped or heading):
            yield "text", entities.unescape(piece), opened.labelled > 0

    def pop(n):
        for mark in [mark for _, _, own in opened.cut(n) for mark in own]:
            yield "tag", "/" + mark, opened.labelled > 0

    for match in TOKEN.finditer(page):
        yield from text(page[at:match.start()])
        at = match.end()
        name = (match[3] or match[6] or "").lower()
        if not name:
            continue
        closing = match[2] or match[5]
        if name not in _sets["inline"]:
            yield "break", "", opened.labelled > 0
        aside = opened.asides > 0
        if closing:
            found = opened.place(name)
            was = opened.stack[found][1] if found is not None else ""
            if name in LABELLED and found is not None:
                yield from pop(found)
                yield "tag", "/" + name, False
            else:
                if not aside and was != "aside":
                    yield "tag", "/" + name, opened.labelled > 0
                if found is not None:
                    yield from pop(found)
            continue
        if _ends_last(opened.stack, name):
            yield from pop(len(opened.stack) - 1)
        kind, marks = _dropped(name, match[4] or match[7] or "")
        if kind == "named":
            if holders is None:
                holders = _holders(page)
            kind = "" if match.start() in holders else "aside"
        if not aside and kind != "aside":
            yield "tag", name, opened.labelled > 0 and name not in LABELLED
        if aside or kind == "aside" or name in _sets["void"]:
            marks = ()
        for mark in marks:
            yield "tag", mark, opened.labelled > 0
        if name not in _sets["void"]:
            opened.push(name, kind, marks)
    yield from text(page[at:])


def counts(page: str) -> dict[tuple[str, bool], int]:
    """Words (as ``""``) and tags of a page, by whether they stand in its labelled element."""
    found = {}
    for kind, value, inside in tokens(page):
        if kind == "text":
            found["", inside] = found.get(("", inside), 0) + len(value.split())
        elif kind == "tag":
            found[value, inside] = found.get((value, inside), 0) + 1
    return found


def main_text(page: str, word: float, tags: dict[str, float]) -> str:
    """The words of the best-scoring run; white space and breaks become single spaces."""
    best = total = 0.0
    start = first = last = 0
    sequence = list(tokens(page))
    for k, (kind, value, labelled) in enumerate(sequence):
        if kind == "break":
            continue
        tag = TAG_RANGE[1] if labelled else tags.get(value, UNSEEN_TAG)
        total += word * len(value.split()) if kind == "text" else tag
        if total <= 0:
            total, start = 0.0, k + 1
        elif total > best and kind == "text":
            best, first, last = total, start, k + 1
    pieces = [value if kind == "text" else " " for kind, value, _ in sequence[first:last] if kind != "tag"]
    return " ".join("".join(pieces).split())


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> tuple[float, dict[str, float]]:
    """The weight of a word and of every tag that the labelled pages of the sample have, few or
    many; of no labelled page, the bounds' defaults."""
    marked = pages.where(F.col("html").rlike(r"(?i)<(article|main)[\s>]")).select("html")
    marked = marked.select("html", F.xxhash64("html", F.lit(5)).alias("hash"))
    n = marked.select("hash").distinct().count()  # of copies one counts
    chosen = marked.where(F.pmod("hash", F.lit(1 << 30)) * (n / float(1 << 30)) < sample).select("html").distinct()

    def count(batches):
        total = {}
        for batch in batches:
            for page in batch.column("html").to_pylist():
                for key, c in counts(page).items():
                    total[key] = total.get(key, 0) + c
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.bool_()),
             pa.array(list(total.values()), pa.int64())], ["token", "inside", "n"])

    rows = chosen.mapInArrow(count, "token string, inside boolean, n bigint").groupBy("token").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("b"))
    odds = {r["token"]: math.log((r["a"] + 1) / (r["b"] + 1))
            for r in rows.collect()}
    within = lambda x, low, high: min(high, max(low, x))
    return within(odds.pop("", WORD_RANGE[1]), *WORD_RANGE), {t: within(x, *TAG_RANGE) for t, x in odds.items()}


def extract(pages: DataFrame, columns: list[str], weights: tuple[float, dict[str, float]]) -> DataFrame:
    """``row`` (a struct of ``columns``) and ``text`` for every row of ``pages``.

    A null or empty html, and one without words, gives an empty text.  Unclosed elements end
    with the element around them; unclosed comments and scripts with the page.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.struct(*columns).alias("row"), F.coalesce("html", F.lit("")).alias("html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(page, *weights) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return rows.mapInArrow(run, beside_row(rows, "text string"))


def q_op4_html(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = extract(pages, ["page_id", "url"], fit(pages))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("bigint").alias("n_chars"))
