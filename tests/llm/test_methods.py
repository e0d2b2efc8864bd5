"""The scans and networks of operators 4 and 7 against plain loops."""

import math
import random
import time

import numpy as np
import pytest

from llm import gru, op4_html


# --- the best-scoring run -------------------------------------------------------------------


def brute_text(page, word, tags):
    """Every run of tokens, one by one: the first of the best, and of those the one that scores
    nowhere nothing before its end and ends first."""
    sequence = [t for t in op4_html.tokens(page)]
    value = [0.0 if kind == "break" else word * len(text.split()) if kind == "text"
             else op4_html.TAG_RANGE[1] if inside else tags.get(text, op4_html.UNSEEN_TAG)
             for kind, text, inside in sequence]
    best = 0.0
    for i in range(len(value)):
        total = 0.0
        for j in range(i, len(value)):
            total += value[j]
            best = max(best, total)
    return sequence, value, best


@pytest.mark.parametrize("seed", range(40))
def test_scan_finds_the_best_of_all_runs(seed):
    r = random.Random(seed)
    names = ["p", "div", "li", "a", "h1", "td", "nav", "section"]
    page = "".join(r.choice([f"<{n}>", f"</{n}>", "one ", "two words ", "three of them ", " "])
                   for n in r.choices(names, k=r.randint(1, 60)))
    tags = {("/" * k) + n: -r.choice([0.5, 1.0, 2.5]) for n in names for k in (0, 1)}
    sequence, value, best = brute_text(page, 0.5, tags)
    text = op4_html.main_text(page, 0.5, tags)
    # the text is that of some run with the best score
    found = set()
    for i in range(len(value)):
        total = 0.0
        for j in range(i, len(value)):
            total += value[j]
            if math.isclose(total, best) and best > 0:
                pieces = [t if k == "text" else " " for k, t, _ in sequence[i:j + 1] if k != "tag"]
                found.add(" ".join("".join(pieces).split()))
    assert text in found if found else text == ""


def test_unmatched_tags_take_linear_time():
    """Ten times the tags, about ten times the time (a hundred if each were searched for)."""
    shapes = [lambda n: "<b>" * n + "</i>" * n, lambda n: "<article><header>" + "<b>" * n + "x",
              lambda n: "<p>" * n + "</div>" * n, lambda n: "<form>" * n + "<article>w</article>"]
    for shape in shapes:
        times = []
        for n in (3000, 30000):
            start = time.process_time()
            op4_html.main_text(shape(n), 1.0, {})
            times.append(time.process_time() - start)
        assert times[1] < 40 * times[0] + 0.5


@pytest.mark.parametrize("page, text", [
    ("<form><p>x</p><article>the main text</article></form>", "x the main text"),
    ("<fieldset><main>the main text</main></fieldset>", "the main text"),
    ("<article>the text<form>your name</form> goes on</article>", "the text goes on"),
    ("<form>name <input> mail</form><article>the text</article>", "the text"),
    ("<aside><article>teaser of another</article></aside><article>the text</article>", "the text")])
def test_forms_that_hold_the_article(page, text):
    assert op4_html.main_text(page, 1.0, {}) == text


# --- the network, position by position ------------------------------------------------------


def brute_probabilities(data, weights):
    """One text of at most one segment, one position and one hidden unit after the other."""
    hidden, labels = weights["state"].shape[-1], weights["bias"].size
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    states = {}
    for direction, order in ((0, range(len(data))), (1, range(len(data) - 1, -1, -1))):
        e, u, h = weights["input"][direction], weights["state"][direction], [0.0] * hidden
        for t in order:
            new = []
            for k in range(hidden):
                z = sigmoid(float(e[0][data[t]][k]) + sum(h[j] * float(u[0][j][k]) for j in range(hidden)))
                reset = sigmoid(float(e[1][data[t]][k]) + sum(h[j] * float(u[1][j][k]) for j in range(hidden)))
                c = math.tanh(float(e[2][data[t]][k]) + reset * sum(h[j] * float(u[2][j][k]) for j in range(hidden)))
                new.append(c + z * (h[k] - c))
            h = new
            states[direction, t] = h
    out = []
    for t in range(len(data)):
        logits = [float(weights["bias"][c]) + sum(states[d, t][k] * float(weights["out"][d][k][c]) for d in (0, 1) for k in range(hidden))
                  for c in range(labels)]
        top = max(logits)
        odds = [math.exp(v - top) for v in logits]
        out.append([v / sum(odds) for v in odds])
    return out


@pytest.mark.parametrize("length", [128, 7])
def test_labels_equal_plain_loops(length):
    """Mean over positions of texts of many lengths; states begin anew every ``length`` bytes."""
    r = np.random.default_rng(2)
    weights = gru.new_weights(3, 4, 1)
    weights["bias"] = r.normal(size=4).astype(np.float32)
    texts = [r.integers(0, 256, n).astype(np.uint8) for n in (0, 1, 5, 7, 8, 30, 127, 128, 129, 300)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = gru.label_texts(np.concatenate(texts), offsets, gru.Model(list("abcd"), weights), length, side_by_side=3)
    for row, text in zip(got, texts):
        rows = [p for a in range(0, len(text), length) for p in brute_probabilities(text[a:a + length], weights)]
        want = np.mean(rows, axis=0) if rows else np.zeros(4)
        assert np.allclose(row, want, atol=1e-5)
