"""Licences wrapped over lines or inside longer ones, against all windows of words."""

from __future__ import annotations

import random
import re
import textwrap

import pytest
from llm.conftest import docs_of

from tesela.llm import licenses

SCANNER = licenses.Scanner(licenses.TEMPLATES, licenses.THRESHOLD)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def grams(w):
    return set(zip(w, w[1:]))


def brute_best(text):
    """The best coefficient of all windows of words of all paragraphs."""
    best = 0.0
    for part in re.split(r"\n[^\w\n]*\n", text):
        w = words(part)
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                g = grams(w[i:j])
                best = max([best, *(2 * len(g & t) / (len(g) + len(t)) for t in TEMPLATES if abs(len(g) - len(t)) <= len(t) / 2)])
    return best if best >= licenses.THRESHOLD else 0.0


TEMPLATES = [grams(words(t)) for _, t in licenses.TEMPLATES]


@pytest.mark.parametrize("name, template", licenses.TEMPLATES)
def test_wrapped_and_inside(name, template):
    for width in (80, 40):
        lines = textwrap.wrap(template, width, initial_indent=" * ", subsequent_indent=" * ")
        found = SCANNER.scan("\n".join(["int x;", "", *lines, "", "int y;"]))
        assert name in {n for _, n, _ in found} and max(d for _, _, d in found) == 1.0
    found = SCANNER.scan(f"Some words that come before it in this line and go on for a good while longer than it does. {template} And as many words that come after it, to make of the whole a line that no template can reach at all.")
    assert name in {n for _, n, _ in found} and max(d for _, _, d in found) == 1.0


def test_one_line_is_one_hit():
    for name, template in licenses.TEMPLATES:
        for text in (template, f"Before it.\n{template}\nAfter it."):
            assert [d for _, _, d in SCANNER.scan(text)] == [1.0]


def test_best_window_of_all():
    rng = random.Random(8)
    short = [t for _, t in licenses.TEMPLATES if len(t) < 140]
    for _ in range(60):
        w = rng.choice(short).split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(["other", "the", "License"])
        w = ["in", "front", "the"] * rng.randint(1, 3) + w + ["and", "the", "rest"] * rng.randint(1, 3)
        text = "\n".join(textwrap.wrap(" ".join(w), 30))
        assert max((d for _, _, d in SCANNER.scan(text)), default=0.0) == brute_best(text)


def test_repeated_words_end():
    assert SCANNER.scan("all rights " * 30_000) == [] and len(SCANNER.scan("all rights reserved\n" * 2000)) == 2000


def test_rows(spark):
    mit = "\n".join(textwrap.wrap(next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 200), 78))
    got = licenses.scan(docs_of(spark, [(1, mit), (2, None), (None, "All rights\nreserved.")])).collect()
    assert sorted((r.doc_id or 0, r.n_lines, r.licenses, r.best_dice) for r in got) == [(0, 1, "Proprietary", 1.0), (1, 1, "MIT", 1.0), (2, 0, "", 0.0)]
