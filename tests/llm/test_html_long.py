"""Pages of a megabyte with what made earlier versions climb or rescan, and inline fallback text."""

import random
import time

import pytest

from kitwise.llm import html_text

P = "<p>Some prose here, with a point. And another one; fine.</p>"
TEXT = P[3:-4]
PROSE_LINES = {
    "unclosed hidden": ("<article>", P + "<span hidden>x ", 14000, "</article>"),
    "nested articles": ("", "<article>" + P, 15000, ""),
    "nested divs": ("<article>", "<div>" + P, 15000, "</article>"),
    "flat sidebars": ("<article>", "<div class='sidebar'>" + P + "</div>" + P + P, 5000, "</article>"),
    "unclosed list items": ("<ul>", "<li><b>" + P, 15000, "</ul>"),
    "unknown elements": ("<div>" + "<x-y>" * 20000, P, 15000, ""),
}


@pytest.mark.parametrize("name", PROSE_LINES)
def test_a_megabyte_takes_seconds_and_keeps_its_text(name):
    start, part, n, end = PROSE_LINES[name]
    began = time.process_time()
    text = html_text.main_text(start + part * n + end)
    assert time.process_time() - began < 8  # quadratic work takes minutes
    assert set(text.split("\n")) - {"x"} == {TEXT}  # a hidden element that nothing closes hides nothing
    assert text.count(TEXT) == n * (2 if name == "flat sidebars" else 1)


@pytest.mark.parametrize("page", ["<div>" * 40000 + "</section>" * 40000, "<a " * 300000 + '"', "<a href='" + "<span hidden " * 80000, "<x>" * 9 + "<div>" + "<y></x>" * 60000])
def test_a_megabyte_without_text(page):
    began = time.process_time()
    assert html_text.main_text(page) == ""
    assert time.process_time() - began < 8


def test_inline_fallback_text_and_hidden_style():
    page = (
        f"<article><p>{TEXT} So <math><mi>a</mi><mo>=</mo><mn>2</mn></math>, <object>an object</object>"
        f" and <canvas>a canvas</canvas>.</p><p style='visibility: hidden'>{TEXT}</p></article>"
    )
    assert html_text.main_text(page) == f"{TEXT} So a=2, an object and a canvas."


def test_open_elements_against_climbing():
    """End tags and implied ends find the same elements as a climb from the innermost one."""
    rng = random.Random(3)
    names = ["div", "section", "p", "li", "x", "table", "td"]
    for _ in range(300):
        root = html_text._Element("", None, {}, {})
        line = html_text._Open(root)
        for _ in range(30):
            here, name = line.here, rng.choice(names)
            e = here
            while e is not None and e.name != name:
                e = None if e.name in html_text.SCOPE and name not in html_text.SCOPE else e.parent
            assert line.ended(name) is e
            ends, outer, e = {"p", "li"}, None, here
            while e is not None and e.name not in html_text.SCOPE:
                outer, e = (e if e.name in ends else outer), e.parent
            assert line.outermost(ends) is outer
            if rng.random() < 0.3 and line.ended(name) is not None:
                line.close(line.ended(name))
            else:
                line.push(html_text._Element(name, line.here, {}, {}))


def test_hidden_ends_against_a_walk():
    rng = random.Random(4)
    for _ in range(200):
        html = "".join(rng.choice(["<b>", "</b>", "<b hidden>", "x", "<i>"]) for _ in range(20))
        ends = html_text._Ends(html)
        for at in [i + 1 for i, c in enumerate(html) if c == ">"]:
            depth, i, want = 1, at, at
            while i < len(html):
                depth += html.startswith(("<b>", "<b "), i) - html.startswith("</b>", i)
                if not depth:
                    want = i + 4
                    break
                i += 1
            assert ends.past(at, "b") == want
