"""Pages with many elements that are never closed, or closed without being open."""

from __future__ import annotations

import time

from shelfwise.llm import pages


def marked(page: str) -> str:
    return " ".join(text.strip() for _, name, text, inside in pages.sequence(page) if not name and inside and text.strip())


def test_broken_nesting():
    assert marked("<div><p>a</div></p>b</div><article>x<div>y</article>z</div></article>") == "x y"
    assert marked("</article><article>a<nav>b</article>c<main>d</main></article>e") == "a d"
    assert marked("<article>a<ul><li>b<li>c</ul>d</article>e") == "a b c d"


def test_cost_grows_with_the_page():
    def seconds(n: int, unit: str) -> float:
        start = time.perf_counter()
        pages.sequence(unit * n + "<article>text</article>")
        return time.perf_counter() - start

    for unit in ("<div></p>", "<div><a>", "</div>", "<p></div></p>"):
        seconds(1000, unit)
        assert seconds(40_000, unit) < 40 * max(seconds(2_000, unit), 0.01)
