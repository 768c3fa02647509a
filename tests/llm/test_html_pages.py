"""Pages without </head>, and pages nested deeply."""

import pytest

from tests.llm.conftest import prose
from voxelloom.llm import html_extract


def _texts(pages):
    return html_extract.main_texts(pages, html_extract.trained())


@pytest.mark.parametrize("between", ["<body>", "", "</head><body>", "</head>"])
@pytest.mark.parametrize("head", ["<head>", "<head><meta charset=utf-8><title>Not this</title><style>p {}</style>"])
def test_heads_without_an_end(rng, head, between):
    one, two = prose(rng, 4), prose(rng, 5)
    page = f"<!doctype html><html>{head}{between}<article><h1>Name</h1><p>{one}</p><p>{two}</p></article></html>"
    assert _texts([page]) == [f"Name {one} {two}"]


def test_text_ends_a_head(rng):
    text = prose(rng, 6)
    assert [b.text() for b in html_extract.parse(f"<html><head><title>Not this</title>{text}")] == [text]


def test_deep_nesting_keeps_blocks(rng):
    one, two = prose(rng, 4), prose(rng, 5)
    for tag in ("div", "b"):
        page = f"<body>{f'<{tag}>' * 3000}<article><p>{one}</p><p>{two}</p></article>"
        blocks = html_extract.parse(page)
        assert [b.text() for b in blocks if b.tag == "p"] == [one, two]
        assert f"{one} {two}" in _texts([page])[0]


def test_wide_and_deep_pages_take_linear_time(rng):
    """A hundred thousand siblings, open tags, or stray end tags: seconds, not minutes."""
    import time

    text = prose(rng, 3)
    start = time.monotonic()
    for page in ("<p>word word</p>" * 100_000, "<div>" * 100_000 + text, "<b>" * 100_000 + text, "<b><div>" * 50_000 + text, "<div>" * 50_000 + "</i></p>" * 100_000 + text, "<div>" * 50_000 + "<li>x" * 50_000, "<div>" * 50_000 + "<tr><td>x" * 50_000, "<b><div>" + "<i>" * 50_000 + "</b>" * 50_000 + text):
        blocks = html_extract.parse(page)
        html_extract.decode(blocks, html_extract.features(blocks)[:, 0])
    assert time.monotonic() - start < 90


def test_formulas_and_pictures(rng):
    one = prose(rng, 4)
    page = f"<article><p>{one}</p><p>Sum <math><mi>x</mi><mo>+</mo><mn>1</mn></math> of a<img src=x>b and <my-tag>more</my-tag> words, {one}</p><p>one</p><p>two</p></article>"
    assert _texts([page]) == [f"{one} Sum x+1 of ab and more words, {one} one two"]


def test_pages_without_article_tags(rng):
    """Layouts of plain divs, tables and sections; menus, adverts and footers beside them."""
    right = n = 0
    for k in range(60):
        body = [prose(rng, rng.randint(3, 6)) for _ in range(rng.randint(2, 5))]
        inner = "".join(f"<p>{t}</p>" for t in body)
        inner = [f"<div class=content>{inner}</div>", f"<main>{inner}</main>", f"<section><div>{inner}</div></section>", f"<div id=story>{inner}</div>", inner][k % 5]
        menu = "<div class=menu><ul>" + "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(6)) + "</ul></div>"
        page = f"<html><body>{menu}{inner}<div class=sidebar><h3>More</h3><ul><li><a href=/x>Other story</a></li></ul></div><footer><p>&copy; 2024 Someone</p></footer></body></html>"
        right, n = right + (_texts([page])[0] == " ".join(body)), n + 1
    assert right >= 0.9 * n
