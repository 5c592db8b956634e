"""Pages that no pattern may read twice, and articles that lose nothing: a labelled fixture."""

import time

import pytest

from vitalair.llm import wrapper as w

HARD = {
    "open spans before paragraphs": "<span>" * 75_000 + "<p>x</p>" * 70_000, "quotes": '<a "' * 250_000, "single quotes": "<a '" * 250_000 + "<p>x", "open spans and items": "<span><li>x</li>" * 62_000,
    "stray ends behind a barrier": "<b><table>" + "<span>" * 90_000 + "</b>" * 90_000, "scripts without end": "<script " * 120_000, "declarations": "<!a " * 250_000, "depth": "<div>" * 200_000 + "x",
    "options": "<option><span>" * 70_000, "attributes": "<a " + 'class=" ' * 120_000 + ">x", "ampersands": "&" * 1_000_000, "comments": "<!-- " * 200_000,
}


@pytest.mark.parametrize("which", HARD)
def test_a_megabyte_of_each_pattern(which):
    began = time.time()
    w.extract(HARD[which])
    assert time.time() - began < 15


def page(i, body):
    menu = "".join(f'<li><a href="/{k}">Section {k}</a></li>' for k in range(5))
    return (
        f'<html><body><div class="site-header"><ul>{menu}</ul></div><div class="cookie-banner2">We use cookies {i}</div>{body}'
        f'<div class="share-buttons">Share {i}</div><div id="comments-list"><p>Reader {i} says no</p></div><div class="footer-links">About us {i}</div></body></html>'
    )


def words(i, k):
    return " ".join(f"w{i}x{k}y{j}" for j in range(12))


def fixture():
    """(html, wanted text) of the pages of one host."""
    out = []
    for i in range(8):
        title, parts = f"Title of dish {i}", [words(i, k) for k in range(6)]
        body = (
            f"<h1>{title}</h1><article><div class='share-price'><p>{parts[0]}</p></div><section class='legal-analysis'><p>{parts[1]}</p></section><div id='search-engines'><p>{parts[2]}</p></div>"
            f"<h2>Ingredients</h2><ul><li>{parts[3]}</li></ul><h2>Method</h2><p>{parts[4]}</p><h2>Newsletter</h2><p>Subscribe to our weekly letter</p></article><article><p>{parts[5]}</p></article>"
        )
        want = [title, *parts[:3], "Ingredients", parts[3], "Method", parts[4], parts[5]]
        out.append((page(i, body), "\n".join(want)))
    return out


def test_labelled_pages_are_extracted_whole_and_without_template():
    pages = fixture()
    wrapper = w.loaded(w.induce([h for h, _ in pages]))
    assert [w.extract(h, wrapper) for h, _ in pages] == [t for _, t in pages]


@pytest.mark.parametrize("name, noise", [
    ("share-price", False), ("legal-analysis", False), ("search-engines", False), ("comment", True), ("comments-list", True), ("site-footer", True), ("cookie-banner", True), ("ad", True), ("ad-slot-3", True),
    ("related-posts", True), ("header2", True), ("form-letters-of-credit", False), ("article-body", False), ("sidebar left", True), ("price share", True), ("", False), ("nav_main", True), ("advertising-law", False),
])
def test_names_speak_as_a_whole(name, noise):
    assert any(map(w.speaks_of_noise, name.split())) == noise
    text = w.extract(f'<body><div class="{name}">inside</div><p>outside</p></body>')
    assert ("inside" in text) != noise
