"""Markup that browsers forgive: no text is lost, and time stays in proportion."""

from __future__ import annotations

import time

import pytest

from pcmarts.llm import htmltext


def texts(page: str) -> list[str]:
    return [x[0] for x in htmltext.leaves(page)]


def test_quotes_open_values_after_an_equals_sign_only():
    assert texts("<p title=it's>One</p><p class='b'>Two</p>") == ["One", "Two"]
    assert texts('<p it\'s "odd>One</p><div class="a > b" x = \'>\'>Two</div>') == ["One", "Two"]
    assert texts('<p title="never closed>One</p><p>Two</p>') == ["One", "Two"]
    assert texts("<a href=x/>One</a><br/>two") == ["One two"] or texts("<a href=x/>One</a><br/>two") == ["One", "two"]
    ((_, path, _, _),) = htmltext.leaves("<p class=it's id='side' role=\"x y\">One</p>")
    assert {".it", ".side", ".x", ".y"} <= path


def test_raw_elements_that_are_closed_or_endless():
    for tag in ("svg", "math", "select", "template", "iframe", "textarea", "noscript"):
        assert texts(f'<p>One</p><{tag} width="1"/><p>Two</p>') == ["One", "Two"]
        assert texts(f"<p>One</p><{tag}><p>Two</p><{tag}><p>Three</p>") == ["One", "Two", "Three"]
        assert texts(f"<p>One</p><{tag}>unseen</{tag}><p>Two</p>") == ["One", "Two"]
    assert texts("<p>One</p><script src=x></script><script>if (a < b) '<p>no</p>'</script><p>Two</p>") == ["One", "Two"]
    assert texts("<p>One</p><script>endless <p>code") == ["One"]
    assert texts('<p>One</p><script src="x"/><p>Two</p>') == ["One", "Two"]


def test_words_after_the_twelfth_are_read():
    ((_, path, _, _),) = htmltext.leaves(f'<div class="{" ".join(f"u{chr(97 + k)}" for k in range(26))} sidebar">One</div>')
    assert ".sidebar" in path and len(path) == 28


def test_closing_stays_within_its_scope():
    assert texts("<p>One<b>two<div>three</b> four</div>five") == ["One two", "three four", "five"] or len(texts("<p>One<b>two<div>three</b> four</div>five")) == 3
    assert texts("<ul><li>One<ul><li>Two</ul><li>Three</ul><table><tr><td>a<td>b<tr><td>c</table>") == ["One", "Two", "Three", "a", "b", "c"]
    assert texts("<div><p>One</section></article></b></i>on</p></div>") == ["One", "on"]


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "</p>" * 100_000 + "text",
        "<i>" * 100_000 + "<p>text" * 100_000,
        "<li><ul>" + "<i>" * 60_000 + "<li>x</li>" * 60_000,
        "<p><b>" * 120_000 + "text",
        "<select>x" * 100_000,
        '<a b="' * 120_000,
        "<!--" * 200_000 + "<p " * 100_000,
        "<object><b>" * 60_000 + "</b></i>" * 60_000,
    ],
    ids=["unmatched", "inline", "scoped", "closed", "endless", "quotes", "open", "objects"],
)
def test_a_megabyte_of_broken_markup(page):
    start = time.monotonic()
    htmltext.leaves(page)
    assert time.monotonic() - start < 5
