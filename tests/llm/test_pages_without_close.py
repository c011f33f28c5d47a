"""Pages that leave out </head>, and unseen elements that an implied close removes."""

from __future__ import annotations

from pcmarts.llm import htmltext


def texts(page: str) -> list[str]:
    return [x[0] for x in htmltext.leaves(page)]


def test_head_without_end_tag():
    head = '<html><head><meta charset="utf-8"><title>t</title><link rel="x"><script>s</script><style>c</style><noscript>n</noscript>'
    assert texts(head + "<body><article><h1>A</h1><p>One<p>Two</article></body></html>") == ["A", "One", "Two"]
    assert texts(head + "<div>One</div><p>Two") == ["One", "Two"]
    assert texts(head + "\n <b>One</b> two") == ["One two"]
    assert texts(head + "\n bare text<p>Two") == ["bare text", "Two"]
    assert texts(head + "</head><body><p>One</p></body>") == ["One"]


def test_unseen_elements_removed_by_an_implied_close():
    assert texts("<p><video><p>fallback</p></video></p><p>One</p><div>Two</div>")[-2:] == ["One", "Two"]
    assert texts("<p>Zero<object><div>fallback</div></object></p><p>One</p>") == ["Zero", "One"]
    assert texts("<ul><li><audio><li>One</ul><p>Two</p>") == ["One", "Two"]
    assert texts("<p>Zero<video>unseen</video> on</p><p>One</p>") == ["Zero", "on", "One"]
