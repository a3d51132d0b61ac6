"""The scan of pages that are broken on purpose: right, and in time that follows their length."""

import random
import time

import pytest

from presswork.llm import html_text


def shape(source):
    page = html_text.parse(source)
    return page.tags, page.parents, page.texts


@pytest.mark.parametrize(
    "source,tags,texts",
    [
        ("a < b <3 <", ["body"], ["a < b <3 <"]),
        ("<p title='>'>x</p>", ["body", "p"], ["x"]),
        ("<p title='>x</p>", ["body", "p"], ["x"]),
        ("<P>x<p>y", ["body", "p", "p"], ["x", "y"]),
        ("<div>a</p>b</div>c", ["body", "div"], ["a", "b", "c"]),
        ("a<!-- <p> -->b<!-- open <p>c", ["body"], ["ab"]),
        ("a<script>'<p>\"</SCRIPT>b", ["body"], ["ab"]),
        ("a<script>never closed <p>b", ["body"], ["a"]),
        ("İ<script>x</script>b", ["body"], ["İb"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["body", "ul", "li", "li", "ul", "li"], ["a", "b", "c"]),
        ("<table><tr><td>a<td>b<tr><td>c", ["body", "table", "tr", "td", "td", "tr", "td"], ["a", "b", "c"]),
        ("", ["body"], []),
        ("x &amp;lt; &#65;", ["body"], ["x &lt; A"]),
    ],
)
def test_pages(source, tags, texts):
    page = html_text.parse(source)
    assert page.tags == tags and [text for _, text in page.texts] == texts


def plain_end(source, at):
    """Where a tag ends whose name ends at ``at``, without anything remembered."""
    start, quote = at, None
    while at < len(source):
        c = source[at]
        if quote is None and c == ">":
            return at
        if c == quote:
            quote = None
        elif quote is None and c in "\"'":
            quote = c
        at += 1
    return source.find(">", start)


def test_tags_end_where_a_plain_scan_ends_them():
    random.seed(8)
    bits = ["<b", "</b", ">", "'", '"', " x", "=", "<", "<i>", " "]
    for _ in range(5000):
        source = "".join(random.choice(bits) for _ in range(random.randint(1, 20)))
        for start, end, tag, _, attributes in html_text.tags_of(source):
            if tag:
                name = html_text._NAME.match(source, start + 1)
                assert end == plain_end(source, name.end()) + 1
                assert attributes == source[name.end() : end - 1]


@pytest.mark.parametrize(
    "parts",
    [
        ("<a ",), ("<b '",), ("<b '>'",), ("<b \"'>",), ("<",), ("<!-",), ("<!--",), ("</",),
        ('<a href="',), ("<x y='\">",), ("<script>",), ("<script/>",), ("&#",), ("<p>",),
        ("<div>", "</p>"), ("<div>", "<li></li>"), ("<li><ul>", "<div>", "<li></li>"),
    ],
)
def test_time_follows_the_length(parts):
    def seconds(size):
        page = "".join(part * (size // len(parts) // len(part)) for part in parts)
        began = time.process_time()
        html_text.features(html_text.parse(page))
        return time.process_time() - began

    seconds(10_000)
    # A quadratic scan would take 64 times as long for 8 times the page.
    assert seconds(800_000) < 30 * max(seconds(100_000), 0.05)
