"""HTML rendering: layout, implied tags, visibility, odd input."""

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from titlelens.llm import htmltext


def text(page):
    return htmltext.render(page)["text"]


@pytest.mark.parametrize("page,want", [
    ("plain", "plain"), ("", ""), ("<p>One<p>Two", "One\n\nTwo"),
    ("<div>a</div><div>b</div>", "a\nb"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<b>x</b><i>y</i> z", "xy z"), ("a  \n b", "a b"), ("&lt;&amp;&eacute;&#8364;", "<&é€"),
    ("<p>a<!-- x > y --->b", "ab"), ("<p>a<!-- never closed", "a"),
    ("<script>var t='</p>';</script>x", "x"), ("<style>p{}</style>x", "x"),
    ("<script>never closed <p>x", ""), ("<head><title>t</title></head><body>b", "b"),
    ("<p hidden>no</p>yes", "yes"), ('<p style="color:red; display: none">no</p>yes', "yes"),
    ('<p style="visibility:hidden">no<b>nor</b></p>yes', "yes"),
    ("<template>no</template><noscript>no</noscript>yes", "yes"),
    ("<ul><li>a<li>b</ul>c", "- a\n- b\n\nc"),
    ("<ol start=3><li>a<li>b</ol>", "3. a\n4. b"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "- a\n  - b\n- c"),
    ("<pre>a\n  b  c</pre>d", "a\n  b  c\n\nd"),
    ("<table><tr><td>a<td>bbb<tr><td>cc<td>d</table>", "a  | bbb\ncc | d"),
    ("<table><tr><th colspan=2>wide<tr><td>a<td>b</table>", "wide\na | b"),
    ("<table><tr><td>a<table><tr><td>in<td>x</table><td>b</table>", "a      | b\n       |\nin | x |"),
    ("<td>stray", "stray"), ("</p></div>x", "x"), ("<a href='x>y'>z</a>", "z"),
    ("<a href='never closed>x", ""), ("a < b > c", "a < b > c"), ("<3 x", "<3 x"),
    ("x<hr>y", "x\n---\ny"), ("<img alt='pic'>", "pic"), ("<h1>T</h1>t", "T\n\nt"),
    ("<blockquote>q</blockquote>t", "  q\n\nt"), ("<dl><dt>a<dd>b<dt>c</dl>", "a\n  b\nc"),
    ("<p><b>x<br></article>y", "x\ny"), ("<select><option>a<option>b</select>", "a\nb"),
    ("<table><tr><td>日本<td>x<tr><td>abcd<td>y</table>", "日本 | x\nabcd | y"),
])
def test_layout(page, want):
    assert text(page) == want


@pytest.mark.parametrize("page,want", [
    ("<p class=it's>Hello world</p><p>More</p>", "Hello world\n\nMore"),
    ('<p class="a"">Hello</p><p>More</p>', "Hello\n\nMore"),
    ("<a title=Bob's>x</a><p>It's two</p>", "x\n\nIt's two"),
    ("<p 'x>a</p>b", "a\n\nb"), ("<p a='1'b=\"2>\"'>c", "c"), ("<p a=>b</p>c", "b\n\nc"),
    ("<p a = '>' hidden>no</p>yes", "yes"), ("<p a=b' hidden>no</p>yes", "yes"),
    ("<p =' hidden>no</p>yes", "yes"), ("<a title= 'never closed>x", ""), ("</p '>x", "x"),
    ('<p class=a/ style="display:none">no</p>yes', "yes"), ("<br/>x<br / >y", "x\ny"),
])
def test_quotes_count_only_after_the_equals_sign(page, want):
    assert text(page) == want


@pytest.mark.parametrize("page,want", [
    # a head without its end tag
    ("<html><head><title>T</title><h1>Hi</h1><p>a", "Hi\n\na"), ("<head><title>T</title>a", "a"),
    ("<head><meta charset=x><script>no</script> <noscript><img alt=no></noscript><p>a", "a"),
    ("<head>\n<style>no</style>\n</head>\n<p>a", "a"), ("<head></br>a", "a"),
    # drawings and formulas
    ("a<svg><defs><text>no</text></defs><title>no</title><text>Jan</text><text>Feb</text></svg>b",
     "a Jan Feb b"),
    ("<svg>no<g><text>x<tspan>y</tspan></text></g><style>no</style></svg>z", "xy z"),
    ("<p>a<svg width=1 />b</p>c", "ab\n\nc"), ("<p>a<math/>b</p>c", "ab\n\nc"),
    ("<p><svg><path d='M0'/><circle/><title/><text>l</text></svg>b", "l b"),
    ("<svg><text><![CDATA[x > y]]></text></svg>", "x > y"), ("<svg><defs><p>a", "a"),
    ("<svg><text display=none>no</text><text style='display:none'>no</text></svg>a", "a"),
    ("<li>a<svg><foreignObject><ul><li>b</ul></foreignObject></svg>c", "- a\n\n- b\n\nc"),
    ("<math>\n <mi>x</mi>\n <mo>=</mo> <mn>2</mn> <mphantom>no</mphantom></math>", "x=2"),
    ("<math><semantics><mi>x</mi><annotation>no</annotation><annotation-xml encoding='text/html'>"
     "<b>no</b></annotation-xml></semantics></math>y", "xy"),
    # cells over several rows
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
    ("<table><tr><td>a<td rowspan=0>b<tr><td>c<tr><td>d</table>", "a | b\nc |\nd |"),
    ("<table><tr><td>a<td>b<td rowspan=2>c<tr><td>d<tr><td>e<td>f<td>g</table>",
     "a | b | c\nd |\ne | f | g"),
    ("<table><tbody><tr><td rowspan=9>a<td>b<tbody><tr><td>c<td>d</table>", "a | b\nc | d"),
    ("<table><tr><td rowspan=2>a<td>b<tr><tr><td>c<td>d</table>", "a | b\nc | d"),
    ("<table><tr><td>a<td rowspan=2>b<tr><td colspan=2>c<td>d</table>", "a | b\nc     | d"),
])
def test_whole_pages_are_shown(page, want):
    assert text(page) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<svg>", "<svg/>", "</svg>", "<text>", "</text>", "<foreignObject>", "</foreignObject>",
     "<math>", "<mi>", "</mi>", "</math>", "<title>", "</title>", "<table>", "<tbody>", "<tr>",
     "<td rowspan=2>", "<td colspan=2>", "<td rowspan=0>", "</td>", "</table>", "<p>", "</p>", "a",
     "<head>", "<meta>", "</br>", "<li>", "<ul>", "</ul>", "<tr hidden>", "<defs>"]), max_size=25))
def test_odd_drawings_and_tables_are_nested(parts):
    test_events_are_nested_whatever_comes.hypothesis.inner_test(parts)


def test_deep_nesting_and_long_pages():
    assert text("<div>" * 50_000 + "x") == "x"
    assert text("<ul><li>" * 3_000 + "x").strip().endswith("x")
    assert text("<table><tr><td>" * 300 + "x") == "x"
    assert len(text("<p>word</p>" * 30_000).split()) == 30_000
    assert text("<a " * 20_000) == "" and text("<!" * 20_000) == ""


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<p>", "</p>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</td>", "</table>", "a",
     " ", "<br>", "<div hidden>", "</div>", "<!--", "-->", "<pre>", "</pre>", "<b", ">", "&lt;",
     "<script>", "</script>", "<dl>", "<dd>", "<select>", "<option>", "'", '"', "<ol>", "</ol>",
     "<blockquote>", "</blockquote>"]), max_size=25))
def test_events_are_nested_whatever_comes(parts):
    above = []
    for event in htmltext.tree("".join(parts)):
        if event[0] == htmltext.OPEN:
            above.append(event[1])
        elif event[0] == htmltext.CLOSE:
            assert above.pop() == event[1]
    assert not above
    htmltext.render("".join(parts))


def test_table_of_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<p>a", "x"), (2, None, None, "y"), (None, "u", "<ul><li>i", "z"),
         (1, "u", "<p>a", "x")], "page_id long, url string, html string, text string")
    rows = sorted(map(tuple, htmltext.extract(pages).collect()), key=str)
    assert rows == sorted([(1, "a", 1, 0, 0), (1, "a", 1, 0, 0), (2, "", 0, 0, 0),
                           (None, "- i", 2, 1, 0)], key=str)
    assert htmltext.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "x", "<p>" + "<b>a</b> " * 100_000, "<table>" + "<tr><td rowspan=0>x" * 4000,
    "<p>" + "<button><div>" * 50_000, "<ul>" + "<li>x" * 100_000, "<table><tr>" + "<td>x" * 50_000,
    "</p></x>" * 100_000], ids=["nested", "inline", "rowspan", "scopes", "items", "cells", "ends"])
def test_time_grows_with_the_page(page):
    start = time.perf_counter()
    htmltext.render(page)
    assert time.perf_counter() - start < 12


def test_columns_beyond_the_aligned_ones_keep_their_text():
    page = "<table>" + "".join("<tr>" + "".join(f"<td>{i}.{j}" for j in range(200))
                               for i in range(3)) + "</table>"
    lines = htmltext.render(page)["text"].split("\n")
    assert [[c.strip() for c in line.split("|")] for line in lines] == [
        [f"{i}.{j}" for j in range(200)] for i in range(3)]


def test_all_columns_are_aligned():
    wide = "<table>" + "<tr>" + "<td>ab" * 100 + "<tr>" + "<td>c" * 100 + "</table>"
    first, second = text(wide).split("\n")
    assert first == " | ".join(["ab"] * 100) and second == " | ".join(["c "] * 100).rstrip(" ")
    # Blanks below cells that reach down, each with its own bar, wherever they stand.
    rows = 90
    lines = text("<table>" + "<tr><td rowspan=0>xy" * rows + "</table>").split("\n")
    assert lines == [" | ".join(["  "] * i + ["xy"]) for i in range(rows)]
