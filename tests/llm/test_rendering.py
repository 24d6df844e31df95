import pytest

from treeloom.llm import rendering
from treeloom.llm.rendering import render


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
        ("<title>t</title><body>a<script>x</script><style>p{}</style><!-- c -->b<noscript>n</noscript>", "ab"),
        ("a <b>bold</b><i> it</i>, x", "a bold it, x"),
        ("<b><p>x</b>y</p>z", "xy\n\nz"),
        ("<ul><li>a<li>b<ol start=9><li>c<li>d</ol></ul>e", "- a\n- b\n\n  9. c\n  10. d\n\ne"),
        ("<ol><li value=4>a<li>b</ol>", "4. a\n5. b"),
        ("<pre>\n a\n   b\n</pre>c", " a\n   b\n\nc"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td>b<td>22</table>", "Name   N\nalpha  1\nb      22"),
        ("<table><caption>C</caption><tr><td rowspan=2>A<td>B<tr><td>D</table>", "C\nA  B\n   D"),
        ("<table><tr><td colspan=2>wide cell<td>r<tr><td>a<td>b<td>c</table>", "wide cell  r\na  b  c"),
        ("<table><tr><td>a<br>bb<td>c</table>", "a   c\nbb"),
        ("<table>stray<tr><td>a</table>", "a\nstray"),
        ("<p hidden>a</p><p style='display: NONE'>b</p><p style='visibility:hidden'>c</p>d", "d"),
        ("<style>.x, #y{display:none} p .z{display:none}</style><i class='a x'>1</i><i id=y>2</i><i class=z>3</i>", "3"),
        ("<details><summary>s</summary>h</details><details open>o</details><dialog>d</dialog>", "s\no"),
        ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
        ("&lt;a&gt; &amp;&nbsp;&eacute;&#233;", "<a> & éé"),
        ("<![foo bar]>x<!weird>y<?php z ?>w", "xyw"),
        ("<p>a</p></p></div><td>b", "a\n\nb"),
        ("<head><title>t</title><p>visible", "visible"),
        ("x<", "x<"),
        ("Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> hold", "Let x=2 hold"),
        ("<map name=m><a href=a>link</a><area href=b></map>", "link"),
        ("a<svg>\n<title>t</title><desc>d</desc><g>no<text>one</text><text>two</text></g></svg>b", "a one two b"),
        ("<svg><desc/><g/><text>one</text></svg>x", "one x"),
        ("<p style='visibility:hidden'>a<b style='visibility: visible'>b</b>c</p>d", "b\n\nd"),
        ("<style>.h{visibility:hidden}.v{visibility:visible}</style><div class=h>a<p>b<p class=v>c<i>d</i></div>e", "cd\n\ne"),
        ("<div style='display:none'>a<b style='display:inline;visibility:visible'>b</b></div>c", "c"),
        ("<ol><li>a<li style='visibility:hidden'>b<li>c</ol>", "1. a\n3. c"),
        ("<style>.a{display:none}#b{display:block}i{display:none}</style><i class=a>1</i><b class=a id=b>2</b>", "2"),
        ("<style>.a{display:none}.c{display:none!important}</style><i class=a style='display:inline'>1</i>"
         "<i class=c style='display:inline'>2</i>", "1"),
        ("<svg><style>text{display:none}</style><defs><text>d</text></defs><text>x</text></svg>y", "y"),
    ],
)
def test_layout(html, text):
    assert render(html) == text


@pytest.mark.parametrize("piece", ["<div>", "<table><tr><td>", "<ul><li>", "<b>", "<p>", "</p>", "<!--", "<a href='", "&", "<"])
def test_any_markup_ends(piece):
    assert "word" in render("word" + piece * 3000) + "word"
    render(piece * 3000 + "word")


def test_no_text_is_lost_in_depth():
    assert render("<div>" * 1000 + "deep") == "deep"
    assert render("<ul><li>" * 400 + "deep").strip(" -") == "deep"


def test_rows_come_back(spark):
    rows = [(1, "<p>a", "x"), (1, "<p>a", "x"), (None, None, None), (2, "", "y"), (3, "<p>" + "long " * 200_000, "z")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = rendering.with_text(pages, "shown").collect()
    assert [r.shown for r in got] == ["a", "a", "", "", ("long " * 200_000).strip()]
    assert [tuple(r)[:3] for r in got] == rows
    assert rendering.with_text(pages.limit(0), "shown").count() == 0


@pytest.mark.parametrize(
    "css, seen",
    [
        ("@media print { nav, .a { display: none } }", True),
        ("@media print{.a{display:none}} .a{color:red}", True),
        ("@media screen{.a{display:none}}", False),
        ("@media print, screen{.a{display:none}}", False),
        ("@media not print{.a{display:none}}", False),
        ("@media not screen{.a{display:none}}", True),
        ("@media (max-width: 600px){.a{display:none}}", True),
        (".a{display:none}@media(min-width:600px){.a{display:block}}", True),
        (".a{display:none} .a{display:block}", True),
        (".a{display:block} .a{display:none}", False),
        (".a{display:none !important} .a{display:block}", False),
        (".a{display:none} .a{color:red}", False),
        (".a{content:'}';display:none}", False),
        ("/* .b{ */ .a{display:none}", False),
        ("@keyframes k{from{display:none}} i{color:red}", True),
        ("@import 'x';.a{display:none}", False),
        (".a{display:none", False),
    ],
)
def test_sheets(css, seen):
    assert render(f"<style>{css}</style>x<i class=a>y</i>") == ("xy" if seen else "x")


def test_print_sheets_and_order_of_sheets():
    assert render("<style media=print>.a{display:none}</style><i class=a>y</i>") == "y"
    assert render("<style>.a{display:none}</style><style>.a{display:inline}</style><i class=a>y</i>") == "y"


@pytest.mark.parametrize(
    "html, text",
    [
        ("<script>no</script>yes", "yes"),
        ("<style>.a{color:red}</style>yes", "yes"),
        ("<div hidden>no<div>no</div>no</div>yes", "yes"),
        ("<p style='display:none'>no<b>no</b><div>yes</div>", "yes"),
        ("<ul><li hidden>no<li>yes</ul>", "yes"),
        ("<div hidden>no<ul><li>no</ul>no</div>yes", "yes"),
        ("<style>.a{display:none}</style><div class=a>no<p>no</div>yes", "yes"),
        ("<p class=b>no<b class=c>yes</b>no</p><style>.b{visibility:hidden}.c{visibility:visible}</style>", "yes"),
    ],
)
@pytest.mark.parametrize("depth", [1, 299, 300, 400, 5000])
def test_unseen_text_stays_out_in_depth(html, text, depth):
    assert render("<div>" * depth + html).strip(" -") == text


def test_layout_in_depth():
    page = "<p>a<p>b<ul><li>c<li>d</ul><table><tr><td>e<td>f<tr><td>g</table>h<br>i"
    assert render("<div>" * 400 + page) == "a\n\nb\n\nc\nd\n\ne f\ng\n\nh\ni"
    assert "- c\n- d\n\ne  f\ng\n\nh" in render("<div>" * 250 + page)
