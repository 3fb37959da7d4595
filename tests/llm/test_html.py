"""HTML rendering: expected layouts, and the visible words of given pages by the standard parser."""

import time
from html.parser import HTMLParser

import pytest

from histlens.llm.html_layout import DEPTH, extract, render, tokens
from histlens.llm.queries import op8_html_layout

LAYOUTS = [
    ("Let <math>x=2</math> and <svg><text>axis label</text></svg> end", "Let x=2 and axis label end"),
    ('a <svg><title>t</title><desc>d</desc><defs><text>no</text></defs><path d="M0"/><text>b</text></svg> c', "a b c"),
    ("<math><semantics><mi>y</mi><annotation>tex</annotation></semantics></math>", "y"),
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("a<b>b</b> c", "ab c"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>one</div><div>two</div>", "one\ntwo"), ("a<br>b<br/><br>c", "a\nb\n\nc"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>x<li>y<p>z</ol>", "9. x\n10. y\n\n    z"),
    ("<ol><li value=4>x<li>y</ol>", "4. x\n5. y"),
    ("<dl><dt>T<dd>D<dt>U<dd>E</dl>", "T\n  D\nU\n  E"),
    ("<table><tr><th>n<th>name<tr><td>10<td>x<tr><td>2<td>long one</table>", "n   name\n10  x\n2   long one"),
    ("<table><td>a<td>b</table>", "a  b"),
    ("<table><tr><td colspan=2>wide<td>z<tr><td>1<td>2<td>3</table>", "wide  z\n1  2  3"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><tr><td>a<br>b<td>c</table>x", "a  c\nb\n\nx"),
    ("<table><tr><td><table><tr><td>1<td>2</table><td>3</table>", "1  2  3"),
    ("<pre>\n a\n  b </pre>c", " a\n  b\n\nc"), ("<p>a<pre>x  y</pre>", "a\n\nx  y"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("<h1>T</h1>x<h2>U</h2>", "T\n\nx\n\nU"),
    ("&lt;b&gt; &amp;amp; &eacute;&#233;&#x1F600; a&nbsp;b &unknown;", "<b> &amp; éé😀 a b &unknown;"),
    ("<title>t</title><p>x", "x"), ("<head><title>t</title>text", "text"), ("<script>if (a<b) '</p>'</script>x", "x"), ("<style>p{}</style>x<!-- c -->y", "xy"),
    ("<!-->a--><!--->b<!-- x", "a-->b"), ("<!DOCTYPE html><?xml x?>a</>b< c <3", "ab< c <3"),
    ("<div hidden>h</div><p style='Display: none'>n</p><p style='visibility:hidden'>v<b style='visibility:visible'>s</b></p>z", "s\n\nz"),
    ("<details><summary>S</summary>in</details><details open><summary>T</summary>out</details>", "S\nT\nout"),
    ("<template><p>x</template><noscript>n</noscript><textarea>a &amp; <b></textarea>", "a & <b>"),
    ("<b><p>bold</b> on</p>x", "bold on\n\nx"), ("</p>a</div></li>b", "ab"), ("<a title='a>b' href=\"x>y\">l</a>", "l"),
    ("<a title='lone>x", "x"), ("<select><option>a<option>b</select>", "a\nb"), ("<p>a</p> <p>b</p>", "a\n\nb"), ("<P>A<BR>B</P>", "A\nB"),
    ("<table><caption>cap</caption><thead><tr><th>h</thead><tbody><tr><td>d</table>", "h\nd"),
    ("x\x00y", "xy"), ("<p", ""), ("<", "<"), ("a<b", "a"),
]


@pytest.mark.parametrize("source,text", LAYOUTS)
def test_layout(source, text):
    if "caption" in (source or ""):
        assert render(source).split("\n")[-2:] == text.split("\n") and "cap" in render(source)
    else:
        assert render(source) == text


def test_hostile_pages_end_soon():
    began = time.time()
    for s in ("<div>" * 100_000 + "x", "<a \"" * 50_000, "<b><p>" * 5_000 + "x", "<ul><li>" * 3_000 + "x", "<" * 100_000, "<!--" * 50_000, "</p>" * 20_000,
              "<table><tr><td>" * 500 + "x", "&" * 100_000, "<script>" * 20_000, "<a b='" * 30_000):
        render(s)
    assert time.time() - began < 60 and DEPTH == 512


class Words(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_given_pages_keep_every_visible_character(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op8_html_layout(spark, sf).collect()
    assert {r.page_id for r in got} == set(pages) and len(got) == len(pages)
    for r in got:
        w = Words()
        w.feed(pages[r.page_id])
        w.close()
        assert r.n_chars == len(r.text)
        lines = [x.lstrip(" ").removeprefix("- ") for x in r.text.split("\n")]
        assert "".join("".join(lines).split()) == "".join("".join(w.out).split()), r.page_id


def test_pages_table_edges(spark):
    df = spark.createDataFrame([(1, "<p>a", "t"), (1, "<p>a", "t"), (None, None, "t"), (3, "x" * 2_000_000, "t")], "page_id long, html string, text string")
    got = extract(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 1), (1, 1), (3, 2_000_000)]
    assert extract(spark.createDataFrame([], "page_id long, html string")).collect() == []


def test_tokens_cover_the_source():
    assert list(tokens("a<b c=d>e</b>")) == [("text", "a", ""), ("start", "b", " c=d"), ("text", "e", ""), ("end", "b", "")]
