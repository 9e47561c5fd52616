"""HTML extraction: implied tags, visibility, layout, odd markup."""

import re
from collections import Counter
from html.parser import HTMLParser

import pytest

from fleetpulse.llm import html_text
from fleetpulse.llm.html_text import visible_text


@pytest.mark.parametrize("page, text", [
    ("<p>one<p>two", "one\n\ntwo"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>a<li>b<ol><li>x<li>y</ol><li>c</ul>", "- a\n- b\n   1. x\n   2. y\n- c"),
    ("<ol start=7><li>a<li>b</ol>", " 7. a\n 8. b"),
    ("<table><tr><th>Name<th>Qty<tr><td>fig tart<td>3<tr><td>x</table>",
     "Name      Qty\nfig tart  3\nx"),
    ("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>", "a b c  d"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("a <b> b </b> <i>c</i>d", "a b cd"),
    ("<pre>\n x  y\n\n  z</pre>after", " x  y\n\n  z\n\nafter"),
    ("<p style='color:red'>a<p style=\"x:y; display : none\">b<p hidden>c<p>d", "a\n\nd"),
    ("<p data-x='hidden'>a", "a"),
    ("<style>p{}</style><script>if(a<b)'</p>'</script><!-- x --><p>a", "a"),
    ("<details>s<summary>t</summary>u</details><details open><summary>v</summary>w</details>",
     "t\nv\nw"),
    ("<html><head><title>t</title><meta charset=x><body>b", "b"),
    ("<title>t</title>b", "b"),
    ("a &lt; b &amp;&nbsp;c &unknown; &#x41;", "a < b &\xa0c &unknown; A"),
    ("a < b and c > d", "a < b and c > d"),
    ("<a href='x>y'>z</a>", "z"),
    ("<p>a</b></i></div>b", "ab"),
    ("<textarea> k  l\nm</textarea>", " k  l\nm"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("<script>never closed", ""), ("<!-- never closed", ""), ("<a title=\"never closed>x", ""),
    ("", ""), (None, ""),
])
def test_rendered(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<p title=it's>Hello</p><p>more</p>", "Hello\n\nmore"),
    ("<table><tr><td width=50\">A</td><td>B</td></table>", "A  B"),
    ("<p \">a</p \"><p '>b</p '>c", "a\n\nb\n\nc"),
    ("<p title=\"x\"\">a</p>b", "a\n\nb"),
    ("<p a=b=\"c>d\"</p>e", "d\"\n\ne"), ("<p a==\"c>d</p>e", "d\n\ne"),
    ("<p a=>b</p>c", "b\n\nc"), ("<p a = '>' b=\">\">c", "c"), ("<p a=x/>b<br/>c", "b\nc"),
    ("<p a\n=\n'>'>b", "b"), ("<p =\">b</p>c", "b\n\nc"), ("<p a='b'c='>'>d", "d"),
    ("<p title=it's class='x hidden y'>a</p>b", "a\n\nb"),
    ("<p title=it's hidden data-x='a'>a</p>b", "b"),
    ("<p title=\"a style='display:none'\">a", "a"), ("<p title=5' style='display:none'>a</p>b", "b"),
    ("<p style=color:red style='display:none'>a", "a"), ("<p title=a\"hidden>b", "b"),
    ("<ol title=it's start='4'><li>a</ol>", " 4. a"),
])
def test_stray_quotes(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<table><tr><td>name<td colspan=2>both<td>end<tr><td>x<td>left<td>right<td>z</table>",
     "name  both         end\nx     left  right  z"),
    ("<table><tr><td rowspan=2>two rows<td>a<tr><td>b<tr><td>c<td>d</table>",
     "two rows  a\n          b\nc         d"),
    ("<table><tr><td rowspan=0>all<td>a<tr><td>b<tr><td>c</table>", "all  a\n     b\n     c"),
    ("<table><tr><td rowspan=2 colspan=2>big<td>1<tr><td>2<tr><td>x<td>y<td>3</table>",
     "big   1\n      2\nx  y  3"),
    ("<table><tr><td colspan=3>a long heading over all<tr><td>a<td>b<td>c</table>",
     "a long heading over all\na  b  c"),
    ("<table><tr><td colspan=900>a<td>b<tr><td>c</table>", "a  b\nc"),
    ("<table><tr><td colspan=0 rowspan=x>a<td>b<tr><td>c<td>d</table>", "a  b\nc  d"),
    (f"<table><tr><td>k<td>{'word ' * 30}<td>z<tr><td>key<td>v<td>w</table>",
     f"k    {'word ' * 16}  z\n     {('word ' * 14).strip()}\nkey  v{' ' * 81}w"),
    (f"<table><tr><td>{'y' * 100}<td>z<tr><td>a<td>b</table>",
     f"{'y' * 100}  z\na{' ' * 81}b"),
])
def test_spans_and_wrapped_cells(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize("page", [
    "<table><tr><td>" + "x " * 50_000 + "".join("<tr><td>a<td>b" for _ in range(1_000)),
    "<table><tr>" + "<td>" + "y" * 100_000 + "".join("<tr><td>a<td>b" for _ in range(1_000)),
    "<table><tr>" + "<td>wide cell here" * 3_000 + "<tr>" + "<td>" * 2_999 + "<td>" + "x " * 9_000,
    "<table><tr>" + "<td rowspan=60000 colspan=1000>" * 900 + "<tr><td>x" * 5_000,
    "<table><tr>" + "<td rowspan=60000>abcdefgh" * 39 + "<tr><td>x" * 5_000])
def test_text_in_proportion_to_the_page(page):
    text = visible_text(page)
    assert len(text) <= 50 * len(page)
    want = Counter(c for c in re.sub("<[^>]*>", "", page) if c != " ")
    assert Counter(c for c in text if c not in " \n") == want


def test_deep_and_long_pages():
    assert visible_text("<div>" * 100_000 + "x") == "x"
    assert visible_text("<table><tr><td>" * 200 + "x").split() == ["x"]
    assert visible_text("<p>" + "word " * 200_000).count("word") == 200_000
    visible_text("<a '" * 20_000 + "<" * 20_000 + "</x" * 20_000)


class Words(HTMLParser):
    """All text outside of hidden elements, without layout."""

    def __init__(self):
        super().__init__()
        self.hidden, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("head", "script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("head", "script", "style")

    def handle_data(self, data):
        if not self.hidden:
            self.words.append(data)


def test_words_of_pages(spark, sf_dir):
    """The pages' words are all there, in order, if letters are compared without spaces and marks."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for page in pages.collect():
        parser = Words()
        parser.feed(page.html)
        parser.close()
        want = re.sub(r"\s", "", "".join(parser.words))
        mine = re.sub(r"\s", "", re.sub(r"(?m)^ *- ", "", got[page.page_id]))
        assert mine == want
