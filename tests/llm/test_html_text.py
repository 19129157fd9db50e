import re
from html.parser import HTMLParser

import pytest
from sightline.llm import html_text, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("page, text", [
    ("<p>a<p>b<br>c", "a\n\nb\nc"),
    ("x<ul><li>a<li>b<ol><li>q<li>r</ol></ul>y", "x\n\n - a\n - b\n   1. q\n   2. r\n\ny"),
    ("<table><tr><th>A<th>Long head<tr><td>1<td>22</table>", "A | Long head\n1 | 22"),
    ("<table><td colspan=2>w<td>z<tr><td>a<td>bb<td>c</table>", "w |    | z\na | bb | c"),
    ("a<div hidden>no</div><span style='display : none'>no</span><b style='color:red'>b</b>", "ab"),
    ("<title>no</title><script>var a='</p>'</script><style>p{}</style><noscript>no</noscript>yes", "yes"),
    ("a&amp;b &lt;i&gt; &#233; &copy;", "a&b <i> é ©"),
    ("<pre> x\n   y</pre>z", " x\n   y\n\nz"),
    ("<!-- <p>no -->a<!doctype html><![CDATA[b]]>c", "ac"),
    ("<div>a</div><div>b</div> c  \n d", "a\nb\nc d"),
    ("a</p>b</nothing>c", "a\n\nbc"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n   d\nu"),
    ("<textarea>kept &amp; <b></textarea><img alt='pic'><input value=no>", "kept & <b>pic"),
    ("<a title='x > y'>in</a><p title=\"unclosed>out", "in<p title=\"unclosed>out"),
    ("", ""), ("   \n", ""), ("<table></table>", ""), ("<", "<"), ("a < b", "a < b"),
])
def test_layout(page, text):
    assert html_text.visible_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>T</title><p>Text<p>more", "Text\n\nmore"),
    ("<head><meta charset=utf-8><title>T</title>\n<style>p{}</style> Bare <b>text</b>", "Bare text"),
    ("<head><script>x</script><noscript>no</noscript><div>a</div>b", "a\nb"),
    ("<head><title>T</title></head><body>a", "a"), ("<head><title>T</title><body>a", "a"),
    ("a <svg><title>no</title><defs><text>no</text></defs><path d='x'/><defs/><text>Sales</text><text>2020</text></svg> b", "a\nSales\n2020\nb"),
    ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>.", "x=2."),
])
def test_head_without_end_and_foreign_text(page, text):
    assert html_text.visible_text(page) == text


def test_hostile_pages_end_soon():
    assert html_text.visible_text("<div>" * 30_000 + "x" + "</div>" * 30_000) == "x"
    assert html_text.visible_text("<p><i>" * 20_000 + "x").strip() == "x"
    assert len(html_text.visible_text("<a " * 50_000)) > 0 and html_text.visible_text("<" * 50_000)
    assert html_text.visible_text("w " * 200_000).count("w") == 200_000


class Seen(HTMLParser):
    """Words outside of elements that are never shown."""

    def __init__(self):
        super().__init__()
        self.off, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title", "head")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title", "head")

    def handle_data(self, data):
        if not self.off:
            self.words.append(data)


def test_every_visible_word_of_the_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = queries.QUERIES["op3_html_text"](spark, FOLDER).collect()
    assert len(rows) == len(pages)
    for r in rows:
        seen = Seen()
        seen.feed(pages[r.page_id])
        seen.close()
        bare = lambda t: re.sub(r"\s", "", t)
        assert bare(re.sub(r"(?m)^ - ", "", r.text)) == bare("".join(seen.words))


def test_nulls_repeats_and_empty(spark):
    table = spark.createDataFrame([(1, None, "u"), (1, None, "u"), (None, "<p>x", "u"), (3, "", "u")], "page_id long, html string, text string")
    assert sorted(((r.page_id, r.text) for r in html_text.page_texts(table).collect()), key=str) == sorted([(1, ""), (1, ""), (None, "x"), (3, "")], key=str)
    assert html_text.page_texts(table.where("false")).count() == 0
