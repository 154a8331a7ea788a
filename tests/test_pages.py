"""CV1: pages as they are found, read once with a stack."""

import time

import pytest
from pyspark.sql import functions as F

from inferframe.operators import pages as PG
from inferframe.operators.html_blocks import decode, page_blocks


def test_all_articles_and_footers_come_out(spark):
    rows = [(1, "<body><article class=x><p>one</p></article><p>aside</p><ARTICLE><p>two</p></ARTICLE>"
                "<footer>f1</footer><footer>f2</footer></body>"),
            (2, "<article><p>a</p><article><p>b</p></article><p>c</p></article><footer>f</footer>"),
            (3, "<article><p>only</p></article>"), (4, None)]
    out = PG.pages_to_blocks(spark.createDataFrame(rows, "page_id long, html string")).collect()
    texts = {k: [(r.category, r.text) for r in sorted(out, key=lambda r: r.elem_idx) if r.page_id == k] for k in range(1, 5)}
    assert texts == {1: [("Text", "one"), ("Text", "two"), ("Page-footer", "f1 f2")],
                     2: [("Text", "a"), ("Text", "b"), ("Text", "c"), ("Page-footer", "f")], 3: [("Text", "only")], 4: []}


T, L, S = "Text", "List-item", "Section-header"


@pytest.mark.parametrize("page, blocks", [
    ("<article><p>a</p></article><article><p>b</p></body>", [(T, "a"), (T, "b")]),  # a missing end tag loses nothing
    ("<html><head><title>t</title></head><body><p>x", [(T, "x")]),  # the title is no text
    ("<title>t</title><p>x</p>", [(T, "x")]),
    ("<article><p>x</p><div class='big AD'>buy<div>now</div></div>y</article>", [(T, "x"), (T, "y")]),
    ("<div class=ad>buy</div><div class=adverb>read</div>", [(T, "read")]),
    ('<p title="a > b" data-x=\'</p>\'>x</p>', [(T, "x")]),
    ("<p>one<p>two<b>bold</p>three", [(T, "one"), (T, "twobold"), (T, "three")]),
    ("<h1>a</h1>\n<h2 id=1>b</h2>\n  <p>c</p>\n", [("Title", "a"), (S, "b"), (T, "c")]),
    ("<ul><li>a<li><p>b</p><p>c</p><ul><li>d</li></ul></ul>", [(L, "a"), (L, "b"), (T, "c"), (L, "d")]),
    ("<table><tr><th>a</th><td>b</td></tr><tr><td><p>c</p><td>d</table>after", [("Table", "a | b\nc | d"), (T, "after")]),
    ("<table>\n<tr>\n<td>a</td>\n<td></td>\n</tr><tr><td>b\n<td>c\n<tr><td>d</table>", [("Table", "a |\nb | c\nd")]),
    ("<div>a</div><div>b</div>c<br>d", [(T, "a"), (T, "b"), (T, "cd")]),
    ("<main>m</main><p>rest</p>", [(T, "m")]), ("<main></main><p>rest</p>", [(T, "rest")]),
    ("<main>m<article>a</article></main>", [(T, "a")]),
    ("<script>if (a</b) '<p>x</p>'</script><style>p{}</style><p>y</p><!-- <p>z</p> -->", [(T, "y")]),
    ("<p>x<!-- open", [(T, "x")]), ("<p>y</p><script>x", [(T, "y")]),
    ("<nav><p>n</p></nav><p>x</p></nav></div>", [(T, "x")]),
    ("<footer>a <b>b</b></footer><p>x</p>", [(T, "x"), ("Page-footer", "a b")]),
    ("a < b and c > d", [(T, "a < b and c > d")]), ("1 <2", [(T, "1 <2")]), ('<p class="x>open', [(T, "open")]),
    ("<p></p><p> </p>", [(T, ""), (T, "")]), ("", []), ("  \n ", []), ("<p", [(T, "<p")]),
])
def test_pages_as_found(page, blocks):
    assert page_blocks(page) == blocks


def test_references_are_decoded_once():
    assert decode("&lt;p&gt; &amp;lt; &eacute;&#65;&#x42; &nbsp;| &copy 1 &nosuch; &#0; &#xD800; &#x110000; &Uuml;") == \
        "<p> &lt; éAB  | &copy 1 &nosuch; &#0; &#xD800; &#x110000; Ü"


def test_long_and_hostile_pages_stay_linear():
    def took(page):
        began = time.perf_counter()
        page_blocks(page)
        return time.perf_counter() - began

    for piece in ("<p>x", "<div>", "<b><i>", "</p>", "<td>", "<!-- x -->", "<", '<a b="c">'):
        small, large = took(piece * 5_000), took(piece * 50_000)
        assert large < 40 * max(small, 0.005), piece


def test_rows_keep_any_key_and_stay_where_they_are(spark):
    df = spark.createDataFrame([(f"k{i}", f"<p>{i}</p><p>x") for i in range(200)], "page_id string, html string").withColumn("text", F.lit(1))
    out = PG.pages_to_blocks(df)
    assert out.count() == 400 and dict(out.dtypes)["page_id"] == "string"
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert PG.pages_to_blocks(df.limit(0)).collect() == []
