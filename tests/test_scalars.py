"""Scalar functions against independent Python versions (property tests)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from inferframe.functions import scalars as S


def py_smart_resize(h, w, factor=28, lo=3136, hi=11289600):
    def rnd(x):  # round half to even, like Python's round
        return round(x / factor) * factor
    hb, wb = max(factor, rnd(h)), max(factor, rnd(w))
    if hb * wb > hi:
        beta = math.sqrt(h * w / hi)
        hb = max(factor, math.floor(h / beta / factor) * factor)
        wb = max(factor, math.floor(w / beta / factor) * factor)
    elif hb * wb < lo:
        beta = math.sqrt(lo / (h * w))
        hb = math.ceil(h * beta / factor) * factor
        wb = math.ceil(w * beta / factor) * factor
        if hb * wb > hi:
            beta = math.sqrt(hb * wb / hi)
            hb = max(factor, math.floor(hb / beta / factor) * factor)
            wb = max(factor, math.floor(wb / beta / factor) * factor)
    return hb, wb


sizes = st.lists(st.tuples(st.integers(1, 9000), st.integers(1, 9000)), min_size=1, max_size=300)


@settings(max_examples=12, deadline=None)
@given(sizes, st.sampled_from([(28, 3136, 11289600), (14, 60000, 62000), (32, 1000, 5000)]))
def test_smart_resize_matches_python(spark, pairs, bounds):
    f, lo, hi = bounds
    df = spark.createDataFrame(pairs, "h int, w int")
    out = df.select("h", "w", S.smart_resize("h", "w", f, lo, hi).alias("r")).collect()
    for row in out:
        h, w = row["h"], row["w"]
        if max(h, w) / min(h, w) > 200:
            assert row["r"] is None
            continue
        assert (row["r"]["new_h"], row["r"]["new_w"]) == py_smart_resize(h, w, f, lo, hi)
        assert row["r"]["new_h"] % f == 0 and row["r"]["new_w"] % f == 0


def test_round_half_even(spark):
    df = spark.createDataFrame([(14,), (42,), (70,), (13,)], "x int")
    r = [x[0] for x in df.select(S.round_by_factor("x", 28)).collect()]
    assert r == [0, 56, 56, 0]


def test_render_size_fallback(spark):
    df = spark.createDataFrame([(612.0, 792.0), (2000.0, 1000.0)], "w double, h double")
    r = df.select(S.render_size("w", "h").alias("r")).collect()
    assert (r[0]["r"]["px_w"], r[0]["r"]["px_h"], r[0]["r"]["dpi"]) == (1700, 2200, 200)
    assert (r[1]["r"]["px_w"], r[1]["r"]["px_h"], r[1]["r"]["dpi"]) == (2000, 1000, 72)


def test_base64_has_no_line_breaks(spark):
    df = spark.createDataFrame([("x" * 500,)], "t string")
    b = df.select(S.base64_nolines("t")).first()[0]
    assert "\n" not in b and "\r" not in b and len(b) == 668


def test_flatten_options_equal_spellings(spark):
    df = spark.createDataFrame([('{"a":{"b":"c"},"d":"e","l":["x","y"]}',
                                 '{"a.b":"c","d":"e","l":["x","y"]}')], "n string, f string")
    r = df.select(S.canonical_options(S.flatten_options("n")).alias("a"),
                  S.canonical_options(S.flatten_options("f")).alias("b")).first()
    assert r["a"] == r["b"] == 'a.b=c;d=e;l=["x","y"]'


def test_mime(spark):
    df = spark.createDataFrame([("a/B.PNG",), ("x.mp4",), ("noext",)], "p string")
    assert [r[0] for r in df.select(S.mime_of("p")).collect()] == [
        "image/png", "video/mp4", "application/octet-stream"]


def test_smart_resize_area_bounds(spark):
    import random
    rnd = random.Random(3)
    pairs = [(rnd.randint(30, 9000), rnd.randint(30, 9000)) for _ in range(2000)]
    df = spark.createDataFrame(pairs, "h int, w int")
    r = df.select(S.smart_resize("h", "w").alias("r")).filter("r is not null").collect()
    assert all(x["r"]["new_h"] * x["r"]["new_w"] <= 11289600 for x in r)
    assert all(x["r"]["new_h"] % 28 == 0 and x["r"]["new_w"] % 28 == 0 for x in r)


def test_dot_and_cosine(spark):
    import numpy as np
    rows = [([1.0, 2.0, 3.0], [4.0, -5.0, 6.0]), ([0.0, 0.0], [1.0, 2.0])]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    out = df.select(S.dot("a", "b").alias("d"), S.cosine("a", "b").alias("c")).collect()
    a, b = np.array(rows[0][0]), np.array(rows[0][1])
    assert out[0]["d"] == float(a @ b)
    assert abs(out[0]["c"] - float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))) < 1e-12
    assert out[1]["c"] is None


def test_flatten_options_all_levels_last_wins(spark):
    from pyspark.sql import functions as F
    from inferframe.functions import scalars as S
    df = spark.createDataFrame([('{"a.b":"1","a":{"b":"2","c":{"d":{"e":[1,2]}}},"z":null}',)], "o string")
    r = df.select(S.flatten_options("o").alias("m")).first().m
    assert r == {"a.b": "2", "a.c.d.e": "[1,2]", "z": None}
    assert df.select(F.size(S.flatten_options("o"))).first()[0] == 3


def test_bbox_text_keeps_fractions(spark):
    from pyspark.sql import functions as F
    from inferframe.operators.requests import bbox_text
    df = spark.range(1).select(bbox_text(F.array(F.lit(0.75), F.lit(1.5), F.lit(2.0))).alias("f"), bbox_text(F.array(F.lit(1), F.lit(2))).alias("i"))
    assert tuple(df.first()) == ("[0.75, 1.5, 2]", "[1, 2]")


def test_token_set_of_any_script(spark):
    from inferframe.functions.scalars import token_set
    df = spark.createDataFrame([("Über élève straße 東京 x2 x2",)], "t string")
    assert df.select(token_set("t")).first()[0] == ["über", "élève", "straße", "東京", "x2"]


def test_blocks_of_general_pages(spark):
    from inferframe.operators.pages import pages_to_blocks, render_blocks
    pages = [
        (1, '<ARTICLE class="a"><h1 id=x>T &amp; U</h1>lead<p class="b">one &#233;&#x41;</p>tail<h2>S</h2><ul><li>i<li>j</ul></ARTICLE><footer>f</footer>'),
        (2, "<body><script>var x='<p>no</p>'</script><nav>n</nav><p>only</p></body>"),
        (3, "plain <b>text</b>"),
        (4, "<main><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table></main>"),
        (5, None), (6, ""),
    ]
    got = pages_to_blocks(spark.createDataFrame(pages, "page_id long, html string"))
    by = {}
    for r in got.orderBy("page_id", "elem_idx").collect():
        by.setdefault(r.page_id, []).append((r.category, r.text))
    assert by[1] == [("Title", "T & U"), ("Text", "lead"), ("Text", "one éA"), ("Text", "tail"), ("Section-header", "S"),
                     ("List-item", "i"), ("List-item", "j"), ("Page-footer", "f")]
    assert by[2] == [("Text", "only")] and by[3] == [("Text", "plain text")]
    assert by[4] == [("Table", "a | b\n1 | 2")] and 5 not in by and 6 not in by
    doc = render_blocks(got.filter("page_id = 2"), "doctags").first().document
    assert doc == "<doctag>\n<text>only</text>\n</doctag>"


def test_schema_checks_never_pass_silently(spark):
    import pytest
    from pyspark.sql import functions as F
    from inferframe.operators.validate import json_schema_errors
    schema = {"$defs": {"E": {"enum": ["a", "b"]}}, "type": "object", "required": ["e"],
              "properties": {"e": {"$ref": "#/$defs/E"}, "l": {"type": "array", "items": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}}}}}}
    rows = ['{"e":"a"}', '{"e":123}', '{"l":[]}', '{"e":"b","l":[{"n":1},{}]}', "[]", "x", '{"e":"a","l":[{"n":"1"}]}']
    df = spark.createDataFrame([(r,) for r in rows], "c string")
    got = [r[0] for r in df.select(json_schema_errors("c", schema)).collect()]
    assert got == [[], ["enum:e"], ["missing:e"], ["missing:l[].n"], ["not_object"], ["invalid_json"], ["type:l[].n"]]
    with pytest.raises(ValueError):
        json_schema_errors(F.lit("{}"), {"type": "object", "properties": {"a": {"oneOf": []}}})
