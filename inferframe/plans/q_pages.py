"""Page, conversion and scalar queries: FL1, FL3, AG6, SO2, CV1, CV2, RSP7, VAL7, SC1-SC9."""

from __future__ import annotations

from pyspark.sql import functions as F

from inferframe import refdata as R
from inferframe.functions import scalars as S
from inferframe.operators import pages as PG
from inferframe.operators import responses as RS
from inferframe.operators import validate as V
from inferframe.plans.catalog import query
from inferframe.plans.fixtures import SQL_PAGE_PLANS, SQL_SELECTED_PAGES, page_plans, tbl

# ------------------------------------------------------------------------------- pages


@query("fl_pages", sql=f"""
WITH {SQL_PAGE_PLANS}, {SQL_SELECTED_PAGES}
SELECT s.doc_id, s.page_idx, coalesce(p."end" > p.n_pages - 1, FALSE) AS clamped
FROM selected_pages s JOIN page_plans p USING (doc_id)""")
def fl_pages(spark, sf):
    """Requested inclusive page range per document (end clamped, negative start = 0)."""
    p = PG.select_pages(page_plans(spark, sf).drop("text"))
    return p.select("doc_id", "page_idx", "clamped")


@query("ag_document", sql=f"""
WITH {SQL_PAGE_PLANS}, {SQL_SELECTED_PAGES}
SELECT doc_id, count(*)::BIGINT AS n_pages_used,
       md5(string_agg(substring(text, (page_idx*1000 + 1)::INTEGER, 1000), chr(10) || chr(10) ORDER BY page_idx)) AS document_md5
FROM selected_pages GROUP BY doc_id""")
def ag_document(spark, sf):
    """Per-page OCR text (1000 characters of the document per page) joined in page order.
    Pages are cut in one linear pass and the requested range is kept (FL1 bounds)."""
    p = page_plans(spark, sf)
    st, en = PG.page_bounds("n_pages", "start", "end")
    cut = p.select("doc_id", st.alias("st"), en.alias("en"),
                   F.posexplode_outer(F.regexp_extract_all("text", F.lit("(?s).{1,1000}"), 0))
                   .alias("page_idx", "page_text"))
    ex = cut.filter(F.col("page_idx").isNotNull() & F.col("page_idx").between(F.col("st"), F.col("en")))
    d = PG.assemble_document(ex, "doc_id", "page_idx", "page_text")
    return d.select("doc_id", F.col("n_pages_used").cast("bigint").alias("n_pages_used"),
                    F.md5("document").alias("document_md5"))


@query("sc_render_size", sql=f"""
WITH {SQL_PAGE_PLANS},
r AS (SELECT doc_id, w_pt, h_pt, ceil(w_pt * 200 / 72.0) AS sw, ceil(h_pt * 200 / 72.0) AS sh FROM page_plans)
SELECT doc_id,
       (CASE WHEN greatest(sw, sh) > 4500 THEN ceil(w_pt::DOUBLE) ELSE sw END)::BIGINT AS px_w,
       (CASE WHEN greatest(sw, sh) > 4500 THEN ceil(h_pt::DOUBLE) ELSE sh END)::BIGINT AS px_h,
       CASE WHEN greatest(sw, sh) > 4500 THEN 72 ELSE 200 END AS dpi
FROM r""")
def sc_render_size(spark, sf):
    """Rendered pixel size at 200 dpi, falling back to 72 dpi above 4500 px."""
    p = page_plans(spark, sf).withColumn("r", S.render_size("w_pt", "h_pt"))
    return p.select("doc_id", "r.px_w", "r.px_h", "r.dpi")


@query("fl_aspect", sql=f"""
WITH {SQL_PAGE_PLANS}
SELECT doc_id, h, w,
       CASE WHEN least(h, w) > 0 THEN greatest(h, w)::DOUBLE / least(h, w) END AS ratio,
       coalesce(CASE WHEN least(h, w) > 0 THEN greatest(h, w)::DOUBLE / least(h, w) > 200 END, TRUE) AS rejected
FROM page_plans""")
def fl_aspect(spark, sf):
    """Image sizes that cannot be resized (aspect ratio > 200, zero side) are flagged."""
    p = PG.reject_bad_aspect(page_plans(spark, sf), "h", "w")
    return p.select("doc_id", "h", "w", S.aspect_ratio("h", "w").alias("ratio"), "rejected")


FACTORS = [28, 14, 8, 3]


def _by_factor(fn):
    """fn(x, factor) for the row's factor."""
    out = F.lit(None).cast("bigint")
    for f in FACTORS:
        out = F.when(F.col("f") == f, fn("x", f).cast("bigint")).otherwise(out)
    return out


def _factor_rows(spark, sf):
    d = tbl(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("x"))
    return d.withColumn("f", F.explode(F.array(*[F.lit(f) for f in FACTORS])))


_SQL_FACTOR_ROWS = f"(SELECT doc_id, n_chars AS x, unnest({FACTORS}) AS f FROM documents)"


@query("sc_round", sql=f"""
SELECT doc_id, f, x, (round_even(x / f::DOUBLE, 0)::BIGINT * f)::BIGINT AS r FROM {_SQL_FACTOR_ROWS}""")
def sc_round(spark, sf):
    """Closest multiple of the factor, ties to even."""
    return _factor_rows(spark, sf).select("doc_id", "f", "x", _by_factor(S.round_by_factor).alias("r"))


@query("sc_ceil", sql=f"""
SELECT doc_id, f, x, (ceil(x / f::DOUBLE)::BIGINT * f)::BIGINT AS r FROM {_SQL_FACTOR_ROWS}""")
def sc_ceil(spark, sf):
    """Smallest multiple of the factor not below x."""
    return _factor_rows(spark, sf).select("doc_id", "f", "x", _by_factor(S.ceil_by_factor).alias("r"))


@query("sc_floor", sql=f"""
SELECT doc_id, f, x, (floor(x / f::DOUBLE)::BIGINT * f)::BIGINT AS r FROM {_SQL_FACTOR_ROWS}""")
def sc_floor(spark, sf):
    """Largest multiple of the factor not above x."""
    return _factor_rows(spark, sf).select("doc_id", "f", "x", _by_factor(S.floor_by_factor).alias("r"))


RESIZE_SETTINGS = [("default", R.IMAGE_FACTOR, R.MIN_PIXELS, R.MAX_PIXELS),
                   ("tight", 14, 60000, 62000)]


def _sql_resize(name, f, lo, hi):
    return f"""
SELECT doc_id, '{name}' AS setting, new_h, new_w FROM (
 WITH a AS (SELECT doc_id, h, w, greatest({f}, round_even(h / {f}.0, 0)::BIGINT * {f}) AS a0,
                   greatest({f}, round_even(w / {f}.0, 0)::BIGINT * {f}) AS b0, h::BIGINT * w AS hw
            FROM page_plans WHERE least(h, w) > 0 AND greatest(h, w)::DOUBLE / least(h, w) <= 200),
 b AS (SELECT *, CASE WHEN a0*b0 > {hi} THEN sqrt(hw / {hi}.0) WHEN a0*b0 < {lo} THEN sqrt({lo}.0 / hw) END AS be,
              CASE WHEN a0*b0 > {hi} THEN 's' WHEN a0*b0 < {lo} THEN 'g' ELSE 'k' END AS m FROM a),
 c AS (SELECT *, CASE m WHEN 's' THEN greatest({f}, floor(h / be / {f}.0)::BIGINT * {f})
                        WHEN 'g' THEN ceil(h * be / {f}.0)::BIGINT * {f} ELSE a0 END AS a1,
                 CASE m WHEN 's' THEN greatest({f}, floor(w / be / {f}.0)::BIGINT * {f})
                        WHEN 'g' THEN ceil(w * be / {f}.0)::BIGINT * {f} ELSE b0 END AS b1 FROM b),
 e AS (SELECT *, m = 'g' AND a1*b1 > {hi} AS o, sqrt(a1*b1 / {hi}.0) AS b2 FROM c)
 SELECT doc_id, (CASE WHEN o THEN greatest({f}, floor(a1 / b2 / {f}.0)::BIGINT * {f}) ELSE a1 END)::BIGINT AS new_h,
                (CASE WHEN o THEN greatest({f}, floor(b1 / b2 / {f}.0)::BIGINT * {f}) ELSE b1 END)::BIGINT AS new_w
 FROM e)"""


@query("sc_smart_resize", sql=f"WITH {SQL_PAGE_PLANS} " + " UNION ALL ".join(
    _sql_resize(*s) for s in RESIZE_SETTINGS))
def sc_smart_resize(spark, sf):
    """Model-friendly image size (multiples of the factor, area within bounds) under the
    default bounds and a tight bound setting that exercises the grow-then-shrink branch;
    rejected sizes (FL3) produce no row."""
    p = page_plans(spark, sf)
    outs = []
    for name, f, lo, hi in RESIZE_SETTINGS:
        r = p.withColumn("r", S.smart_resize("h", "w", f, lo, hi)).filter(F.col("r").isNotNull())
        outs.append(r.select("doc_id", F.lit(name).alias("setting"), "r.new_h", "r.new_w"))
    return outs[0].unionByName(outs[1])


MIME_EXTS = ["png", "JPG", "jpeg", "mp4", "mp3", "pdf", "wav", "xyz"]


@query("sc_mime", sql=f"""
WITH f AS (SELECT doc_id, 'media/doc' || doc_id || '.' || ({MIME_EXTS})[(doc_id % {len(MIME_EXTS)} + 1)::INTEGER] AS path FROM documents)
SELECT doc_id, path, CASE lower(regexp_extract(path, '\\.([^./]+)$', 1))
  {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in S.MIME_BY_EXT.items())}
  ELSE 'application/octet-stream' END AS mime
FROM f""")
def sc_mime(spark, sf):
    """MIME type from the file extension (map literal, case-insensitive)."""
    d = tbl(spark, sf, "documents").select("doc_id")
    exts = F.array(*[F.lit(e) for e in MIME_EXTS])
    path = F.concat(F.lit("media/doc"), F.col("doc_id").cast("string"), F.lit("."),
                    F.element_at(exts, (F.col("doc_id") % len(MIME_EXTS) + 1).cast("int")))
    return d.withColumn("path", path).select("doc_id", "path", S.mime_of("path").alias("mime"))


@query("sc_json", sql="""
SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, '{"k":' || json_extract(props, '$.k')::BIGINT || '}' AS props_json,
       json_valid(props) AS valid
FROM events""")
def sc_json(spark, sf):
    """JSON decode with an explicit schema and encode back (compact form)."""
    e = tbl(spark, sf, "events").select("event_id", "props")
    parsed = F.from_json("props", "struct<k: bigint>")
    return e.select("event_id", parsed["k"].alias("k"), F.to_json(parsed).alias("props_json"),
                    F.try_parse_json("props").isNotNull().alias("valid"))


@query("sc_flatten", sql="""
SELECT doc_id, 'layout_custom_config.kind=' || source || ';ocr_engine=' || lang AS flat, TRUE AS same FROM documents""")
def sc_flatten(spark, sf):
    """Nested and dotted spellings of the same converter options flatten to one map."""
    d = tbl(spark, sf, "documents").select("doc_id", "lang", "source")
    nested = F.to_json(F.struct(F.struct(F.col("source").alias("kind")).alias("layout_custom_config"),
                                F.col("lang").alias("ocr_engine")))
    dotted = F.to_json(F.struct(F.col("source").alias("layout_custom_config.kind"),
                                F.col("lang").alias("ocr_engine")))
    a = S.canonical_options(S.flatten_options(nested))
    b = S.canonical_options(S.flatten_options(dotted))
    return d.select("doc_id", a.alias("flat"), (a == b).alias("same"))


# -------------------------------------------------------------------------- conversion

SQL_BLOCKS = """
art AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS a,
               regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1) AS f FROM pages),
parts AS (SELECT page_id, string_split(a, '<p>') AS ps, f FROM art),
raw_blocks AS (
  SELECT page_id, 0::BIGINT AS elem_idx, 'Title' AS category, regexp_extract(ps[1], '(?s)<h1>(.*?)</h1>', 1) AS raw FROM parts
  UNION ALL
  SELECT page_id, (i - 1)::BIGINT, 'Text', regexp_replace(ps[i], '(?s)</p>.*', '') FROM parts,
         LATERAL (SELECT unnest(generate_series(2, len(ps))) AS i)
  UNION ALL
  SELECT page_id, len(ps)::BIGINT, 'Page-footer', f FROM parts WHERE f <> ''),
blocks AS (
  SELECT page_id, elem_idx, category,
         replace(replace(replace(replace(replace(replace(replace(
           trim(regexp_replace(raw, '<[^>]+>', '', 'g')),
           '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&amp;', '&') AS text
  FROM raw_blocks)"""


@query("cv_blocks", sql=f"""
WITH {SQL_BLOCKS} SELECT page_id, elem_idx, category, md5(text) AS text_md5, length(text)::BIGINT AS text_len FROM blocks""")
def cv_blocks(spark, sf):
    """Web pages to ordered blocks: title, paragraphs (unclosed tags tolerated), footer."""
    b = PG.pages_to_blocks(tbl(spark, sf, "pages"))
    return b.select("page_id", "elem_idx", "category", F.md5("text").alias("text_md5"),
                    F.length("text").cast("bigint").alias("text_len"))


@query("cv_render", sql=f"""
WITH {SQL_BLOCKS}
SELECT page_id, count(*)::BIGINT AS n_blocks,
       md5(string_agg(CASE category WHEN 'Title' THEN '# ' || text ELSE text END, chr(10) || chr(10) ORDER BY elem_idx)) AS document_md5
FROM blocks GROUP BY page_id""")
def cv_render(spark, sf):
    """Blocks rendered as one Markdown document per page."""
    b = PG.pages_to_blocks(tbl(spark, sf, "pages"))
    r = PG.render_blocks(b, "md")
    return r.select("page_id", F.col("n_blocks").cast("bigint").alias("n_blocks"),
                    F.md5("document").alias("document_md5"))


@query("cv_render_doctags", sql=f"""
WITH {SQL_BLOCKS},
e AS (SELECT *, lower(replace(category, '-', '_')) AS tag, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS t FROM blocks)
SELECT page_id, count(*)::BIGINT AS n_blocks,
  md5('<doctag>' || chr(10) || string_agg('<' || tag || '>' || t || '</' || tag || '>', chr(10) ORDER BY elem_idx) || chr(10) || '</doctag>') AS document_md5
FROM e GROUP BY page_id""")
def cv_render_doctags(spark, sf):
    """Blocks rendered as one doctags document per page."""
    r = PG.render_blocks(PG.pages_to_blocks(tbl(spark, sf, "pages")), "doctags")
    return r.select("page_id", F.col("n_blocks").cast("bigint").alias("n_blocks"), F.md5("document").alias("document_md5"))


@query("cv_render_json", sql=f"""
WITH {SQL_BLOCKS}
SELECT page_id, count(*)::BIGINT AS n_blocks, string_agg(category, ',' ORDER BY elem_idx) AS categories,
       md5(string_agg(text, chr(30) ORDER BY elem_idx)) AS texts_md5
FROM blocks GROUP BY page_id""")
def cv_render_json(spark, sf):
    """Blocks rendered as one JSON document per page (parsed back: order, categories, texts)."""
    r = PG.render_blocks(PG.pages_to_blocks(tbl(spark, sf, "pages")), "json")
    d = F.from_json("document", "array<struct<category: string, text: string>>")
    return r.select("page_id", F.col("n_blocks").cast("bigint").alias("n_blocks"),
                    F.array_join(F.transform(d, lambda x: x["category"]), ",").alias("categories"),
                    F.md5(F.array_join(F.transform(d, lambda x: x["text"]), "\u001e")).alias("texts_md5"))


def layout_answers(spark, sf):
    """D9: the layout model's answer per page: JSON list of {bbox, category, text} from the
    page blocks with synthetic boxes; every 9th element is broken in one of 4 ways."""
    b = PG.pages_to_blocks(tbl(spark, sf, "pages"))
    k = (F.col("page_id") * 7 + F.col("elem_idx")) % 9
    y1 = F.lit(50.0) + F.col("elem_idx") * 40.0
    bbox = (F.when(k == 3, F.array(F.lit(50.0), y1, F.lit(550.0)))
            .when(k == 8, F.array(F.lit(550.0), y1, F.lit(50.0), y1 + 30.0))
            .otherwise(F.array(F.lit(50.0), y1, F.lit(550.0), y1 + 30.0)))
    cat = (F.when(k == 0, F.lit("Paragraph")).when(k == 6, F.lit("Picture"))
           .otherwise(F.col("category")))
    el = F.struct(bbox.alias("bbox"), cat.alias("category"), F.col("text").alias("text"),
                  F.col("elem_idx").alias("_i"))
    packed = b.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct(F.col("elem_idx"), el))).alias("e"))
    content = F.to_json(F.transform("e", lambda x: F.struct(x["col2"]["bbox"].alias("bbox"),
                                                            x["col2"]["category"].alias("category"),
                                                            x["col2"]["text"].alias("text"))))
    wrapped = F.concat(F.lit('{"layout":'), content, F.lit("}"))
    return packed.select("page_id", F.when(F.col("page_id") % 2 == 0, content).otherwise(wrapped).alias("content"))


SQL_LAYOUT = """
layout AS (
  SELECT page_id, elem_idx, (page_id * 7 + elem_idx) % 9 AS k,
         CASE (page_id * 7 + elem_idx) % 9 WHEN 0 THEN 'Paragraph' WHEN 6 THEN 'Picture' ELSE category END AS category,
         CASE (page_id * 7 + elem_idx) % 9
           WHEN 3 THEN '50,' || (50 + 40*elem_idx) || ',550'
           WHEN 8 THEN '550,' || (50 + 40*elem_idx) || ',50,' || (80 + 40*elem_idx)
           ELSE '50,' || (50 + 40*elem_idx) || ',550,' || (80 + 40*elem_idx) END AS bbox_text,
         text
  FROM blocks),
lcheck AS (
  SELECT page_id, elem_idx,
         category IN ('Caption','Footnote','Formula','List-item','Page-footer','Page-header','Picture','Section-header','Table','Text','Title') AS cat_ok,
         k <> 3 AS bbox_ok,
         NOT (category = 'Picture' AND text IS NOT NULL) AS picture_ok,
         k NOT IN (3, 8) AS order_ok
  FROM layout)"""


def layout_rows(spark, sf):
    return RS.explode_layout(layout_answers(spark, sf), "content")


@query("rsp_layout", sql=f"""
WITH {SQL_BLOCKS}, {SQL_LAYOUT}
SELECT page_id, elem_idx::INTEGER AS elem_idx, category, bbox_text, md5(text) AS text_md5 FROM layout""")
def rsp_layout(spark, sf):
    """Layout answers exploded to elements in reading order."""
    r = layout_rows(spark, sf)
    return r.select("page_id", "elem_idx", "category",
                    F.array_join(F.transform("bbox", lambda x: x.cast("bigint").cast("string")), ",")
                    .alias("bbox_text"), F.md5("text").alias("text_md5"))


@query("val_layout", sql=f"""
WITH {SQL_BLOCKS}, {SQL_LAYOUT}
SELECT page_id, elem_idx::INTEGER AS elem_idx, cat_ok, bbox_ok, picture_ok, order_ok,
       cat_ok AND bbox_ok AND picture_ok AND order_ok AS valid FROM lcheck""")
def val_layout(spark, sf):
    """Layout elements checked: category list, 4-number box, Picture without text, x1<=x2, y1<=y2."""
    v = V.check_layout(layout_rows(spark, sf))
    return v.select("page_id", "elem_idx", "cat_ok", "bbox_ok", "picture_ok", "order_ok", "valid")


@query("so_reading_order", sql=f"""
WITH {SQL_BLOCKS}, {SQL_LAYOUT}
SELECT page_id, elem_idx::INTEGER AS elem_idx,
       (row_number() OVER (PARTITION BY page_id ORDER BY elem_idx) - 1)::BIGINT AS reading_pos
FROM lcheck WHERE cat_ok AND bbox_ok AND picture_ok AND order_ok""")
def so_reading_order(spark, sf):
    """Reading position of the valid elements of each page."""
    v = V.check_layout(layout_rows(spark, sf))
    r = PG.reading_order(v, "page_id", "elem_idx", keep=F.col("valid"))
    return r.select("page_id", "elem_idx", "reading_pos")
