"""Pages and document conversion: FL1 page ranges, FL3 aspect rejection, AG6 document
assembly, SO2 reading order, CV1 HTML -> ordered blocks, CV2 blocks -> Markdown/JSON.

A page is the unit of parallelism: a document's pages are generated with
``explode(sequence(...))`` and spread over the cluster like any other rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inferframe.functions.scalars import aspect_rejected
from inferframe.operators.html_blocks import page_blocks
from inferframe.operators.ordered import ordered_collect, ordered_concat


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def page_bounds(n_pages, start, end) -> tuple[Column, Column]:
    """Inclusive page range of the PDF loader: ``end`` NULL or negative => last page;
    ``end`` beyond the document => clamped; negative ``start`` => from page 0."""
    n = _c(n_pages)
    st = F.greatest(F.coalesce(_c(start), F.lit(0)), F.lit(0))
    en = F.least(F.coalesce(F.when(_c(end) >= 0, _c(end)), n - 1), n - 1)
    return st, en


def select_pages(docs: DataFrame, n_pages: str = "n_pages", start: str = "start",
                 end: str = "end", out: str = "page_idx") -> DataFrame:
    """FL1: one row per selected page (0-based), generated directly from the bounds; an
    empty range (``start > end``) gives no rows. ``clamped`` flags an end past the last
    page (the loader prints a notice)."""
    st, en = page_bounds(n_pages, start, end)
    seq = F.when(st <= en, F.sequence(st.cast("bigint"), en.cast("bigint")))
    return (docs.withColumn("clamped", F.coalesce(F.col(end) > F.col(n_pages) - 1, F.lit(False)))
                .select("*", F.explode(seq).alias(out)))


def reject_bad_aspect(df: DataFrame, h: str = "h", w: str = "w") -> DataFrame:
    """FL3: a ``rejected`` flag instead of an exception (ratio above 200, a zero or NULL
    side)."""
    return df.withColumn("rejected", aspect_rejected(h, w))


def assemble_document(pages: DataFrame, key: str = "doc_id", page: str = "page_idx",
                      text: str = "text", sep: str = "\n\n") -> DataFrame:
    """AG6: page texts joined in page order (two-level, see ``ordered_concat``)."""
    return ordered_concat(pages, [key], page, text, sep, out="document",
                          extra={"n_pages_used": (F.count("*"), "sum")})


def reading_order(layout: DataFrame, key: str = "page_id", elem: str = "elem_idx",
                  keep: Column | None = None) -> DataFrame:
    """SO2: reading position of the kept elements of each page (dense, 0-based, in element
    order), rows clustered by page and sorted within partitions (no global sort)."""
    df = layout.filter(keep) if keep is not None else layout
    w = Window.partitionBy(key).orderBy(elem)
    return (df.withColumn("reading_pos", (F.row_number().over(w) - 1).cast("bigint"))
              .sortWithinPartitions(key, elem))


# ------------------------------------------------------------------------------ CV1/CV2

#: pages read before their blocks are handed on
PAGES_AT_ONCE = 64

def pages_to_blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """CV1: HTML page -> ordered blocks ``(elem_idx, category, text)``.

    The text is that of all ``<article>``, else of all ``<main>`` (whichever hold text), else the whole page, without head, title,
    scripts, styles, navigation, advertising (``<div class="ad">``) and comments. Blocks are headings, paragraphs, list items and
    tables, whose end tags are optional: ``Title`` (h1), ``Section-header`` (h2-h6), ``Text``, ``List-item``, ``Table``
    (cells joined by " | ", rows by line ends). Text outside such an element is a ``Text`` block too, divided by block-level elements.
    The page's footers come last as one ``Page-footer``. Tags may carry attributes in quotes, any case, and may be
    left open. A NULL page gives no block.

    Every page is read once with a stack of open elements (``html_blocks``), in Arrow batches: which text belongs to which
    element depends on all open ones, which no expression over the page can follow. Rows stay where they are."""
    kind = pages.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for first in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.column(1).slice(first, PAGES_AT_ONCE)
                blocks = [page_blocks(page) for page in part.to_pylist()]
                n = [len(b) for b in blocks]
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array([first + i for i, k in enumerate(n) for _ in range(k)], pa.int64())),
                    pa.array([i for k in n for i in range(k)], pa.int64()),
                    pa.array([c for b in blocks for c, _ in b], pa.string()), pa.array([t for b in blocks for _, t in b], pa.string())],
                    [key, "elem_idx", "category", "text"])

    return pages.select(key, F.col(html).cast("string").alias("html")).mapInArrow(run, T.StructType([
        T.StructField(key, kind), T.StructField("elem_idx", T.LongType()), T.StructField("category", T.StringType()),
        T.StructField("text", T.StringType())]))


def block_markdown(category: Column, text: Column) -> Column:
    return (F.when(category == "Title", F.concat(F.lit("# "), text))
            .when(category == "Section-header", F.concat(F.lit("## "), text))
            .when(category == "List-item", F.concat(F.lit("- "), text))
            .otherwise(text))


def render_blocks(blocks: DataFrame, to_format: str = "md", key: str = "page_id") -> DataFrame:
    """CV2: blocks -> one document per page, Markdown (``# `` titles, ``- `` list items,
    blank line between blocks), JSON (ordered list of ``{category, text}``) or doctags (one element per
    block, named after its category, inside ``<doctag>``)."""
    if to_format == "doctags":
        tag = F.lower(F.regexp_replace("category", "-", "_"))
        text = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        el = blocks.withColumn("_el", F.concat(F.lit("<"), tag, F.lit(">"), text, F.lit("</"), tag, F.lit(">")))
        out = ordered_concat(el, [key], "elem_idx", "_el", "\n", out="document",
                             extra={"n_blocks": (F.count("*"), "sum")})
        return out.withColumn("document", F.concat(F.lit("<doctag>\n"), F.col("document"), F.lit("\n</doctag>")))
    if to_format == "md":
        md = blocks.withColumn("_md", block_markdown(F.col("category"), F.col("text")))
        return ordered_concat(md, [key], "elem_idx", "_md", "\n\n", out="document",
                              extra={"n_blocks": (F.count("*"), "sum")})
    if to_format == "json":
        packed = ordered_collect(blocks, [key], "elem_idx",
                                 F.struct(F.col("category").alias("category"),
                                          F.col("text").alias("text")), out="_b")
        return packed.select(key, F.to_json("_b").alias("document"),
                             F.size("_b").cast("bigint").alias("n_blocks"))
    raise ValueError(f"unsupported format {to_format}")
