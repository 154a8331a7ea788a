"""SC1-SC10: scalar functions as Column expressions (JVM-side, whole-stage codegen).

Semantics follow the image/request helpers being reproduced:
* ``round_by_factor`` rounds half to even (``rint``), like Python's ``round``.
* ``smart_resize`` returns (height, width), both multiples of ``factor``, area within
  [min_pixels, max_pixels], including the "grow then shrink again" branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inferframe import refdata as R


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_by_factor(x, factor: int) -> Column:
    """SC1: closest multiple of ``factor`` (ties to even), BIGINT."""
    return F.rint(_c(x).cast("double") / F.lit(float(factor))).cast("bigint") * F.lit(factor)


def ceil_by_factor(x, factor: int) -> Column:
    """SC2: smallest multiple of ``factor`` >= x, BIGINT."""
    return F.ceil(_c(x).cast("double") / F.lit(float(factor))) * F.lit(factor)


def floor_by_factor(x, factor: int) -> Column:
    """SC3: largest multiple of ``factor`` <= x, BIGINT."""
    return F.floor(_c(x).cast("double") / F.lit(float(factor))) * F.lit(factor)


def aspect_ratio(h, w) -> Column:
    """max/min side ratio as DOUBLE; NULL when a side is zero or NULL."""
    h, w = _c(h).cast("double"), _c(w).cast("double")
    lo = F.least(h, w)
    return F.when(lo > 0, F.greatest(h, w) / lo)


def aspect_rejected(h, w, max_ratio: int = R.MAX_ASPECT_RATIO) -> Column:
    """FL3 predicate: true when the size cannot be resized (ratio above the bound, a zero or
    negative side, or a NULL side)."""
    r = aspect_ratio(h, w)
    return F.coalesce(r > F.lit(float(max_ratio)), F.lit(True))


def smart_resize(h, w, factor: int = R.IMAGE_FACTOR, min_pixels: int = R.MIN_PIXELS,
                 max_pixels: int = R.MAX_PIXELS) -> Column:
    """SC4: ``struct(new_h BIGINT, new_w BIGINT)``; NULL for rejected sizes (see FL3)."""
    f = F.lit(factor)
    fd = F.lit(float(factor))
    hi = F.lit(max_pixels)
    lo = F.lit(min_pixels)
    hd, wd = _c(h).cast("double"), _c(w).cast("double")
    a0 = F.greatest(f.cast("bigint"), round_by_factor(h, factor))
    b0 = F.greatest(f.cast("bigint"), round_by_factor(w, factor))
    hw = _c(h).cast("bigint") * _c(w).cast("bigint")
    area0 = a0 * b0
    shrink = area0 > hi
    grow = area0 < lo
    beta_s = F.sqrt(hw.cast("double") / F.lit(float(max_pixels)))
    beta_g = F.sqrt(F.lit(float(min_pixels)) / hw.cast("double"))
    a1 = (F.when(shrink, F.greatest(f.cast("bigint"), F.floor(hd / beta_s / fd) * f))
          .when(grow, F.ceil(hd * beta_g / fd) * f).otherwise(a0))
    b1 = (F.when(shrink, F.greatest(f.cast("bigint"), F.floor(wd / beta_s / fd) * f))
          .when(grow, F.ceil(wd * beta_g / fd) * f).otherwise(b0))
    over = grow & ((a1 * b1) > hi)
    beta_o = F.sqrt((a1 * b1).cast("double") / F.lit(float(max_pixels)))
    new_h = F.when(over, F.greatest(f.cast("bigint"), F.floor(a1.cast("double") / beta_o / fd) * f)
                   ).otherwise(a1)
    new_w = F.when(over, F.greatest(f.cast("bigint"), F.floor(b1.cast("double") / beta_o / fd) * f)
                   ).otherwise(b1)
    ok = ~aspect_rejected(h, w)
    return F.when(ok, F.struct(new_h.cast("bigint").alias("new_h"),
                               new_w.cast("bigint").alias("new_w")))


def render_size(w_pt, h_pt, dpi: int = R.RENDER_DPI,
                max_side: int = R.RENDER_MAX_PIXELS_SIDE) -> Column:
    """SC5: rendered pixel size of a page given in points: scale dpi/72, falling back to
    72 dpi when either side exceeds ``max_side`` pixels. ``struct(px_w, px_h, dpi)``;
    pixel rounding is ``ceil`` (a renderer choice)."""
    w, h = _c(w_pt).cast("double"), _c(h_pt).cast("double")
    sw = F.ceil(w * F.lit(float(dpi)) / F.lit(float(R.BASE_DPI)))
    sh = F.ceil(h * F.lit(float(dpi)) / F.lit(float(R.BASE_DPI)))
    big = F.greatest(sw, sh) > F.lit(max_side)
    return F.struct(
        F.when(big, F.ceil(w)).otherwise(sw).cast("bigint").alias("px_w"),
        F.when(big, F.ceil(h)).otherwise(sh).cast("bigint").alias("px_h"),
        F.when(big, F.lit(R.BASE_DPI)).otherwise(F.lit(dpi)).alias("dpi"),
    )


# MIME types by lower-case file extension.
MIME_BY_EXT = {
    "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif",
    "webp": "image/webp", "pdf": "application/pdf", "mp3": "audio/mpeg", "wav": "audio/wav",
    "mp4": "video/mp4", "parquet": "application/vnd.apache.parquet", "json": "application/json",
    "txt": "text/plain", "html": "text/html",
}


def file_ext(path) -> Column:
    return F.lower(F.regexp_extract(_c(path), r"\.([^./]+)$", 1))


def mime_of(path, default: str = "application/octet-stream") -> Column:
    """SC6: MIME type from the file extension (map literal lookup, no UDF)."""
    m = F.create_map(*[x for kv in MIME_BY_EXT.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(F.try_element_at(m, file_ext(path)), F.lit(default))


def base64_nolines(x) -> Column:
    """SC7: standard base64 without the line breaks ``base64()`` may insert."""
    return F.translate(F.base64(_c(x)), "\r\n", "")


def data_uri(content, mime) -> Column:
    """PRJ8: ``data:<mime>;base64,<payload>``."""
    return F.concat(F.lit("data:"), _c(mime), F.lit(";base64,"), base64_nolines(content))


def dot(a, b) -> Column:
    """SC10: dot product of two numeric arrays in DOUBLE."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def cosine(a, b) -> Column:
    """SC10: cosine similarity; NULL if a vector has zero norm."""
    na = F.sqrt(dot(a, a))
    nb = F.sqrt(dot(b, b))
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb))


OPTION_LEVELS = 8


def flatten_options(json_text, levels: int = OPTION_LEVELS) -> Column:
    """SC9: option JSON -> ``map<string,string>`` with nested objects flattened to dotted
    keys (``{"a":{"b":"c"}}`` -> ``a.b=c``), so the dotted and nested spellings of one
    option compare equal; of several spellings of one key the last wins. Objects are opened down to
    ``levels`` levels, deeper ones keep their JSON text, as do lists; plain strings are unquoted."""
    def expand(e):
        nested = F.from_json(e["value"], "map<string,string>")
        is_obj = F.startswith(F.ltrim(F.coalesce(e["value"], F.lit(""))), F.lit("{"))
        inner = F.transform(F.map_entries(nested),
                            lambda n: F.struct(F.concat(e["key"], F.lit("."), n["key"]).alias("key"),
                                               n["value"].alias("value")))
        return F.when(is_obj & nested.isNotNull(), inner).otherwise(
            F.array(F.struct(e["key"].alias("key"), e["value"].alias("value"))))

    entries = F.transform(F.map_entries(F.from_json(_c(json_text), "map<string,string>")),
                          lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    for _ in range(levels - 1):
        entries = F.flatten(F.transform(entries, expand))
    empty = F.create_map().cast("map<string,string>")
    return F.aggregate(entries, empty, lambda m, e: F.map_concat(
        F.map_filter(m, lambda k, v: k != e["key"]), F.create_map(e["key"], e["value"])))


def canonical_options(m) -> Column:
    """Deterministic text of an options map: ``k=v`` pairs sorted by key, joined by ``;``."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(_c(m)),
                                                 lambda e: F.concat(e["key"], F.lit("="),
                                                                    F.coalesce(e["value"], F.lit("null"))))),
                        ";")


def token_set(text) -> Column:
    """Distinct lower-case words of a text (array<string>): runs of letters, marks and numbers of
    any script."""
    return F.array_distinct(F.regexp_extract_all(F.lower(_c(text)), F.lit(r"([\p{L}\p{M}\p{N}]+)"), 1))
