"""Resolution of not-modified revisits in web archives.

A revisit record says "unchanged" (HTTP 304) and carries no payload. It is resolved by an as-of join:
the latest earlier full response of the same canonical URL lends its payload, provided the validators agree,
and its headers are brought up to date by those that a 304 may update.

Records: record_id, url, ts (any orderable capture time, as long), kind ("response" or "revisit"),
headers (map of lower-case names), payload_digest. Result: one row per revisit with
record_id, canonical_url, ts, response_id, response_ts, status, headers, payload_digest.

status: `resolved` (the validators agree), `unverified` (the revisit carries no validator that the response
also has), `mismatch` (a validator differs: the payload is not that response's; response_id is told, headers and digest stay
null), `no_earlier` (no earlier response). ETags are compared weakly (a leading W/ is ignored) and come before last-modified.
"Earlier" is strict: a response of the same instant doesn't count. Of responses at one instant the largest record_id wins.

Canonical URL: host in lower case without "www." and default port, scheme dropped, fragment dropped, tracking
parameters (utm_*) dropped, remaining parameters sorted, no trailing slash.

Skew: one URL may hold a third of all records. URLs with more than `SLICE` records are cut into time slices at
their own time quantiles. Inside a slice a window carries the last response along; across slices only one
summary row per slice is carried (a window over at most `SLICES` + 1 rows). No task sorts a hot URL's records
whole. Cut points are joined by a broadcast only while counted small.

Defined results: null url or one without "://" has a null canonical URL, and such revisits are `no_earlier`.
A null ts is earlier than nothing and later than nothing: `no_earlier`, and never lends. Null headers count as
empty. Repeated revisit rows are answered each. Other kinds are ignored. An empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inferframe.llm.shared import written

#: fixed: header fields that a 304 answer may update (HTTP semantics and caching standards)
UPDATABLE = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
SLICE = 50_000
SLICES = 256
MAX_BROADCAST_URLS = 2_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(url: Column) -> Column:
    """Canonical form of a URL (see above), null without "://"."""
    scheme = F.translate(F.regexp_extract(url, r"(?s)^(.*?)://", 1), UPPER, LOWER)
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    host = F.when(scheme == "http", F.regexp_replace(host, r":80$", "")) \
        .when(scheme == "https", F.regexp_replace(host, r":443$", "")).otherwise(host)
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_"))), "&")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def _etag(headers: Column) -> Column:
    return F.regexp_replace(F.element_at(headers, F.lit("etag")), "^W/", "")


def merged(stored: Column, update: Column) -> Column:
    """Headers of the stored response, updated by the permitted ones of the revisit."""
    allowed = F.map_filter(update, lambda k, v: k.isin(*UPDATABLE) & v.isNotNull())
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k)), allowed)


def _sliced(rows: DataFrame) -> DataFrame:
    """rows with `slice`: 0 for most URLs, a time slice number for URLs with very many records."""
    hot = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > SLICE).select(F.col("key").alias("hot"))
    hot = written(hot, "hot-urls")
    n = hot.limit(MAX_BROADCAST_URLS + 1).count()
    if not n:
        return rows.withColumn("slice", F.lit(0))
    small = F.broadcast if n <= MAX_BROADCAST_URLS else (lambda x: x)
    at = [i / SLICES for i in range(1, SLICES)]
    cuts = written(rows.join(small(hot), F.col("key") == F.col("hot"), "left_semi").groupBy(F.col("key").alias("hot"))
                   .agg(F.array_distinct(F.percentile_approx("ts", at, 10 * SLICES)).alias("cuts")), "slices")
    # equal times stay in one slice, so "strictly earlier" never looks across a cut sideways
    return rows.join(small(cuts), F.col("key") == F.col("hot"), "left") \
        .withColumn("slice", F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("ts"))), F.lit(0))).drop("hot", "cuts")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of records, resolved against the latest earlier response of its URL."""
    empty = F.create_map().cast("map<string,string>")
    rows = records.where(F.col("kind").isin("response", "revisit")).select(
        F.col("record_id").cast("string").alias("record_id"), canonical(F.col("url")).alias("key"), F.col("ts").cast("long").alias("ts"),
        (F.col("kind") == "response").alias("full"), F.coalesce(F.col("headers"), empty).alias("headers"),
        F.col("payload_digest").cast("string").alias("payload_digest"))
    usable = F.col("key").isNotNull() & F.col("ts").isNotNull()
    lender = F.when(F.col("full"), F.struct("ts", "record_id", "headers", "payload_digest"))
    rows_ = _sliced(rows.where(usable)).withColumn("lender", lender)
    # at equal times revisits come first, so they don't see that instant's responses
    order = [F.col("ts"), F.col("full"), F.col("record_id")]
    inside = Window.partitionBy("key", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows_.withColumn("found", F.last("lender", ignorenulls=True).over(inside)).where(~F.col("full"))
    tails = rows_.where("slice > 0 or full").groupBy("key", "slice").agg(F.max_by("lender", F.when(F.col("full"), F.struct("ts", "record_id"))).alias("tail"))
    across = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.withColumn("carry", F.last("tail", ignorenulls=True).over(across)).where("slice > 0 and carry is not null") \
        .select(F.col("key").alias("k"), F.col("slice").alias("s"), "carry")
    local = local.join(carried, (F.col("key") == F.col("k")) & (F.col("slice") == F.col("s")), "left") \
        .withColumn("found", F.coalesce("found", "carry")).select("record_id", "key", "ts", "headers", "found")
    lost = rows.where(~usable & ~F.col("full")).select("record_id", "key", "ts", "headers", F.lit(None).cast(local.schema["found"].dataType).alias("found"))
    both = local.unionByName(lost)

    stored = F.col("found.headers")
    tag, theirs = _etag(F.col("headers")), _etag(stored)
    date, their_date = (F.element_at(h, F.lit("last-modified")) for h in (F.col("headers"), stored))
    status = F.when(F.col("found").isNull(), "no_earlier") \
        .when(tag.isNotNull() & theirs.isNotNull(), F.when(tag == theirs, "resolved").otherwise("mismatch")) \
        .when(date.isNotNull() & their_date.isNotNull(), F.when(date == their_date, "resolved").otherwise("mismatch")) \
        .otherwise("unverified")
    lends = F.col("status").isin("resolved", "unverified")
    return both.withColumn("status", status).select(
        "record_id", F.col("key").alias("canonical_url"), "ts", F.col("found.record_id").alias("response_id"),
        F.col("found.ts").alias("response_ts"), "status",
        F.when(lends, merged(stored, F.col("headers"))).alias("headers"),
        F.when(lends, F.col("found.payload_digest")).alias("payload_digest"))


def crawl_records(pages: DataFrame) -> DataFrame:
    """A capture history derived from `pages`: each page is a full response, and is asked for again twice.

    The first revisit spells the URL differently (host in capitals, a fragment) and repeats the ETag, weakly; the second
    carries only Last-Modified, or for a fifth of the pages an ETag of changed content. Times follow the page id."""
    digest = F.md5(F.coalesce("html", F.lit("")))
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    ts = F.col("page_id") * 7919 % 31536000
    stamp = F.concat(F.lit("t"), ts.cast("string"))
    changed = F.substring(digest, 1, 1).isin("0", "1", "2")
    base = pages.select("page_id", "url", digest.alias("digest"), tag.alias("tag"), ts.alias("t"), stamp.alias("stamp"), changed.alias("changed"))
    name = lambda i: F.concat(F.lit("r"), F.col("page_id").cast("string"), F.lit(f"-{i}"))

    def headers(**fields: Column) -> Column:
        return F.create_map(*[x for k, v in fields.items() for x in (F.lit(k.replace("_", "-")), v)])

    def record(i: int, url: Column, ts: Column, kind: str, head: Column, digest: Column) -> Column:
        return F.struct(name(i).alias("record_id"), url.alias("url"), ts.cast("long").alias("ts"), F.lit(kind).alias("kind"),
                        head.alias("headers"), digest.cast("string").alias("payload_digest"))

    none = F.lit(None).cast("string")
    shout = F.concat(F.substring_index("url", "://", 1), F.lit("://"), F.upper(F.regexp_extract("url", r"://([^/?#]*)", 1)),
                     F.regexp_extract("url", r"://[^/?#]*([^#]*)", 1), F.lit("#again"))
    full = record(0, F.col("url"), F.col("t"), "response", headers(
        content_type=F.lit("text/html"), etag=F.col("tag"), last_modified=F.col("stamp"), cache_control=F.lit("max-age=60")), F.col("digest"))
    one = record(1, shout, F.col("t") + 86400, "revisit", headers(
        etag=F.concat(F.lit("W/"), F.col("tag")), cache_control=F.lit("max-age=3600"), content_type=F.lit("text/plain")), none)
    two = record(2, F.col("url"), F.col("t") + 172800, "revisit", F.when(F.col("changed"), headers(
        etag=F.lit('"changed"'), date=F.lit("d2"))).otherwise(headers(last_modified=F.col("stamp"), date=F.lit("d2"))), none)
    return base.select(F.explode(F.array(full, one, two)).alias("r")).select("r.*")
