"""One query per operator over its whole table, with production parameters. Each maps
(spark, sf_dir) to the operator's full result as digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from inferframe.llm import (hard_negatives, langid, line_crf, lm_scoring, minhash, mixing, packing, periodic_runs,
                            simhash, suffix_dedup, token_counts, url_reputation, warc_revisits)
from inferframe.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZER_PACK = "word_bpe_49k.json"
TOKENIZER_COUNT = "byte_bpe_50k.json"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_url_reputation", """
with p as (
  select page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path from pages),
o as (
  select doc_id as page_id, min(case when quality = 1 and coalesce(toxic, 0) = 0 then 1 else 0 end) as good
  from labels where quality is not null group by 1),
h0 as (
  select host, count(good) as n, coalesce(sum(good), 0) as k, regexp_replace(host, '\\.?(:[0-9]*)?$', '') as name
  from p left join o using (page_id) group by host),
h1 as (
  select *, regexp_extract(name, '(?:^|\\.)((?:ac|co|com|edu|gov|net|org)\\.[a-z]{2})$', 1) as two from h0),
h2 as (select *, case when two <> '' then two else regexp_extract(name, '([^.]*)$', 1) end as suffix from h1),
h3 as (select *, regexp_extract(substr(name, 1, greatest(length(name) - length(suffix) - 1, 0)), '([^.]*)$', 1) as label from h2),
h as (select host, n::double as n, k::double as k, suffix, case when label = '' then name else label || '.' || suffix end as domain from h3),
g as (select (sum(k) + 1) / (sum(n) + 2) as m from h),
s0 as (select suffix, sum(n) as n, sum(k) as k, any_value(m) as m from h, g group by suffix),
s1 as (select sum((k - n * m) * (k - n * m) - n * m * (1 - m)) as a, sum(n * (n - 1) * m * (1 - m)) as b from s0),
s2 as (select 1 / (case when b > 0 then least(greatest(a / b, 0.0001), 0.95) else 0.01 end) - 1 as c from s1),
s as (select suffix, (k + c * m) / (n + c) as mean from s0, s2),
d0 as (select suffix, domain, sum(n) as n, sum(k) as k, any_value(mean) as m from h join s using (suffix) group by 1, 2),
d1 as (select sum((k - n * m) * (k - n * m) - n * m * (1 - m)) as a, sum(n * (n - 1) * m * (1 - m)) as b from d0),
d2 as (select 1 / (case when b > 0 then least(greatest(a / b, 0.0001), 0.95) else 0.01 end) - 1 as c from d1),
d as (select suffix, domain, (k + c * m) / (n + c) as m from d0, d2),
f0 as (select h.*, m from h join d using (suffix, domain)),
f1 as (select sum((k - n * m) * (k - n * m) - n * m * (1 - m)) as a, sum(n * (n - 1) * m * (1 - m)) as b from f0),
f2 as (select 1 / (case when b > 0 then least(greatest(a / b, 0.0001), 0.95) else 0.01 end) - 1 as c from f1),
f3 as (select host, k + c * m as x, n - k + c * (1 - m) as y from f0, f2),
f as (select host, x / (x + y) + 1.645 * sqrt(x * y / ((x + y) * (x + y) * (x + y + 1))) >= 0.7 as good from f3),
rules as (select * from (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) as t(rh, rp, rv)),
fit as (
  select host, path, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(rv, length(rh || rp)) as rv
  from (select distinct host, path from p) u join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
  group by host, path)
select page_id, p.host, p.path, fit.rule, coalesce(fit.rv, case when f.good then 'allow' else 'block' end) as verdict
from p join f using (host) left join fit on fit.host = p.host and fit.path = p.path
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query("op2_prefix_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_COUNT))


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_PACK))


@query("op4_backoff_automaton")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


@query("op5_minmax_dedup", """
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws
  from documents),
sh as (
  select distinct doc_id, s from (
    select doc_id, unnest(case when len(ws) >= 3
      then list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
      when len(ws) > 0 then [array_to_string(ws, ' ') || ' #' || len(ws)] else [] end) as s from w)),
n as (select doc_id, count(*) as n from sh group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as i from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from common c join n x on x.doc_id = c.a join n y on y.doc_id = c.b where 100 * i >= 85 * (x.n + y.n - i)),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join links l on l.a = r.b),
label as (select a as doc_id, min(b) as component_id from reach group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, l.component_id, d.doc_id = l.component_id as kept
from documents d join label l using (doc_id) left join n using (doc_id)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


@query("op6_line_crf")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.line_quality(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(table(spark, sf_dir, "documents"))


@query("op8_pareto_mixing", """
with s as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
src as (select source, sum(size)::bigint as source_size from s group by source),
w as (
  select *, ([5, 2, 1])[((row_number() over (order by source is null, source) - 1) % 3 + 1)::int] as weight, 2 * source_size as stop from src),
f as (
  select *, 1.5::double * sum(source_size) over () as budget,
    coalesce(sum(stop) over o, 0) as gone, sum(weight) over () - coalesce(sum(weight) over o, 0) as rest
  from w window o as (order by stop::double / weight, source is null, source rows between unbounded preceding and 1 preceding)),
g as (select *, stop * rest <= (budget - gone) * weight as stopped from f),
free as (select arg_min((budget - gone)::double, (stop::double / weight, source is null, source)) as b,
    arg_min(rest, (stop::double / weight, source is null, source)) as r from g where not stopped),
t as (select source, source_size, case when stopped then stop::double else b * weight::double / r::double end as target from g left join free on true),
d as (
  select s.*, source_size, target, case when source_size > 0 then least(target / source_size, 2.0) else 0.0 end as p,
    (('0x' || substr(md5(coalesce(doc_id::varchar, 'null')), 1, 12))::bigint::double + 0.5) / 281474976710656.0 as u
  from s join t on s.source is not distinct from t.source),
e as (select *, floor(p) as whole, p - floor(p) as f from d),
q as (select *, u * (1 - f) / (u * (1 - f) + f * (1 - u)) as q, sum(size * whole) over (partition by source) as certain from e),
r as (
  select *, sum(size) over (partition by source, f > 0 and size > 0 order by q, doc_id::varchar rows between unbounded preceding and current row) as upto from q)
select doc_id, size, source_size::bigint as source_size, target,
  (size * (whole + case when f > 0 and size > 0 and 2 * upto - size <= 2 * (target - certain) then 1 else 0 end))::bigint as taken
from r
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


@query("op9_warc_revisits", """
with b as (
  select page_id, url, md5(coalesce(html, '')) as digest, page_id * 7919 % 31536000 as t from pages),
c as (
  select *, '"' || substr(digest, 1, 16) || '"' as tag, substr(digest, 1, 1) in ('0', '1', '2') as changed, 't' || t as stamp,
    case when contains(url, '://') then
      regexp_replace(regexp_replace(lower(regexp_extract(url, '^.*?://([^/?#]*)', 1)),
        case lower(regexp_extract(url, '^(.*?)://', 1)) when 'http' then ':80$' when 'https' then ':443$' else '$^' end, ''), '^www\\.', '')
      || regexp_replace(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1), '/+$', '') end as place,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '^.*?://[^?#]*\\?([^#]*)', 1), '&'),
      lambda x: x <> '' and not starts_with(x, 'utm_'))), '&') as q
  from b),
k as (select *, place || case when q <> '' then '?' || q else '' end as key from c),
v as (
  select 'r' || page_id || '-1' as record_id, key, t + 86400 as ts, 1 as i, tag, stamp, changed from k
  union all select 'r' || page_id || '-2', key, t + 172800, 2, tag, stamp, changed from k),
r as (select 'r' || page_id || '-0' as rid, key as rkey, t as rts, tag as rtag, stamp as rstamp, digest from k),
best as (
  select v.record_id, max((r.rts, r.rid)) as top from v join r on r.rkey = v.key and r.rts < v.ts group by 1),
j as (
  select v.*, r.rid, r.rts, r.rtag, r.rstamp, r.digest,
    case when r.rid is null then 'no_earlier'
      when i = 1 or changed then case when (case when i = 1 then v.tag else '"changed"' end) = r.rtag then 'resolved' else 'mismatch' end
      when v.stamp = r.rstamp then 'resolved' else 'mismatch' end as status
  from v left join best using (record_id) left join r on r.rid = best.top[2])
select record_id, key as canonical_url, ts::bigint as ts, rid as response_id, coalesce(rts, -1)::bigint as response_ts, status,
  case when status <> 'resolved' then null
    when i = 1 then 'cache-control=max-age=3600;content-type=text/html;etag=W/' || v2.tag || ';last-modified=' || rstamp
    else 'cache-control=max-age=60;content-type=text/html;date=d2;etag=' || rtag || ';last-modified=' || v2.stamp end as headers,
  case when status = 'resolved' then digest end as payload_digest
from j v2
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisits.resolve(warc_revisits.crawl_records(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("headers", F.array_join(lines, ";")) \
        .withColumn("response_ts", F.coalesce("response_ts", F.lit(-1).cast("long")))


@query("op10_naive_bayes_langid")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(periodic_runs.with_periodic_tails(table(spark, sf_dir, "documents")))


@query("op12_suffix_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"))


@query("op13_spanning_tree_negatives", """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_dot_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.id as positive_id,
  (row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id))::int as rank,
  s.id as negative_id, p.score as positive_score, s.score as negative_score
from p join s using (anchor_id) where not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score
qualify row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id) <= 5
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hard_negatives.with_moved_labels(table(spark, sf_dir, "embeddings"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)
