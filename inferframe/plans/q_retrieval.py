"""Retrieval queries: JN1, WN1, AG1, AG2, RSP3, RSP4, JN2, JN9."""

from __future__ import annotations

from pyspark.sql import functions as F

from inferframe import refdata as R
from inferframe.operators import responses as RS
from inferframe.operators import retrieval as RT
from inferframe.operators import requests as RQ
from inferframe.operators.vector_index import VectorIndex
from inferframe.plans import answers as AN
from inferframe.plans.catalog import query
from inferframe.plans.fixtures import tbl

TOPK = 5
FIRST_STAGE_N = R.RERANK_DOCUMENTS
FINAL_K = 3


def knn(spark, sf, k=TOPK, **kw):
    emb = tbl(spark, sf, "embeddings")
    r = RT.topk_similar(emb, emb, k, query_id="vec_id", doc_id="vec_id", vector="embedding",
                        doc_cols=["label"], exclude_self=True, **kw)
    return r.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", "label")


@query("jn_topk", sql=f"""
WITH s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS doc_id, d.label,
         list_dot_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) AS score
  FROM embeddings q JOIN embeddings d ON q.vec_id <> d.vec_id)
SELECT query_id, rank, doc_id, label FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
WHERE rank <= {TOPK}""")
def jn_topk(spark, sf):
    """Every vector's 5 nearest neighbours (dot product), with the neighbour's label."""
    return knn(spark, sf)


@query("jn_topk_index")
def jn_topk_index(spark, sf):
    """The same search through the index: probes calibrated for a recall above 0.9, true scores."""
    emb = tbl(spark, sf, "embeddings")
    index = VectorIndex.build(emb, doc_id="vec_id", doc_cols=["label"])
    found = index.calibrate(emb, TOPK, query_id="vec_id", exclude_self=True)
    r = index.topk(emb, TOPK, probes=found["probes"], query_id="vec_id", exclude_self=True)
    return r.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", "label", "score")


def first_stage(spark, sf, n=FIRST_STAGE_N):
    """Benchmark items as queries against all documents, token-overlap score."""
    bench = tbl(spark, sf, "benchmark")
    docs = tbl(spark, sf, "documents")
    return RT.topk_overlap(bench, docs, n, query_id="item_id", query_text="text",
                           doc_id="doc_id", doc_text="text")


SQL_FIRST_STAGE = f"""
qt AS (SELECT item_id, text, list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}]+')) AS tok FROM benchmark),
dt AS (SELECT doc_id, text, list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}]+')) AS tok FROM documents),
sc AS (SELECT qt.item_id AS query_id, dt.doc_id, len(list_intersect(qt.tok, dt.tok)) AS overlap,
              qt.text AS qtext, dt.text AS dtext
       FROM qt, dt),
stage1 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, doc_id) AS rank
                 FROM sc WHERE overlap >= 1)
  WHERE rank <= {FIRST_STAGE_N})"""


@query("wn_rank", sql=f"""
WITH {SQL_FIRST_STAGE}
SELECT query_id, rank::BIGINT AS rank, doc_id, overlap::BIGINT AS overlap FROM stage1""")
def wn_rank(spark, sf):
    """First retrieval stage: top-10 documents per benchmark item by shared tokens."""
    r = first_stage(spark, sf)
    return r.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id",
                    F.col("score").cast("bigint").alias("overlap"))


def rerank_requests(spark, sf):
    return RT.rerank_requests(tbl(spark, sf, "benchmark"), tbl(spark, sf, "documents"), FIRST_STAGE_N) \
        .withColumn("query_id", F.col("request_id"))


def rerank_results(spark, sf):
    """Requests are written once (reliable checkpoint): the candidate lists are needed again to
    attach the answers, and must not be recomputed."""
    from inferframe.session import checkpoint_root
    checkpoint_root(spark)
    req = rerank_requests(spark, sf).select("query_id", "request_id", "query", "documents", "doc_ids") \
        .checkpoint(eager=True)
    return req.select("query_id", "doc_ids"), AN.rerank_answers(req, "query", "documents", broken="2")


@query("ag_rerank_pack", sql=f"""
WITH {SQL_FIRST_STAGE}
SELECT query_id, count(*)::BIGINT AS n_docs, string_agg(doc_id::VARCHAR, ',' ORDER BY rank) AS doc_ids
FROM stage1 GROUP BY query_id""")
def ag_rerank_pack(spark, sf):
    req = rerank_requests(spark, sf)
    return req.select("query_id", F.col("n_docs").cast("bigint").alias("n_docs"),
                      F.array_join("doc_ids", ",").alias("doc_ids"))


SQL_RERANK = """
rr AS (
  SELECT query_id, (rank - 1)::INTEGER AS idx, doc_id,
         ('0x' || substr(md5(qtext || chr(10) || dtext), 1, 8))::UBIGINT / 4294967296.0 AS relevance_score,
         substr(md5(qtext), 1, 1) AS fault
  FROM stage1)"""


@query("rsp_rerank", sql=f"""
WITH {SQL_FIRST_STAGE}, {SQL_RERANK}
SELECT query_id, idx, relevance_score, '' AS parse_error FROM rr WHERE fault NOT IN ('0', '1', '2')
UNION ALL
SELECT DISTINCT query_id, -1, NULL, 'malformed' FROM rr WHERE fault = '2'""")
def rsp_rerank(spark, sf):
    """Rerank answers exploded to (query, position, score); unreadable ones are reject rows."""
    _, resp = rerank_results(spark, sf)
    ex = RS.explode_rerank(resp)
    return ex.select(F.col("request_id").alias("query_id"), F.coalesce("idx", F.lit(-1)).alias("idx"),
                     "relevance_score", F.coalesce("parse_error", F.lit("")).alias("parse_error"))


def attached(spark, sf):
    req, resp = rerank_results(spark, sf)
    res = RS.explode_rerank(resp).filter(F.col("parse_error").isNull()).select(F.col("request_id").alias("query_id"), "idx",
                                         "relevance_score")
    cand = RT.candidates_with_idx(req)
    return RT.attach_rerank(cand, res)


@query("jn_rerank", sql=f"""
WITH {SQL_FIRST_STAGE}, {SQL_RERANK}
SELECT query_id, idx, doc_id, relevance_score FROM rr WHERE fault NOT IN ('0', '1', '2')""")
def jn_rerank(spark, sf):
    """Rerank positions joined back to the submitted candidate documents."""
    return attached(spark, sf).select("query_id", "idx", "doc_id", "relevance_score")


@query("jn_two_stage", sql=f"""
WITH {SQL_FIRST_STAGE}, {SQL_RERANK}
SELECT query_id, rank, doc_id FROM (
  SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY relevance_score DESC, doc_id)::BIGINT AS rank
  FROM rr WHERE fault NOT IN ('0', '1', '2'))
WHERE rank <= {FINAL_K}""")
def jn_two_stage(spark, sf):
    """Retrieve 10 by token overlap, rerank, keep the best 3 per query."""
    def answer(req):
        return AN.rerank_answers(req, "query", "documents", broken="2")
    r = RT.retrieve_then_rerank(tbl(spark, sf, "benchmark"), tbl(spark, sf, "documents"), answer,
                                first_n=FIRST_STAGE_N, k=FINAL_K)
    return r.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id")


@query("jn_two_stage_vectors", sql=f"""
WITH s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS doc_id, list_dot_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) AS score
  FROM embeddings q JOIN embeddings d ON q.vec_id <> d.vec_id WHERE q.vec_id IN (SELECT doc_id FROM documents)),
stage1 AS (
  SELECT query_id, rank, r.doc_id, a.text AS qtext, b.text AS dtext FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s) r
  JOIN documents a ON a.doc_id = query_id JOIN documents b ON b.doc_id = r.doc_id WHERE rank <= {FIRST_STAGE_N}),
{SQL_RERANK}
SELECT query_id, rank, doc_id FROM (
  SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY relevance_score DESC, doc_id)::BIGINT AS rank
  FROM rr WHERE fault NOT IN ('0', '1', '2'))
WHERE rank <= {FINAL_K}""")
def jn_two_stage_vectors(spark, sf):
    """First stage by vectors: each document's 10 nearest by embedding (of the same id), reranked by text, the best 3 kept."""
    emb, docs = tbl(spark, sf, "embeddings"), tbl(spark, sf, "documents")
    cand = RT.topk_similar(emb.join(docs.select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi"), emb, FIRST_STAGE_N,
                           query_id="vec_id", doc_id="vec_id", exclude_self=True)
    r = RT.retrieve_then_rerank(docs, docs, lambda req: AN.rerank_answers(req, "query", "documents", broken="2"),
                                first_n=FIRST_STAGE_N, k=FINAL_K, query_id="doc_id", candidates=cand)
    return r.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id")


@query("ag_embed_batches", sql=f"""
SELECT doc_id // {R.EMBED_BATCH_DOCUMENTS} AS batch_id, count(*)::BIGINT AS n_items,
       string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids,
       md5(string_agg(text, chr(31) ORDER BY doc_id)) AS texts_md5
FROM documents GROUP BY 1""")
def ag_embed_batches(spark, sf):
    """Documents packed 10 per embedding request, id order kept."""
    items = tbl(spark, sf, "documents").select(F.col("doc_id").alias("item_id"), "text")
    b = RT.pack_embedding_batches(items, R.EMBED_BATCH_DOCUMENTS)
    return b.select("batch_id", F.col("n_items").cast("bigint").alias("n_items"),
                    F.array_join("ids", ",").alias("ids"),
                    F.md5(F.array_join("texts", "\u001f")).alias("texts_md5"))


@query("rsp_embeddings", sql=f"""
WITH b AS (
  SELECT doc_id, text, doc_id // {R.EMBED_BATCH_DOCUMENTS} AS batch_id,
         (doc_id - min(doc_id) OVER (PARTITION BY doc_id // {R.EMBED_BATCH_DOCUMENTS}))::INTEGER AS pos,
         first(text ORDER BY doc_id) OVER (PARTITION BY doc_id // {R.EMBED_BATCH_DOCUMENTS}) AS first_text
  FROM documents)
SELECT doc_id AS item_id, pos,
       ('0x' || substr(md5(text), 1, 2))::INTEGER / 256.0 AS e0,
       ('0x' || substr(md5(text), 3, 2))::INTEGER / 256.0 AS e1,
       ('0x' || substr(md5(text), 5, 2))::INTEGER / 256.0 AS e2,
       ('0x' || substr(md5(text), 7, 2))::INTEGER / 256.0 AS e3
FROM b WHERE substr(md5(first_text), 1, 1) NOT IN ('0', '1')""")
def rsp_embeddings(spark, sf):
    """Embedding batches answered, vectors exploded back to one per document by index."""
    items = tbl(spark, sf, "documents").select(F.col("doc_id").alias("item_id"), "text")
    b = RT.pack_embedding_batches(items, R.EMBED_BATCH_DOCUMENTS)
    req = (b.withColumn("body", RQ.embedding_body(F.lit("embedder"), "texts"))
            .withColumn("sent", F.from_json(F.get_json_object("body", "$.input"), "array<string>")))
    ex = RS.explode_embeddings(AN.embedding_answers(req.withColumn("first", F.element_at("sent", 1)), "sent", "first"))
    e = F.col("embedding")
    return ex.select("item_id", "pos", *[e[i].cast("double").alias(f"e{i}") for i in range(4)])


@query("sc_cosine", sql="""
SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 6) AS dot,
       round(list_cosine_similarity(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 6) AS cosine
FROM embeddings""")
def sc_cosine(spark, sf):
    """Dot product and cosine of every vector with its reverse."""
    from inferframe.functions.scalars import cosine, dot
    e = tbl(spark, sf, "embeddings").withColumn("r", F.reverse("embedding"))
    return e.select("vec_id", F.round(dot("embedding", "r"), 6).alias("dot"),
                    F.round(cosine("embedding", "r"), 6).alias("cosine"))


@query("src_items", sql="SELECT doc_id AS item_id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark")
def src_items(spark, sf):
    """Item lists read with only the id and text columns (documents and benchmark)."""
    from inferframe.sources.readers import read_items
    d = read_items(spark, f"{sf}/documents.parquet", "doc_id", "text")
    b = read_items(spark, f"{sf}/benchmark.parquet", "item_id", "text")
    return d.unionByName(b)
