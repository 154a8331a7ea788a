"""Retrieval: JN1 top-k similarity join, JN2 attach rerank results, JN9 two-stage retrieval,
AG1/AG2 request packing, WN1 per-query ranking.

Top-k similarity never materialises (query, document) pairs as rows. Queries are hashed into
``nqb`` blocks and documents into ``ndb`` blocks, as many as keep a block of either side within
``BLOCK_BYTES`` (both numbers come from one count over each side). Where one block holds all
queries, it is broadcast and the documents stay where they are; otherwise nothing is pulled to the
driver and each (query block, document block) pair is one co-group. Either way blocks are scored with
numpy in tiles, the top k per query are held while they are, and only they leave a task, so every group is
bounded whatever the tables' sizes and however many scores are equal.
The result ends in a ``row_number() <= k`` window that Catalyst turns into a partial + final
WindowGroupLimit.

An exact search compares every query with every document; the blocks only spread that work.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inferframe.functions.scalars import token_set
from inferframe.operators.requests import rerank_body
from inferframe.operators.responses import explode_rerank
from inferframe.session import shared_dir

BLOCK_BYTES = 32 * 1024 * 1024
_TILE = 1024  # queries and documents scored at once inside a task: a tile of scores is 8 MB


# ----------------------------------------------------------------------------- kernels

class DotKernel:
    """Dense vectors -> dot product in float64."""

    def prepare_queries(self, qvals: list) -> np.ndarray:
        if not len(qvals):
            return np.zeros((0, 0))
        return np.stack([np.asarray(v, dtype=np.float64) for v in qvals])

    prepare_docs = prepare_queries

    def score(self, qprep: np.ndarray, dprep: np.ndarray) -> np.ndarray:
        return qprep @ dprep.T


class OverlapKernel:
    """Token-id sets -> size of the intersection (exact integer counts).

    Queries are held as an inverted index (sorted vocabulary -> CSR list of query
    positions); a document batch is scored by expanding its vocabulary hits into
    (query, document) increments and counting them with ``bincount``. Memory is linear in
    the hits, not in vocabulary x queries."""

    def prepare_queries(self, qvals: list):
        arrays = [np.unique(np.asarray(v, dtype=np.int64)) for v in qvals]
        if not arrays:
            return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), 0
        tok = np.concatenate(arrays)
        qpos = np.repeat(np.arange(len(arrays), dtype=np.int64), [len(a) for a in arrays])
        order = np.argsort(tok, kind="stable")
        tok, qpos = tok[order], qpos[order]
        vocab, starts, counts = np.unique(tok, return_index=True, return_counts=True)
        indptr = np.concatenate([starts, [len(tok)]]).astype(np.int64)
        return vocab, indptr, qpos, len(arrays)

    def prepare_docs(self, dvals: list):
        lens = np.fromiter((len(v) for v in dvals), dtype=np.int64, count=len(dvals))
        flat = (np.concatenate([np.asarray(v, dtype=np.int64) for v in dvals])
                if lens.sum() else np.zeros(0, np.int64))
        return lens, flat

    def score(self, qprep, dprep) -> np.ndarray:
        vocab, indptr, qpos, nq = qprep
        lens, flat = dprep
        n = len(lens)
        if len(vocab) == 0 or n == 0:
            return np.zeros((nq, n), dtype=np.float64)
        rows = np.repeat(np.arange(n, dtype=np.int64), lens)
        pos = np.minimum(np.searchsorted(vocab, flat), len(vocab) - 1)
        hit = vocab[pos] == flat
        hrows, hpos = rows[hit], pos[hit]
        cnt = indptr[hpos + 1] - indptr[hpos]
        total = int(cnt.sum())
        if total == 0:
            return np.zeros((nq, n), dtype=np.float64)
        first = np.repeat(indptr[hpos] - (np.cumsum(cnt) - cnt), cnt)
        qsel = qpos[first + np.arange(total, dtype=np.int64)]
        flat_idx = qsel * n + np.repeat(hrows, cnt)
        return np.bincount(flat_idx, minlength=n * nq).reshape(nq, n).astype(np.float64)


def _best(S: np.ndarray, k: int) -> np.ndarray:
    """Positions (ascending) of the ``k`` largest numbers of each row of ``S``; of equal ones the first."""
    kth = np.partition(S, S.shape[1] - k, axis=1)[:, S.shape[1] - k, None]
    keep, tied = S > kth, S == kth
    left = k - keep.sum(1)
    many = tied.sum(1) > left
    tied[many] &= np.cumsum(tied[many], axis=1, dtype=np.int32) <= left[many, None]
    return np.nonzero(keep | tied)[1].reshape(len(S), k)


class _TopK:
    """The k best documents of each query of one block, fed with tiles of documents in the order of their ids: of equal
    scores the earlier document stays, so what is held is k scores and positions a query, whatever is fed."""

    def __init__(self, kernel, q_ids: np.ndarray, values: list, k: int):
        self.kernel, self.ids, self.k = kernel, q_ids, k
        self.preps = [kernel.prepare_queries(values[s:s + _TILE]) for s in range(0, len(q_ids), _TILE)]
        self.score = np.full((len(q_ids), k), -np.inf)
        self.place = np.full((len(q_ids), k), -1, dtype=np.int64)

    def feed(self, values: list, d_ids: np.ndarray, first: int, exclude_self: bool, min_score) -> None:
        """Score one tile of documents; ``first`` is the place of its first one."""
        docs = self.kernel.prepare_docs(values)
        for i, prep in enumerate(self.preps):
            at = slice(i * _TILE, min((i + 1) * _TILE, len(self.ids)))
            S = self.kernel.score(prep, docs)
            if exclude_self:
                own = np.flatnonzero(np.isin(self.ids[at], d_ids))
                S[own] = np.where(self.ids[at][own, None] == d_ids, -np.inf, S[own])
            top = S.max(1)
            if not np.isfinite(top).all():
                S[~np.isfinite(S)] = -np.inf
                top = S.max(1)
            # the others keep what they have
            better = np.flatnonzero((top > self.score[at].min(1)) & (min_score is None or top >= min_score))
            if not len(better):
                continue
            q = better + at.start
            scores = np.hstack([self.score[q], S[better] if min_score is None else np.where(S[better] >= min_score, S[better], -np.inf)])
            best = _best(scores, self.k)
            places = np.take_along_axis(self.place[q], np.minimum(best, self.k - 1), 1)
            self.score[q] = np.take_along_axis(scores, best, 1)
            self.place[q] = np.where(best < self.k, places, first + best - self.k)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, place of the document, score) of what is held."""
        held = np.isfinite(self.score) & ~np.isnan(self.ids)[:, None]
        return np.nonzero(held)[0], self.place[held], self.score[held]


def _score_batches(q_ids: np.ndarray, q_values: list, kernel, dpdf: pd.DataFrame, k: int, vec_col: str, extra_cols: list[str],
                   exclude_self: bool, min_score) -> pd.DataFrame:
    """Each query's k best rows of ``dpdf`` (ties by ``doc_id``), scored tile by tile."""
    best = _TopK(kernel, q_ids, q_values, k)
    dpdf = dpdf.sort_values("doc_id", kind="stable", ignore_index=True)
    d_ids, values = dpdf["doc_id"].to_numpy(), dpdf[vec_col].to_numpy()
    for s in range(0, len(dpdf), _TILE):
        best.feed(list(values[s:s + _TILE]), d_ids[s:s + _TILE], s, exclude_self, min_score)
    query, place, score = best.found()
    out = pd.DataFrame({"query_id": q_ids[query], "doc_id": d_ids[place], "score": score})
    for col in extra_cols:
        out[col] = dpdf[col].to_numpy()[place]
    return out


def _out_schema(docs: DataFrame, extra_cols: list[str]) -> T.StructType:
    fields = [T.StructField("query_id", T.LongType()), T.StructField("doc_id", T.LongType()),
              T.StructField("score", T.DoubleType())]
    for c in extra_cols:
        fields.append(T.StructField(c, docs.schema[c].dataType))
    return T.StructType(fields)


def _empty(schema: T.StructType) -> pd.DataFrame:
    return pd.DataFrame({f.name: pd.Series(dtype="object") for f in schema.fields})


def _conform(pdf: pd.DataFrame, schema: T.StructType) -> pd.DataFrame:
    if pdf.empty:
        return _empty(schema)
    return pdf[[f.name for f in schema.fields]]


def _blocks(rows: DataFrame, val: str, least: int, block_bytes: int) -> int:
    """Number of blocks that keep a block of ``rows`` within ``block_bytes`` (8 bytes a number)."""
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.size(val).cast("bigint")), F.lit(0))).first()
    return max(1, math.ceil(8 * size / block_bytes), min(least, math.ceil(n / 1000)))


def similarity_topk(queries: DataFrame, docs: DataFrame, k: int, kernel, *,
                    query_id: str, doc_id: str, q_val: str, d_val: str,
                    doc_cols: list[str] | tuple = (), exclude_self: bool = False,
                    min_score: float | None = None, block_bytes: int = BLOCK_BYTES,
                    query_blocks: int | None = None, doc_blocks: int | None = None) -> DataFrame:
    """Generic exact top-k over a scoring kernel; see the module docstring for the plan. Rows
    with a NULL value are left out."""
    spark = docs.sparkSession
    extra = list(doc_cols)
    q = queries.select(F.col(query_id).cast("bigint").alias("query_id"),
                       F.col(q_val).alias("qv")).filter("qv is not null")
    d = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"),
                    F.col(d_val).alias("dv"), *extra).filter("dv is not null")
    schema = _out_schema(d, extra)
    nqb = query_blocks or _blocks(q, "qv", 1, block_bytes)
    if nqb == 1 and doc_blocks is None:
        cand = _against_all_queries(q, d, k, kernel, schema, extra, exclude_self, min_score)
        return rank_within_query(cand, k, query_col="query_id", score_col="score", tie_col="doc_id")
    ndb = doc_blocks or _blocks(d, "dv", spark.sparkContext.defaultParallelism, block_bytes)
    qrows = q.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(nqb)).cast("int")) \
        .withColumn("db", F.explode(F.sequence(F.lit(0), F.lit(ndb - 1))))
    drows = d.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nqb - 1)))) \
        .withColumn("db", F.pmod(F.xxhash64("doc_id"), F.lit(ndb)).cast("int"))

    def run_group(qs: pd.DataFrame, ds: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or ds.empty:
            return _empty(schema)
        ids = qs["query_id"].to_numpy(dtype=np.int64)
        return _conform(_score_batches(ids, list(qs["qv"]), kernel, ds, k, "dv", extra, exclude_self, min_score), schema)

    cand = qrows.groupBy("qb", "db").cogroup(drows.groupBy("qb", "db")).applyInPandas(run_group, schema)
    return rank_within_query(cand, k, query_col="query_id", score_col="score",
                             tie_col="doc_id")


def _against_all_queries(q: DataFrame, d: DataFrame, k: int, kernel, schema: T.StructType, extra: list[str], exclude_self: bool,
                         min_score) -> DataFrame:
    """Top-k candidates where all queries are one block: its values, counted to be within ``block_bytes``, are broadcast and each task scores
    its own documents, which stay where they are."""
    rows = q.toArrow()
    shared = q.sparkSession.sparkContext.broadcast((rows["query_id"].to_numpy(), rows["qv"].to_pylist()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, values = shared.value
        for pdf in batches:
            if len(ids) and len(pdf):
                found = _score_batches(ids, values, kernel, pdf, k, "dv", extra, exclude_self, min_score)
                if len(found):
                    yield _conform(found, schema)

    return d.mapInPandas(run, schema)


def usable_vectors(df: DataFrame, vector: str, dim: int) -> DataFrame:
    """Rows whose vector has ``dim`` numbers, none of them NULL; the others can't be scored."""
    v = F.col(vector)
    return df.filter(v.isNotNull() & (F.size(v) == dim) & ~F.exists(v, lambda x: x.isNull()))


def topk_similar(queries: DataFrame, docs: DataFrame, k: int, *, query_id: str = "query_id",
                 doc_id: str = "doc_id", vector: str = "embedding", doc_vector: str | None = None, doc_cols=(),
                 dim: int | None = None, exclude_self: bool = False, **kw) -> DataFrame:
    """JN1: for every query vector, the k documents with the highest dot product
    (cosine for unit vectors), ties broken by ``doc_id``. Columns:
    ``query_id, doc_id, score, <doc_cols>, rank``. NULL vectors and vectors of another length
    than ``dim`` (by default the most frequent one) take no part. ``doc_vector``: the documents' column, if named
    otherwise."""
    doc_vector = doc_vector or vector
    if dim is None:
        dim = docs.filter(F.col(doc_vector).isNotNull()).agg(F.mode(F.size(doc_vector))).first()[0] or 0
    return similarity_topk(usable_vectors(queries, vector, dim), usable_vectors(docs, doc_vector, dim), k, DotKernel(),
                           query_id=query_id, doc_id=doc_id, q_val=vector, d_val=doc_vector,
                           doc_cols=doc_cols, exclude_self=exclude_self, **kw)


def token_ids(text_col) -> F.Column:
    """Distinct token ids (xxhash64 of lower-case words of any script) — computed JVM-side."""
    return F.transform(token_set(text_col), lambda t: F.xxhash64(t))


def topk_overlap(queries: DataFrame, docs: DataFrame, n: int, *, query_id: str = "item_id",
                 query_text: str = "text", doc_id: str = "doc_id", doc_text: str = "text",
                 doc_cols=(), **kw) -> DataFrame:
    """First retrieval stage for text: the n documents sharing the most distinct tokens with
    each query (only documents sharing at least one token), ties by ``doc_id``."""
    q = queries.select(F.col(query_id).alias("query_id"), token_ids(query_text).alias("tok"))
    d = docs.select(F.col(doc_id).alias("doc_id"), token_ids(doc_text).alias("tok"), *doc_cols)
    return similarity_topk(q, d, n, OverlapKernel(), query_id="query_id", doc_id="doc_id",
                           q_val="tok", d_val="tok", doc_cols=list(doc_cols), min_score=1.0, **kw)


def rank_within_query(df: DataFrame, k: int, *, query_col: str = "query_id",
                      score_col: str = "score", tie_col: str = "doc_id",
                      rank_col: str = "rank") -> DataFrame:
    """WN1: ``row_number() over (partition by query order by score desc, tie)`` kept <= k.
    The predicate sits directly on the window so Catalyst plans a WindowGroupLimit."""
    w = Window.partitionBy(query_col).orderBy(F.col(score_col).desc(), F.col(tie_col).asc())
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) <= k))


# ----------------------------------------------------------------------- packing (AG1/AG2)

def pack_embedding_batches(items: DataFrame, n: int, *, id_col: str = "item_id",
                           text_col: str = "text", dense_ids: bool = True,
                           buckets: int | None = None) -> DataFrame:
    """AG1: pack items into requests of at most ``n`` texts, order kept by id.

    With dense ids the batch id is ``id div n`` (no window at all). Otherwise ids are
    hashed into ``buckets`` and numbered with ``row_number`` *within* each bucket, so no
    single task sees the whole table. Output: ``batch_id, ids array<bigint>,
    texts array<string>, n_items``."""
    if dense_ids:
        keyed = items.withColumn("batch_id", F.floor(F.col(id_col) / F.lit(n)).cast("bigint"))
    else:
        nb = buckets or int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        bucket = F.pmod(F.xxhash64(id_col), F.lit(nb))
        w = Window.partitionBy("_bucket").orderBy(id_col)
        keyed = (items.withColumn("_bucket", bucket)
                 .withColumn("_rn", F.row_number().over(w) - 1)
                 .withColumn("batch_id", (F.col("_bucket") * F.lit(1 << 40)
                                          + F.floor(F.col("_rn") / F.lit(n))).cast("bigint")))
    packed = (keyed.groupBy("batch_id")
              .agg(F.sort_array(F.collect_list(F.struct(F.col(id_col).alias("id"),
                                                        F.col(text_col).alias("text"))))
                   .alias("items")))
    return packed.select("batch_id", F.col("items.id").alias("ids"),
                         F.col("items.text").alias("texts"),
                         F.size("items").alias("n_items"))


def pack_rerank_request(candidates: DataFrame, *, query_col: str = "query_id",
                        order_col: str = "rank", doc_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """AG2: one rerank request per query: the candidate list in rank order; ``idx`` is the
    0-based array position that the service answers with. Candidate lists are bounded by
    the first stage's n, so each group is bounded."""
    packed = (candidates.groupBy(query_col)
              .agg(F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                                        F.col(doc_col).alias("doc_id"),
                                                        F.col(text_col).alias("text"))))
                   .alias("c")))
    return packed.select(query_col, F.col("c.doc_id").alias("doc_ids"),
                         F.col("c.text").alias("documents"), F.size("c").alias("n_docs"))


def candidates_with_idx(packed: DataFrame, *, query_col: str = "query_id") -> DataFrame:
    """Unpack a rerank request back to ``(query_id, idx, doc_id)`` rows."""
    return packed.select(query_col, F.posexplode("doc_ids").alias("idx", "doc_id"))


def attach_rerank(candidates: DataFrame, results: DataFrame, *,
                  keys=("query_id", "idx")) -> DataFrame:
    """JN2: equi join of reranker results (positions) to the submitted candidates."""
    return candidates.join(results, list(keys), "inner")


def retrieve_then_rerank(queries: DataFrame, docs: DataFrame, answer: Callable[[DataFrame], DataFrame], *,
                         first_n: int, k: int, model: str = "reranker", query_id: str = "item_id",
                         query_text: str = "text", doc_id: str = "doc_id", doc_text: str = "text",
                         candidates: DataFrame | None = None) -> DataFrame:
    """JN9: the ``first_n`` documents of the first stage are sent for reranking, the best ``k`` of the
    answer stay: ``query_id, rank, doc_id, relevance_score``. The first stage is the overlap of tokens, or ``candidates``
    (query_id, doc_id, rank) as ``topk_similar`` or ``VectorIndex.topk`` give them. ``answer`` takes the requests
    (request_id, kind, body, query, documents, doc_ids) and returns responses with the same
    request_id, e.g. by ``invoke``. Requests are stored in the shared folder before they are sent: answers refer to
    positions in the list that was sent, so the first stage must not run again."""
    spark = queries.sparkSession
    path = shared_dir(spark, "rerank-requests")
    rerank_requests(queries, docs, first_n, model=model, query_id=query_id, query_text=query_text,
                    doc_id=doc_id, doc_text=doc_text, candidates=candidates).write.parquet(path)
    req = spark.read.parquet(path)
    results = explode_rerank(answer(req)).filter(F.col("parse_error").isNull()) \
        .select(F.col("request_id").alias("query_id"), "idx", "relevance_score")
    cand = candidates_with_idx(req.select(F.col("request_id").alias("query_id"), "doc_ids"))
    return rank_within_query(attach_rerank(cand, results), k, query_col="query_id",
                             score_col="relevance_score", tie_col="doc_id")


def rerank_requests(queries: DataFrame, docs: DataFrame, first_n: int, *, model: str = "reranker",
                    query_id: str = "item_id", query_text: str = "text", doc_id: str = "doc_id",
                    doc_text: str = "text", candidates: DataFrame | None = None) -> DataFrame:
    """First stage + AG2: one rerank request per query: request_id, kind, body, query, documents,
    doc_ids, n_docs. ``candidates``: see ``retrieve_then_rerank``."""
    if candidates is None:
        cand = topk_overlap(queries, docs, first_n, query_id=query_id, query_text=query_text,
                            doc_id=doc_id, doc_text=doc_text)
    else:
        cand = candidates.filter(F.col("rank") <= first_n).select("query_id", "doc_id", "rank")
    text = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(doc_text).alias("text"))
    packed = pack_rerank_request(cand.join(text, "doc_id"), query_col="query_id", order_col="rank")
    q = queries.select(F.col(query_id).cast("bigint").alias("query_id"), F.col(query_text).alias("query"))
    return (packed.join(q, "query_id").withColumn("body", rerank_body(F.lit(model), "query", "documents"))
            .withColumn("request_id", F.col("query_id")).withColumn("kind", F.lit("rerank")))
