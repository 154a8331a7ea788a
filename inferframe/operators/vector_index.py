"""JN1's recall stage: an inverted file over vectors, so that a query meets a part of the documents only.

``VectorIndex.build`` fits cell centres (spherical k-means, at most ``MAX_CELLS``) on a bounded sample of
the documents, puts *every* document into its nearest cell and stores that table once in the shared folder.
``topk`` sends a query to its ``probes`` nearest cells and scores it exactly against their documents;
what it returns are true scores, only documents of other cells may be missing. ``calibrate`` measures recall
against the exact search for a bounded sample of queries and picks the smallest number of probes that reaches
the target, so the work follows from the data: few cells for clustered vectors, about half of them for
directions without any structure.

Groups are bounded: documents of a large cell are split into sub-blocks and the queries that probe a cell into
query blocks, both dealt by hash and as many as the counts per cell ask for, so a cell that holds a
third of the documents is many tasks. Only the k best of a query leave a group. Broadcast: the centres
(``MAX_CELLS`` rows) and one count per cell.

Left out, as in the exact search: null vectors, vectors of another length, vectors with null components. Zero vectors fall
into the first cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inferframe.operators import retrieval as RT
from inferframe.session import shared_dir

MAX_CELLS = 4096
TRAIN_ROWS = 20_000
TRAIN_BYTES = 64 * 1024 * 1024
TRAIN_ROUNDS = 12
SAMPLE_QUERIES = 256
SCORES = 1 << 20  # of vectors against centres, held at once


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def fit_centres(sample: np.ndarray, cells: int, rounds: int = TRAIN_ROUNDS, seed: int = 7) -> np.ndarray:
    """Spherical k-means: unit centres of the sample's directions. Cells that run empty start again at the
    vectors worst served by their centre."""
    x = _unit(np.asarray(sample, np.float64))
    rng = np.random.default_rng(seed)
    centre = x[rng.permutation(len(x))[:cells]].copy()
    for _ in range(rounds):
        served, own = _served(x, centre)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        empty = np.flatnonzero(np.bincount(own, minlength=len(centre)) == 0)
        total[empty] = x[np.argsort(served)[:len(empty)]]
        centre = _unit(total)
    return centre


def _served(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score, cell) of each vector's nearest centre, a bounded number of scores at a time."""
    best = []
    for s in range(0, len(x), step := max(1, SCORES // len(centre))):
        score = x[s:s + step] @ centre.T
        best.append((score.max(1), score.argmax(1)))
    return np.concatenate([b[0] for b in best]), np.concatenate([b[1] for b in best])


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)


def _nearest_cells(df: DataFrame, vector: str, centre: np.ndarray, n: int) -> DataFrame:
    """``df`` with ``cells array<int>``: the n nearest cells of each vector, nearest first."""
    shared = df.sparkSession.sparkContext.broadcast(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            for s in range(0, batch.num_rows, step := max(1, SCORES // len(c))):
                part = batch.slice(s, step)
                score = _unit(_vectors(part.column(vector), c.shape[1])) @ c.T
                best = np.argsort(-score, axis=1, kind="stable")[:, :n] if n > 1 else score.argmax(1)[:, None]
                cells = pa.ListArray.from_arrays(np.arange(0, best.size + 1, best.shape[1], dtype=np.int32), best.reshape(-1).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*part.columns, cells], [*part.schema.names, "cells"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))]))


@dataclass(frozen=True)
class VectorIndex:
    """A stored index: ``docs`` (doc_id, dv, cell, <doc_cols>), the centres and the documents per cell."""
    docs: DataFrame
    centre: np.ndarray
    size: tuple[int, ...]
    doc_cols: tuple[str, ...]

    @classmethod
    def build(cls, docs: DataFrame, *, doc_id: str = "doc_id", vector: str = "embedding", doc_cols=(), dim: int | None = None,
              cells: int | None = None, train_rows: int = TRAIN_ROWS, path: str | None = None) -> VectorIndex:
        """Index every usable vector of ``docs``. ``cells``: by default the square root of their number, at most ``MAX_CELLS``.
        ``path``: where the table goes (default: a new folder under the shared one)."""
        spark = docs.sparkSession
        if dim is None:
            dim = docs.filter(F.col(vector).isNotNull()).agg(F.mode(F.size(vector))).first()[0] or 0
        rows = RT.usable_vectors(docs, vector, dim).select(
            F.col(doc_id).cast("bigint").alias("doc_id"), F.col(vector).cast("array<double>").alias("dv"), *doc_cols)
        n = rows.count()
        most = min(cells or max(1, round(math.sqrt(n))), MAX_CELLS)
        taken = min(train_rows, max(most, TRAIN_BYTES // (8 * max(dim, 1))))
        sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(taken).select("dv").collect()
        centre = fit_centres(np.array([r.dv for r in sample]).reshape(-1, dim), most) if dim else np.zeros((0, 0))
        if not len(centre):
            rows, centre = rows.limit(0), np.zeros((1, max(dim, 1)))
        placed = _nearest_cells(rows, "dv", centre, 1)
        path = path or shared_dir(spark, "vector-index")
        placed.withColumn("cell", F.col("cells")[0]).drop("cells").write.parquet(path)
        stored = spark.read.parquet(path)
        size = [0] * len(centre)
        for r in stored.groupBy("cell").count().collect():  # at most MAX_CELLS rows
            size[r["cell"]] = r["count"]
        return cls(stored, centre, tuple(size), tuple(doc_cols))

    def probed(self, queries: DataFrame, n: int, *, query_id: str, vector: str) -> DataFrame:
        """(query_id, qv, cells): each usable query and its n nearest cells."""
        q = RT.usable_vectors(queries, vector, self.centre.shape[1]).select(
            F.col(query_id).cast("bigint").alias("query_id"), F.col(vector).cast("array<double>").alias("qv"))
        return _nearest_cells(q, "qv", self.centre, n)

    def calibrate(self, queries: DataFrame, k: int, *, target: float = 0.93, query_id: str = "query_id", vector: str = "embedding",
                  sample: int = SAMPLE_QUERIES, exclude_self: bool = False) -> dict:
        """Exact top k of at most ``sample`` queries (by hash of their id), and how many probes find which share of it: the
        smallest number of ``probes`` whose ``recall`` is at least ``target``, and the ``work`` they
        take as a share of all (query, document) pairs."""
        some = queries.orderBy(F.xxhash64(query_id), query_id).limit(sample).select(query_id, vector)
        exact = RT.topk_similar(some, self.docs, k, query_id=query_id, doc_id="doc_id", vector=vector, doc_vector="dv",
                                dim=self.centre.shape[1], doc_cols=["cell"], exclude_self=exclude_self)
        order = self.probed(some, len(self.centre), query_id=query_id, vector=vector).drop("qv")
        place = exact.join(order, "query_id").select(F.array_position("cells", F.col("cell")).alias("place"))
        at = {r["place"]: r["count"] for r in place.groupBy("place").count().collect()}
        total, seen, probes = sum(at.values()), 0, len(self.centre)
        for p in range(1, len(self.centre) + 1):
            seen += at.get(p, 0)
            if seen >= target * total:
                probes = p
                break
        sizes = F.transform(F.slice("cells", 1, probes), lambda c: F.element_at(F.lit(list(self.size)), c + 1))
        read = order.agg(F.avg(F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
        return {"probes": probes, "recall": seen / total if total else 1.0, "work": read / max(1, sum(self.size))}

    def topk(self, queries: DataFrame, k: int, *, probes: int, query_id: str = "query_id", vector: str = "embedding",
             exclude_self: bool = False, block_bytes: int = RT.BLOCK_BYTES) -> DataFrame:
        """``query_id, doc_id, score, <doc_cols>, rank``: for every query vector the k best documents (dot product, ties by
        ``doc_id``) of its ``probes`` nearest cells."""
        spark, extra = self.docs.sparkSession, list(self.doc_cols)
        schema = RT._out_schema(self.docs, extra)
        per_group = max(1, block_bytes // (8 * self.centre.shape[1]))
        sent = self.probed(queries, min(probes, len(self.centre)), query_id=query_id, vector=vector) \
            .select("query_id", "qv", F.explode("cells").alias("cell"))
        asked = sent.groupBy("cell").agg(F.ceil(F.count("*") / per_group).cast("int").alias("query_blocks"))
        held = spark.createDataFrame([(c, max(1, -(-n // per_group))) for c, n in enumerate(self.size)], "cell int, doc_blocks int")
        blocks = asked.join(held, "cell")  # a row per cell, at most MAX_CELLS

        def deal(rows: DataFrame, own: str, key: str, other: str) -> DataFrame:
            mine, all_of = F.col(f"{own}_blocks"), F.col(f"{other}_blocks")
            return rows.join(F.broadcast(blocks), "cell").withColumn(f"{own}_block", F.pmod(F.xxhash64(key), mine).cast("int")) \
                .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), all_of - 1))).drop("query_blocks", "doc_blocks")

        key = ["cell", "query_block", "doc_block"]

        def run_group(qs: pd.DataFrame, ds: pd.DataFrame) -> pd.DataFrame:
            if qs.empty or ds.empty:
                return RT._empty(schema)
            return RT._conform(RT._score_batches(qs["query_id"].to_numpy(dtype=np.int64), list(qs["qv"]), RT.DotKernel(),
                                                 ds, k, "dv", extra, exclude_self, None), schema)

        found = deal(sent, "query", "query_id", "doc").groupBy(*key).cogroup(
            deal(self.docs, "doc", "doc_id", "query").groupBy(*key)).applyInPandas(run_group, schema)
        return RT.rank_within_query(found, k)


def recall_at_k(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact (query_id, doc_id) rows that were found."""
    total, hits = exact.select("query_id", "doc_id").join(
        found.select("query_id", "doc_id", F.lit(1).alias("hit")), ["query_id", "doc_id"], "left").agg(F.count("*"), F.count("hit")).first()
    return hits / total if total else 1.0
