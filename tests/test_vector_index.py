"""JN1's recall stage: measured recall, bounded groups, exactness with all probes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from inferframe.operators import retrieval as RT
from inferframe.operators.vector_index import VectorIndex, fit_centres, recall_at_k
from inferframe.plans import q_retrieval as Q
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(20, 16))
    x = np.repeat(centre, 60, 0) + 0.2 * rng.normal(size=(1200, 16))
    x[:400] = x[0]  # one vector is a third of all
    x = np.round(50 * x / np.linalg.norm(x, axis=1, keepdims=True))  # whole numbers: scores don't depend on the order of a sum
    return spark.createDataFrame([(i, v.tolist(), int(i % 3)) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int") \
        .repartition(4)


def test_recall_of_the_query(spark):
    found = Q.jn_topk_index(spark, SF_SMALL)
    assert recall_at_k(found, Q.knn(spark, SF_SMALL)) >= 0.9
    rows = found.groupBy("query_id").agg(F.count("*").alias("n"), F.max("rank").alias("r")).collect()
    assert len(rows) == 500 and all(r.n == r.r == 5 for r in rows)


def test_clustered_vectors_take_few_probes(spark, clustered):
    index = VectorIndex.build(clustered, doc_id="vec_id")
    got = index.calibrate(clustered, 5, query_id="vec_id", exclude_self=True)
    assert got["recall"] >= 0.93 and got["work"] < 0.5 and sum(index.size) == 1200
    exact = RT.topk_similar(clustered, clustered, 5, query_id="vec_id", doc_id="vec_id", exclude_self=True)
    found = index.topk(clustered, 5, probes=got["probes"], query_id="vec_id", exclude_self=True)
    assert recall_at_k(found, exact) >= 0.9


def test_all_probes_and_split_cells_equal_the_exact_search(spark, clustered):
    index = VectorIndex.build(clustered, doc_id="vec_id", doc_cols=["label"], cells=6)
    cols = ["query_id", "rank", "doc_id", "label"]
    exact = RT.topk_similar(clustered, clustered, 3, query_id="vec_id", doc_id="vec_id", doc_cols=["label"], exclude_self=True)
    want = sorted(exact.select(cols).collect())
    for block_bytes in (RT.BLOCK_BYTES, 8 * 16 * 50):  # a block holds 50 vectors: the large cell is 8 blocks or more
        found = index.topk(clustered, 3, probes=6, query_id="vec_id", exclude_self=True, block_bytes=block_bytes)
        assert sorted(found.select(cols).collect()) == want


def test_unusable_vectors_and_empty_tables(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [None, 1.0]), (5, [0.0, 0.0]), (6, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = VectorIndex.build(df, doc_id="vec_id", dim=2)
    assert sorted(r.doc_id for r in index.docs.collect()) == [1, 5, 6]
    got = index.topk(df, 1, probes=2, query_id="vec_id").collect()
    assert {r.query_id for r in got} == {1, 5, 6}
    none = VectorIndex.build(df.limit(0), doc_id="vec_id")
    assert none.topk(df.limit(0), 1, probes=1, query_id="vec_id").collect() == []
    assert none.calibrate(df.limit(0), 1, query_id="vec_id")["recall"] == 1.0


def test_empty_cells_start_again():
    x = np.vstack([np.tile([1.0, 0.0], (50, 1)), [[0.0, 1.0]], [[-1.0, 0.0]]])
    centre = fit_centres(x, 3)
    assert sorted(np.round(centre @ np.array([[1, 0], [0, 1], [-1, 0]]).T, 6).argmax(0).tolist()) == [0, 1, 2]


def test_vector_stage_feeds_the_reranker_once(spark):
    """The requests are stored, so an answer computed from them can't meet another candidate list."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id long, text string")
    cand = spark.createDataFrame([(0, 3, 1), (0, 4, 2), (0, 5, 3), (1, 2, 1)], "query_id long, doc_id long, rank int")
    plans = []

    def answer(req):
        plans.append(req._jdf.queryExecution().optimizedPlan().toString())
        body = F.to_json(F.struct(F.transform(F.sequence(F.lit(0), F.size("doc_ids") - 1), lambda i: F.struct(
            i.alias("index"), (i * 0.1).alias("relevance_score"))).alias("results")))
        return req.select("request_id", F.lit(200).alias("status_code"), body.alias("body"))

    got = RT.retrieve_then_rerank(docs, docs, answer, first_n=2, k=1, query_id="doc_id", candidates=cand)
    assert sorted((r.query_id, r.doc_id) for r in got.collect()) == [(0, 4), (1, 2)]
    assert "Join" not in plans[0] and "Relation" in plans[0]


def test_a_block_holds_k_rows_a_query_whatever_is_scored(spark):
    """Every query ties with every copy of one vector, and many queries meet few documents at a time."""
    import tracemalloc

    ids, values = np.arange(3000), [np.array([3.0, 4.0])] * 3000
    docs = pd.DataFrame({"doc_id": ids[::-1], "dv": values, "label": ids[::-1] % 7})
    tracemalloc.start()
    got = RT._score_batches(ids, values, RT.DotKernel(), docs, 2, "dv", ["label"], True, None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6  # 9 million pairs held at once are 200 MB and more
    want = [(q, d) for q in range(3000) for d in ([0, 1, 2] if q < 3 else [0, 1]) if d != q][:6000]
    assert sorted(zip(got.query_id, got.doc_id)) == want and (got.label == got.doc_id % 7).all() and (got.score == 25).all()


@pytest.mark.parametrize("seed", range(4))
def test_tiles_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    nd, nq, k = int(rng.integers(1, 2500)), int(rng.integers(1, 1200)), int(rng.integers(1, 7))
    x, q, ids = rng.integers(-2, 3, (nd, 3)).astype(float), rng.integers(-2, 3, (nq, 3)).astype(float), rng.permutation(nd)
    least = None if seed % 2 else 2.0
    got = RT._score_batches(np.arange(nq), list(q), RT.DotKernel(), pd.DataFrame({"doc_id": ids, "dv": list(x)}), k, "dv", [], True, least)
    rows = {i: sorted(zip(-g.score, g.doc_id)) for i, g in got.groupby("query_id")}
    score = x @ q.T
    for i in range(nq):
        some = [(-s, d) for s, d in zip(score[:, i], ids) if d != i and (least is None or s >= least)]
        assert rows.get(i, []) == sorted(some)[:k]
