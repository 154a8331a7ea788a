"""Hot-key paths equal their simple forms: two-level ordered concat, bucketed change
ordinal, and the block path of the top-k join."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from inferframe.operators.ordered import change_ordinal, ordered_concat
from inferframe.operators.retrieval import topk_overlap, topk_similar
from tests.conftest import SF_SMALL


def test_ordered_concat_small_buckets(spark):
    rnd = random.Random(7)
    rows = []
    for key in range(5):
        n = 1 if key == 0 else rnd.randint(50, 400)
        for s in rnd.sample(range(n * 3), n):
            rows.append((key, s, None if s % 11 == 0 else f"<{s}>"))
    df = spark.createDataFrame(rows, "k int, s long, v string")
    got = {r["k"]: r["t"] for r in ordered_concat(df, ["k"], "s", "v", "|", out="t",
                                                  bucket_size=7).collect()}
    want = {}
    for k in set(r[0] for r in rows):
        vals = [v for _, s, v in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]) if v]
        want[k] = "|".join(vals)
    assert got == want


def test_change_ordinal_interleaved(spark):
    # index sequence 0,0,1,0 gives calls 1,1,2,3 ; spread over many tiny buckets
    seq = [0, 0, 1, 0, 0, 2, 2, 2, 1, 1, None, None, 3]
    rows = [(1, i, v) for i, v in enumerate(seq)] + [(2, i * 5, i // 3) for i in range(40)]
    df = spark.createDataFrame(rows, "r int, s long, v int")
    got = {(x["r"], x["s"]): x["o"] for x in change_ordinal(df, "r", "s", "v", out="o",
                                                           bucket_size=2).collect()}
    w = Window.partitionBy("r").orderBy("s")
    ref = df.withColumn("chg", F.when(~F.col("v").eqNullSafe(F.lag("v").over(w)), 1).otherwise(0)) \
        .withColumn("o", F.sum("chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    want = {(x["r"], x["s"]): x["o"] for x in ref.collect()}
    assert got == want
    assert [got[(1, i)] for i in range(4)] == [1, 1, 2, 3]


def test_topk_block_path_equals_broadcast(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    kw = dict(query_id="vec_id", doc_id="vec_id", vector="embedding", doc_cols=["label"],
              exclude_self=True)
    a = topk_similar(emb, emb, 4, query_blocks=1, doc_blocks=1, **kw)
    b = topk_similar(emb, emb, 4, query_blocks=3, doc_blocks=5, **kw)
    cols = ["query_id", "rank", "doc_id", "label"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())
    # blocks follow the byte bound
    c = topk_similar(emb, emb, 4, block_bytes=20_000, **kw)
    assert sorted(c.select(cols).collect()) == sorted(a.select(cols).collect())


def test_overlap_block_path_equals_broadcast(spark):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    a = topk_overlap(bench, docs, 5, query_blocks=1, doc_blocks=1)
    b = topk_overlap(bench, docs, 5, query_blocks=4, doc_blocks=3)
    cols = ["query_id", "rank", "doc_id", "score"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())


def test_history_prefix_halo_buckets_equal_plain_window(spark):
    from inferframe.operators.chat import history_prefix
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(37)]
    rows += [(2, t, "assistant", f"x{t}") for t in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for m in (1, 3, 4):
        w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-m, -1)
        ref = (df.withColumn("h", F.collect_list(F.struct("turn", "role", "text")).over(w))
                 .filter("role = 'assistant'"))
        want = {(r["conv_id"], r["turn"]): [x["turn"] for x in r["h"]] for r in ref.collect()}
        got_df = history_prefix(df, max_turns=m, bucket_size=4)
        got = {(r["conv_id"], r["turn"]): [x["turn"] for x in r["history"]] for r in got_df.collect()}
        assert got == want, m


def test_null_and_odd_vectors_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [1.0]), (5, [None, 1.0]), (6, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk_similar(df, df, 2, query_id="vec_id", doc_id="vec_id", exclude_self=True).collect()
    assert {(r.query_id, r["rank"], r.doc_id) for r in got} == {(1, 1, 2), (1, 2, 6), (2, 1, 1), (2, 2, 6), (6, 1, 2), (6, 2, 1)}


def test_sparse_orders_stay_exact_with_a_hot_key(spark):
    from inferframe.operators.chat import history_prefix
    from inferframe.operators.ordered import dense_ordinal
    rnd = random.Random(5)
    rows = [(1 if i % 3 == 0 else 2 + i % 20, o, rnd.choice([None, 1, 2])) for i, o in enumerate(rnd.sample(range(10**7), 900))]
    df = spark.createDataFrame(rows, "k int, s long, v int")
    w = Window.partitionBy("k").orderBy("s")
    want = {(r.k, r.s): r.n - 1 for r in df.withColumn("n", F.row_number().over(w)).collect()}
    got = {(r.k, r.s): r.o for r in dense_ordinal(df, "k", "s", out="o", bucket_size=100, fan=50).collect()}
    assert got == want
    ref = df.withColumn("c", F.when((F.row_number().over(w) == 1) | ~F.col("v").eqNullSafe(F.lag("v").over(w)), 1).otherwise(0)) \
        .withColumn("o", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    got = {(r.k, r.s): r.o for r in change_ordinal(df, "k", "s", "v", out="o", bucket_size=1000, fan=7).collect()}
    assert got == {(r.k, r.s): r.o for r in ref.collect()}
    turns = spark.createDataFrame([(1, 10 * t, "assistant", f"m{t}") for t in range(40)], "conv_id long, turn long, role string, text string")
    got = {r.turn: r.n_history for r in history_prefix(turns, max_turns=3, bucket_size=4).collect()}
    assert got == {10 * t: min(3, t) for t in range(40)}


def test_repeated_fragments_count_once(spark):
    from inferframe.operators.chat import assemble_content, assemble_tool_calls
    c = spark.createDataFrame([(1, 0, "a", None, 5), (1, 0, "a", None, 5), (1, 1, "b", "stop", 6), (1, 2, "", None, 7), (1, 2, "", None, 7)],
                              "request_id long, seq long, content string, finish_reason string, created long")
    r = assemble_content(c).first()
    assert (r.content, r.n_chunks, r.n_heartbeats) == ("ab", 3, 1)
    t = spark.createDataFrame([(1, 0, 0, "id", "f", "{"), (1, 0, 0, "id", "f", "{"), (1, 1, 0, None, None, "}")],
                              "request_id long, seq long, tool_index long, tool_id string, tool_name string, tool_args string")
    r = assemble_tool_calls(t).collect()
    assert len(r) == 1 and (r[0].tool_id, r[0].tool_name, r[0].arguments, r[0].n_fragments) == ("id", "f", "{}", 2)


def test_tool_results_with_repeated_ids(spark):
    from inferframe.operators.chat import attach_tool_results
    calls = spark.createDataFrame([(1, 0, "x"), (1, 1, "x")], "request_id long, call_idx long, tool_call_id string")
    res = spark.createDataFrame([(1, 1, "x", "ok")], "request_id long, call_idx long, tool_call_id string, tool_result string")
    assert sorted((r.call_idx, r.tool_result) for r in attach_tool_results(calls, res).collect()) == [(0, None), (1, "ok")]


def test_pack_embedding_batches_sparse_ids(spark):
    from inferframe.operators.retrieval import pack_embedding_batches
    rnd = random.Random(11)
    ids = rnd.sample(range(10**9), 503)
    items = spark.createDataFrame([(i, f"t{i}") for i in ids], "item_id long, text string")
    b = pack_embedding_batches(items, 10, dense_ids=False, buckets=4).collect()
    seen = [i for r in b for i in r["ids"]]
    assert sorted(seen) == sorted(ids) and len(seen) == len(ids)
    assert all(1 <= r["n_items"] <= 10 and r["ids"] == sorted(r["ids"]) for r in b)
    assert all(r["texts"] == [f"t{i}" for i in r["ids"]] for r in b)
