"""Classes of sets in hot buckets against brute force, with blocks far smaller than a bucket."""

import random

import numpy as np
import pytest

from inferframe.llm import minhash, set_links
from tests.llm import brute


def test_the_bound_is_never_below_the_common_part():
    rng = np.random.default_rng(5)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, int(rng.integers(2, 600)), dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, int(rng.integers(1, len(pool))))) for _ in range(2))
        x, y = (set_links.stacked([set_links.bitmap(v)]) for v in (a, b))
        while x.shape[1] != y.shape[1]:
            x, y = (set_links.folded(v) if v.shape[1] == max(x.shape[1], y.shape[1]) else v for v in (x, y))
        bound = set_links.most_common(len(a), len(b), set_links.filled(x), set_links.filled(y), set_links.filled(x & y))[0]
        assert bound >= len(np.intersect1d(a, b))


@pytest.mark.parametrize("percent", [40, 85])
def test_edges_meet_every_link_of_any_width(percent):
    rng = np.random.default_rng(percent)
    pool = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool[:int(rng.integers(60, 500))], int(rng.integers(40, 900)))) for _ in range(60)]
    n, c = np.array([len(v) for v in sets]), np.arange(60) % 50
    edges = set_links._edges(n, c, np.zeros(60, np.int64), False, [set_links.bitmap(v) for v in sets], percent)
    met = {frozenset(e) for e in edges[1:].T.astype(int).tolist()}
    for i in range(60):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if c[i] != c[j] and common * 100 >= (n[i] + n[j] - common) * percent:
                assert frozenset((i, j)) in met


def test_a_hot_bucket_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(set_links, "BLOCK", 6)
    r = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(70):
        w = list(base)
        for j in r.sample(range(120), r.choice([2, 4, 5, 6, 9])):
            w[j] = f"own{i % 35}x{j}"
        docs.append((i, " ".join(w)))
    out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85)
    want = [(d, n, c) for (d, _), (n, c) in zip(docs, brute.components(docs, 3, 85), strict=True)]
    assert sorted(tuple(x)[:3] for x in out.collect()) == want


def test_a_family_that_holds_together_is_dealt_once_for_each_block_of_the_rest(spark, monkeypatch):
    monkeypatch.setattr(set_links, "BLOCK", 10)
    # bucket 1: a family of 200 and 15 others; bucket 2: one block; bucket 3: 25 members, none linked
    members = [(1, 215, i, 5, 0) for i in range(200)] + [(1, 215, 200 + i, 5, 200 + i) for i in range(15)] \
        + [(2, 9, 300 + i, 5, 300 + i // 2) for i in range(9)] + [(3, 25, 400 + i, 5, 400 + i) for i in range(25)]
    rows = [(b, n, v, s, c, (200, 0) if b == 1 else (2, 306) if b == 2 else (1, 424)) for b, n, v, s, c in members]
    open_ = spark.createDataFrame(rows, "bucket long, n long, node long, size long, class long, main struct<c: long, class: long>")
    groups: dict = {}
    for r in set_links._dealt(open_).collect():
        groups.setdefault((r.bucket, r.i, r.j), []).append(r)
    assert sum(len(g) for k, g in groups.items() if k[0] == 1) == 200 * 2 + 15 * 22
    assert [k for k in groups if k[0] == 2] == [(2, 0, 0)]
    met: dict = {}
    for (b, i, j), g in groups.items():
        for x in g:
            for y in g:
                if x.node < y.node and x["class"] != y["class"] and (i == j or x.side != y.side):
                    met[b, x.node, y.node] = met.get((b, x.node, y.node), 0) + 1
    wanted = {(b, x, y) for b, _, x, _, c in members for d, _, y, _, e in members if b == d and x < y and c != e}
    assert met.keys() == wanted and set(met.values()) == {1}


def _hot_family(r: random.Random) -> list[tuple]:
    """Near copies of one text, in pairs that are no copies of other pairs, and texts that only share a bucket with them."""
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(90):
        w = list(base)
        for j in r.sample(range(120), r.choice([2, 4, 5, 6, 9])):
            w[j] = f"own{i % 45}x{j}"
        docs.append((i, " ".join(w)))
    return docs


def test_later_rounds_meet_only_members_of_pairs_not_handed_on(spark, monkeypatch):
    docs, wrote = _hot_family(random.Random(8)), []
    real = set_links.written

    def seen(df, name):
        out = real(df, name)
        wrote.append((name, out))
        return out

    monkeypatch.setattr(set_links, "written", seen)
    out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85)
    want = [(d, n, c) for (d, _), (n, c) in zip(docs, brute.components(docs, 3, 85), strict=True)]
    assert sorted(tuple(x)[:3] for x in out.collect()) == want
    # the members of open buckets are joined with their bucket once, whatever the number of rounds
    assert [n for n, _ in wrote].count("open") == 1
    met = [t for n, t in wrote if n == "met"]
    left = [t.where("node is not null").count() for t in met]
    assert left[0] < next(t for n, t in wrote if n == "open").count() and left == sorted(left, reverse=True) and left[-1] == 0


def test_a_block_hands_on_a_forest_and_the_members_of_other_pairs():
    import pyarrow as pa
    rng = np.random.default_rng(2)
    own = [rng.integers(0, 1 << 63, 50, dtype=np.uint64) for _ in range(3)]
    sets = [np.sort(np.append(own[0], rng.integers(0, 1 << 63, 2, dtype=np.uint64))) for _ in range(4)] + own[1:] \
        + [np.append(own[2][1:], np.uint64(7))]
    group = [(9, 0, 0, node, len(v), node, 0, set_links.bitmap(v)) for node, v in enumerate(sets)]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*group, strict=True), types, strict=True)], names=list("abcdefgh"))
    rows = {f: [r for b in set_links._block_batches(85, f)(iter([batch])) for r in b.to_pylist()] for f in (True, False)}
    # four copies of one text: six pairs, those of node 0 in the forest; nodes 5 and 6: one pair, handed on; node 4: none
    pairs = {f: {(r["a"], r["b"]) for r in rows[f] if r["a"] is not None} for f in rows}
    assert len(pairs[True]) == 4 and pairs[True] < pairs[False] and len(pairs[False]) == 7 and (5, 6) in pairs[True]
    assert {r["node"] for r in rows[True] if r["node"] is not None} == {1, 2, 3}
    assert not [r for r in rows[False] if r["node"] is not None]


def test_only_texts_of_the_pairs_move_to_be_confirmed(spark, monkeypatch):
    docs, plans = _hot_family(random.Random(4)), []
    real = minhash.linked

    def watched(rows, prepare):
        def seen(nodes):
            confirm, *rest = prepare(nodes)

            def kept(pairs):
                out = confirm(pairs)
                plans.append(out._jdf.queryExecution().executedPlan().toString())
                return out
            return (kept, *rest)
        return real(rows, seen)

    monkeypatch.setattr(minhash, "linked", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no table were small
    try:
        out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(tuple(x)[:3] for x in out) == [(d, n, c) for (d, _), (n, c) in zip(docs, brute.components(docs, 3, 85), strict=True)]
    # one shuffle, of the pairs with their texts; the candidates' table is read where it lies
    assert plans and all(p.count("Exchange hashpartitioning") == 1 for p in plans)


def test_no_text_is_shuffled_to_drop_a_few_rows(spark):
    docs = spark.createDataFrame([*_hot_family(random.Random(6)), (500, "a b c d"), (501, None), (None, "x y z u"), (7, "one two three four")],
                                 "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no table were small
    try:
        kept = minhash.drop_near_duplicates(docs, shingle_words=3, percent=85)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        rows = kept.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning(doc_id" not in plan and "hashpartitioning(cast(doc_id" not in plan
    want = {d for d, (_, c) in ((d, x) for (d, _), x in zip(*(lambda r: (r, brute.components(r, 3, 85)))([tuple(r) for r in docs.collect()]), strict=True))
            if d is not None and d == c}
    assert {r.doc_id for r in rows} == want | {None} and len(rows) == len(want) + 2
