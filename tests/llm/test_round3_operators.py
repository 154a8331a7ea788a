"""Periodic runs, suffix-array dedup and hard negatives against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inferframe.llm import hard_negatives, periodic_runs, simhash, suffix_dedup
from tests.conftest import SF_SMALL
from tests.llm import brute


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---------------------------------------------------------------- periodic runs

def test_runs_of_short_sequences():
    rng = random.Random(3)
    for _ in range(400):
        a = rng.randint(1, 4)
        w = [rng.randrange(a) for _ in range(rng.randint(0, 50))]
        if rng.random() < 0.5:
            b = [rng.randrange(a + 3) for _ in range(rng.randint(1, 6))]
            w = w[:rng.randint(0, 10)] + b * rng.randint(2, 6) + w[:5] + b * 3
        for least in ((2, 2), (6, 3), (24, 3)):
            assert [tuple(x) for x in periodic_runs.runs_of(w, *least).tolist()] == brute.runs(w, *least)


def test_suffix_tree_orders_leaves():
    text = [1, 2, 0, 2, 1, 2, 0, 2, 2]
    leaves, depths = periodic_runs.SuffixTree(text).tour()
    full = [*text, -1]
    assert leaves.tolist() == sorted(range(len(full)), key=lambda i: full[i:])
    extension = periodic_runs.CommonExtension(leaves, depths)
    assert extension(np.array([0, 1, 3]), np.array([4, 3, 7])).tolist() == [4, 1, 1]


def run_docs():
    rng = random.Random(4)
    rows = []
    for i in range(250):
        w = [rng.choice(["a", "b", "é", "d"]) + str(rng.randrange(3)) for _ in range(rng.randint(0, 90))]
        if rng.random() < 0.5:
            w[20:20] = [rng.choice("xyz") for _ in range(rng.randint(1, 9))] * rng.randint(2, 9)
        sep = rng.choice([" ", "\n", "  ", "\t", "\x0b"])
        rows.append((rng.choice([i, i, i, None, 3]), rng.choice([sep.join(w)] * 6 + [None, "", " ", f" {sep.join(w)} \n"])))
    return [*rows, (900, "x " * 3000), (901, "one two three " * 40 + "one"), *rows[:3]]


def test_run_report_with_nulls_repeats_and_clashing_columns(spark):
    rows = run_docs()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit("x")).withColumn("n_words", F.lit(0))
    have = rows_of(periodic_runs.run_report(periodic_runs.with_periodic_tails(df)))
    assert have == sorted((brute.run_row(i, brute.with_tail(i, t)) for i, t in rows), key=str)
    assert rows_of(periodic_runs.run_report(df)) == sorted((brute.run_row(i, brute.with_tail(None, t)) for i, t in rows), key=str)
    assert rows_of(periodic_runs.run_report(df, min_words=6, min_exponent=2)) == sorted(
        (brute.run_row(i, brute.with_tail(None, t), 6, 2) for i, t in rows), key=str)


def test_run_report_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("n_chars < 3000")
    have = rows_of(periodic_runs.run_report(periodic_runs.with_periodic_tails(docs)))
    assert have == sorted((brute.run_row(r.doc_id, brute.with_tail(r.doc_id, r.text)) for r in docs.collect()), key=str)
    assert sum(r[1] for r in have) > 5


def test_no_documents_no_runs(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.run_report(periodic_runs.with_periodic_tails(docs)).collect() == []


# ---------------------------------------------------------------- suffix arrays

def test_two_stage_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(200):
        text = np.append(rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(1, 60))), suffix_dedup.GAP).astype(np.uint8)
        raw = text.tobytes()
        assert suffix_dedup.suffix_array(text, len(text))[0].tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_types_of_suffixes():
    raw = b"mississippi"
    assert suffix_dedup.smaller_than_next(np.frombuffer(raw, np.uint8)).tolist() == [raw[i:] < raw[i + 1:] for i in range(len(raw))]


def repeat_docs():
    rng = random.Random(5)
    base = ["".join(rng.choice("ab é\n") for _ in range(rng.randint(0, 60))) for _ in range(12)]
    rows = []
    for i in range(120):
        t = "".join(rng.choice(base) for _ in range(rng.randint(0, 4)))
        rows.append((rng.choice([i, i, i, 7, None]), rng.choice([t, t, t, t, None])))
    return [*rows, (200, "x" * 500), (201, "x" * 300 + "y" + "x" * 90), (202, base[0] * 40), (-3, base[1] * 3), *rows[:4]]


@pytest.mark.parametrize("options", [
    {}, {"length": 12, "gram": 5}, {"length": 12, "gram": 5, "bucket_grams": 40, "bucket_bytes": 200, "hot_segments": 1},
    {"length": 5, "gram": 2, "hot_segments": 0, "bucket_bytes": 100}, {"length": 8, "gram": 8, "bucket_bytes": 500}])
def test_repeats_are_removed_from_later_documents(spark, options):
    rows = repeat_docs()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    df = df.withColumn("block", F.lit(1)).withColumn("kept", F.lit("x")).withColumn("bucket", F.lit(2))
    assert rows_of(suffix_dedup.repeat_report(df, **options)) == sorted(brute.without_repeats(rows, options.get("length", 50)), key=str)


def test_cut_texts_and_spans(spark):
    df = spark.createDataFrame([(1, "abcdefgh" * 4), (2, "zz" + "abcdefgh" * 2 + "q"), (None, "abcdefgh" * 4)], "doc_id long, text string")
    rows = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, length=10, gram=4).collect()}
    assert (bytes(rows[2].kept), [tuple(s) for s in rows[2].spans]) == (b"zzq", [(2, 16)])
    assert bytes(rows[1].kept) == bytes(rows[None].kept) == b"abcdefgh" * 4 and not rows[1].spans and not rows[None].spans


def test_repeats_in_the_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    have = rows_of(suffix_dedup.repeat_report(docs))
    assert have == sorted(brute.without_repeats([(r.doc_id, r.text) for r in docs.collect()], 50), key=str)
    assert sum(r[2] for r in have) > 1000
    assert suffix_dedup.repeat_report(docs.limit(0)).collect() == []


# ---------------------------------------------------------------- fingerprints in a radius

@pytest.mark.parametrize("radius", [1, 3])
def test_all_fingerprints_within_the_radius_meet(spark, radius):
    rng = random.Random(radius)
    prints = []
    for _ in range(25):
        base = rng.getrandbits(128)
        for _ in range(rng.randint(1, 8)):
            prints.append(base ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, radius + 2))))
    hot = rng.getrandbits(128)  # many that share most blocks and are mostly not linked
    prints += [hot ^ sum(1 << b for b in rng.sample(range(128), 4)) for _ in range(60)]
    rows = [(i, f"{p:032x}") for i, p in enumerate(prints)]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[max(find(i), find(j))] = min(find(i), find(j))
    got = {r.fingerprint: r.near_class for r in simhash.near_classes(spark.createDataFrame(rows, "doc_id long, fingerprint string"), radius).collect()}
    assert got == {p: min(find(j) for j, q in rows if q == p) for i, p in rows}


# ---------------------------------------------------------------- hard negatives

def vector_rows(seed, wide=False):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(8)]
    rows = []
    for i in range(240):
        e = list(rng.choice(base)) if rng.random() < 0.5 else [rng.gauss(0, 1) for _ in range(rng.choice([6, 6, 6, 3, 0]))]
        if wide and rng.random() < 0.1:
            e = [x * 1e12 for x in e]
        if e and rng.random() < 0.05:
            e[0] = rng.choice([None, float("nan"), float("inf")])
        rows.append((rng.choice([i] * 9 + [None]), rng.choice([0, 1, 2, 2, 2, None]), rng.choice([e] * 15 + [None])))
    return rows


@pytest.mark.parametrize("options", [{}, {"tree_size": 7, "tile_trees": 2, "tile_bytes": 2000}])
@pytest.mark.parametrize("wide", [False, True])
def test_hard_negatives(spark, wide, options):
    rows = vector_rows(2, wide)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    df = df.withColumn("row", F.lit(0)).withColumn("tree", F.lit(1)).withColumn("score", F.lit("s"))
    have = rows_of(hard_negatives.mine(df, F.col("vec_id") % 4 == 0, **options))
    assert have == sorted(brute.hard_negatives(rows, lambda i: i % 4 == 0), key=str)
    assert len(have) > 100


def test_hard_negatives_without_anchors_or_rows(spark):
    df = spark.createDataFrame(vector_rows(1), "vec_id long, label int, embedding array<double>")
    assert hard_negatives.mine(df, F.lit(False)).collect() == []
    assert hard_negatives.mine(df.limit(0), F.lit(True)).collect() == []


def test_repeated_vec_ids_are_rows_of_their_own(spark):
    rows = [(4, 0, [1.0, 0.0]), (4, 0, [1.0, 0.0]), (5, 1, [0.9, 0.0]), (6, 0, [0.0, 1.0])]
    have = rows_of(hard_negatives.mine(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), F.col("vec_id") == 4))
    assert have == sorted([(4, 4, 1, 5, 65536, 58880)] * 2, key=str)


def test_spanning_tree_and_bounds_prune():
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(3, 16)) * 200
    vectors = np.floor(np.repeat(centre, 20, 0) + rng.normal(size=(60, 16)))
    order, parent, edge = hard_negatives.spanning_tree(vectors)
    vectors = vectors[order]
    assert sorted(order.tolist()) == list(range(60)) and (parent[1:] < np.arange(1, 60)).all()
    np.testing.assert_allclose(edge[1:], np.linalg.norm(vectors[1:] - vectors[parent[1:]], axis=1))
    far = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(-1))
    joined, total = {0}, 0.0
    while len(joined) < 60:  # Prim over the whole matrix
        d, j = min((far[i, j], j) for i in joined for j in range(60) if j not in joined)
        total += d
        joined.add(j)
    assert edge.sum() == pytest.approx(total)
    candidates = np.floor(rng.normal(size=(500, 16)) * 200)
    exact, seen = (vectors @ candidates.T).astype(np.int64), {}
    floor = np.sort(exact, 1)[:, -5]

    def take(place, at, score):
        seen.update({(p, c): s for p, c, s in zip(place.tolist(), at.tolist(), score.tolist())})

    scored = hard_negatives.bounded_scores(vectors, parent, edge, candidates, lambda p, low, high: high >= floor[p][:, None], take)
    assert all(exact[p, c] == s for (p, c), s in seen.items())
    assert {(p, c) for p in range(60) for c in range(500) if exact[p, c] >= floor[p]} <= seen.keys()
    assert scored < 60 * 500 / 4
