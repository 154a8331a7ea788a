"""The ten operators against plain Python on small inputs that hold nulls, empty and long texts,
ties, repeated rows, empty tables and columns with clashing names."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from inferframe.llm import (components, langid, line_crf, lm_scoring, minhash, mixing, packing, simhash, textcore,
                            token_counts, url_reputation, warc_revisits)
from tests.llm import brute

BYTE, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, bucket long, size string, u int"


def vocabulary(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(["th", "er", "on", "an", "re", "ing", "é", "tion"]) for _ in range(r.randint(1, 4))) for _ in range(n)]


def sample_docs():
    r, vocab = random.Random(3), vocabulary(150, 1)
    text = lambda n: " ".join(r.choice(vocab) + ("." if r.random() < 0.1 else "") for _ in range(n))
    docs = [(i, text(r.randint(15, 60)).replace(". ", ".\n")) for i in range(30)]
    base = docs[4][1].split(" ")
    for i in range(30, 42):  # near copies of one text, some chained
        w = list(base)
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = f"edit{i}"
        docs.append((i, " ".join(w)))
    docs += [(50, docs[7][1]), (51, docs[7][1].upper()), (52, ""), (53, None), (54, " \n\t "), (55, "one"), (56, "One"),
             (57, "one two"), (58, "東京 naïve ﬁ <|endoftext|> x"), (59, "a " * 300), (60, text(9000)), (61, "!!! ??? 12 3")]
    docs += [docs[3], docs[3], (None, "null id text of its own kind here"), (None, None)]
    return docs


@pytest.fixture(scope="module")
def rows():
    return sample_docs()


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(d, t, ["en", "fr", None][i % 3], [f"src{i % 4}", None][i % 7 == 6], 0, "n", i, "s", 1) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return (r is not None, r)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is not None, x) for x in r))


def wanted(items):
    return sorted(items, key=lambda r: tuple((x is not None, x) for x in r))


# ------------------------------------------------------------------------------- kernels

def test_words_and_hashes_match_bytes(rows):
    import pyarrow as pa
    texts = [t for _, t in rows] + ["\x00 \x1c a\x0bb\x0cc", "end ", " begin"]
    for limit in (1, 64, 1 << 20):
        seen = []
        for i, j, data, offsets in textcore.slices(pa.array(texts), limit):
            h, first = textcore.words(data, offsets)
            seen += [h[first[k]:first[k + 1]].tolist() for k in range(j - i)]
        assert [len(x) for x in seen] == [len(brute.words(t)) for t in texts]
        table = {}
        for hs, t in zip(seen, texts, strict=True):
            for h, w in zip(hs, brute.words(t, lower=False), strict=True):
                assert table.setdefault(w, h) == h
        assert len(set(table.values())) == len(table)


def test_hash_windows_do_not_change_hashes(monkeypatch):
    data = np.frombuffer(" ".join(vocabulary(400, 9)).encode(), np.uint8)
    offsets = np.array([0, len(data)])
    want = textcore.words(data, offsets)[0]
    monkeypatch.setattr(textcore, "WINDOW", 50)
    assert (textcore.words(data, offsets)[0] == want).all()


# ------------------------------------------------------------------------------- op 2

def test_prefix_counts_equal_the_library():
    from tokenizers import Tokenizer
    lib, c = Tokenizer.from_file(BYTE), token_counts.counter(BYTE)
    n = lambda x: len(lib.encode(x, add_special_tokens=False).ids)
    r = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "'", "'s", "'re", "'v", "don't", "1", "23", "é", "東京", "😀", "<|endoftext|>", "<|endof",
             "!", "...", "the", " the", "\u00a0", "\x1c", "\u3000", "ß", "\u0301", "٣"]
    for _ in range(400):
        x = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert c.count(x) == n(x)
        want = [n(x[:i]) for i in range(len(x) + 1)]
        assert c.prefixes(x).tolist() == want, x
        for budget in (0, 1, 3):
            assert c.cut(x, budget) == max(i for i, m in enumerate(want) if m <= budget)


def test_cache_generations_do_not_change_counts(monkeypatch, rows):
    fresh = token_counts.PrefixCounter(BYTE)
    monkeypatch.setattr(token_counts, "CACHE", 10)
    c = token_counts.counter(BYTE)
    assert [fresh.count(t or "") for _, t in rows] == [c.count(t or "") for _, t in rows]


def test_token_counts_rows(docs, rows, empty):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(BYTE)
    n = [len(lib.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    assert got(token_counts.token_counts(docs, BYTE), "doc_id", "n_bytes", "n_tokens", "over_limit") == \
        wanted((d, len((t or "").encode()), m, m > 512) for (d, t), m in zip(rows, n, strict=True))
    assert token_counts.token_counts(empty, BYTE).count() == 0
    fit = dict(token_counts.truncated(docs.where("doc_id in (58, 60)"), BYTE, 7).collect())
    for d, t in rows:
        if d in fit:
            assert len(lib.encode(t[:fit[d]], add_special_tokens=False).ids) <= 7
    assert all(len(r.prefix_tokens) == len(dict(rows)[r.doc_id]) + 1 for r in token_counts.prefix_tokens(docs.where("doc_id = 58"), BYTE).collect())


# ------------------------------------------------------------------------------- op 3

@pytest.mark.parametrize("window", [16, 4096])
def test_packing_round_trip(docs, rows, empty, window):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(WORDS)
    ids = lambda t: lib.encode(t or "", add_special_tokens=False).ids + [2]
    out = packing.pieces(docs, WORDS, window=window, keep_ids=True).collect()
    # each row's ids come back whole: pieces of one document follow one another in the line of tokens
    line = sorted(out, key=lambda r: (r.sequence_id, r.offset))
    at, docs_back, current = 0, [], []
    for r in line:
        assert (r.sequence_id, r.offset) == divmod(at, window) and r.offset + r.length <= window
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        assert r.start == sum(len(x.ids) // 4 for x in current)
        current.append(r)
        at += r.length
        if r.start + r.length == r.doc_tokens:
            docs_back.append((r.doc_id, b"".join(x.ids for x in current)))
            current = []
    assert not current
    assert wanted(docs_back) == wanted((d, np.array(ids(t), "<u4").tobytes()) for d, t in rows)
    full = sorted(packing.sequences(docs, WORDS, window=window).collect(), key=lambda r: r.sequence_id)
    assert [len(r.ids) // 4 for r in full[:-1]] == [window] * (len(full) - 1)
    assert sum(len(r.ids) // 4 for r in full) == at and [r.sequence_id for r in full] == list(range(len(full)))
    assert packing.pieces(empty, WORDS).count() == 0


# ------------------------------------------------------------------------------- op 4

def test_scores_equal_a_plain_model(docs, rows, empty, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", 700)
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 900)
    uni, bi = brute.lm(rows)
    out = lm_scoring.score(docs).collect()
    have = wanted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in out)
    want = []
    for d, t in rows:
        b, known, n, total, _ = brute.base_score(t, uni)
        want.append((d, d is not None and zlib.crc32(str(d).encode()) % 10 == 0, n, known, total))
    assert have == wanted(want)
    base = {(d, len(brute.words(t)) + 1): brute.base_score(t, uni)[0] for d, t in rows}
    assert all(math.isclose(r.base_score, base[r.doc_id, r.n_tokens], rel_tol=1e-9) for r in out)
    # the bigram model's own numbers: from counts and the one free parameter per size class
    lam = {}
    some = [0] * lm_scoring.CLASSES, [0] * lm_scoring.CLASSES
    for d, t in rows:
        if d is not None and zlib.crc32(str(d).encode()) % 10:
            w = ["<b>", *brute.words(t), "<e>"]
            for h, x in zip(w, w[1:], strict=False):
                some[0][int(math.log2(uni[h]))] += bi[h, x] == 1
                some[1][int(math.log2(uni[h]))] += 1
    monkeypatch.setattr(lm_scoring, "LAMBDA_BLOCKS", 10_000)
    for k in range(lm_scoring.CLASSES):
        lam[k] = min(max(some[0][k] / some[1][k], 0.02), 0.98) if some[1][k] else 0.9
    total, v = brute.base_score("", uni)[3:]
    p = lambda x: (uni[x] + 0.1) / (total + 0.1 * (v + 1))
    want = {}
    for d, t in rows:
        w, s = ["<b>", *brute.words(t), "<e>"], 0.0
        for h, x in zip(w, w[1:], strict=False):
            a = lam[int(math.log2(uni[h]))] if uni[h] else 1.0
            s += math.log10(((1 - a) * bi[h, x] / uni[h] if uni[h] else 0.0) + a * p(x))
        want[d, len(w) - 1] = s
    for r in lm_scoring.score(docs).collect():
        assert math.isclose(r.score, want[r.doc_id, r.n_tokens], rel_tol=1e-6), r
    assert lm_scoring.score(empty).count() == 0


def test_weights_cover_all_blocks(docs, rows, monkeypatch):
    # more than 16 blocks, cut in two ways: one rule, the plain model's
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", 700)
    uni, bi = brute.lm(rows)
    once, all_ = [0] * lm_scoring.CLASSES, [0] * lm_scoring.CLASSES
    for d, t in rows:
        if d is not None and zlib.crc32(str(d).encode()) % 10:
            w = ["<b>", *brute.words(t), "<e>"]
            for h, x in zip(w, w[1:], strict=False):
                once[int(math.log2(uni[h]))] += bi[h, x] == 1
                all_[int(math.log2(uni[h]))] += 1
    lam = [min(max(o / n, 0.02), 0.98) if n else 0.9 for o, n in zip(once, all_, strict=True)]
    total, v = brute.base_score("", uni)[3:]
    p = lambda x: (uni[x] + 0.1) / (total + 0.1 * (v + 1))
    want = {}
    for d, t in rows:
        w, s = ["<b>", *brute.words(t), "<e>"], 0.0
        for h, x in zip(w, w[1:], strict=False):
            a = lam[int(math.log2(uni[h]))] if uni[h] else 1.0
            s += math.log10(((1 - a) * bi[h, x] / uni[h] if uni[h] else 0.0) + a * p(x))
        want[d, len(w) - 1] = s
    for parts in (24, 40):
        assert lm_scoring.blocks(docs.repartition(parts)).count() > 16
        for r in lm_scoring.score(docs.repartition(parts)).collect():
            assert math.isclose(r.score, want[r.doc_id, r.n_tokens], rel_tol=1e-9), r


def test_probabilities_of_a_history_add_up(docs, rows):
    uni, bi = brute.lm(rows)
    total, v = brute.base_score("", uni)[3:]
    vocab = [w for w in uni if w != "<b>"]
    p = lambda x: (uni[x] + 0.1) / (total + 0.1 * (v + 1))
    for h in list(uni)[:20]:
        if h != "<e>":
            s = sum(0.3 * bi[h, x] / uni[h] + 0.7 * p(x) for x in vocab) + 0.7 * p("never seen")
            assert math.isclose(s, 1, rel_tol=1e-9)


# ------------------------------------------------------------------------------- op 5

@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80), (3, 60)])
def test_near_duplicates(docs, rows, k, percent):
    out = minhash.near_duplicates(docs, shingle_words=k, percent=percent)
    want = [(d, n, c, d is not None and d == c) for (d, _), (n, c) in zip(rows, brute.components(rows, k, percent), strict=True)]
    assert got(out, "doc_id", "n_shingles", "component_id", "kept") == wanted(want)


def test_near_duplicates_keep_one_row(docs, rows, empty):
    kept = minhash.drop_near_duplicates(docs, shingle_words=3, percent=85)
    assert kept.columns == docs.columns
    assert minhash.drop_near_duplicates(empty).count() == 0 and minhash.near_duplicates(empty).count() == 0
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 1 and 50 not in ids and 52 in ids and 53 in ids
    want = {d for (d, t), (n, c) in zip(rows, brute.components(rows, 3, 85), strict=True) if d == c and d is not None}
    assert {i for i in ids if i is not None} == want


def test_one_row_of_each_class_stays_whatever_its_id(spark):
    r, vocab = random.Random(31), vocabulary(400, 7)
    a, b, c, d = ([r.choice(vocab) + str(i) for i in range(80)] for _ in range(4))
    near = lambda w, i: " ".join([*w[:79], f"edit{i}"])
    rows = [(1, " ".join(a)), (None, near(a, 1)),                      # a null id that copies a named document
            (None, " ".join(b)), (None, near(b, 2)), (None, near(b, 3)),  # null ids near copies of each other
            (5, " ".join(c)), (5, near(a, 4)), (5, near(c, 5)),        # one id: a kept row, copies of another and of itself
            (9, " ".join(d)), (8, near(d, 6)), (10, ""), (None, ""), (None, None), (None, "")]
    out = minhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=3, percent=85).collect()
    kind = lambda t: t.split()[0] if t else t
    assert wanted((x.doc_id, kind(x.text)) for x in out) == wanted(
        [(1, a[0]), (None, b[0]), (5, c[0]), (8, d[0]), (10, ""), (None, ""), (None, None)])


def test_min_and_max_estimate_similarity():
    import pyarrow as pa
    a = " ".join(f"w{i}" for i in range(400))
    b = " ".join(f"w{i}" for i in range(40, 440))
    run = minhash._signature_batches(3, 2, 400)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([a, b])], names=["doc_id", "text"])
    x, y = next(run(iter([batch]))).column(3).to_pylist()
    same = np.mean([p == q for p, q in zip(x, y, strict=True)])
    sets = [brute.shingle_set(t, 3) for t in (a, b)]
    j = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert abs(math.sqrt(same) - j) < 0.08  # a band of one minimum and one maximum agrees with j squared


def test_a_family_with_far_copies_costs_its_members(spark):
    # one text, near copies of it, and copies too far from anything: linear work, exact result
    r, vocab = random.Random(11), vocabulary(900, 2)
    base = [r.choice(vocab) + str(i) for i in range(150)]
    docs = []
    for i in range(120):
        w = list(base)
        for j in r.sample(range(150), r.choice([0, 1, 2, 3, 6, 8, 12])):
            w[j] = f"own{i}x{j}"
        docs.append((i, " ".join(w)))
    want = [(d, n, c) for (d, _), (n, c) in zip(docs, brute.components(docs, 3, 85), strict=True)]
    seen = []
    real = minhash.linked

    def counted(rows, prepare):
        def watched(spread):
            confirm, members, possible = prepare(spread)
            return (lambda pairs: (seen.append(pairs.count()), confirm(pairs))[1]), members, possible
        return real(rows, watched)

    minhash.linked = counted
    try:
        out = got(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85), "doc_id", "n_shingles", "component_id")
    finally:
        minhash.linked = real
    assert out == wanted(want) and sum(seen) < 3 * len(docs)


def test_components_of_chains_need_no_all_pairs(spark):
    # one bucket of 60 nodes; links only between neighbours on a line, and some nodes alone
    confirmed = []

    def prepare(nodes):
        def confirm(pairs):
            confirmed.append(pairs.count())
            return pairs.where((F.col("b") - F.col("a") == 1) & (F.col("b") < 40))
        return confirm, nodes.select("bucket", "node", F.lit(0.0).alias("weight"), F.lit(0).alias("info")), lambda x, y: F.lit(True)

    rows = spark.range(60).select(F.lit(1).alias("bucket"), F.col("id").alias("node"))
    roots = dict(components.linked(rows, prepare).collect())
    assert roots == {i: 0 for i in range(40)}
    star = spark.range(1, 500).select(F.lit(5).alias("bucket"), F.col("id").alias("node"))
    confirmed.clear()

    def prepare_star(nodes):
        def confirm(pairs):
            confirmed.append(pairs.count())
            return pairs
        return confirm, nodes.select("bucket", "node", F.lit(0.0).alias("weight"), F.lit(0).alias("info")), lambda x, y: F.lit(True)

    assert dict(components.linked(star, prepare_star).collect()) == {i: 1 for i in range(1, 500)}
    assert sum(confirmed) == 498  # a family of copies costs one comparison per member


# ------------------------------------------------------------------------------- op 6

def test_line_counts(docs, rows, empty):
    model = line_crf.fit([])
    out = line_crf.line_quality(docs, model)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = [(d, *brute.line_counts(t)) for d, t in rows]
    assert got(out, "doc_id", *columns) == wanted(want)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in out.collect())
    assert all(r.kept == (not r.base_failed) for r in out.collect())  # untrained: every line is content
    assert line_crf.line_quality(empty, model).count() == 0 and line_crf.keep_quality(empty, model).count() == 0
    assert line_crf.keep_quality(docs, model).columns == docs.columns


def test_repeated_lines_and_windows():
    import pyarrow as pa
    r = random.Random(8)
    texts = ["\n".join(" ".join(r.choice("abc") for _ in range(r.randint(0, 5))) for _ in range(r.randint(1, 12))) for _ in range(60)]
    data, offsets = textcore.strings(pa.array(texts))
    x = line_crf.Lines(data, offsets)
    have = list(zip(x.n_words.tolist(), x.word_chars.tolist(), x.n_symbols.tolist(), x.n_dup_lines.tolist(), x.n_repeat_words.tolist(), strict=True))
    assert have == [brute.line_counts(t) for t in texts]


def test_viterbi_is_the_best_sequence():
    r = np.random.default_rng(4)
    for _ in range(60):
        emit, trans = r.normal(size=(r.integers(1, 9), 2)), r.normal(size=(2, 2))
        assert line_crf.viterbi(emit, trans).tolist() == brute.viterbi(emit, trans)


def test_trained_lines_on_held_out_documents(spark):
    from tests.conftest import SF_SMALL
    docs, labels = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    train, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    model = line_crf.train(docs, train)
    rows = line_crf.line_quality(docs, model).join(test, "doc_id").where("not base_failed").collect()
    right = [r.kept == (r.quality == 1) for r in rows]
    assert len(right) > 20 and np.mean(right) > 0.9
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.95


def test_training_covers_every_line(spark):
    # long texts: junk only after their first hundred lines
    r, vocab = random.Random(21), vocabulary(300, 5)
    clean = lambda n: [" ".join(r.choice(vocab) for _ in range(9)) + "." for _ in range(n)]
    junk = lambda n: [f"BUY {r.randint(0, 99)} !!! $$$ CLICK | NOW {r.randint(0, 99999)} ***" for _ in range(n)]
    docs = [(i, "\n".join(clean(200) if i % 2 else clean(100) + junk(100))) for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    share = {x.doc_id: x.content_share for x in line_crf.line_quality(frame, line_crf.train(frame, labels)).collect()}
    words = {i: [len(x.split()) for x in t.split("\n")] for i, t in docs}
    for i in range(20):  # no junk line counts as content
        assert share[i] > 0.95 if i % 2 else share[i] < sum(words[i][:100]) / sum(words[i]) + 0.05, (i, share[i])


def test_marginals_equal_all_sequences():
    import itertools
    r = np.random.default_rng(9)
    sizes = [1, 2, 7, 1, 5, 8]
    emit, trans = r.normal(size=(sum(sizes), 2)), r.normal(size=(2, 2))
    rank = np.concatenate([np.arange(n) for n in sizes])
    tail = np.concatenate([np.arange(n)[::-1] for n in sizes])
    label, pair, _ = line_crf._expectations(emit, rank, tail, trans)
    want, want_pair, at = np.zeros_like(emit), np.zeros((2, 2)), 0
    for n in sizes:
        seqs = list(itertools.product((0, 1), repeat=n))
        p = np.exp([sum(emit[at + i, y] for i, y in enumerate(s)) + sum(trans[a, b] for a, b in itertools.pairwise(s)) for s in seqs])
        for s, x in zip(seqs, p / p.sum(), strict=True):
            for i, y in enumerate(s):
                want[at + i, y] += x
            for a, b in itertools.pairwise(s):
                want_pair[a, b] += x
        at += n
    assert np.allclose(label, want) and np.allclose(pair, want_pair)


def test_training_takes_both_kinds_where_one_is_rare(spark):
    docs = spark.createDataFrame([(i, "BUY !!! $$$ NOW 99\n" * 5 if i % 50 == 7 else f"A quiet line of words, number {i}.\n" * 5)
                                  for i in range(200)], "doc_id long, text string")
    order = [r.doc_id for r in docs.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").collect()]
    rare = order[-1]  # the last by the sample's hash
    labels = docs.select("doc_id", (F.col("doc_id") != rare).cast("int").alias("quality"))
    weight, _ = line_crf.train(docs, labels, max_docs=20)
    assert not np.array_equal(weight, line_crf.fit([])[0])
    # the bound is used up: 19 of the common kind, and all of one kind only where the other has none
    seen, real = [], line_crf.fit
    line_crf.fit = lambda found: (seen.append(sorted(q for q, _ in found)), real(found))[1]
    try:
        line_crf.train(docs, labels, max_docs=20)
        line_crf.train(docs, docs.select("doc_id", (F.col("doc_id") % 2).alias("quality")), max_docs=20)
        line_crf.train(docs, docs.select("doc_id", F.lit(1).alias("quality")), max_docs=20)
    finally:
        line_crf.fit = real
    assert seen == [[0] + 19 * [1], 10 * [0] + 10 * [1], 20 * [1]]


# ------------------------------------------------------------------------------- op 7

def test_edited_texts(docs, rows, empty, monkeypatch):
    monkeypatch.setattr(simhash, "RANGE_BYTES", 6000)
    out = simhash.fingerprint_report(docs)
    # descending ids, nulls last, ties by text
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for i, (d, t) in enumerate(order):
        text, following = t or "", order[(i + 1) % len(order)][1] or ""
        e = simhash.edit(text, following)
        prints = simhash.fingerprint_texts([text, e, following])
        want.append((d, len(text), hashlib.sha256(e.encode()).hexdigest(), *simhash.hexed(prints[:2]),
                     float(simhash.likeness(prints[:1], prints[1:2])[0]), float(simhash.likeness(prints[:1], prints[2:])[0])))
    assert got(out, *simhash._NAMES) == wanted(want)
    assert simhash.fingerprint_report(empty).count() == 0


def test_single_document_follows_itself(spark):
    one = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    r = simhash.edited_likeness(one).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a ba b").hexdigest() or r.n_chars == 7


def test_fingerprint_votes():
    texts = ["a b a b a b", "", "x", "a b c d e f g h"]
    prints = simhash.fingerprint_texts(texts)
    import pyarrow as pa
    for t, p in zip(texts, prints, strict=True):
        data, offsets = textcore.strings(pa.array([t]))
        terms, _ = textcore.shingles(*textcore.words(data, offsets), 2)
        votes = np.zeros(128)
        for h in terms:
            both = np.array([h, textcore.mix(np.array([h]) ^ textcore.U(0x5851F42D4C957F2D))[0]])
            votes += 2.0 * np.unpackbits(both.view(np.uint8)) - 1
        assert (np.unpackbits(p.view(np.uint8)) == (votes > 0)).all()


def test_all_fingerprints_within_the_radius(spark):
    r = random.Random(2)
    prints = []
    for i in range(40):
        x = r.getrandbits(128)
        prints.append((3 * i, x))
        for j in (1, 2):
            y = x
            for b in r.sample(range(128), r.randint(0, 5)):
                y ^= 1 << b
            prints.append((3 * i + j, y))
    df = spark.createDataFrame([(d, f"{x:032x}") for d, x in prints], "doc_id long, fingerprint string")
    root = {d: d for d, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for d, x in prints:
        for e, y in prints:
            if (x ^ y).bit_count() <= 3 and find(d) != find(e):
                root[max(find(d), find(e))] = min(find(d), find(e))
    have = dict(simhash.near_classes(df).collect())
    assert all(have[f"{x:032x}"] == find(d) for d, x in prints)


# ------------------------------------------------------------------------------- op 8

def test_mixing_meets_targets(docs, rows, empty):
    out = mixing.mix_sizes(docs).collect()
    assert len(out) == len(rows)
    assert all(r["size"] == len(brute.words(t)) for r, t in zip(sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id, r["size"])),
               [t for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0], len(brute.words(r[1]))))], strict=True))
    assert all(0 <= r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0) for r in out)
    by = {}
    for r in out:
        by.setdefault((r.source_size, r.target), []).append(r)
    for (_, target), members in by.items():
        assert abs(sum(r.taken for r in members) - target) <= max(r["size"] for r in members)
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.mix_sizes(docs.repartition(3)).collect()), key=str)
    assert mixing.mix_sizes(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mix_repeats_rows(docs):
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    size = sum(len(brute.words(r.text)) for r in mixed.collect())
    assert size == sum(r.taken for r in mixing.mix_sizes(docs).collect())


def test_targets_fill_up_to_their_stops(spark):
    sizes = {"a": 10, "b": 1000, "c": 20, "d": 500, "e": 1, None: 300, "f": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    have = {r.source: r.target for r in mixing.targets(df).collect()}
    names = [*sorted(k for k in sizes if k is not None), None]
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}
    want, free, budget = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        share = {k: budget * weight[k] / sum(weight[x] for x in free) for k in free}
        over = [k for k in free if share[k] >= 2 * sizes[k]]
        if not over:
            want |= share
            break
        for k in over:
            want[k] = 2.0 * sizes[k]
            budget -= want[k]
            free.discard(k)
    assert have.keys() == want.keys() and all(math.isclose(have[k], want[k], abs_tol=1e-9) for k in want)


def test_weights_change_inclusion(spark):
    rows = [(i, "w " * 10, "s", float(1 + 3 * (i % 2))) for i in range(400)] + [(1000 + i, "w " * 10, "t", 1.0) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double")
    taken = {r.doc_id: r.taken for r in mixing.mix_sizes(df.where("source = 't' or source = 's'"), F.col("weight")).collect()}
    odd = np.mean([taken[i] for i in range(1, 400, 2)])
    even = np.mean([taken[i] for i in range(0, 400, 2)])
    assert odd >= even


# ------------------------------------------------------------------------------- op 10

def test_language_counts_add_up_over_pieces(monkeypatch):
    text = "".join(random.Random(1).choice("abc éß東") for _ in range(1000))
    want = langid.text_counts(text)
    monkeypatch.setattr(langid, "PIECE", 37)
    assert (langid.text_counts(text) == want).all() and want.sum() == 3 * len(text) - 3


def test_languages_on_held_out_documents(spark, docs, empty):
    from tests.conftest import SF_SMALL
    real = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.train(real)
    held = langid.predict(real, model).where("held_out").join(real.select("doc_id", "lang"), "doc_id").collect()
    assert len(held) > 30 and np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    out = {(r.doc_id): r for r in langid.predict(docs, model).collect() if r.doc_id is not None}
    assert all(out[d].lang_pred == "und" and out[d].score == 0 for d in (52, 53, 54)) and out[55].lang_pred != "und"
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in out.items())
    assert langid.predict(empty, model).count() == 0
    nothing = langid.train(empty)
    assert all(r.lang_pred == "und" for r in langid.predict(docs, nothing).collect())
    assert langid.keep_languages(docs, model).columns == docs.columns


def test_posterior_equals_plain_naive_bayes():
    texts = {"x": "aab aab aac", "y": "zzb zzy zb"}
    counts = np.stack([langid.text_counts(t) for t in texts.values()], 1) + langid.SMOOTH
    model = (list(texts), np.log(counts / counts.sum(0)), np.log([0.5, 0.5]))
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["aac", "zy"])], names=["text"])
    r = next(langid._predict_batches(*model)(iter([batch])))
    for t, lang, score in zip(["aac", "zy"], r.column(0).to_pylist(), r.column(1).to_pylist(), strict=True):
        log = langid.text_counts(t) @ model[1] + model[2]
        post = np.exp(log - log.max()) / np.exp(log - log.max()).sum()
        assert lang == model[0][int(log.argmax())] and math.isclose(score, post.max(), rel_tol=1e-4)


# ------------------------------------------------------------------------------- op 1

def test_urls(spark, monkeypatch):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?y#z", "http://example.org/es/", "http://example.org/en/12",
            "http://example.org/en/2", "http://badexample.org", "http://x.com/fr/1", "http://x.com/de/1", "http://x.com", "http://X.net:80?q",
            "a://b://c/d", "http://bad.net/1", "http://bad.net/1"] + [f"http://bad.net/{i}" for i in range(60)]
    pages = spark.createDataFrame([(i, u, None, "clash") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    labels = spark.createDataFrame([(i, 0 if u and "bad.net" in u else 1, 0) for i, u in enumerate(urls)] + [(3, None, None), (9999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    monkeypatch.setattr(url_reputation, "HOT", 3)  # both join paths
    out = {r.page_id: r for r in url_reputation.judge(pages, labels).collect()}
    assert len(out) == len(urls)
    assert (out[0].host, out[0].path, out[2].host) == ("", "", "")
    assert (out[4].host, out[4].path, out[4].rule, out[4].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert (out[6].rule, out[6].verdict, out[7].rule, out[7].verdict) == ("example.org/en/1", "block", "org/", "allow")
    assert out[8].rule is None and (out[9].verdict, out[10].verdict) == ("allow", "block") and out[11].rule is None
    assert (out[12].host, out[13].host, out[13].path) == ("x.net:80", "b:", "//c/d")
    assert out[14].verdict == "block" and out[20].verdict == "block" and out[11].verdict == "allow"
    none = url_reputation.judge(pages.limit(0), labels)
    assert none.count() == 0
    assert url_reputation.judge(pages, labels.limit(0)).count() == len(urls)
    kept = url_reputation.keep_allowed(pages, labels)
    assert kept.columns == pages.columns and 14 not in {r.page_id for r in kept.collect()}


def test_domains(spark):
    hosts = {"a.b.example.com": ("example.com", "com"), "x.co.uk": ("x.co.uk", "co.uk"), "y.x.co.uk": ("x.co.uk", "co.uk"),
             "com": ("com", "com"), "": ("", ""), "h.net:8080": ("h.net", "net"), "h.net.": ("h.net", "net"), "co.uk": ("co.uk", "co.uk")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string").withColumn("s", url_reputation.suffix_of(F.col("host"))) \
        .withColumn("d", url_reputation.domain_of(F.col("host"), F.col("s")))
    assert {r.host: (r.d, r.s) for r in df.collect()} == hosts


# ------------------------------------------------------------------------------- op 9

RECORDS = "record_id string, url string, ts long, kind string, headers map<string,string>, payload_digest string, slice int"


def brute_revisits(records):
    def weak(h):
        e = (h or {}).get("etag")
        return e[2:] if e and e.startswith("W/") else e
    out = []
    for r in records:
        if r[3] != "revisit":
            continue
        best = max((x for x in records if x[3] == "response" and x[1] is not None and x[1] == r[1] and None not in (x[2], r[2]) and x[2] < r[2]),
                   key=lambda x: (x[2], x[0]), default=None)
        status, headers, digest = "no_earlier", None, None
        if best:
            a, b = r[4] or {}, best[4] or {}
            if weak(a) and weak(b):
                status = "resolved" if weak(a) == weak(b) else "mismatch"
            elif a.get("last-modified") and b.get("last-modified"):
                status = "resolved" if a["last-modified"] == b["last-modified"] else "mismatch"
            else:
                status = "unverified"
            if status != "mismatch":
                headers, digest = {**b, **{k: v for k, v in a.items() if k in warc_revisits.UPDATABLE}}, best[5]
        out.append((r[0], status, best and best[0], headers and tuple(sorted(headers.items())), digest))
    return out


@pytest.mark.parametrize("slice_", [50_000, 20])
def test_revisits(spark, monkeypatch, slice_):
    monkeypatch.setattr(warc_revisits, "SLICE", slice_)
    monkeypatch.setattr(warc_revisits, "SLICES", 5)
    r = random.Random(6)
    records = []
    for i in range(300):
        url = r.choice(["http://h.com/a"] * 6 + ["http://h.com/b", "http://h.com/c", None])
        head = {k: r.choice(v) for k, v in {"etag": ['"1"', 'W/"1"', '"2"'], "last-modified": ["x", "y"], "date": ["d1", "d2"],
                "content-length": ["5", "6"]}.items() if r.random() < 0.5}
        records.append((f"r{i:03}", url, r.choice([None, *range(40)]), r.choice(["response", "revisit", "revisit", "other"]),
                        r.choice([head, head, head, None]), f"p{i}", 0))
    df = spark.createDataFrame(records, RECORDS)
    have = [(x.record_id, x.status, x.response_id, x.headers if x.headers is None else tuple(sorted(x.headers.items())), x.payload_digest)
            for x in warc_revisits.resolve(df).collect()]
    assert sorted(have, key=str) == sorted(((a, b, c, d if b in ("resolved", "unverified") else None, e) if d != () else (a, b, c, (), e)
                                            for a, b, c, d, e in fixed(brute_revisits(records))), key=str)
    assert warc_revisits.resolve(df.limit(0)).count() == 0


def fixed(rows):
    """An empty header map stays a map."""
    return [(a, b, c, () if b in ("resolved", "unverified") and d is None or d == {} else d, e) for a, b, c, d, e in rows]


def test_canonical_urls(spark):
    urls = {"HTTP://WWW.A.com:80/x/?b=2&a=1&utm_source=q#f": "a.com/x?a=1&b=2", "https://a.com:443": "a.com", "https://a.com:80/": "a.com:80",
            "no": None, None: None, "ftp://A.b/C": "a.b/C"}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url: r.c for r in df.withColumn("c", warc_revisits.canonical(F.col("url"))).collect()} == urls


def test_packing_holds_a_plain_word_once():
    enc = packing.TextEncoder(WORDS)
    text = "word Word word, can't 12 re-use ''s l'\u00e9t\u00e9 \u4e2d\u6587"
    assert enc.text(text) == enc.ids(text) == enc.text(text)
    caches = [v for v in vars(enc).values() if isinstance(v, packing.Generations)]
    assert sum("word" in c for c in caches) == 1
    assert all(c[k] == enc.ids(k) for c in caches for k in list(c))
