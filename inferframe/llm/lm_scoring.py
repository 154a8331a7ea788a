"""N-gram scoring by a weighted backoff automaton.

Model. Bigrams, smoothed by deleted interpolation: after a known word h,
p(w | h) = (1 - L) c(h w) / c(h) + L p(w), where p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)) and L depends only on
the size class of c(h) (floor of log2). L is the Good-Turing share of tokens in that class whose
bigram occurs once, the chance that such a history continues in a new way. For every
history the probabilities of all words add up to one (every word of a text is followed by a word or by the
end, so c(h) counts its continuations).

Automaton. A state per known word (and one for the text's begin) plus the root. State h has an arc
per seen bigram, weighing log10 p(w | h) and leading to state w, and a failure arc weighing log10 L to the
root, whose arcs weigh log10 p(w); an unknown word leads to the root. One left-to-right
traversal carries the state and adds up weights. Because the state after a token is fixed by
that token alone, a whole block of texts is traversed with array operations.

Distribution. The automaton grows with the corpus, so no task holds it and nothing of it is broadcast:

1. Texts become blocks (about 4 MB of text) of local word numbers, written to the shared folder.
2. Each block sends its distinct words and bigrams with their training counts to shards: equal
   ranges of 64-bit hashes, so a frequent word or pair is one entry per block, whatever its count. The number
   of shards follows the corpus (`SHARD_TOKENS` tokens each).
3. A shard adds up counts and answers each block with the totals, in the order asked; it also
   counts its distinct training words. Answers are written to the shared folder.
4. N and V are sums over answers.
5. Each block meets its answers, so holds exactly the part of the automaton its texts can
   visit. It is written in that form, with its share of the counts behind L; their sum over
   all blocks gives L, so L covers the whole corpus, however it is cut into blocks.
6. Each block is traversed. Memory is bounded by one block.

Words are told apart by 64-bit hashes, bigrams by their shard and 48 more hash bits; a wrong match has a
chance below 1e-8 per lookup at any corpus size, since the shard number grows with the corpus.

Defined results: null text counts as empty, its only token is the end. A null doc_id is held out
of training (its remainder is unknown), `held_out` is false for it. Repeated rows count and score each. With
nothing to learn from N = V = 0. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inferframe.llm import textcore as T
from inferframe.llm.shared import crc_mod, ship, written

FOLDS, HELD = 10, 0
ADD = 0.1
SHARD_TOKENS = 400_000
BLOCK_BYTES = 4 << 20
LAMBDA_BLOCKS = None  # no bound: L is counted over all blocks (a test sets the name, nothing reads it)
LAMBDA_LEAST, LAMBDA_MOST, LAMBDA_NONE = 0.02, 0.98, 0.9
CLASSES = 64
#: hashes of the end token and of the begin state, apart from all word hashes by construction of neither
END, BEGIN = T.U(0x1D8E4E27C47D124F), T.U(0x7A6F8C1B5E39D042)
_codec = pa.Codec("zstd", compression_level=1)


def _pack(x: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(x).tobytes()
    return len(raw).to_bytes(8, "little") + (_codec.compress(raw, asbytes=True) if raw else b"")


def _unpack(b: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(b[:8], "little")
    return np.frombuffer(_codec.decompress(b[8:], decompressed_size=size, asbytes=True) if size else b"", dtype)


# --- blocks -----------------------------------------------------------------------------------

_BLOCK = "block long, doc_ids array<long>, learn binary, n_words binary, tokens binary, vocab binary, n_tokens long"


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for i, j, data, offsets in T.slices(batch.column(2), BLOCK_BYTES):
            word, first = T.words(T.lower_ascii(data), offsets)
            vocab, tokens = np.unique(word, return_inverse=True)
            learn = np.asarray(batch.column(1).slice(i, j - i).to_pylist(), bool)
            yield pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([batch.column(0).slice(i, j - i).to_pylist()], pa.list_(pa.int64())),
                *(pa.array([x], pa.binary()) for x in (_pack(learn), _pack(np.diff(first).astype(np.uint32)),
                                                       _pack(tokens.astype(np.uint32)), vocab.tobytes())),
                pa.array([len(word) + j - i], pa.int64())], names=[c.split()[0] for c in _BLOCK.split(", ")])
            number += 1


def blocks(docs: DataFrame) -> DataFrame:
    """Texts as blocks of local word numbers, written."""
    learn = F.coalesce(crc_mod("doc_id", FOLDS) != HELD, F.lit(False))
    return written(docs.select(F.col("doc_id").cast("long"), learn.alias("learn"), F.col("text").cast("string"))
                   .mapInArrow(_block_batches, _BLOCK), "blocks")


class Texts:
    """The texts of one block: `word` and `history` number every token (ends included) among the block's
    `size` words, then END, then BEGIN."""

    def __init__(self, row: dict, size: int):
        self.doc_ids = row["doc_ids"]
        n = _unpack(row["n_words"], np.uint32).astype(np.int64)
        words = _unpack(row["tokens"], np.uint32)
        end, begin = size, size + 1
        self.n_words, self.at = n, np.concatenate([[0], np.cumsum(n + 1)])
        self.word = np.full(self.at[-1], end, np.int64)
        inside = np.ones(self.at[-1], bool)
        inside[self.at[1:] - 1] = False
        self.word[inside] = words
        self.history = np.empty_like(self.word)
        self.history[1:] = self.word[:-1]
        self.history[self.at[:-1]] = begin
        self.local = self.history * (size + 2) + self.word


class Block(Texts):
    """One block, opened to ask: `vocab` holds the block's words, END and BEGIN; `pair` numbers a token's
    bigram among the sorted `pairs`."""

    def __init__(self, row: dict):
        vocab = np.frombuffer(row["vocab"], np.uint64)
        super().__init__(row, len(vocab))
        self.learn = _unpack(row["learn"], bool)
        self.vocab = np.concatenate([vocab, [END, BEGIN]]).astype(np.uint64)
        self.learns = np.repeat(self.learn, self.n_words + 1)
        # unigrams asked for: in hash order, BEGIN among them to count the texts that begin
        self.order = np.argsort(self.vocab, kind="stable")
        self.words = self.vocab[self.order]
        seen = np.bincount(self.word[self.learns], minlength=len(self.vocab))
        seen[len(vocab) + 1] = int(self.learn.sum())
        self.word_counts = seen[self.order]
        key = T.mix(self.vocab[self.history] * T.U(0x9FB21C651E98DF25) + self.vocab[self.word])
        self.pairs, self.pair = np.unique(key, return_inverse=True)
        self.pair_counts = np.bincount(self.pair[self.learns], minlength=len(self.pairs))


# --- shards -----------------------------------------------------------------------------------

_ASK = "shard long, block long, words binary, word_counts binary, pairs binary, pair_counts binary"


def _cut(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range begins in sorted hashes (shards + 1 positions)."""
    width = (1 << 64) // shards + 1
    edges = np.array([min(i * width, (1 << 64) - 1) for i in range(shards)], np.uint64)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


def _low48(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _ask_batches(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                w, p = _cut(b.words, shards), _cut(b.pairs, shards)
                out = []
                for s in range(shards) if shards < len(b.pairs) + len(b.words) else np.unique(np.concatenate([np.flatnonzero(np.diff(w)), np.flatnonzero(np.diff(p))])).tolist():
                    i, j, k, m = w[s], w[s + 1], p[s], p[s + 1]
                    if j > i or m > k:
                        out.append((s, row["block"], b.words[i:j].tobytes(), _pack(b.word_counts[i:j].astype(np.uint32)),
                                    _low48(b.pairs[k:m]).tobytes(), _pack(b.pair_counts[k:m].astype(np.uint32))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64(), pa.int64()] + 4 * [pa.binary()], strict=True)],
                    names=[c.split()[0] for c in _ASK.split(", ")])
    return run


_ANSWER = "block long, shard long, words binary, pairs binary, distinct long, learned long"


def _totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Total count per entry, and totals per distinct key."""
    _, inverse = np.unique(keys, return_inverse=True)
    total = np.bincount(inverse, counts, minlength=0).astype(np.uint64)
    return total[inverse], total


def _answer(table: pa.Table) -> pa.Table:
    rows = table.sort_by("block").to_pylist()
    words = [np.frombuffer(r["words"], np.uint64) for r in rows]
    pairs = []
    for r in rows:
        wide = np.zeros((len(r["pairs"]) // 6, 8), np.uint8)
        wide[:, :6] = np.frombuffer(r["pairs"], np.uint8).reshape(-1, 6)
        pairs.append(wide.view("<u8").ravel())
    every = np.concatenate(words)
    word_total, distinct = _totals(every, np.concatenate([_unpack(r["word_counts"], np.uint32) for r in rows]))
    pair_total, _ = _totals(np.concatenate(pairs), np.concatenate([_unpack(r["pair_counts"], np.uint32) for r in rows]))
    # BEGIN is a state, not a word
    keys = np.unique(every)
    distinct = distinct[keys != BEGIN]
    wa, pa_ = np.cumsum([0, *map(len, words)]), np.cumsum([0, *map(len, pairs)])
    n = len(rows)
    first = [int((distinct > 0).sum())] + [0] * (n - 1)
    learned = [int(distinct.sum())] + [0] * (n - 1)
    return pa.table({
        "block": pa.array([r["block"] for r in rows], pa.int64()), "shard": pa.array([r["shard"] for r in rows], pa.int64()),
        "words": pa.array([_pack(word_total[a:b]) for a, b in zip(wa[:-1], wa[1:], strict=True)], pa.binary()),
        "pairs": pa.array([_pack(_small(pair_total[a:b])) for a, b in zip(pa_[:-1], pa_[1:], strict=True)], pa.binary()),
        "distinct": pa.array(first, pa.int64()), "learned": pa.array(learned, pa.int64())})


def _small(x: np.ndarray) -> np.ndarray:
    """Counts as bytes, 255 standing for the 64-bit counts that follow."""
    large = x >= 255
    return np.concatenate([np.where(large, 255, x).astype(np.uint8), x[large].astype("<u8").view(np.uint8)])


def _large(x: np.ndarray, n: int) -> np.ndarray:
    out = x[:n].astype(np.int64)
    out[out == 255] = np.frombuffer(x[n:].tobytes(), "<u8").astype(np.int64)
    return out


# --- traversal --------------------------------------------------------------------------------

def _size_class(count: np.ndarray) -> np.ndarray:
    return np.frexp(np.maximum(count, 1).astype(float))[1] - 1


_MET = "doc_ids array<long>, n_words binary, tokens binary, words binary, pairs binary, once array<long>, n array<long>"


def _meet(row: dict, answers: list[dict], shards: int) -> dict:
    """A block with its part of the automaton: total counts of its words and of its bigrams (sorted by local
    numbers), and per size class of the history the training tokens whose bigram occurs once, and all."""
    block = Block(row)
    answers = sorted(answers, key=lambda r: r["shard"])
    count = np.empty(len(block.vocab), np.uint64)
    count[block.order] = np.concatenate([_unpack(r["words"], np.uint64) for r in answers])
    p = _cut(block.pairs, shards)
    total = np.concatenate([_large(_unpack(r["pairs"], np.uint8), int(p[r["shard"] + 1] - p[r["shard"]])) for r in answers])
    seen = total[block.pair]
    cls = _size_class(count)[block.history[block.learns]]
    once = seen[block.learns] == 1
    first = np.unique(block.local, return_index=True)[1]
    return {"doc_ids": block.doc_ids, "n_words": row["n_words"], "tokens": row["tokens"], "words": _pack(count),
            "pairs": _pack(_small(seen[first])), "once": np.bincount(cls[once], minlength=CLASSES).tolist(),
            "n": np.bincount(cls, minlength=CLASSES).tolist()}


def _meet_tables(shards: int):
    types = pa.schema([("doc_ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("n_words", "tokens", "words", "pairs")),
                       *((c, pa.list_(pa.int64())) for c in ("once", "n"))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = right.to_pylist()
        return pa.Table.from_pylist([_meet(row, answers, shards) for row in left.to_pylist()], types)
    return run


class Automaton:
    """The part of the automaton that one block's texts can visit."""

    def __init__(self, row: dict):
        self.count = _unpack(row["words"], np.uint64).astype(np.int64)
        self.texts = Texts(row, len(self.count) - 2)
        pairs, pair = np.unique(self.texts.local, return_inverse=True)
        self.seen = _large(_unpack(row["pairs"], np.uint8), len(pairs))[pair]

    def traverse(self, n: int, v: int, lam: np.ndarray) -> dict[str, np.ndarray]:
        t, seen = self.texts, self.seen
        base = (self.count + ADD) / (n + ADD * (v + 1))
        state, word = t.history, t.word
        known_state = self.count[state] > 0
        fail = np.where(known_state, lam[_size_class(self.count)[state]], 1.0)  # at the root there is nothing to fall from
        arc = np.where(known_state, (1 - fail) * seen / np.maximum(1, self.count[state]), 0.0)
        step = np.where(seen > 0, np.log10(arc + fail * base[word]), np.log10(fail) + np.log10(base[word]))
        add = lambda x: np.add.reduceat(x, t.at[:-1])
        return {"n_tokens": np.diff(t.at), "n_known": add((self.count[word] > 0).astype(np.int64)),
                "base_score": add(np.log10(base[word])), "score": add(step)}


def _score_batches(n: int, v: int, lam: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                got = Automaton(row).traverse(n, v, lam)
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), *map(pa.array, got.values())], names=["doc_id", *got])
    return run


_SCORE = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs."""
    spark = docs.sparkSession
    ship(spark)
    held = F.coalesce(crc_mod("doc_id", FOLDS) == HELD, F.lit(False))
    made = blocks(docs)
    tokens = made.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    shards = max(1, -(-tokens // SHARD_TOKENS))
    answers = written(made.mapInArrow(_ask_batches(shards), _ASK).groupBy("shard").applyInArrow(_answer, _ANSWER), "answers")
    v, n = answers.agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("learned"), F.lit(0))).first()

    met = written(made.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_meet_tables(shards), _MET), "met")
    once, all_ = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in met.select(F.posexplode(F.arrays_zip("once", "n")).alias("size_class", "c")) \
            .groupBy("size_class").agg(F.sum("c.once").alias("once"), F.sum("c.n").alias("n")).collect():
        once[r.size_class], all_[r.size_class] = r.once, r.n
    lam = np.clip(np.where(all_ > 0, once / np.maximum(1, all_), LAMBDA_NONE), LAMBDA_LEAST, LAMBDA_MOST)
    found = met.select("doc_ids", "n_words", "tokens", "words", "pairs").mapInArrow(_score_batches(n, v, lam), _SCORE)
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                        "base_score", "score")
