"""Quality rules by line labelling: a linear-chain conditional random field marks every line of a
text as content or boilerplate, and the share of words in content lines decides retention.

Lines are the \\n-split parts that hold a word. Each line is described by a few one-of-n
indicators (capitals, symbols, exclamation marks, digits, length, repetition inside the text and
inside the line, punctuation, place). Weights for indicators and for label transitions are fitted
by gradient ascent on the conditional likelihood; decoding is Viterbi over the two labels.

Training: document labels (`quality` 0 or 1) stand in for line labels. Lines of good documents
are content. Lines of bad documents start as boilerplate and are then relabelled twice by the
fitted chain, each bad document keeping at least its most suspicious line; so clean lines inside
bad documents come out as content. At most `TRAIN_DOCS` labelled documents are used (the first of
each kind by a hash of doc_id, half of them from either kind or more where the other has fewer), the documented bound of what reaches the driver: one small integer per indicator
of each of their lines. Training takes every line of these documents, decoding every line of every text.

A text is rejected beforehand (`base_failed`) below `MIN_WORDS` words, or when more than
`MAX_REPEAT_PERCENT` of its words lie in 8-word windows found twice or more.

Defined results: null text counts as empty; a text without words fails the base rules. Without
labelled documents of both kinds every line is content. A null doc_id is judged like any other.
Repeated rows are judged row by row, with equal answers. An empty table gives an empty result.
Extra columns are ignored by `line_quality` and kept by `keep_quality`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from inferframe.llm import textcore as T
from inferframe.llm.shared import ship, written

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8
MIN_CONTENT_SHARE = 0.5
TRAIN_DOCS = 2000

#: upper bucket edges of each indicator group; a group of k edges has k + 1 indicators
EDGES = {
    "capitals": (0.02, 0.1, 0.3, 0.6), "symbols": (0.001, 0.02, 0.08), "bangs": (0.001, 0.02, 0.08),
    "digits": (0.001, 0.05, 0.2), "words": (2.5, 5.5, 10.5, 20.5, 50.5, 150.5), "word_size": (2.5, 4, 6, 8, 12),
    "variety": (0.2, 0.4, 0.6, 0.8, 0.95), "repeated": (0.5,), "covered": (0.01, 0.3, 0.7),
    "stops": (0.02, 0.05, 0.1, 0.2, 0.4), "place": (0.5, 1.5),
}
SIZES = [len(e) + 1 for e in EDGES.values()]
STARTS = np.concatenate([[0], np.cumsum(SIZES)])
N_FEATURES = int(STARTS[-1])

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:")] = True


def _kind(low: int, high: int) -> np.ndarray:
    out = np.zeros(256, bool)
    out[low:high] = True
    return out


_UPPER, _DIGIT, _CHAR = _kind(0x41, 0x5B), _kind(0x30, 0x3A), np.ones(256, bool)
_CHAR[0x80:0xC0] = False  # continuation bytes of UTF-8


class Lines:
    """Counts and line indicators of one slice of documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        starts, ends, first = T.spans(data, offsets)
        word = T.hash_spans(data, starts, ends)
        self.n_words = np.diff(first)
        running = np.concatenate([[0], np.cumsum(_CHAR[data], dtype=np.int64)])
        size = running[ends] - running[starts]
        self.word_chars = T.reduce_rows(np.add, size, first, 0)
        symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data], dtype=np.int64)])
        self.n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]
        doc_of_word = np.repeat(np.arange(n), self.n_words)
        covered = repeated_windows(word, first, WINDOW_WORDS)
        self.n_repeat_words = T.reduce_rows(np.add, covered.astype(np.int64), first, 0)

        # lines: cut at every newline and at document edges, keep those with a word
        cuts = np.flatnonzero(data == 0x0A)
        begin = np.unique(np.concatenate([offsets[:-1], cuts + 1]))
        begin = begin[begin < len(data)]
        end = np.concatenate([begin[1:], [len(data)]]) if len(begin) else begin
        owner = np.searchsorted(offsets, begin, side="right") - 1
        at = np.searchsorted(starts, np.concatenate([begin, [len(data)]]))
        has = np.diff(at) > 0
        begin, end, owner, lo, hi = begin[has], end[has], owner[has], at[:-1][has], at[1:][has]
        end = end - ((end > begin) & (data[np.maximum(end - 1, 0)] == 0x0A)) if len(end) else end
        self.line_doc, self.line_words = owner, hi - lo
        self.line_at = np.searchsorted(owner, np.arange(n + 1))
        key = T.mix(T.hash_spans(data, begin, end) + T.mix(owner.astype(T.U)))
        _, earliest, inverse, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        later = np.arange(len(key)) != earliest[inverse] if len(key) else np.zeros(0, bool)
        self.n_dup_lines = np.bincount(owner[later], minlength=n).astype(np.int64)

        def share(mask: np.ndarray) -> np.ndarray:
            c = np.concatenate([[0], np.cumsum(mask[data], dtype=np.int64)])
            return (c[end] - c[begin]) / np.maximum(1, end - begin)

        def per_line(values: np.ndarray) -> np.ndarray:
            c = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
            return c[hi] - c[lo]

        count = np.maximum(1, self.line_words)
        line_of_word = np.repeat(np.arange(len(lo)), self.line_words)
        seen = np.unique(T.mix(word + T.mix(line_of_word.astype(T.U))), return_index=True)[1] if len(word) else []
        fresh = np.zeros(len(word), bool)
        fresh[seen] = True
        rank = np.arange(len(lo)) - self.line_at[owner]
        tail = np.diff(self.line_at)[owner] - 1 - rank
        bang = np.zeros(256, bool)
        bang[0x21] = True
        values = {
            "capitals": share(_UPPER), "symbols": share(_SYMBOL), "bangs": share(bang), "digits": share(_DIGIT),
            "words": self.line_words, "word_size": per_line(size) / count, "variety": per_line(fresh) / count,
            "repeated": (times[inverse] > 1).astype(float) if len(key) else np.zeros(0),
            "covered": per_line(covered) / count, "stops": share(_STOP) * 6,
            "place": np.where(rank == 0, 0, np.where(tail == 0, 1, 2)),
        }
        self.features = np.stack([STARTS[g] + np.searchsorted(np.array(EDGES[k]), values[k]) for g, k in enumerate(EDGES)],
                                 axis=1).astype(np.int16) if len(lo) else np.zeros((0, len(EDGES)), np.int16)
        assert len(doc_of_word) == len(word)


def repeated_windows(word: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """For each word: does it lie in a k-word window that occurs twice or more in its document."""
    n = np.diff(first)
    counts = np.maximum(0, n - k + 1)
    total = int(counts.sum())
    mark = np.zeros(len(word) + 1, np.int64)
    if total:
        docs = np.repeat(np.arange(len(n)), counts)
        where = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + first[docs]
        h = word[where].copy()
        for j in range(1, k):
            h *= T.U(0x9FB21C651E98DF25)
            h += word[where + j]
            h ^= h >> T.U(29)
        h = T.mix(h + T.mix(docs.astype(T.U)))
        order = np.argsort(h, kind="stable")
        sorted_ = h[order]
        same = np.zeros(total, bool)
        same[1:] = sorted_[1:] == sorted_[:-1]
        same[:-1] |= same[1:]
        hit = where[order[same]]
        np.add.at(mark, hit, 1)
        np.add.at(mark, hit + k, -1)
    return np.cumsum(mark[:-1]) > 0


def viterbi(emit: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best label sequence (0 content, 1 boilerplate) of one text: emit is (lines, 2)."""
    n = len(emit)
    (t00, t01), (t10, t11) = trans.tolist()
    a, b = emit[0].tolist()
    back = bytearray(2 * n)
    for i, (e0, e1) in enumerate(emit[1:].tolist(), 1):
        x0, y0, x1, y1 = a + t00, b + t10, a + t01, b + t11
        back[2 * i], back[2 * i + 1] = y0 > x0, y1 > x1
        a, b = (y0 if y0 > x0 else x0) + e0, (y1 if y1 > x1 else x1) + e1
    out = np.empty(n, np.int8)
    label = int(b > a)
    for i in range(n - 1, -1, -1):
        out[i] = label
        label = back[2 * i + label]
    return out


def _chain(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log-space product of 2 x 2 matrices, row by row."""
    return np.logaddexp(x[:, :, 0, None] + y[:, 0, None, :], x[:, :, 1, None] + y[:, 1, None, :])


def _expectations(emit: np.ndarray, rank: np.ndarray, tail: np.ndarray, trans: np.ndarray):
    """Forward-backward over all texts at once: label and transition marginals, log partition sums. emit is (lines, 2) of texts one
    after the other; `rank` and `tail` count a line's predecessors and successors in its text. Products of the
    step matrices double their reach each turn, so a long text costs the logarithm of its lines in turns."""
    step = trans + emit[:, None, :]
    fwd, bwd = np.where((rank == 0)[:, None, None], emit[:, None, :], step), np.zeros((len(emit), 2, 2))
    inner = np.flatnonzero(tail > 0)
    bwd[inner] = step[inner + 1]
    reach = 1
    while reach <= rank.max():
        i, j = np.flatnonzero(rank >= reach), np.flatnonzero(tail > reach)
        fwd[i] = _chain(fwd[i - reach], fwd[i])
        bwd[j] = _chain(bwd[j], bwd[j + reach])
        reach *= 2
    alpha = fwd[:, 0]
    beta = np.where((tail > 0)[:, None], np.logaddexp(bwd[:, :, 0], bwd[:, :, 1]), 0.0)
    last = np.arange(len(emit)) + tail
    z = np.logaddexp(alpha[last, 0], alpha[last, 1])[:, None]
    label = np.exp(alpha + beta - z)
    joint = alpha[inner, :, None] + step[inner + 1] + beta[inner + 1, None, :] - z[inner, :, None]
    return label, np.exp(np.minimum(joint, 0)).sum(0), z[rank == 0, 0]


def fit(docs: list[tuple[int, np.ndarray]], rounds: int = 3, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features, 2) and transitions (2, 2) from (quality, line features) of documents."""
    weight, trans = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    weight[:, 0] += 1e-3
    docs = [(q, x) for q, x in docs if len(x)]
    if len({q for q, _ in docs}) < 2:
        return weight, trans
    quality = np.array([q for q, _ in docs])
    size = np.array([len(x) for _, x in docs])
    first = np.cumsum(size) - size
    feats = np.concatenate([x for _, x in docs])
    doc = np.repeat(np.arange(len(docs)), size)
    rank = np.arange(len(feats)) - first[doc]
    tail = size[doc] - 1 - rank
    inner = np.flatnonzero(tail > 0)
    # both kinds of document weigh the same
    balance = np.where(quality == 1, 0.5 / (quality == 1).mean(), 0.5 / (quality == 0).mean())[doc]
    bad_line = (quality == 0)[doc]
    truth = bad_line
    emission = lambda: sum(weight[feats[:, g]] for g in range(len(EDGES)))
    for turn in range(rounds):
        gold = np.stack([~truth, truth], axis=1).astype(float)
        seen_pair = gold[inner].T @ gold[inner + 1]
        square_w, square_t = np.full_like(weight, 1e-6), np.full((2, 2), 1e-6)
        best = (-np.inf, weight, trans)
        for _ in range(steps):
            emit = emission()
            label, pair, z = _expectations(emit, rank, tail, trans)
            fits = (emit * gold * balance[:, None]).sum() + (trans[truth[inner].astype(int), truth[inner + 1].astype(int)] * balance[inner]).sum() \
                - (z * balance[first]).sum() - 5e-4 * len(docs) * ((weight ** 2).sum() + (trans ** 2).sum())
            if fits > best[0]:
                best = fits, weight.copy(), trans.copy()
            delta = (gold - label) * balance[:, None]
            grad = np.stack([sum(np.bincount(feats[:, g], delta[:, c], N_FEATURES) for g in range(len(EDGES))) for c in (0, 1)],
                            axis=1) / len(docs) - 1e-3 * weight
            grad_t = (seen_pair - pair) / len(docs) - 1e-3 * trans
            square_w += grad ** 2
            square_t += grad_t ** 2
            weight += 0.3 * grad / np.sqrt(square_w)
            trans += 0.1 * grad_t / np.sqrt(square_t)
        # over long texts a step can overshoot: the likeliest weights of the round go on
        _, weight, trans = best
        if turn < rounds - 1:
            suspicion = _expectations(emission(), rank, tail, trans)[0][:, 1]
            bad = suspicion > 0.5
            order = np.lexsort((rank, -suspicion, doc))
            bad[order[first]] = True  # the first line of the highest value
            truth = bad & bad_line
    return weight, trans


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in T.slices(batch.column(1)):
            lines = Lines(data, offsets)
            rows = [lines.features[a:b].astype("<i2").tobytes()
                    for a, b in zip(lines.line_at[:-1], lines.line_at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(rows, pa.binary())],
                                             names=["quality", "features"])


def train(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Fit the chain on at most `max_docs` labelled documents."""
    ship(docs.sparkSession)
    known = written(labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("__id"))
                    .agg(F.min(F.col("quality").cast("int")).alias("__quality"))
                    .join(docs.select(F.col("doc_id").alias("__id")).distinct(), "__id", "left_semi"), "labelled")
    n = dict(known.groupBy("__quality").count().collect())
    bad = min(n.get(0, 0), max(max_docs // 2, max_docs - n.get(1, 0)))
    first = lambda q, k: known.where(F.col("__quality") == q).orderBy(F.xxhash64("__id"), "__id").limit(k)
    sample = first(0, bad).unionByName(first(1, max_docs - bad))
    text = docs.select(F.col("doc_id").alias("__id"), F.col("text").cast("string").alias("__text")) \
        .join(F.broadcast(sample), "__id").select("__quality", "__text")
    rows = text.mapInArrow(_feature_batches, "quality int, features binary").collect()
    found = sorted((r.quality, bytes(r.features)) for r in rows)  # the fit doesn't depend on the partitions
    return fit([(q, np.frombuffer(x, "<i2").reshape(-1, len(EDGES))) for q, x in found])


def _judge_batches(weight: np.ndarray, trans: np.ndarray, min_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in T.slices(batch.column(0)):
                x = Lines(data, offsets)
                emit = weight[x.features].sum(1) if len(x.features) else np.zeros((0, 2))
                content = np.zeros(j - i)
                for d, (a, b) in enumerate(zip(x.line_at[:-1].tolist(), x.line_at[1:].tolist(), strict=True)):
                    if b > a:
                        labels = viterbi(emit[a:b], trans)
                        content[d] = x.line_words[a:b][labels == 0].sum()
                share = content / np.maximum(1, x.n_words)
                failed = (x.n_words < MIN_WORDS) | (100 * x.n_repeat_words > MAX_REPEAT_PERCENT * x.n_words)
                rest = [c.slice(i, j - i) for c in batch.columns[1:]]
                names = batch.schema.names[1:]
                made = {"n_words": x.n_words, "word_chars": x.word_chars, "n_symbols": x.n_symbols,
                        "n_dup_lines": x.n_dup_lines, "n_repeat_words": x.n_repeat_words, "base_failed": failed,
                        "content_share": share, "kept": ~failed & (share >= min_share)}
                yield pa.RecordBatch.from_arrays(
                    [*rest, *(pa.array(v if v.dtype != np.int32 else v.astype(np.int64)) for v in made.values())],
                    names=[*names, *made])
    return run


_MADE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " \
        "base_failed boolean, content_share double, kept boolean"


def line_quality(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """doc_id, counts, base_failed, content_share and kept of every row of docs."""
    ship(docs.sparkSession)
    schema = ST._parse_datatype_string("doc_id long, " + _MADE)
    return docs.select(F.col("text").cast("string"), F.col("doc_id").cast("long")) \
        .mapInArrow(_judge_batches(*model, min_share), schema)


def keep_quality(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """The rows of docs that pass, columns unchanged: one pass, no join."""
    ship(docs.sparkSession)
    hidden = [ST.StructField(f"__c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    made = ST._parse_datatype_string(_MADE)
    judged = docs.select(F.col("text").cast("string").alias("__text"), *(docs[f"`{c}`"].alias(h.name) for c, h in zip(docs.columns, hidden, strict=True))) \
        .mapInArrow(_judge_batches(*model, min_share), ST.StructType([*hidden, *made.fields]))
    return judged.where("kept").select(*(F.col(h.name).alias(c) for c, h in zip(docs.columns, hidden, strict=True)))
