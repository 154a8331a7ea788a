"""Operator 11: periodic runs of words in each document, and the text with repeated periods dropped.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, of at least
`min_words` words and `min_exponent` periods.

Method: Ukkonen's suffix tree of the words and of their reversal. A tour of a tree gives the order of its leaves and
the depth of the lowest common ancestor of neighbouring leaves; a table of range minima over it answers how far two
suffixes agree in constant time. Every run holds, under the words' order or its opposite, a Lyndon root that is the
longest Lyndon word at its position (the suffix ends it that is the next smaller one), so each position gives two
candidates, which are extended to both sides.

Trees in Python cost some 20 microseconds a word, so they are built only where a run can be. A run of period q repeats each
of its windows of `min_words * (1 - 1 / min_exponent)` words q words later or earlier, and these windows cover it. Hence a run
lies whole within a stretch of words covered by repeating windows, in which some window repeats within 1 / `min_exponent` of
the stretch. The screen compares window hashes: equal windows always pass it and unequal ones only cost work. What it lets
through is decided on the words themselves. Memory: about a kilobyte a word of the longest such stretch.

Edge cases: null text counts as empty and has no words, no runs and an empty collapsed text. Null and repeated doc_ids are rows like
others, each with its own result. Columns of the input other than doc_id and text are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inferframe.llm import textcore as tc
from inferframe.llm.shared import ship

MIN_WORDS = 24
MIN_EXPONENT = 3
U = np.uint64
WORD = r"[^\x20\x09-\x0D]+"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


# ---------------------------------------------------------------- suffix trees

class SuffixTree:
    """Ukkonen's tree of a sequence of numbers >= 0 and a terminator below them. Inner nodes are numbered from 0 (the
    root); a leaf is the complement of its suffix. The edge into node x is text[start[x]:end[x]]."""

    def __init__(self, sequence: list[int]):
        text = [*sequence, -1]
        self.kids, self.start, self.end = [{}], [0], [0]
        kids, start, end, link = self.kids, self.start, self.end, [0]
        leaf_start = [0] * len(text)
        node = edge = length = suffix = 0  # the active point and the first suffix that has no leaf
        for i, c in enumerate(text):
            last = 0
            while suffix <= i:
                if not length:
                    edge = i
                below = kids[node]
                x = below.get(text[edge])
                if x is None:
                    below[text[edge]] = ~suffix
                    leaf_start[suffix] = i
                    if last:
                        link[last] = node
                        last = 0
                else:
                    if x >= 0:
                        a = start[x]
                        n = end[x] - a
                        if length >= n:
                            edge += n
                            length -= n
                            node = x
                            continue
                    else:
                        a = leaf_start[~x]
                    a += length
                    if text[a] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    new = len(kids)
                    kids.append({c: ~suffix, text[a]: x})
                    start.append(a - length)
                    end.append(a)
                    link.append(0)
                    leaf_start[suffix] = i
                    if x >= 0:
                        start[x] = a
                    else:
                        leaf_start[~x] = a
                    below[text[edge]] = new
                    if last:
                        link[last] = new
                    last = new
                suffix += 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = suffix

    def tour(self, opposite: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(leaves, depths): the suffixes in ascending order, and for each the string depth of its lowest common
        ancestor with the one before. `opposite`: by descending numbers, the terminator still first."""
        kids, start, end = self.kids, self.start, self.end
        leaves, depths, least = [], [], 0
        stack = [(0, 0)]
        while stack:
            x, depth = stack.pop()
            if depth < least:
                least = depth
            if x < 0:
                leaves.append(~x)
                depths.append(least)
                least = 1 << 60
                continue
            depth += end[x] - start[x]
            below = kids[x]
            names = sorted(below, reverse=not opposite)
            if opposite and names[0] < 0:
                names.append(names.pop(0))
            for c in names:
                stack.append((below[c], depth))
        return np.array(leaves, np.int64), np.array(depths, np.int64)


class CommonExtension:
    """Length of the longest common prefix of two suffixes: the least depth between their leaves on the tour."""

    def __init__(self, leaves: np.ndarray, depths: np.ndarray):
        self.place = np.empty(len(leaves), np.int64)
        self.place[leaves] = np.arange(len(leaves))
        self.least = [depths.astype(np.int32)]
        span = 1
        while 2 * span <= len(depths):
            row = self.least[-1]
            self.least.append(np.minimum(row[:-span], row[span:]))
            span *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For suffixes a != b."""
        a, b = self.place[a], self.place[b]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        out = np.empty(len(a), np.int64)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = level == k
            row = self.least[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return out


def longest_lyndon(leaves: np.ndarray, n: int) -> np.ndarray:
    """The length of the longest Lyndon word at each position: up to the next smaller suffix."""
    place = np.empty(n + 1, np.int64)
    place[leaves] = np.arange(n + 1)
    rank, ends = place.tolist(), [n] * (n + 1)
    for i in range(n - 1, -1, -1):
        j, own = i + 1, rank[i]
        while rank[j] > own:  # the terminator's suffix is the smallest
            j = ends[j]
        ends[i] = j
    return np.array(ends[:n], np.int64) - np.arange(n)


def runs_of(words: list, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """All runs (start, length, period) of the sequence, by start, then period."""
    n = len(words)
    if n < max(min_words, min_exponent):
        return np.zeros((0, 3), np.int64)
    number: dict = {}
    sequence = [number.setdefault(w, len(number)) for w in words]
    tree = SuffixTree(sequence)
    leaves, depths = tree.tour()
    roots = np.stack([longest_lyndon(leaves, n), longest_lyndon(tree.tour(opposite=True)[0], n)])
    del tree
    forward = CommonExtension(leaves, depths)
    sequence.reverse()
    backward = CommonExtension(*SuffixTree(sequence).tour())
    at, period = np.tile(np.arange(n), 2), roots.reshape(-1)
    may = period * min_exponent <= n
    at, period = at[may], period[may]
    # suffix n is the terminator's: it agrees with no other
    right, left = forward(at, at + period), backward(n - at, n - at - period)
    start, length = at - left, left + period + right
    kept = length >= np.maximum(min_words, min_exponent * period)
    return np.unique(np.stack([start[kept], period[kept], length[kept]], 1), axis=0)[:, [0, 2, 1]]


# ---------------------------------------------------------------- documents

def stretches(word: np.ndarray, first: np.ndarray, min_words: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(document, first word, end) of the stretches in which a run can be. `word`: hashes, `first`: first word of each document."""
    k = -(-min_words * (min_exponent - 1) // min_exponent)
    n = len(word) - k + 1
    if n < 2:
        return []
    h = word.copy()
    span, rest = 1, k - 1  # hashes of k words by doubling
    while rest:
        step = min(span, rest)
        h = tc.mix(h[:len(h) - step] * U(0x9E3779B97F4A7C15) + h[step:])
        span, rest = span + step, rest - step
    doc = np.searchsorted(first, np.arange(n), side="right") - 1
    at = np.flatnonzero(np.arange(n) + k <= first[doc + 1])
    key = tc.mix(h[at] ^ tc.mix(doc[at].astype(U)))
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    pair = np.flatnonzero(key[1:] == key[:-1])
    if not len(pair):
        return []
    a, b = at[pair], at[pair + 1]
    change = np.zeros(len(word) + 1, np.int64)
    np.add.at(change, np.concatenate([a, b]), 1)
    np.add.at(change, np.concatenate([a, b]) + k, -1)
    covered = np.cumsum(change[:-1]) > 0
    new = covered.copy()
    new[1:] &= ~covered[:-1]
    edge = first[(first > 0) & (first < len(word))]
    new[edge] |= covered[edge]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(word))
    name = np.cumsum(new) - 1  # the stretch of each covered word
    total = np.bincount(name[covered], minlength=len(begin))
    nearest = np.full(len(begin), len(word) + 1)
    same = name[a] == name[b]
    np.minimum.at(nearest, name[a[same]], (b - a)[same])
    end = begin + total
    may = (total >= min_words) & (nearest * min_exponent <= total)
    doc = np.searchsorted(first, begin, side="right") - 1
    return list(zip(doc[may].tolist(), begin[may].tolist(), end[may].tolist()))


def _find(min_words: int, min_exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in tc.slices(batch.column(1)):
                starts, ends, first = tc.spans(data, offsets)
                found: list[list[dict]] = [[] for _ in range(j - i)]
                kept = np.ones(len(starts), bool)
                raw = None
                for doc, a, b in stretches(tc.hash_spans(data, starts, ends), first, min_words, min_exponent):
                    raw = raw or data.tobytes()
                    words = [raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]
                    for start, length, period in runs_of(words, min_words, min_exponent).tolist():
                        found[doc].append({"start": start + a - int(first[doc]), "length": length, "period": period})
                        kept[a + start + period:a + start + length] = False
                collapsed = _joined(data, starts[kept], ends[kept], np.searchsorted(np.flatnonzero(kept), first))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array(np.diff(first)), pa.array(found, pa.list_(RUN)), collapsed],
                    ["doc_id", "n_words", "runs", "collapsed"])
    return run


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """Each document's words joined by one space."""
    sizes = ends - starts + 1
    full = first[1:] > first[:-1]
    sizes[first[1:][full] - 1] -= 1
    at = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    out = tc.gather(np.append(data, np.uint8(0x20)), starts, sizes)
    out[at[1:][sizes > ends - starts] - 1] = 0x20
    return pa.StringArray.from_buffers(len(first) - 1, pa.py_buffer(at[first].astype(np.int32)), pa.py_buffer(out))


def periodic_runs(docs: DataFrame, *, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, `runs` (start, length, period in words; by start, then period) and
    `collapsed`: the words but those after the first period of a run, joined by one space."""
    if min_exponent < 2 or min_words < min_exponent:
        raise ValueError("runs have at least two periods and as many words")
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_find(min_words, min_exponent), RESULT)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text of `docs`, a tenth of them (by crc32 of the id) with a periodic tail: stand-in input."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(w):
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        block = F.slice(w, (a + 1).cast("int"), p.cast("int"))
        many = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), F.slice(many, F.lit(1), (n - a).cast("int"))), " ")

    words = F.filter(F.array(F.regexp_extract_all("text", F.lit(WORD), 0)), lambda w: F.size(w) > 0)  # bound once
    planted = F.try_element_at(F.transform(words, tail), F.lit(1))
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(planted, "text")).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame, **options) -> DataFrame:
    """Digest columns of `periodic_runs`: the run of the greatest length / period (ties: start, then period) and sha256
    of all runs and of the collapsed text."""
    def order(x, y):
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(a > b, -1).when(a < b, 1).when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1)
                .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))

    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return periodic_runs(docs, **options).withColumn("top", F.try_element_at(F.array_sort("runs", order), F.lit(1))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"),
        F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
