"""Document fingerprints by SimHash, and all fingerprints within a Hamming radius.

Terms are 2-word shingles of the lower-cased text (the single word of a one-word text), weighted by how
often they occur. Each term's 128 hash bits vote with that weight, plus for a one and minus for a
zero; the signs of the sums are the fingerprint (32 hex digits, a sum of zero gives a zero bit). Two
texts whose weighted term vectors lie at angle a differ in a / pi of the bits on average, so
`likeness` turns a share d of differing bits into the cosine cos(pi d), cut off at 0.

Near pairs: `near_classes` cuts the fingerprint into radius + 2 blocks. Fingerprints within the radius
agree in at least two blocks, so permuted tables, one for each two blocks, keyed by both (51 bits or so at the
default radius of 3; hashed, so a collision only adds a candidate), meet every pair. Candidates are compared on all bits
within the join, so only links leave it. Equal fingerprints are one class beforehand, and members of a bucket are
linked by `components.linked`; a bucket whose members are not linked costs comparisons of two words a pair, no rows.

The next document in descending doc_id order is found without a global sort: doc_id quantiles cut
the ids into ranges, one shuffle brings each range together, and each range also receives a copy
of the following range's first document (`with_next`). Ranges are sized by the text bytes in
them; the sort inside a task is external (Spark's).

Defined results: null text counts as empty. A text without words has the all-zero fingerprint; two
such texts have likeness 1. Null doc_ids come last in the order; equal ids are ordered by their text.
With one row the next document is the row itself. An empty table gives an empty result, extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inferframe.llm import textcore as T
from inferframe.llm.components import linked
from inferframe.llm.shared import ship, written

BITS = 128
RADIUS = 3
TERM_WORDS = 2
RANGE_BYTES = 16 << 20
RANGES_MOST = 20_000
VOTES = 1 << 15


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, 2) 64-bit words of each text's fingerprint."""
    word, first = T.words(T.lower_ascii(data), offsets)
    terms, at = T.shingles(word, first, TERM_WORDS)
    votes = np.zeros((len(offsets) - 1, BITS), np.int64)
    docs = np.repeat(np.arange(len(at) - 1), np.diff(at))
    # bits of VOTES terms at a time; a document that spans two stretches adds up
    for i in range(0, len(terms), VOTES):
        h = terms[i:i + VOTES]
        bits = np.unpackbits(np.stack([h, T.mix(h ^ T.U(0x5851F42D4C957F2D))], 1).view(np.uint8).reshape(len(h), 16), axis=1)
        d = docs[i:i + VOTES]
        edge = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        ones = np.add.reduceat(bits, edge, axis=0, dtype=np.int32)
        size = np.diff(np.concatenate([edge, [len(d)]]))
        votes[d[edge]] += 2 * ones - size[:, None]
    return np.packbits(votes > 0, axis=1).view(np.uint64)


def _encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return T.strings(pa.array(texts, pa.large_string()))


def fingerprint_texts(texts: list[str]) -> np.ndarray:
    """Fingerprints of Python strings, a bounded number of bytes at a time."""
    out, i = [np.zeros((0, 2), np.uint64)], 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= T.SLICE_BYTES):
            size += len(texts[j])
            j += 1
        out.append(fingerprints(*_encode(texts[i:j])))
        i = j
    return np.concatenate(out)


def hexed(prints: np.ndarray) -> list[str]:
    raw = np.ascontiguousarray(prints).tobytes().hex()
    return [raw[i:i + 32] for i in range(0, len(raw), 32)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine estimated from the differing bits of two fingerprints, between 0 and 1."""
    different = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return np.maximum(0.0, np.cos(math.pi * different / BITS))


def edit(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """Ranges of docs for `grouped` use: rows range, rank (0 own, 1 the following range's first
    document), doc_id, text, so that sorting a range by (rank, doc_id descending, text) chains each text to its next."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # ranges from id quantiles; their number follows the text bytes
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("doc_id")).first()
    n = int(min(RANGES_MOST, max(1, size[0] // RANGE_BYTES)))
    bounds = []
    if n > 1 and size[1]:
        at = [i / n for i in range(1, n)]
        bounds = sorted(set(rows.select(F.percentile_approx("doc_id", at, 10 * n).alias("q")).first().q))
    # range 0 holds the largest ids; ids equal to a bound belong to the range above it
    high = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    place = F.when(F.col("doc_id").isNull(), F.lit(len(bounds))) \
        .otherwise(F.lit(len(bounds)) - F.size(F.filter(high, lambda b: b <= F.col("doc_id"))))
    own = rows.withColumn("range", place.cast("int"))
    # the first document of each range: its largest id, then its smallest text (nulls last)
    first = own.groupBy("range").agg(F.max("doc_id").alias("top")).collect()  # one row per range
    present = sorted(r.range for r in first)
    before = {present[i]: present[i - 1] for i in range(len(present))}  # cyclic: the first follows the last
    tops = {r.range: r.top for r in first}
    heads = None
    if present:
        wanted = [F.col("doc_id").eqNullSafe(F.lit(tops[p]).cast("long")) & (F.col("range") == p) for p in present]
        known = F.array(*[F.lit(tops[p]).cast("long") for p in present if tops[p] is not None])
        some = (F.array_contains(known, F.col("doc_id")) | F.col("doc_id").isNull()) if len(wanted) > 8 else wanted[0]
        for w in wanted[1:] if len(wanted) <= 8 else ():
            some = some | w
        to = F.element_at(F.create_map(*[F.lit(x) for p in present for x in (p, before[p])]), F.col("range"))
        top = F.element_at(F.create_map(*[x for p in present for x in (F.lit(p), F.lit(tops[p]).cast("long"))]), F.col("range"))
        heads = own.where(some).where(F.col("doc_id").eqNullSafe(top)).groupBy("range", "doc_id").agg(F.min("text").alias("text")) \
            .select(to.alias("range"), F.lit(1).alias("rank"), "doc_id", "text")
    out = own.select("range", F.lit(0).alias("rank"), "doc_id", "text")
    return out.unionByName(heads) if heads is not None else out


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ranges, one after the other: judge each document with the one that follows it."""
    held: tuple[int, int | None, str] | None = None
    for batch in batches:
        where, rank, ids, texts = (batch.column(i) for i in range(4))
        for i in range(0, len(batch), 1024):
            rows = list(zip(where.slice(i, 1024).to_pylist(), rank.slice(i, 1024).to_pylist(),
                            ids.slice(i, 1024).to_pylist(), texts.slice(i, 1024).to_pylist(), strict=True))
            todo, follow = [], []
            for r, k, d, text in rows:
                if held is not None and held[0] == r:
                    todo.append(held)
                    follow.append(text)
                held = (r, d, text) if k == 0 else None
            if todo:
                yield _judged(todo, follow)


def _judged(todo: list[tuple[int, int | None, str]], follow: list[str]) -> pa.RecordBatch:
    own = [t for _, _, t in todo]
    edited = [edit(t, f) for t, f in zip(own, follow, strict=True)]
    # a chain's next text is mostly the following row's own text: fingerprint each once
    prints = fingerprint_texts(own)
    after = np.empty_like(prints)
    same = [i for i in range(len(own) - 1) if follow[i] is own[i + 1]]
    after[same] = prints[[i + 1 for i in same]]
    other = sorted(set(range(len(own))) - set(same))
    after[other] = fingerprint_texts([follow[i] for i in other])
    changed = fingerprint_texts(edited)
    return pa.RecordBatch.from_arrays([
        pa.array([d for _, d, _ in todo], pa.int64()), pa.array([len(t) for t in own], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]), pa.array(hexed(prints)), pa.array(hexed(changed)),
        pa.array(likeness(prints, changed)), pa.array(likeness(prints, after))], names=_NAMES)


def edited_likeness(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    ship(docs.sparkSession)
    ranges = with_next(docs)
    parts = max(1, ranges.sparkSession.sparkContext.defaultParallelism)
    n = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(max(n, parts), "range") \
        .sortWithinPartitions("range", "rank", F.desc_nulls_last("doc_id"), "text") \
        .mapInArrow(_edit_batches, _SCHEMA)


def near_classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, near_class) for prints (doc_id, fingerprint): near_class is the smallest doc_id of
    the class connected by fingerprints that differ in at most `radius` bits."""
    classes = written(prints.groupBy(F.col("fingerprint").alias("node")).agg(F.min("doc_id").alias("first_id")), "fingerprints")
    # radius + 2 blocks, a table for each two of them: fingerprints within the radius agree in two blocks at least
    n = radius + 2
    cuts = [round(32 * i / n) for i in range(n + 1)]
    blocks = [F.substring("node", cuts[i] + 1, cuts[i + 1] - cuts[i]) for i in range(n)]
    keys = F.array(*[F.xxhash64(F.lit(n * i + j), blocks[i], blocks[j]) for i in range(n) for j in range(i + 1, n)])
    rows = classes.select(F.explode(keys).alias("bucket"), "node")

    def half(c: str, i: int) -> Column:
        # signed 64-bit value of 16 hex digits, in two 32-bit parts
        high = F.conv(F.substring(c, 16 * i + 1, 8), 16, 10).cast("long")
        low = F.conv(F.substring(c, 16 * i + 9, 8), 16, 10).cast("long")
        return F.shiftleft(high, 32).bitwiseOR(low)

    def within(x: Column, y: Column) -> Column:
        return F.bit_count(x["a"].bitwiseXOR(y["a"])) + F.bit_count(x["b"].bitwiseXOR(y["b"])) <= radius

    def bits(c: str) -> Column:
        return F.struct(half(c, 0).alias("a"), half(c, 1).alias("b"))

    def prepare(spread: DataFrame):
        # a pair that meets this condition is a link, so none is handed on that is not
        return lambda pairs: pairs, spread.withColumn("weight", F.lit(0.0)).withColumn("info", bits("node")), within

    roots = linked(rows, prepare)
    if roots is None:
        return classes.select(F.col("node").alias("fingerprint"), F.col("first_id").alias("near_class"))
    rooted = classes.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    names = written(rooted.groupBy("root").agg(F.min("first_id").alias("near_class")), "names")
    return rooted.join(names, "root").select(F.col("node").alias("fingerprint"), "near_class")


def fingerprint_report(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`edited_likeness` with near_class, the class of fingerprints within the radius, per document."""
    found = written(edited_likeness(docs), "simhash")
    return found.join(near_classes(found.select("doc_id", "fingerprint"), radius), "fingerprint", "left") \
        .select(*_NAMES, "near_class")
