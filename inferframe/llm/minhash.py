"""Near-duplicate documents by min-max hashing.

Each permutation of a document's word shingles gives two signature values, its minimum and its
maximum, so a signature of n values costs n / 2 hash evaluations per shingle. Minimum and maximum
agree between two documents with probability equal to their Jaccard similarity each, and
nearly independently, so the estimate keeps the usual mean with a lower variance per evaluation.

Steps
1. One pass over the texts: distinct shingles, signature bands and two 64-bit digests of the
   shingle set per document (`signatures`).
2. Documents with equal sets form one class at once (sets are told apart by a 64-bit digest); only one
   representative per class goes on, so thousands of exact copies cost one row each.
3. Representatives meet in band buckets; `set_links.linked` compares members, first with one centre a bucket, then in blocks
   where a bucket still holds several classes. A bitmap of each set bounds the common part of two sets from above (bits that only one
   has count shingles that only it has); pairs within the bound are decided on the whole shingle sets. No link is lost, and
   a family costs about its number of members in exact checks.

Bands: `rows` values per band and as many bands as bring the chance to miss a pair at exactly the
threshold under `miss` (1e-6: 30 bands for 0.85, 46 for 0.8; closer pairs are missed less). Sets too small for two different sets to reach the
threshold can only be linked when equal, which step 2 settles without any chance.

Defined results: a null or empty text, or one without words, has no shingles, is its own class and
is linked with nothing. A null doc_id takes part, but a class is named by its smallest non-null
doc_id; `kept` is false where doc_id is null. Rows that repeat a doc_id are all judged; all of them
carry the same answer if their texts are equal. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from inferframe.llm import textcore as T
from inferframe.llm.set_links import _PAIR, _PAIRS, bitmap, linked
from inferframe.llm.shared import ship, small, written

def bands_for(percent: int, rows: int, miss: float) -> int:
    """Bands that keep the chance to miss a pair at exactly `percent` similarity under `miss`."""
    return math.ceil(math.log(miss) / math.log1p(-(percent / 100) ** rows))


def _sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, with document offsets."""
    word, first = T.words(T.lower_ascii(data), offsets)
    sh, at = T.shingles(word, first, k)
    unique = [np.unique(sh[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    out = np.zeros(len(at), np.int64)
    np.cumsum([len(u) for u in unique], out=out[1:])
    return (np.concatenate(unique) if unique else sh), out


def _digests(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Order-free 64-bit digest of each set."""
    total = T.reduce_rows(np.add, T.mix(sets ^ T.U(0xA0761D6478BD642F)), at, T.U(0))
    return T.mix(total + np.diff(at).astype(T.U)).view(np.int64)


def _signature_batches(k: int, rows: int, bands: int):
    half = bands * rows // 2
    rng = np.random.default_rng(77)
    mul = rng.integers(1, 1 << 63, half, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(1, 1 << 63, half, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in T.slices(batch.column(1)):
                sets, at = _sets(data, offsets, k)
                n, size = j - i, np.diff(at)
                full = np.flatnonzero(size > 0)
                keys = np.zeros((len(full), bands), np.uint64)
                if len(full):
                    for p in range(half):
                        v = sets * mul[p]
                        v += add[p]
                        v ^= v >> T.U(32)
                        v *= T.U(0xD6E8FEB86659FD93)
                        low, high = np.minimum.reduceat(v, at[full]), np.maximum.reduceat(v, at[full])
                        b = p // (rows // 2)
                        keys[:, b] = T.mix(keys[:, b] * T.U(0x9FB21C651E98DF25) + low) + high
                    keys = T.mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * T.U(0x9E3779B97F4A7C15))
                lists = np.zeros(n + 1, np.int32)
                lists[1 + full] = bands
                yield pa.RecordBatch.from_arrays([
                    ids.slice(i, n), pa.array(size.astype(np.int64)), pa.array(_digests(sets, at)),
                    pa.ListArray.from_arrays(np.cumsum(lists, dtype=np.int32), pa.array(keys.view(np.int64).ravel()))],
                    names=["doc_id", "n_shingles", "digest", "bands"])
    return run


def _candidate_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in T.slices(batch.column(1)):
                sets, at = _sets(data, offsets, k)
                yield pa.RecordBatch.from_arrays([
                    pa.array(_digests(sets, at)), pa.array(np.diff(at).astype(np.int64)),
                    pa.array([bitmap(sets[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                    batch.column(1).slice(i, j - i)], names=["node", "size", "bits", "text"])
    return run


def _confirm_batches(k: int, percent: int):
    """Pairs (a, b, na, nb, ca, cb, ta, tb) whose texts' whole sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in T.slices(batch.column(6)):
                rows = batch.slice(i, j - i)
                x, at = _sets(data, offsets, k)
                y, bt = _sets(*T.strings(rows.column(7)), k)
                common = np.array([len(np.intersect1d(x[at[r]:at[r + 1]], y[bt[r]:bt[r + 1]], assume_unique=True)) for r in range(j - i)], np.int64)
                linked_ = common * 100 >= (np.diff(at) + np.diff(bt) - common) * percent
                yield pa.RecordBatch.from_arrays(list(rows.filter(pa.array(linked_)).columns[:6]), names=_PAIR)
    return run


def signatures(docs: DataFrame, k: int, rows: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, digest of the shingle set, band keys (none without shingles)."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _signature_batches(k, rows, bands),
        "doc_id long, n_shingles long, digest long, bands array<long>")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, rows: int = 6,
                    miss: float = 1e-6) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text): documents are
    linked when 100 * |A and B| >= percent * |A or B| over distinct word shingles."""
    return _judged(docs, shingle_words, percent, rows, miss).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _judged(docs: DataFrame, shingle_words: int = 5, percent: int = 80, rows: int = 6, miss: float = 1e-6) -> DataFrame:
    """doc_id, n_shingles, node (digest of the set), root (one node of its class), component_id of every row of docs."""
    if rows % 2:
        raise ValueError("rows counts minima and maxima in pairs: it must be even")
    spark = docs.sparkSession
    ship(spark)
    bands = bands_for(percent, rows, miss)
    sig = written(signatures(docs, shingle_words, rows, bands), "signatures")
    full = sig.where("n_shingles > 0")
    # one representative per set; the smallest doc_id names it
    classes = written(full.groupBy(F.col("digest").alias("node")).agg(
        F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    # two different sets need at least this many shingles to reach the threshold
    least = math.ceil(percent / (100 - percent)) if percent < 100 else 1 << 60
    banded = classes.where(F.col("n") >= least).select("node", F.explode("bands").alias("bucket"))

    def prepare(nodes: DataFrame):
        found = candidates(docs, nodes.join(classes.select("node", "first_id"), "node"), shingle_words)

        def confirm(pairs: DataFrame) -> DataFrame:
            # only texts of these pairs move, each to its pair: a text is smaller than the 64-bit hashes of its set
            sides = pairs.select(*_PAIR, F.explode(F.array("a", "b")).alias("node"))
            side = found.select("node", "text").join(small(sides), "node").groupBy(*_PAIR)
            both = side.agg(*(F.max(F.when(F.col("node") == F.col(v), F.col("text"))).alias(f"t{v}") for v in ("a", "b")))
            return both.mapInArrow(_confirm_batches(shingle_words, percent), _PAIRS)

        return confirm, found.select("node", "size", "bits"), percent

    roots = linked(banded, prepare)
    if roots is None:
        named = classes.select("node", F.col("node").alias("root"), F.col("first_id").alias("component_id"))
    else:
        root = F.coalesce("root", "node")
        all_ = classes.join(roots, "node", "left").select("node", "first_id", root.alias("root"))
        names = all_.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = written(all_.join(names, "root").select("node", "root", "component_id"), "named")
    out = sig.select("doc_id", "n_shingles", F.col("digest").alias("node")).join(named, "node", "left")
    name = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", "node", "root", name.alias("component_id"))


def candidates(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, size, bits, text): size and bitmap of the set of every candidate class, and a text that has this set: that of the
    document that names it. The id list is broadcast when it is counted small, else shuffled."""
    ids = small(nodes.select(F.col("first_id").alias("doc_id")).distinct())
    text = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # null ids name classes too: null-safe
    wanted = text.join(ids.withColumnRenamed("doc_id", "wanted"), F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    found = wanted.mapInArrow(_candidate_batches(k), "node long, size long, bits binary, text string")
    return written(found.join(nodes.select("node"), "node").dropDuplicates(["node"]), "texts")


def _node_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in T.slices(batch.column(0)):
                sets, at = _sets(data, offsets, k)
                digest = pa.array(_digests(sets, at), mask=np.diff(at) == 0)
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns[1:]), digest],
                                                 names=[*batch.schema.names[1:], "__node"])
    return run


def drop_near_duplicates(docs: DataFrame, **params) -> DataFrame:
    """docs with one row of each class left, columns unchanged: a row of the smallest doc_id, or of a null id
    where no row of the class has a name. Rows that repeat a doc_id, or have none, are told apart by their shingle
    sets; those without shingles collapse to one (any of them) where doc_id and text are equal."""
    judged = written(_judged(docs, **params), "judged")
    # ids that don't stand: those of several rows, and those of one row that goes. Where these are few no text is shuffled for them
    same = written(judged.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("same"), F.first("component_id").alias("name"))
                   .where("same > 1 or name <> doc_id"), "same")
    key = docs["doc_id"].cast("long")
    # an id of one row stands for its row, without another look at the text
    single = docs.where(key.isNotNull()).join(small(same.select(F.col("doc_id").alias("__id"))), key == F.col("__id"), "left_anti")
    many = docs.join(small(same.where("same > 1").select(F.col("doc_id").alias("__id"))), key == F.col("__id"), "left_semi") \
        .unionByName(docs.where(key.isNull()))
    hidden = [ST.StructField(f"__c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    extra = [ST.StructField("__id", ST.LongType()), ST.StructField("__text", ST.StringType()), ST.StructField("__node", ST.LongType())]
    text = F.col("text").cast("string")
    noded = many.select(text.alias("__in"), *(many[f"`{c}`"].alias(h.name) for c, h in zip(docs.columns, hidden, strict=True)),
                        F.col("doc_id").cast("long").alias("__id"), text.alias("__text")) \
        .mapInArrow(_node_batches(params.get("shingle_words", 5)), ST.StructType([*hidden, *extra]))
    first = judged.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("w")) \
        .select(F.col("w.doc_id").alias("__first"), F.col("w.node").alias("__first_node"))
    chosen = noded.where("__node is not null").join(
        first, (F.col("__node") == F.col("__first_node")) & F.col("__id").eqNullSafe(F.col("__first")), "left_semi").dropDuplicates(["__node"])
    bare = noded.where("__node is null").dropDuplicates(["__id", "__text"])
    rest = chosen.unionByName(bare).select(*(F.col(h.name).alias(c) for c, h in zip(docs.columns, hidden, strict=True)))
    return single.unionByName(rest)
