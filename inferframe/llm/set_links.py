"""Connected classes of sets that share buckets and reach a similarity, hot buckets included.

Buckets that hold the same members are one bucket (told by number, least and greatest member and an xor of 64-bit
hashes), so a family that agrees in many bands is looked at once.

1. A bucket of two is its pair. In a larger one every member is paired with one centre: the member that shares most bucket places,
   as the text that a family was copied from does. That is linear in the bucket rows.
2. Buckets that still hold several classes are compared in blocks of `BLOCK` members inside tasks: each set is a bitmap of
   8 to 16 bits a shingle, and bits that only one of two sets has bound the common part from above. Of the pairs of different
   classes within the bound, a round hands on those of a maximum spanning forest over the classes (by estimate) of each block pair, so
   a family of n costs about n exact checks. Only members with a pair that was not handed on meet again, in the same block pair:
   classes only grow, so no other pair can come up later. After `FORESTS` rounds, or one without a link, all pairs left within the bound are checked.

Only pairs within the bound leave a task. The bound is never below the true common part, and every pair of different
classes is met in the last round, so no link is lost and no bucket is capped. A hot bucket's members are dealt to blocks by hash and each
pair of blocks is one group, but for two blocks of its greatest class: a family of any size that holds together is dealt once for each block
of the rest. A bucket of n unlinked members costs n(n-1)/2 comparisons of bitmaps, some tens of nanoseconds each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inferframe.llm.components import star_labels
from inferframe.llm.shared import small, written

BLOCK = 1024
FORESTS = 2
LEAST_BYTES = 64

Confirm = Callable[[DataFrame], DataFrame]


def bitmap(shingles: np.ndarray) -> bytes:
    """One bit per shingle, in a power of two of bytes not below the number of shingles. Bitmaps of different width
    compare after `folded`."""
    size = max(LEAST_BYTES, 1 << max(0, len(shingles) - 1).bit_length())
    bits = np.zeros(size * 8, bool)
    bits[(shingles & np.uint64(size * 8 - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: np.ndarray) -> np.ndarray:
    """Rows of bitmaps of half the width."""
    half = bits.shape[1] // 2
    return bits[:, :half] | bits[:, half:]


def stacked(bits: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), -1)


def filled(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


def most_common(na, nb, pa_, pb, both):
    """Upper bound of the common part: neither set has more than its shingles less the bits only it has."""
    return np.minimum(na - (pa_ - both), nb - (pb - both))


def _bound_batches(percent: int):
    """Pairs (a, b, na, nb, ca, cb, xa, xb) whose bitmaps allow the link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xa, xb = (batch.column(i).to_pylist() for i in (6, 7))
            na, nb = (batch.column(i).to_numpy() for i in (2, 3))
            keep = np.zeros(len(batch), bool)
            widths: dict[tuple[int, int], list[int]] = {}
            for i, (x, y) in enumerate(zip(xa, xb, strict=True)):
                widths.setdefault((len(x), len(y)), []).append(i)
            for at in widths.values():
                for i in range(0, len(at), BLOCK):
                    rows = np.array(at[i:i + BLOCK])
                    x, y = stacked([xa[r] for r in rows]), stacked([xb[r] for r in rows])
                    while x.shape[1] > y.shape[1]:
                        x = folded(x)
                    while y.shape[1] > x.shape[1]:
                        y = folded(y)
                    common = most_common(na[rows], nb[rows], filled(x), filled(y), filled(x & y))
                    keep[rows] = common * 100 >= (na[rows] + nb[rows] - common) * percent
            yield pa.RecordBatch.from_arrays(list(batch.filter(pa.array(keep)).columns[:6]), names=_PAIR)
    return run


_PAIR = ["a", "b", "na", "nb", "ca", "cb"]
_PAIRS = "a long, b long, na long, nb long, ca long, cb long"


def _edges(size, class_, side, cross: bool, bits: list[bytes], percent: int):
    """(common over union at most, i, j) of all pairs of different classes within the bound; across sides only if `cross`."""
    width = np.array([len(x) for x in bits])
    found = [np.zeros((3, 0))]
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        # a set of width w has at most w shingles, one of a greater width v more than v / 2: beyond this they differ too much in size
        rows, tables = [own], [stacked([bits[i] for i in own])]
        for v in [v for v in np.unique(width).tolist() if w < v and v * percent <= 200 * w]:
            rows.append(np.flatnonzero(width == v))
            wide = stacked([bits[i] for i in rows[-1]])
            while wide.shape[1] > tables[0].shape[1]:
                wide = folded(wide)
            tables.append(wide)
        rows, table = np.concatenate(rows), np.concatenate(tables)
        full, n, c, s = filled(table), size[rows], class_[rows], side[rows]
        for i in range(len(own)):
            near = i + 1 + np.flatnonzero((c[i + 1:] != c[i]) & (np.minimum(n[i + 1:], n[i]) * 100 >= np.maximum(n[i + 1:], n[i]) * percent)
                                          & ((s[i + 1:] != s[i]) if cross else True))
            if len(near):
                common = most_common(n[i], n[near], full[i], full[near], filled(table[near] & table[i]))
                union = n[i] + n[near] - common
                ok = common * 100 >= union * percent
                if ok.any():
                    found.append(np.stack([common[ok] / union[ok], np.full(ok.sum(), own[i]), rows[near[ok]]]))
    return np.concatenate(found, axis=1)


def _forest(edges: np.ndarray, class_: np.ndarray) -> np.ndarray:
    """Which edges are those of a maximum spanning forest over the classes."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    order = np.argsort(-edges[0], kind="stable")
    left = np.unique(class_).size - 1
    keep = np.zeros(edges.shape[1], bool)
    kept = 0
    for e in order.tolist():
        x, y = find(int(class_[int(edges[1, e])])), find(int(class_[int(edges[2, e])]))
        if x != y:
            root[x] = y
            keep[e] = True
            kept += 1
            if kept == left:
                break
    return keep


_AGAIN = ["bucket", "i", "j", "node", "side"]
_MET = _PAIRS + ", bucket long, i int, j int, node long, side int"


def _block_batches(percent: int, forest: bool):
    """Sorted groups (bucket, i, j): pairs of members within the bound, and the members of pairs that are not handed on (the other
    columns are null)."""
    def batch_of(columns: list[np.ndarray], first: int) -> pa.RecordBatch:
        n, types = len(columns[0]), [pa.int64()] * 7 + [pa.int32()] * 2 + [pa.int64(), pa.int32()]
        at = dict(enumerate(columns, first))
        return pa.RecordBatch.from_arrays([pa.array(at[k], t) if k in at else pa.nulls(n, t) for k, t in enumerate(types)], names=[*_PAIR, *_AGAIN])

    def judge(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        node, size, class_, side = (np.array([g[k] for g in group], np.int64) for k in (3, 4, 5, 6))
        edges = _edges(size, class_, side, group[0][1] != group[0][2], [g[7] for g in group], percent)
        if not edges.shape[1]:
            return
        keep = _forest(edges, class_) if forest else np.ones(edges.shape[1], bool)
        i, j = edges[1:, keep].astype(np.int64)
        i, j = np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)
        yield batch_of([node[i], node[j], size[i], size[j], class_[i], class_[j]], 0)
        again = np.unique(edges[1:, ~keep].astype(np.int64))
        if len(again):
            yield batch_of([*(np.full(len(again), v) for v in group[0][:3]), node[again], side[again]], 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    yield from judge(held)
                    held = []
                held.append(row)
        if held:
            yield from judge(held)
    return run


def linked(rows: DataFrame, prepare: Callable[[DataFrame], tuple[Confirm, DataFrame, int]]) -> DataFrame | None:
    """(node, root) of all nodes that share a bucket; None when no two do.

    rows: (bucket, node), each once. prepare: gets the members that share a bucket (node) and returns a function that takes pairs
    (a, b, na, nb, ca, cb) and returns the linked ones of them, the members' sizes and bitmaps (node, size, bits), and the percent
    that the common part of two linked sets reaches of their union."""
    # plain numbers, hashed: of most buckets one row is shuffled, and a struct or a size would widen each
    buckets = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"),
                                         F.bit_xor(F.xxhash64("node")).alias("mark")).where("n > 1")
    buckets = written(buckets.groupBy("n", "lo", "hi", "mark").agg(F.min("bucket").alias("bucket")), "buckets")
    if not buckets.limit(1).count():
        return None
    more = written(rows.select("bucket", "node").join(small(buckets.where("n > 2").select("bucket", "n")), "bucket"), "members")
    two = buckets.where("n = 2")
    nodes = written(two.select(F.explode(F.array("lo", "hi")).alias("node")).unionByName(more.select("node")).distinct(), "candidates")
    confirm, sets, percent = prepare(nodes)
    sizes, bits = sets.select("node", "size"), sets.select("node", "bits")
    places = more.groupBy("node").agg(F.sum("n").alias("places"))
    centres = more.join(places, "node").groupBy("bucket").agg(F.max(F.struct("places", "node")).alias("c"))
    hubs = more.join(centres.select("bucket", F.col("c.node").alias("centre")), "bucket").where(F.col("node") != F.col("centre")) \
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    pairs = two.select(F.col("lo").alias("a"), F.col("hi").alias("b")).unionByName(hubs).distinct() \
        .join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b") \
        .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) \
        .select("a", "b", "na", "nb", F.col("a").alias("ca"), F.col("b").alias("cb"))
    x, y = bits.toDF("a", "xa"), bits.toDF("b", "xb")
    pairs = pairs.join(x, "a").join(y, "b").select(*_PAIR, "xa", "xb").mapInArrow(_bound_batches(percent), _PAIRS)
    label = sizes.select("node", "size", F.col("node").alias("class"))
    label, _ = _merged(label, confirm(written(pairs, "pairs")))
    sorted_ = more.join(label, "node")
    parts = sorted_.groupBy("bucket", "class").agg(F.count("*").alias("c"))
    still = parts.groupBy("bucket").agg(F.max(F.struct("c", "class")).alias("main"), F.count("*").alias("k")).where("k > 1").select("bucket", "main")
    open_ = written(sorted_.join(still, "bucket").select("bucket", "n", "node", "size", "class", "main"), "open")
    groups, forests = _dealt(open_), FORESTS if open_.limit(1).count() else -1
    while forests >= 0:
        forest, forests = forests > 0, forests - 1
        dealt = groups.join(bits, "node").select("bucket", "i", "j", "node", "size", "class", "side", "bits")
        met = written(dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
                      .mapInArrow(_block_batches(percent, forest), _MET), "met")
        pairs = written(met.where("a is not null").select(*_PAIR).distinct(), "pairs")
        if not pairs.limit(1).count():
            break
        label, found = _merged(label, confirm(pairs))
        if not found:
            forests = min(forests, 0)
        again = met.where("node is not null").select(*_AGAIN)
        if not again.limit(1).count():
            break
        groups = again.join(label, "node")
    return label.select("node", F.col("class").alias("root"))


def _dealt(open_: DataFrame) -> DataFrame:
    """(bucket, i, j, node, size, class, side): the members of open buckets, once for each pair of blocks i <= j that they are compared in.

    A bucket of one block is one group. In a larger one the members of its greatest class (`main`: its size and name), which need no
    comparison with each other, fill blocks of their own that meet the blocks of the rest only."""
    row = ["node", "size", "class", "side"]
    one = open_.where(F.col("n") <= BLOCK).select("bucket", F.lit(0).alias("i"), F.lit(0).alias("j"), "node", "size", "class", F.lit(0).alias("side"))
    inner = F.col("class") == F.col("main.class")
    mains, rests = (F.ceil(c / BLOCK).cast("int") for c in (F.col("main.c"), F.col("n") - F.col("main.c")))
    hash_ = F.xxhash64("node")
    many = open_.where(F.col("n") > BLOCK) \
        .withColumn("side", F.when(inner, rests + F.pmod(hash_, mains)).otherwise(F.pmod(hash_, rests)).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(inner, rests).otherwise(rests + mains) - 1))) \
        .select("bucket", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), *row)
    return one.unionByName(many)


def _merged(label: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
    """label with the classes that the links join made one, and whether there were any."""
    links = written(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "links")
    if not links.limit(1).count():
        return label, False
    roots = star_labels(links).select(F.col("node").alias("class"), "root")
    return written(label.join(roots, "class", "left").select("node", "size", F.coalesce("root", "class").alias("class")), "labels"), True
