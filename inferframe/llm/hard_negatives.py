"""Operator 13: hard negatives of anchor vectors.

A row's score for an anchor is the inner product of the two integer vectors floor(scale * x). An anchor's positives are its
`positives` best other rows of the same label; for each of them, its negatives are the `negatives` best rows of another label
with low * positive <= 100 * negative <= high * positive. Higher scores come first, ties by the smaller vec_id (null last).

Method: anchors are grouped by the signs of fixed random projections, so that near ones meet, into trees of about
`TREE` anchors, each a minimum spanning tree by Euclidean distance. A candidate c is scored exactly at the tree's root; for
every other anchor its score lies within distance(anchor, parent) * |c| of the bounds known for the parent, by
Cauchy's inequality. Only candidates whose interval meets the anchor's window are scored exactly, which narrows the
intervals below. The window is, for positives, everything down to the worst of the best so far; for negatives the
hull of the windows of its positives, above the worst kept so far. Each anchor ends with the same rows as by scoring all.

Anchors and rows meet in tiles of at most `TILE_TREES` trees and `TILE_BYTES` of rows, both dealt evenly by
hashes of the row, so no label, vector or anchor decides a task's size; a tile passes on at most `positives` or
`positives * negatives` rows an anchor. The search compares every anchor with every row in the worst case.

Edge cases. Rows with a null label, a null vector or any null or non-finite component take no part. Vectors of
different lengths: missing components count as 0. Null vec_id: no anchor by itself (`anchor` decides; null counts as
false), a candidate like any other. Rows with the same vec_id are different rows, each an anchor or a candidate of
its own, in the order of the stored rows where all else is equal. Scores beyond 64 bits are cut to the largest or smallest
long before they are compared. No anchors, or an empty table: an empty result. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inferframe.llm.shared import ship, written

TREE = 1024
TILE_TREES = 16
TILE_BYTES = 32 << 20
CHUNK = 4096
SIGNS = 12
#: share of candidates above which a matrix product is cheaper than single ones
DENSE = 0.12
EXACT = float(1 << 53)
LONG = (1 << 63) - 1

ROW = "row long, vec_id long, label long, anchor boolean, code int, wide boolean, vector binary"
ANCHOR = "row long, vec_id long, label long, wide boolean, vector binary, tree long, place int, parent int, edge double"
FOUND = "anchor_row long, nth int, row long, vec_id long, score long"


# ---------------------------------------------------------------- vectors

def _quantised(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            vec_id, label, anchor, vector = batch.columns
            flat = pc.fill_null(pc.list_flatten(vector).cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
            size = pc.fill_null(pc.list_value_length(vector), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.zeros(len(size) + 1, np.int64)
            np.cumsum(size, out=at[1:])
            bad = np.zeros(len(flat) + 1, np.int64)
            np.cumsum(~np.isfinite(flat), out=bad[1:])
            good = (bad[at[1:]] == bad[at[:-1]]) & pc.and_(vector.is_valid(), label.is_valid()).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                flat = np.floor(scale * flat)
            row = number + np.arange(len(size))
            number += len(size)
            for n in np.unique(size[good]).tolist():
                own = np.flatnonzero(good & (size == n))
                x = flat[at[own][:, None] + np.arange(n)]
                top = np.abs(x).max(1, initial=0)
                if n not in planes:
                    planes[n] = np.random.default_rng(n).standard_normal((n, SIGNS))
                bits = (x / np.maximum(top, 1)[:, None]) @ planes[n] > 0
                wide = top >= 1 << 31
                packed = [(v.astype("<f8") if w else v.astype("<i4")).tobytes() for v, w in zip(x, wide.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[own]), vec_id.take(pa.array(own)), label.take(pa.array(own)), anchor.take(pa.array(own)),
                     pa.array(_gray_order(bits @ (1 << np.arange(SIGNS))).astype(np.int32)), pa.array(wide), pa.array(packed, pa.binary())],
                    ["row", "vec_id", "label", "anchor", "code", "wide", "vector"])
    return run


def _gray_order(code: np.ndarray) -> np.ndarray:
    """The place of a code in the Gray sequence: neighbours there differ in one sign."""
    for shift in (1, 2, 4, 8):
        code = code ^ code >> shift
    return code


def _matrix(table: pa.Table, width: int = 0) -> np.ndarray:
    """The vectors of a table as float64 rows, zeros behind the shorter ones."""
    rows = [np.frombuffer(v, "<f8" if w else "<i4") for v, w in zip(table["vector"].to_pylist(), table["wide"].to_pylist())]
    out = np.zeros((len(rows), max([width, *map(len, rows)])))
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


def _ids(table: pa.Table) -> np.ndarray:
    return table["vec_id"].fill_null(LONG).to_numpy()


def _integers(x: np.ndarray) -> np.ndarray:
    return np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object)


def _largest(x: np.ndarray) -> float:
    return float(np.sqrt((x * x).sum(1).max(initial=0)))


def all_products(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of each row of a with each row of c."""
    if _largest(a) * _largest(c) < EXACT:
        return (a @ c.T).astype(np.int64)
    return np.clip(_integers(a) @ _integers(c).T, -LONG - 1, LONG).astype(np.int64)


def pair_products(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of a and c at the same places."""
    if _largest(a) * _largest(c) < EXACT:
        return np.einsum("ij,ij->i", a, c).astype(np.int64)
    return np.clip((_integers(a) * _integers(c)).sum(1), -LONG - 1, LONG).astype(np.int64)


# ---------------------------------------------------------------- trees

def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): Prim's minimum spanning tree; order[0] is the root, parent[i] the place in that order of
    the i-th one's parent, edge[i] their distance."""
    n = len(vectors)
    order, parent, edge = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    near, by, free = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool)
    at = 0
    for i in range(n):
        order[i], free[at] = at, False
        if i:
            parent[i], edge[i] = by[at], near[at]
        if i + 1 < n:
            far = np.sqrt(((vectors - vectors[at]) ** 2).sum(1))
            closer = far < near
            near[closer], by[closer] = far[closer], i
            at = int(np.argmin(np.where(free, near, np.inf)))
            if not free[at]:  # distances beyond a double: any free one will do, its bounds are infinite
                at = int(np.argmax(free))
    return order, parent, edge


def _plant(table: pa.Table) -> pa.Table:
    table = table.sort_by([("row", "ascending")])
    order, parent, edge = spanning_tree(_matrix(table))
    table = table.select(["row", "vec_id", "label", "wide", "vector", "tree"]).take(pa.array(order))
    for name, column in (("place", pa.array(np.arange(len(order)), pa.int32())), ("parent", pa.array(parent, pa.int32())),
                         ("edge", pa.array(edge))):
        table = table.append_column(name, column)
    return table


def _levels(parent: np.ndarray) -> list[np.ndarray]:
    depth = np.zeros(len(parent), np.int64)
    for i in range(1, len(parent)):
        depth[i] = depth[parent[i]] + 1
    return [np.flatnonzero(depth == d) for d in range(1, int(depth.max(initial=0)) + 1)]


def _first(keep: int, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """The `keep` best of each slot, best first."""
    order = np.lexsort((row, vec_id, ~score, slot))  # ~score falls as score rises, without overflow
    slot = slot[order]
    kept = np.arange(len(slot)) - np.searchsorted(slot, slot) < keep
    return [slot[kept], *(x[order][kept] for x in (score, vec_id, row))]


class _Best:
    """The best `keep` rows of each slot; `worst`: what a score must reach to enter."""

    def __init__(self, slots: int, keep: int):
        self.keep = keep
        self.worst = np.full(slots, -LONG - 1)
        self.kept = [np.zeros(0, np.int64)] * 4
        self.new: list[list[np.ndarray]] = []

    def add(self, *found: np.ndarray) -> None:
        may = found[1] >= self.worst[found[0]]
        self.new.append(_first(self.keep, *(x[may] for x in found)))

    def settle(self) -> None:
        """Merge what came since the last call."""
        self.kept = _first(self.keep, *(np.concatenate(x) for x in zip(self.kept, *self.new)))
        self.new = []
        slot, score = self.kept[:2]
        full = np.arange(len(slot)) - np.searchsorted(slot, slot) == self.keep - 1
        self.worst[slot[full]] = score[full]


def _around(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of exact scores as doubles."""
    near = score.astype(np.float64)
    slack = np.abs(near) * 2.0 ** -51
    return near - slack, near + slack


def bounded_scores(vectors: np.ndarray, parent: np.ndarray, edge: np.ndarray, candidates: np.ndarray, wanted, take) -> int:
    """Walk a tree over the candidates. `wanted(places, low, high)` says which (anchor, candidate) pairs overlap their windows,
    `take(place, candidate, score)` receives their exact scores. Returns how many pairs were scored exactly."""
    norm = np.sqrt((candidates * candidates).sum(1))
    low, high = np.empty((len(vectors), len(candidates))), np.empty((len(vectors), len(candidates)))
    score = all_products(vectors[:1], candidates)
    low[:1], high[:1] = _around(score)
    place, at = np.nonzero(wanted(np.zeros(1, np.int64), low[:1], high[:1]))
    take(place, at, score[place, at])
    scored = len(candidates)
    for level in _levels(parent):
        for some in np.array_split(level, -(-len(level) // 64)):
            with np.errstate(invalid="ignore", over="ignore"):
                reach = edge[some][:, None] * norm * (1 + 1e-9) + 1
                below, above = low[parent[some]] - reach, high[parent[some]] + reach
            below[np.isnan(below)], above[np.isnan(above)] = -np.inf, np.inf
            mask = wanted(some, below, above)
            place, at = np.nonzero(mask)
            if len(place) > DENSE * mask.size:
                whole = all_products(vectors[some], candidates)
                below, above = _around(whole)
                score = whole[place, at]
                scored += mask.size
            else:
                score = np.concatenate([np.zeros(0, np.int64), *(
                    pair_products(vectors[some[place[i:i + 65536]]], candidates[at[i:i + 65536]]) for i in range(0, len(place), 65536))])
                below[place, at], above[place, at] = _around(score)
                scored += len(place)
            low[some], high[some] = below, above
            take(some[place], at, score)
    return scored


def _tile(anchors: pa.Table, rows: pa.Table, slots: int, keep: int, search) -> pa.Table:
    """Run `search` over each tree of the tile and each chunk of its rows; slots: results of `keep` rows an anchor."""
    out = []
    if len(anchors) and len(rows):
        rows, anchors = rows.sort_by([("row", "ascending")]), anchors.sort_by([("tree", "ascending"), ("place", "ascending")])
        width = max(_matrix(anchors).shape[1], 1)
        candidates = _matrix(rows, width)
        vectors = _matrix(anchors, candidates.shape[1])
        ids, names, labels = _ids(rows), rows["row"].to_numpy(), rows["label"].to_numpy()
        tree = anchors["tree"].to_numpy()
        for t in np.unique(tree):
            a, b = np.searchsorted(tree, [t, t + 1])
            own = anchors.slice(a, b - a)
            best = _Best(slots * len(own), keep)
            for i in range(0, len(rows), CHUNK):
                part = slice(i, i + CHUNK)
                search(own, best, vectors[a:b], candidates[part], ids[part], names[part], labels[part])
                best.settle()
            slot, score, vec_id, row = best.kept
            out.append(pa.table({
                "anchor_row": pa.array(own["row"].to_numpy()[slot // slots]), "nth": pa.array((slot % slots).astype(np.int32)),
                "row": pa.array(row), "vec_id": pa.array(vec_id, mask=vec_id == LONG), "score": pa.array(score)}))
    kinds = (("anchor_row", pa.int64()), ("nth", pa.int32()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()))
    return pa.concat_tables(out) if out else pa.table([pa.array([], k) for _, k in kinds], [n for n, _ in kinds])


def _search_positives(own, best, vectors, candidates, ids, names, labels):
    label, row = own["label"].to_numpy(), own["row"].to_numpy()

    def wanted(place, low, high):
        return (high >= best.worst[place][:, None]) & (label[place][:, None] == labels) & (row[place][:, None] != names)

    bounded_scores(vectors, own["parent"].to_numpy(), own["edge"].to_numpy(), candidates, wanted,
                   lambda place, at, score: best.add(place, score, ids[at], names[at]))


def _search_negatives(slots: int, low_percent: int, high_percent: int):
    def within(x: int) -> int:
        return max(-LONG - 1, min(x, LONG))

    def run(own, best, vectors, candidates, ids, names, labels):
        label = own["label"].to_numpy()
        least = np.full((len(own), slots), LONG)  # windows without scores are empty
        most = np.full((len(own), slots), -LONG - 1)
        for i, scores in enumerate(own["scores"].to_pylist()):
            for j, p in enumerate(scores):
                least[i, j], most[i, j] = within(-(-low_percent * p // 100)), within(high_percent * p // 100)
        empty = least > most

        def wanted(place, low, high):
            floor = np.where(empty[place], np.inf, np.maximum(least[place], best.worst.reshape(-1, slots)[place])).min(1)
            ceiling = np.where(empty[place], -np.inf, most[place]).max(1)
            return (high >= floor[:, None]) & (low <= ceiling[:, None]) & (label[place][:, None] != labels)

        def take(place, at, score):
            for j in range(slots):
                inside = (score >= least[place, j]) & (score <= most[place, j])
                best.add(place[inside] * slots + j, score[inside], ids[at[inside]], names[at[inside]])

        bounded_scores(vectors, own["parent"].to_numpy(), own["edge"].to_numpy(), candidates, wanted, take)
    return run


# ---------------------------------------------------------------- the query

def mine(vectors: DataFrame, anchor: Column, *, positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100,
         scale: int = 256, tree_size: int = TREE, tile_trees: int = TILE_TREES, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """For each row of `vectors` (vec_id, embedding, label) where `anchor` holds and each of its positives, the hard
    negatives: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    ship(spark)
    used = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.coalesce(anchor, F.lit(False)).alias("anchor"), "embedding")
    rows = written(used.select("vec_id", "label", "anchor", "embedding").mapInArrow(_quantised(scale), ROW), "negatives-rows")
    size = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("anchor"), 1)).alias("m"),
                    F.max(F.octet_length("vector") / F.when(F.col("wide"), 8).otherwise(4)).alias("width")).first()

    # trees: an anchor's place among all, by code, then at random within the code (at most 2 ** SIGNS codes)
    anchors = rows.filter("anchor")
    codes = anchors.groupBy("code").count().withColumn(
        "before", F.sum("count").over(Window.orderBy("code").rowsBetween(Window.unboundedPreceding, -1)))
    placed = anchors.join(F.broadcast(codes), "code").withColumn(
        "tree", ((F.coalesce("before", F.lit(0)) + F.pmod(F.xxhash64("row"), F.col("count"))) / tree_size).cast("long"))
    planted = written(placed.select("row", "vec_id", "label", "wide", "vector", "tree").groupBy("tree").applyInArrow(_plant, ANCHOR),
                      "negatives-trees")

    across = max(1, -(-(size.m or 0) // (tree_size * tile_trees)))
    per_tile = max(1, tile_bytes // (8 * max(1, int(size.width or 0))))
    down = max(-(-size.n // per_tile), min(-(-2 * spark.sparkContext.defaultParallelism // across), -(-size.n // 256)), 1)
    dealt = rows.select("row", "vec_id", "label", "wide", "vector", F.pmod(F.xxhash64("row"), F.lit(down)).alias("down"),
                        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across"))

    def tiles(of: DataFrame, slots: int, keep: int, search) -> DataFrame:
        spread = of.withColumn("across", (F.col("tree") / tile_trees).cast("int")) \
            .withColumn("down", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))))
        found = spread.groupBy("down", "across").cogroup(dealt.groupBy("down", "across")).applyInArrow(
            lambda a, c: _tile(a, c, slots, keep, search), FOUND)
        order = Window.partitionBy("anchor_row", "nth").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)

    best = written(tiles(planted, 1, positives, _search_positives), "negatives-positives")
    windows = best.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("s")) \
        .select(F.col("anchor_row").alias("row"), F.col("s.score").alias("scores"))
    found = tiles(planted.join(windows, "row"), positives, negatives, _search_negatives(positives, low_percent, high_percent))
    return found.select("anchor_row", (F.col("nth") + 1).alias("nth"), "rank", F.col("vec_id").alias("negative_id"),
                        F.col("score").alias("negative_score")) \
        .join(best.select("anchor_row", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"),
                          F.col("score").alias("positive_score")), ["anchor_row", "nth"]) \
        .join(planted.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row") \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def with_moved_labels(vectors: DataFrame) -> DataFrame:
    """`vectors` where every seventh vec_id has the next of ten labels: stand-in input with mislabelled rows."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
