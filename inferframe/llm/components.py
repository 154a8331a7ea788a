"""Connected classes of bucket members, without enumerating the pairs of a bucket.

Input: which nodes share which buckets, and a function that confirms a set of node pairs. The
classes are those of the graph "share a bucket and are confirmed". Members that are already
connected need no further comparison, so each round compares only a few *centres* of every
unfinished bucket with the members outside the centres' classes:

* round 1 takes one centre per bucket: linear in the bucket rows, and enough for a family of copies
  around one text when the centre is that text. The caller gives members a weight: the
  lightest member is the centre, so a caller that can tell central nodes says so there. It may
  also leave out members that it can prove to have no link in the bucket, and say of a pair that it
  can't be confirmed;
* later rounds take the next 16, 256, 4096, ... nodes of buckets that still hold several classes.

A bucket is finished when its members form one class or all but one of them have been centres:
then every pair in it was compared or was already connected. No pair is dropped, no bucket is
capped. A bucket of n members that are neither confirmed nor left out costs its n(n-1)/2
comparisons, the price of exactness, spread over rounds and tasks; bucket keys are chosen selective
so that this is rare.

All state between rounds is written to the shared folder, links included: nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inferframe.llm.shared import written

GROWTH = 16


def star_labels(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the smallest node it can reach.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each replaces a node's
    edges by edges to its smallest neighbour, halving paths, until the edges are stars."""
    state = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")) \
        .where("u <> v").distinct()
    state = written(state, "cc")
    before = None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v") \
            .where("u <> v").distinct()
        state = written(small, "cc")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    leaves = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


Confirm = Callable[[DataFrame], DataFrame]
Possible = Callable[[Column, Column], Column]


def linked(rows: DataFrame, prepare: Callable[[DataFrame], tuple[Confirm, DataFrame, Possible]]) -> DataFrame | None:
    """(node, root) of all nodes with a confirmed link; None when there is none.

    rows: (bucket, node), each pair once.
    prepare: gets the rows (bucket, node) of buckets with two members or more. Returns a function
    that takes distinct candidate pairs (a, b) and returns the confirmed ones; the members (bucket,
    node, weight, info) to compare; and a condition on two members' info that every link meets."""
    # tables that meet again on the bucket are written first: the join then has an exchange of its
    # own on either side, which adaptive execution can split where one bucket is hot
    several = written(rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"), "several")
    spread = written(rows.join(several, "bucket").select("bucket", "node"), "buckets")
    if not spread.limit(1).count():
        return None
    confirm, spread, possible = prepare(spread)
    spread = written(spread.select("bucket", "node", "weight", "info"), "weighed")
    lightest = F.struct("weight", "node", "info")
    centre = written(spread.groupBy("bucket").agg(F.min(lightest).alias("c"), F.count("*").alias("n"))
                     .where("n > 1").select("bucket", F.col("c.node").alias("centre"), F.col("c.info").alias("centre_info")), "centres")
    spread = written(spread.join(centre, "bucket"), "members")
    may = possible(F.col("info"), F.col("centre_info"))
    pairs = spread.where((F.col("node") != F.col("centre")) & may).select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b"))
    links = written(confirm(written(pairs.distinct(), "pairs")), "links")
    open_rows, roots, tried, width = spread.select("bucket", "node", "weight", "info"), None, 1, GROWTH
    while True:
        if links.limit(1).count():
            roots = written(star_labels(links), "roots")
        labelled = open_rows.select("bucket", "node", "weight", "info")
        if roots is not None:
            labelled = labelled.join(roots, "node", "left") \
                .select("bucket", "node", "weight", "info", F.coalesce("root", "node").alias("class"))
        else:
            labelled = labelled.withColumn("class", F.col("node"))
        labelled = written(labelled, "labelled")
        still = written(labelled.groupBy("bucket").agg(
            F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
            .where((F.col("low") != F.col("high")) & (F.col("n") > F.lit(tried + 1))).select("bucket"), "still")
        if not still.limit(1).count():
            return roots
        open_rows = written(labelled.join(still, "bucket"), "open")
        centres = written(next_centres(open_rows, tried, width), "centres")
        pairs = open_rows.join(centres, "bucket").where((F.col("class") != F.col("centre_class")) & may) \
            .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
        links = written(links.unionByName(confirm(written(pairs.distinct(), "pairs"))), "links")
        tried, width = tried + width, width * GROWTH


def next_centres(rows: DataFrame, tried: int, width: int) -> DataFrame:
    """Members number tried + 1 ... tried + width of each bucket, lightest first.

    A rank per bucket in two steps: the first `tried + width` nodes of each (bucket, salt),
    then of each bucket, so no task sorts a whole hot bucket."""
    top = tried + width
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(64)))
    part = Window.partitionBy("bucket", "salt").orderBy("weight", "node")
    whole = Window.partitionBy("bucket").orderBy("weight", "node")
    return salted.withColumn("r", F.row_number().over(part)).where(F.col("r") <= top) \
        .withColumn("r", F.row_number().over(whole)) \
        .where((F.col("r") <= top) & (F.col("r") > tried)) \
        .select("bucket", F.col("node").alias("centre"), F.col("class").alias("centre_class"), F.col("info").alias("centre_info"))
