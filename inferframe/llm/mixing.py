"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Targets. Sources in code point order, null last, take the weights 5, 2, 1, 5, 2, 1, ... and share
`SHARE` (150 %) of all sizes by weight. A source's target stops at `MAX_COPIES` times its size; the excess is reshared
by weight among the others until none is above its stop (`targets`).

Documents. A source with target T and size S asks for T / S copies of each document: the whole
part is certain and goes to every document; the fraction f is the inclusion probability of one more
copy. With weights, document i's expected copies are T / S times its weight relative to the source's mean,
between 0 and MAX_COPIES. Each document draws u from a hash of its id and is ranked by its random
odds divided by its inclusion odds, u / (1 - u) : f / (1 - f) (Rosen's Pareto sampling). The
documents of lowest rank value are taken, as many as bring the taken words to the target: the size
of the sample is fixed in words. Reruns agree because u is a hash.

The cut between taken and left is found without sorting a source: rank values are binned
(`BINS` bins twice), words are summed per (source, bin), and only the one bin where a source
crosses its target is refined; the last bin is ordered by rank value and id. So no task holds more than a
BINS^2-th of a source, whatever the skew. The cut is one row per source; it is joined back to the
documents by a broadcast whose size is one row per source (checked, with a shuffle join beyond).

Defined results: null text has size 0 and is never above its limit; null sources form one source;
source sizes of 0 have target 0 and nothing taken. Rows equal in id and source draw the same u and
are taken or left together. A null doc_id draws like the text "null". An empty table gives an empty result. Extra
columns, also of the same names as the internal ones, pass through `mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inferframe.llm.shared import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
BINS = 4096
MAX_BROADCAST_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column) -> Column:
    """Uniform number strictly between 0 and 1 from md5 of the id as text: 48 bits, halfway."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> source, source_size, target: one row per source."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    pick = F.array(*[F.lit(w) for w in WEIGHTS])
    weighed = sizes.withColumn("weight", pick[(F.row_number().over(order) - 1) % len(WEIGHTS)]) \
        .withColumn("stop", (F.col("source_size") * MAX_COPIES).cast("long"))
    # sources reach their stop in the order of stop / weight; a source is stopped if the level that
    # the rest would get together with it is not below its own stop / weight
    fill = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighed.withColumn("budget", F.lit(SHARE) * F.sum("source_size").over(everything)) \
        .withColumn("gone", F.coalesce(F.sum("stop").over(before), F.lit(0))) \
        .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))) \
        .withColumn("stopped", F.col("stop") * F.col("left") <= (F.col("budget") - F.col("gone")) * F.col("weight"))
    first_free = F.min(F.when(~F.col("stopped"), F.struct(
        F.col("stop") / F.col("weight"), F.col("source").isNull(), F.col("source"), "budget", "gone", "left"))).over(everything)
    return levels.withColumn("free", first_free).select(
        "source", "source_size",
        F.when(F.col("stopped"), F.col("stop").cast("double"))
        .otherwise((F.col("free.budget") - F.col("free.gone")) * F.col("weight") / F.col("free.left")).alias("target"))


def inclusion(target: Column, size: Column, weight: Column) -> Column:
    """Expected copies of a document, between 0 and MAX_COPIES."""
    ratio = F.when(size > 0, target / size * weight).otherwise(F.lit(0.0))
    return F.least(F.greatest(ratio, F.lit(0.0)), F.lit(float(MAX_COPIES)))


def _rank_value(u: Column, f: Column) -> Column:
    """q / (1 + q) of the ratio of odds q: the same order, between 0 and 1, and defined for f = 0."""
    return u * (1 - f) / (u * (1 - f) + f * (1 - u))


def _cross(rows: DataFrame, bin_: Column, name: str) -> DataFrame:
    """Per source, the bin in which the running sum of words first exceeds `need`, and the words before it."""
    sums = rows.groupBy("source", "need", bin_.alias(name)).agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy(name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sums.withColumn("upto", F.sum("words").over(run)).where(F.col("upto") > F.col("need")) \
        .groupBy("source").agg(F.min(F.struct(name, (F.col("upto") - F.col("words")).alias("before"))).alias("c")) \
        .select("source", f"c.{name}", "c.before")


def _on_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Null-safe join on source; right has one row per source and is broadcast when counted small."""
    key = right.withColumnRenamed("source", "__source")
    if key.limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES:
        key = F.broadcast(key)
    return left.join(key, F.col("source").eqNullSafe(F.col("__source")), how).drop("__source")


def cuts(docs: DataFrame, weight: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, cuts): the thin document table doc_id, source, size, weight (written to the shared
    folder) and per source its size, target, mean weight and the last taken (rank value, id)."""
    w = F.lit(1.0) if weight is None else F.greatest(F.coalesce(weight.cast("double"), F.lit(0.0)), F.lit(0.0))
    thin = written(docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("source").cast("string").alias("source"),
                               n_words(F.col("text").cast("string")).alias("size"), w.alias("weight")), "sizes")
    sizes = thin.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.sum(F.col("size") * F.col("weight")).alias("weighed"))
    # the mean weight by size makes the expected words meet the target
    goal = written(targets(sizes.select("source", "source_size")).join(
        sizes.select(F.col("source").alias("s"), "weighed"), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "source_size", "target",
        F.when(F.col("weighed") > 0, F.col("source_size") / F.col("weighed")).otherwise(F.lit(0.0)).alias("scale")), "targets")
    part = _on_source(thin, goal).withColumn("p", inclusion(F.col("target"), F.col("source_size"), F.col("weight") * F.col("scale"))) \
        .withColumn("whole", F.floor("p")).withColumn("f", F.col("p") - F.col("whole"))
    certain = part.groupBy("source").agg(F.sum(F.col("size") * F.col("whole")).alias("certain"))
    need = goal.join(certain.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))) \
        .select("source", (F.col("target") - F.col("certain")).alias("need"))
    q = _rank_value(draw(F.col("doc_id")), F.col("f"))
    ranked = _on_source(part.where("f > 0 and size > 0").select("source", "doc_id", "size", q.alias("q")), written(need, "need"))
    spot = F.col("q") * BINS
    ranked = ranked.withColumn("b1", F.floor(spot)).withColumn("b2", F.floor((spot - F.floor(spot)) * BINS))
    one = written(_cross(ranked, F.col("b1"), "b1").select("source", F.col("b1").alias("c1"), "before"), "bins")
    inside = _on_source(ranked, one).where("b1 = c1").withColumn("need", F.col("need") - F.col("before")).drop("before")
    two = written(_cross(inside, F.col("b2"), "b2").select("source", F.col("b2").alias("c2"), "before"), "bins")
    last = _on_source(inside, two).where("b2 = c2").groupBy("source", "need", "before", "c1", "c2", "q", "doc_id").agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy("q", "doc_id")
    # a document belongs to the sample if the sum with it is nearer to the need than without it
    upto = F.col("before") + F.sum("words").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    taken = last.withColumn("upto", upto).where(2 * F.col("upto") - F.col("words") <= 2 * F.col("need"))
    edge = taken.groupBy("source").agg(F.max(F.struct("q", "doc_id")).alias("edge"))
    border = one.select("source", "c1").join(two.select(F.col("source").alias("s2"), "c2"), F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2") \
        .join(edge.withColumnRenamed("source", "s3"), F.col("source").eqNullSafe(F.col("s3")), "left").drop("s3")
    final = goal.join(border.withColumnRenamed("source", "s4"), F.col("source").eqNullSafe(F.col("s4")), "left").drop("s4")
    return thin, written(final, "cuts")


def copies(u_id: Column) -> Column:
    """Copies of a document, from the columns of its row (weight) and of its source's cut."""
    p = inclusion(F.col("target"), F.col("source_size"), F.col("weight") * F.col("scale"))
    f = p - F.floor(p)
    q = _rank_value(draw(u_id), f)
    spot = q * BINS
    b1, b2 = F.floor(spot), F.floor((spot - F.floor(spot)) * BINS)
    # no crossing bin: the need exceeds all fractions together, every fraction is taken
    below = F.when(F.col("c1").isNull(), F.lit(True)).when(b1 != F.col("c1"), b1 < F.col("c1")) \
        .when(F.col("c2").isNull(), F.lit(True)).when(b2 != F.col("c2"), b2 < F.col("c2")) \
        .otherwise(F.coalesce(F.struct(q.alias("q"), F.coalesce(u_id, F.lit("")).alias("doc_id"))
                              <= F.struct(F.col("edge.q").alias("q"), F.coalesce("edge.doc_id", F.lit("")).alias("doc_id")), F.lit(False)))
    return (F.floor(p) + F.when((f > 0) & below, 1).otherwise(0)).cast("long")


def mix_sizes(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken (words of all copies) of every row of docs."""
    kind = docs.schema["doc_id"].dataType
    thin, cut = cuts(docs, weight)
    rows = _on_source(thin, cut).withColumn("n", copies(F.col("doc_id")))
    taken = F.when(F.col("size") > 0, F.col("size") * F.col("n")).otherwise(F.lit(0)).cast("long")
    return rows.select(F.col("doc_id").cast(kind).alias("doc_id"), "size", "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """docs with every row repeated as often as the mix takes it (0, 1 or 2 times), columns unchanged."""
    _, cut = cuts(docs, weight)
    packed = docs.select(F.struct(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"),
                         F.col("source").cast("string").alias("source"), F.col("doc_id").cast("string").alias("doc_id"),
                         (F.lit(1.0) if weight is None else F.greatest(F.coalesce(weight.cast("double"), F.lit(0.0)), F.lit(0.0))).alias("weight"))
    rows = _on_source(packed, cut).withColumn("n", copies(F.col("doc_id"))).where("n > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return rows.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
