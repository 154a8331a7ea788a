"""Order-preserving aggregation and scans that survive a hot key.

A key (request, conversation, document) may hold a large share of all rows. Instead of
gathering one key into one task, rows are first combined per ``(key, seq div B)`` bucket
(at most B rows per bucket when ``seq`` is unique per key), then only the small
per-bucket partials are combined per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET = 4096


def _ordered_join(order: Column, value: Column, sep: str) -> Column:
    """Ordered string concatenation of a group (NULL values skipped)."""
    arr = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.array_join(F.transform(arr, lambda x: x["v"]), sep)


def ordered_concat(df: DataFrame, keys: list[str], order: str, value: str, sep: str = "",
                   out: str = "text", bucket_size: int = DEFAULT_BUCKET,
                   extra: dict[str, tuple[Column, str]] | None = None,
                   unique: bool = False) -> DataFrame:
    """``listagg(value, sep) within group (order by order)`` per key, in two levels.

    ``extra`` maps an output name to ``(partial aggregate, combiner)`` where the combiner
    is one of ``sum``, ``min``, ``max`` applied to the partials (e.g. counts, first/last).
    With ``unique`` rows that repeat a (key, order) count once (at-least-once delivery): they
    meet in the bucket's partition, so the shuffle stays the same.
    """
    extra = extra or {}
    bucket = F.floor(F.col(order) / F.lit(bucket_size)).alias("_b")
    if unique:
        df = (df.withColumn("_b", bucket).repartition(*keys, "_b")
              .dropDuplicates([*keys, "_b", order]))
        bucket = F.col("_b")
    part_aggs = [F.min(order).alias("_o"),
                 _ordered_join(F.col(order), F.col(value), sep).alias("_s"),
                 F.count(F.col(value)).alias("_n")]
    part_aggs += [agg.alias(f"_x_{name}") for name, (agg, _) in extra.items()]
    parts = df.groupBy(*keys, bucket).agg(*part_aggs)
    comb = {"sum": F.sum, "min": F.min, "max": F.max}
    final = [F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("_o").alias("o"),
                                             F.when(F.col("_n") > 0, F.col("_s")).alias("v")))),
        lambda x: x["v"]), sep).alias(out)]
    final += [comb[c](F.col(f"_x_{name}")).alias(name) for name, (_, c) in extra.items()]
    return parts.groupBy(*keys).agg(*final)


def ordered_collect(df: DataFrame, keys: list[str], order: str, value: Column, out: str = "items",
                    bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """``collect_list(value)`` in ``order`` per key, in two levels (per-bucket partial arrays,
    then the buckets' arrays flattened in order)."""
    bucket = F.floor(F.col(order) / F.lit(bucket_size)).alias("_b")
    parts = df.groupBy(*keys, bucket).agg(
        F.min(order).alias("_o"),
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v")))),
                    lambda x: x["v"]).alias("_a"))
    return parts.groupBy(*keys).agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("_o").alias("o"), F.col("_a").alias("a")))),
        lambda x: x["a"])).alias(out))


def _runs(stats: DataFrame, key: str, fan: int, levels: int) -> DataFrame:
    """For each segment (key, _b) of a chain with its first and last value and the number of
    changes inside (_first_v, _last_v, _inner): the last value before it (_prev_last,
    _has_prev) and the number of runs begun before it (_offset).

    Segments combine like partial sums, so ``fan`` neighbours are scanned together and then
    stand as one segment on the next level: a window never holds more than ``fan`` rows of a
    key until the top, where a key has its number of segments divided by fan ** levels."""
    group = [key] if not levels else [key, "_g"]
    if levels:
        stats = stats.withColumn("_g", F.floor(F.col("_b") / F.lit(fan)))
    w = Window.partitionBy(*group).orderBy("_b")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = (stats.withColumn("_prev_last", F.lag("_last_v").over(w))
                 .withColumn("_has_prev", F.row_number().over(w) > 1))
    # the first segment of a group begins a run or not; its own predecessor decides that later
    starts = F.when(F.col("_has_prev") & ~F.col("_first_v").eqNullSafe(F.col("_prev_last")), 1).otherwise(0)
    rows = rows.withColumn("_total", F.col("_inner") + starts)
    rows = rows.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0)))
    if not levels:
        # nothing precedes a key's first segment: it always begins a run
        return rows.withColumn("_offset", F.col("_offset") + F.when(F.col("_has_prev"), 1).otherwise(0)) \
            .select(key, "_b", "_prev_last", "_has_prev", "_offset")
    upper = rows.groupBy(key, F.col("_g").alias("_b")).agg(
        F.min_by("_first_v", "_b").alias("_first_v"), F.max_by("_last_v", "_b").alias("_last_v"),
        F.sum("_total").alias("_inner"))
    above = _runs(upper, key, fan, levels - 1).join(
        upper.select(F.col(key).alias("_k"), F.col("_b").alias("_u"), F.col("_first_v").alias("_uv")),
        F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_u")))
    begun = F.when(~F.col("_has_prev") | ~F.col("_uv").eqNullSafe(F.col("_prev_last")), 1).otherwise(0)
    above = above.select(F.col("_k").alias("_ak"), F.col("_b").alias("_ag"), F.col("_prev_last").alias("_apl"),
                         F.col("_has_prev").alias("_ahp"), F.col("_offset").alias("_ao"), begun.alias("_ab"))
    j = rows.join(above, F.col(key).eqNullSafe(F.col("_ak")) & (F.col("_g") == F.col("_ag")))
    return j.select(
        key, "_b", F.when(F.col("_has_prev"), F.col("_prev_last")).otherwise(F.col("_apl")).alias("_prev_last"),
        (F.col("_has_prev") | F.col("_ahp")).alias("_has_prev"),
        (F.col("_ao") + F.when(F.col("_has_prev"), F.col("_ab")).otherwise(0) + F.col("_offset")).alias("_offset"))


def change_ordinal(df: DataFrame, key: str, order: str, value: str, out: str = "ordinal",
                   bucket_size: int = DEFAULT_BUCKET, fan: int = DEFAULT_BUCKET) -> DataFrame:
    """Running count of value changes along ``order`` within ``key``: a row starts a new
    run when ``value`` differs (null-safe) from the previous row's value; ``out`` is the
    1-based run number. Equivalent to ``sum(not (v <=> lag(v))) over (partition by key
    order by order)``, but the per-row windows run per (key, order div ``bucket_size``) and the
    buckets are scanned as a tree (``_runs``), so sparse orders, where a bucket holds few rows,
    don't bring a hot key back together either."""
    b = F.floor(F.col(order) / F.lit(bucket_size))
    rows = df.withColumn("_b", b)
    w_in = Window.partitionBy(key, "_b").orderBy(order)
    rows = (rows.withColumn("_prev", F.lag(value).over(w_in))
                .withColumn("_first", F.row_number().over(w_in) == 1))
    stats = rows.groupBy(key, "_b").agg(
        F.min_by(value, order).alias("_first_v"),
        F.max_by(value, order).alias("_last_v"),
        F.sum(F.when(~F.col("_first") & ~F.col(value).eqNullSafe(F.col("_prev")), 1)
              .otherwise(0)).alias("_inner"))
    found = _runs(stats, key, fan, 1).select(
        F.col(key).alias("_rk"), F.col("_b").alias("_rb"), "_prev_last", "_has_prev", "_offset")
    j = rows.join(found, F.col(key).eqNullSafe(F.col("_rk")) & (F.col("_b") == F.col("_rb")), "inner")
    flag = F.when(F.col("_first"),
                  F.when(~F.col("_has_prev") | ~F.col(value).eqNullSafe(F.col("_prev_last")), 1)
                  .otherwise(0)).otherwise(
        F.when(~F.col(value).eqNullSafe(F.col("_prev")), 1).otherwise(0))
    w_run = w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (j.withColumn("_flag", flag)
             .withColumn(out, (F.col("_offset") + F.sum("_flag").over(w_run)).cast("bigint"))
             .drop("_b", "_prev", "_first", "_prev_last", "_has_prev", "_offset", "_flag", "_rk", "_rb"))


def dense_ordinal(df: DataFrame, key: str, order: str, out: str = "ordinal",
                  bucket_size: int = DEFAULT_BUCKET, fan: int = DEFAULT_BUCKET) -> DataFrame:
    """0-based row number along ``order`` within ``key``, without a window over a whole key:
    rows are numbered per (key, order div ``bucket_size``) and offset by the counts of the
    buckets before, summed in two levels of at most ``fan`` buckets each."""
    rows = df.withColumn("_b", F.floor(F.col(order) / F.lit(bucket_size)))
    counts = rows.groupBy(F.col(key).alias("_ck"), F.col("_b").alias("_cb")).agg(F.count("*").alias("_n")) \
        .withColumn("_g", F.floor(F.col("_cb") / F.lit(fan)))
    inside = Window.partitionBy("_ck", "_g").orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_o", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    across = Window.partitionBy("_gk").orderBy("_gg").rowsBetween(Window.unboundedPreceding, -1)
    upper = counts.groupBy(F.col("_ck").alias("_gk"), F.col("_g").alias("_gg")).agg(F.sum("_n").alias("_gn")) \
        .withColumn("_go", F.coalesce(F.sum("_gn").over(across), F.lit(0)))
    counts = counts.join(upper, F.col("_ck").eqNullSafe(F.col("_gk")) & (F.col("_g") == F.col("_gg"))) \
        .select("_ck", "_cb", (F.col("_o") + F.col("_go")).alias("_o"))
    w = Window.partitionBy(key, "_b").orderBy(order)
    return (rows.withColumn("_r", F.row_number().over(w) - 1)
            .join(counts, F.col(key).eqNullSafe(F.col("_ck")) & (F.col("_b") == F.col("_cb")))
            .withColumn(out, (F.col("_o") + F.col("_r")).cast("bigint"))
            .drop("_b", "_r", "_ck", "_cb", "_o"))
