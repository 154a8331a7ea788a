"""Size checks in front of broadcasts: a side is broadcast only when it is known to be small in
bytes; otherwise the plan keeps a shuffle join (AQE may still convert it at runtime).

Spark's size estimate of the optimised plan (literal rows, file sizes) answers without running
anything. Only frames without an estimate (built from Python rows) are measured, by one job over
at most a bounded number of their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_MAX_BROADCAST_ROWS = 100_000
_UNKNOWN = 1 << 60


def estimated_bytes(df: DataFrame) -> int:
    """Spark's size estimate of df; at least 2^60 where it knows nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured_bytes(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> int | None:
    """Bytes of df as JSON, None if it has more than ``max_rows`` rows."""
    size = F.octet_length(F.to_json(F.struct(*[df[f"`{c}`"] for c in df.columns])))
    n, total = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return total if n <= max_rows else None


def fits(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    size = estimated_bytes(df)
    if size >= _UNKNOWN:
        size = measured_bytes(df)
    return size is not None and size <= max_bytes


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly over at least as many tasks as run at once. For work that is heavy for the bytes it reads: a few MB
    are one split or two, and the rest of the cluster would wait for them."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with ``value`` as the column ``name``, computed once a row: a generator of one row, into which the optimizer copies
    nothing and through which it pushes no filter on the column."""
    once = f"__{name}"
    return df.withColumn(once, value).select(*[df[f"`{c}`"] for c in df.columns if c != name], F.explode(F.array(F.col(once))).alias(name))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if fits(df, max_bytes) else df
