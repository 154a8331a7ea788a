"""Small helpers every operator of this subpackage uses: package shipping, tables written to the
shared folder (lineage cuts that survive lost executors) and empty-safe column selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inferframe.session import shared_dir, ship_package

BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000
BROADCAST_ROWS = 500_000


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers."""
    ship_package(spark)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of `BATCH_ROWS` rows between the JVM and the Python workers, unless the session sets a number. Whole texts
    in Spark's default of 10,000 rows are some 40 MB a batch and column, held outside the heap on both sides."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """`df`, computed once and reread from Parquet in the folder of `spark.checkpoint.dir`.

    The files are committed by Spark's writer and shared by all executors, so a lost executor
    costs only its running tasks."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(rows: DataFrame) -> DataFrame:
    """Narrow rows for a join: broadcast when they are counted few, so that the wide side isn't shuffled for them."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(column: str, m: int) -> Column:
    """crc32 of the column as text, modulo m (null stays null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(m)
