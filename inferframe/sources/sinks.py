"""SNK1/SNK2: request and outcome sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel


def write_requests(requests: DataFrame, path: str, body_col: str = "body",
                   partition_by: str | None = "kind", mode: str = "overwrite") -> None:
    """SNK1: one JSON request per line (text files), partitioned by request kind so that a
    downstream sender can pick one endpoint's requests by directory (partition pruning)."""
    cols = [F.col(body_col).alias("value")]
    writer_df = requests.select(*(cols + ([partition_by] if partition_by else [])))
    writer = writer_df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.text(path)


def write_outcomes(responses: DataFrame, path: str, outcome_col: str = "outcome",
                   mode: str = "overwrite", fmt: str = "parquet") -> None:
    """SNK2: ok rows and dead letters in one pass, partitioned by outcome
    (``outcome=ok``, ``outcome=http_error``, ``outcome=connection_error``)."""
    responses.write.mode(mode).format(fmt).partitionBy(outcome_col).save(path)


OK_SINK, DEAD_SINK, COMMITS = "ok", "dead", "commits"
COMMIT_SCHEMA = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("n_ok", T.LongType()), T.StructField("n_dead", T.LongType())])


def _committed_batch(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether the batch's commit record is there. Looked up through Spark's own file system layer."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}/batch_id={batch_id}/_SUCCESS")
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def write_outcome_batch(batch: DataFrame, batch_id: int, path: str, status_col: str = "status_code") -> bool:
    """One micro-batch into two sinks: answers with status 200 under ``path/ok``, all others under ``path/dead``, each in a
    folder of the batch's own, then a commit record under ``path/commits``. Returns False, and writes
    nothing, if the record is there already.

    The folders are overwritten, so a batch that broke off anywhere before its record is written again whole;
    ``read_outcomes`` shows committed batches only, so what such a batch left is never read."""
    spark = batch.sparkSession
    if _committed_batch(spark, path, batch_id):
        return False
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ok = F.coalesce(F.col(status_col) == 200, F.lit(False))
        for sink, rows in ((OK_SINK, batch.filter(ok)), (DEAD_SINK, batch.filter(~ok))):
            rows.write.mode("overwrite").parquet(f"{path}/{sink}/batch_id={batch_id}")
        counts = batch.agg(F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_dead"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/{COMMITS}/batch_id={batch_id}")
    finally:
        batch.unpersist()
    return True


def stream_outcomes(responses: DataFrame, path: str, checkpoint: str, status_col: str = "status_code",
                    available_now: bool = False) -> StreamingQuery:
    """SNK2 over a streaming frame of responses: ``write_outcome_batch`` per micro-batch. Exactly once with the stream's
    checkpoint: a batch that Spark runs again, before or after its record was written, neither repeats nor loses
    rows. ``path`` belongs to one checkpoint, as batch ids are its own."""
    writer = responses.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: write_outcome_batch(batch, batch_id, path, status_col))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, n_ok, n_dead) of each committed batch."""
    return spark.read.schema(COMMIT_SCHEMA).parquet(f"{path}/{COMMITS}").select(*COMMIT_SCHEMA.names)


def read_outcomes(spark: SparkSession, path: str, sink: str, schema: T.StructType) -> DataFrame:
    """The rows of committed batches in one sink, with their ``batch_id`` (a partition column: batches without a record
    are pruned, not read)."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(f"{path}/{sink}")
    return rows.join(read_commits(spark, path).select("batch_id"), "batch_id", "left_semi")
