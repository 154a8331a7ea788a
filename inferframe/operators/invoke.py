"""UDF1: send requests through a per-partition transport (``mapInPandas``).

* The transport is built once per partition by a picklable factory and closed after.
* Every request yields exactly one row; an exception becomes a row with NULL status and
  the error text (never a task failure), so one bad call cannot fail a stage.
* ``max_in_flight`` caps concurrent calls cluster-wide by repartitioning the request set.
* ``durable=True`` cuts lineage with a reliable checkpoint (``spark.checkpoint.dir``): a
  retried downstream stage or a lost executor then reads stored answers instead of
  calling the model again.

* ``invoke_resumable`` sends in rounds of bounded size and appends each round's answers to a log before the next starts;
  a run that died is started again with the same log and sends what the log doesn't answer.

Request ids keep their type, bodies and error texts stay whole. Only the request columns enter Python (projection before ``mapInPandas``); payload
columns should be joined back by ``request_id`` afterwards.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inferframe.session import shared_dir

ANSWER_FIELDS = [
    T.StructField("kind", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("body", T.StringType()),
    T.StructField("error", T.StringType()),
]


class TransportError(Exception):
    """A call that never produced an HTTP status (connection error, timeout)."""


def invoke(requests: DataFrame, transport_factory: Callable[[], object], *,
           id_col: str = "request_id", kind_col: str = "kind", body_col: str = "body",
           max_in_flight: int | None = None, batch_size: int = 64,
           durable: bool = False) -> DataFrame:
    """Call ``transport(kind, body) -> (status_code, response_body)`` for every request.

    A transport that also offers ``call_many(kinds, bodies) -> [(status, body) | Exception]``
    receives up to ``batch_size`` requests per call (one round trip for a batch endpoint or
    a pipelined client); otherwise requests are sent one by one."""
    req = requests.select(F.col(id_col).alias("request_id"),
                          F.col(kind_col).cast("string").alias("kind"),
                          F.col(body_col).cast("string").alias("body"))
    if max_in_flight:
        req = req.repartition(max_in_flight)

    def run(batches):
        transport = transport_factory()
        many = getattr(transport, "call_many", None)
        try:
            for pdf in batches:
                status, bodies, errors = [], [], []

                def record(res):
                    if isinstance(res, Exception):
                        status.append(None)
                        bodies.append(None)
                        errors.append(f"{type(res).__name__}: {res}")
                    else:
                        s, b = res
                        status.append(s)
                        bodies.append(b)
                        errors.append(None if s == 200 else (b or ""))

                kinds, reqs = list(pdf["kind"]), list(pdf["body"])
                if many is not None:
                    for i in range(0, len(reqs), batch_size):
                        k, b = kinds[i:i + batch_size], reqs[i:i + batch_size]
                        try:
                            results = many(k, b)
                        except Exception as e:  # noqa: BLE001 - the whole call failed
                            results = [e] * len(b)
                        for r in results:
                            record(r)
                else:
                    for kind, body in zip(kinds, reqs):
                        try:
                            record(transport(kind, body))
                        except Exception as e:  # noqa: BLE001 - every failure becomes a row
                            record(e)
                yield pd.DataFrame({
                    "request_id": pdf["request_id"],
                    "kind": pdf["kind"],
                    "status_code": pd.array(status, dtype="Int32"),
                    "body": bodies,
                    "error": errors,
                })
        finally:
            close = getattr(transport, "close", None)
            if close:
                close()

    schema = T.StructType([T.StructField("request_id", req.schema["request_id"].dataType), *ANSWER_FIELDS])
    out = req.mapInPandas(run, schema)
    if durable:
        from inferframe.session import checkpoint_root
        checkpoint_root(out.sparkSession)
        out = out.checkpoint(eager=True)
    return out


def _answered(log: DataFrame, done: Column) -> DataFrame:
    return log.filter(done).select("request_id").distinct()


def read_log(spark: SparkSession, log: str, id_type: T.DataType) -> DataFrame | None:
    """All attempts in an answer log: request_id, kind, status_code, body, error, ``sent_ms`` (start of the
    round) and ``round`` (its folder); None before the first."""
    target = spark._jvm.org.apache.hadoop.fs.Path(log)
    files = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(target):
        return None
    schema = T.StructType([T.StructField("request_id", id_type), *ANSWER_FIELDS, T.StructField("sent_ms", T.LongType())])
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("round", T.StringType())])).parquet(log)


def invoke_resumable(requests: DataFrame, transport_factory: Callable[[], object], log: str, *, round_size: int = 100_000,
                     unit: int = 256, done: Column | None = None, max_rounds: int | None = None, id_col: str = "request_id",
                     kind_col: str = "kind", body_col: str = "body", batch_size: int = 64) -> DataFrame:
    """UDF1 that resumes: the answers of ``requests``, the latest attempt of each, as ``invoke`` gives them.

    Requests that ``log`` (a folder shared by the cluster) doesn't answer yet are dealt by hash into rounds of about
    ``round_size``, stored by round, and sent one round after the other. A round is one job of tasks with about ``unit`` requests; its
    answers are committed under ``log`` before the next round starts. What a failure can cost twice is therefore bounded:
    a lost task the ``unit`` requests it was sending, a lost driver the round it was in. ``done`` says which attempts count as
    an answer (default: any HTTP status); others are sent again by the next run, and the log keeps every attempt.

    ``max_rounds`` ends a run early (a budget); the next run goes on. Repeated request ids are sent once, with the
    smallest (kind, body); requests without an id can't be found in a log and are left out. Two runs on one log at
    the same time would send twice."""
    spark = requests.sparkSession
    done = F.col("status_code").isNotNull() if done is None else done
    todo = requests.select(F.col(id_col).alias("request_id"), F.col(kind_col).cast("string").alias("kind"),
                           F.col(body_col).cast("string").alias("body")).filter("request_id is not null")
    todo = todo.groupBy("request_id").agg(F.min(F.struct("kind", "body")).alias("r")).select("request_id", "r.kind", "r.body")
    id_type = todo.schema["request_id"].dataType
    asked = todo.select("request_id")
    known = read_log(spark, log, id_type)
    if known is not None:
        todo = todo.join(_answered(known, done), "request_id", "left_anti")
    path = shared_dir(spark, "invoke-pending")
    rounds = max(1, -(-todo.count() // round_size))
    todo.withColumn("round", F.pmod(F.xxhash64("request_id"), F.lit(rounds))).write.partitionBy("round").parquet(path)
    schema = T.StructType([*todo.schema.fields, T.StructField("round", T.LongType())])
    sent = 0
    for r in range(rounds):
        if max_rounds is not None and sent >= max_rounds:
            break
        part = spark.read.schema(schema).parquet(path).filter(F.col("round") == r).drop("round")
        n = part.count()
        if n:
            answers = invoke(part.repartition(-(-n // unit), "request_id"), transport_factory, batch_size=batch_size)
            answers.withColumn("sent_ms", F.lit(time.time_ns() // 1_000_000)).write.parquet(f"{log}/round={uuid.uuid4().hex}")
            sent += 1
    attempts = read_log(spark, log, id_type)
    if attempts is None:
        return invoke(todo.limit(0), transport_factory)
    latest = attempts.join(asked, "request_id", "left_semi").groupBy("request_id").agg(F.max_by(
        F.struct("kind", "status_code", "body", "error"), F.struct(F.coalesce(done, F.lit(False)), "sent_ms", "round")).alias("a"))
    return latest.select("request_id", "a.*")
