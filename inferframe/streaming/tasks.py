"""ST3: track asynchronous tasks with a timeout instead of polling forever.

``join_tasks`` has two streams, submissions and results: a left outer interval join on the task and
``submitted <= result <= submitted + timeout``, both sides with a watermark, in Spark's own joined state; a submission that
nothing meets comes out when the watermarks pass its deadline. ``track_tasks`` has one stream, the raw log of polls. Per task a state keeps the first poll's time and the earliest
terminal event; once the watermark passes the task's deadline (first poll + timeout) the task is
answered once: the first terminal state if it came in time, else ``timeout``. Later events of an
answered task change nothing. The answered mark goes when the watermark passes ``keep`` after it, so
state is bounded by the watermark, not by history."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from inferframe import refdata as R

TASK_OUT = T.StructType([T.StructField("task_id", T.LongType()), T.StructField("outcome", T.StringType())])
TASK_STATE = T.StructType([
    T.StructField("first_us", T.LongType()), T.StructField("end_us", T.LongType()), T.StructField("end_tie", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("answered", T.BooleanType())])


def _task_state_fn(timeout_us: int, keep_us: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            first, end, tie, status, answered = state.get
            if answered:
                state.remove()
                return
            in_time = end is not None and end <= first + timeout_us
            state.update((first, end, tie, status, True))
            state.setTimeoutTimestamp(max((first + timeout_us + keep_us) // 1000, state.getCurrentWatermarkMs() + 1))
            yield pd.DataFrame({"task_id": [key[0]], "outcome": [status if in_time else "timeout"]})
            return
        first, end, tie, status, answered = state.get if state.exists else (None, None, None, None, False)
        if answered:
            for _ in pdfs:
                pass
            state.setTimeoutTimestamp(max((first + timeout_us + keep_us) // 1000, state.getCurrentWatermarkMs() + 1))
            return
        for pdf in pdfs:
            low = int(pdf["ts_us"].min())
            first = low if first is None else min(first, low)
            over = pdf[pdf["status"].isin([R.TASK_SUCCESS, R.TASK_FAILURE])].sort_values(["ts_us", "tie", "status"])
            if len(over):
                row = over.iloc[0]
                if end is None or (int(row["ts_us"]), int(row["tie"])) < (end, tie):
                    end, tie, status = int(row["ts_us"]), int(row["tie"]), row["status"]
        state.update((first, end, tie, status, False))
        state.setTimeoutTimestamp(max((first + timeout_us) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
    return fn


def join_tasks(submits: DataFrame, results: DataFrame, timeout: str = "7 days", watermark: str = "1 hour", tie: str | None = None) -> DataFrame:
    """One row (task_id, submit_ts, outcome, result_ts) per submission of the streaming frames ``submits`` (task_id, submit_ts)
    and ``results`` (task_id, result_ts, status): the first terminal result within ``timeout`` of the submission, else ``timeout``
    and NULL. Of results at one instant the lowest ``tie`` (a column of ``results``) counts, then the lowest status.

    Built-in operators only. The interval bounds the join's state on both sides: a result is kept until no
    submission before it can still come, a submission until its deadline. The aggregation over the matches, keyed
    by submission, holds them until the same watermark has passed, so a task that reports several terminal
    results is answered once. Results without a task, status or time are ignored; a submission without a
    time can't time out and is left out; a task submitted twice is two submissions."""
    s = submits.select(F.col("task_id"), F.col("submit_ts").cast("timestamp").alias("submit_ts")) \
        .filter("task_id is not null and submit_ts is not null").withWatermark("submit_ts", watermark)
    order = F.col(tie).cast("bigint") if tie else F.lit(0).cast("bigint")
    r = results.filter(F.col("status").isin(R.TASK_SUCCESS, R.TASK_FAILURE)) \
        .select(F.col("task_id").alias("result_task"), F.col("result_ts").cast("timestamp").alias("result_ts"), "status", order.alias("tie")) \
        .filter("result_task is not null and result_ts is not null").withWatermark("result_ts", watermark)
    meets = (F.col("task_id") == F.col("result_task")) & (F.col("result_ts") >= F.col("submit_ts")) \
        & (F.col("result_ts") <= F.col("submit_ts") + F.expr(f"INTERVAL {timeout}"))
    first = F.min(F.when(F.col("result_ts").isNotNull(), F.struct("result_ts", "tie", "status")))
    return s.join(r, meets, "left_outer").groupBy("task_id", "submit_ts").agg(first.alias("f")).select(
        "task_id", "submit_ts", F.coalesce("f.status", F.lit("timeout")).alias("outcome"), F.col("f.result_ts").alias("result_ts"))


def track_tasks(events: DataFrame, timeout: str = "7 days", watermark: str = "1 hour", tie: str | None = None,
                keep: str = "30 days") -> DataFrame:
    """One row (task_id, outcome) per task of a streaming frame (task_id, ts, status). Of terminal events
    at one instant the lowest ``tie`` (a column) counts."""
    def micros(span: str) -> int:
        n, unit = span.split()
        return int(float(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1_000_000)

    src = (events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
           .withColumn("ts_us", F.unix_micros("ts")).withColumn("tie", F.col(tie).cast("bigint") if tie else F.lit(0).cast("bigint")))
    return src.groupBy("task_id").applyInPandasWithState(
        _task_state_fn(micros(timeout), micros(keep)), TASK_OUT, TASK_STATE, "append", GroupStateTimeout.EventTimeTimeout)
