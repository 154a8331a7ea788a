"""Run bookkeeping: JN7 reconcile / pending, AG7 outcome summary, AG8 constraint pass
rate and reasons of failure, WN4 task outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inferframe import refdata as R
from inferframe.operators.responses import classify_outcome


def best_outcome(responses: DataFrame, key: str = "request_id") -> DataFrame:
    """One row per request from a log that may hold several attempts: ``ok`` if any attempt
    succeeded, else ``http_error`` if any got a status, else ``connection_error``. A partial
    + final aggregation, so a request retried many times is combined map-side."""
    rank = (F.when(F.col("status_code") == 200, 3).when(F.col("status_code").isNotNull(), 2)
            .otherwise(1))
    return responses.groupBy(key).agg(F.max(rank).alias("_rank"), F.count("*").alias("attempts"))


def reconcile(requests: DataFrame, responses: DataFrame, key: str = "request_id") -> DataFrame:
    """JN7: every request with its outcome; requests without any response are
    ``pending``. The log is first reduced to one row per request (``best_outcome``), then
    left-joined on the request id, so repeated attempts never duplicate requests."""
    j = requests.join(best_outcome(responses, key), key, "left")
    outcome = (F.when(F.col("_rank") == 3, "ok").when(F.col("_rank") == 2, "http_error")
               .when(F.col("_rank") == 1, "connection_error").otherwise("pending"))
    return (j.withColumn("outcome", outcome)
             .withColumn("attempts", F.coalesce(F.col("attempts"), F.lit(0)))
             .drop("_rank"))


def pending(requests: DataFrame, responses: DataFrame, key: str = "request_id") -> DataFrame:
    """JN7: requests never answered (left anti join)."""
    return requests.join(responses.select(key), key, "left_anti")


def retry_set(requests: DataFrame, responses: DataFrame, key: str = "request_id") -> DataFrame:
    """Pending requests plus those whose call failed - the set to send again."""
    rec = reconcile(requests, responses, key)
    return rec.filter(F.col("outcome") != "ok")


def outcome_summary(responses: DataFrame, by=("kind",)) -> DataFrame:
    """AG7: counts per kind and outcome (partial + final hash aggregation)."""
    return (responses.withColumn("outcome", classify_outcome("status_code"))
            .groupBy(*by, "outcome").agg(F.count("*").alias("n")))


def constraint_pass_rate(validated: DataFrame, by=("kind",), valid: str = "valid") -> DataFrame:
    """AG8: share of answers meeting their constraint, per kind."""
    return (validated.groupBy(*by)
            .agg(F.count("*").alias("n"), F.sum(F.col(valid).cast("bigint")).alias("n_valid"))
            .withColumn("pass_rate", F.col("n_valid") / F.col("n")))


def constraint_errors(validated: DataFrame, by=("kind",), errors: str = "errors") -> DataFrame:
    """AG8: why answers fail, per kind and reason: ``n`` answers with the reason, their ``share`` of the kind's answers, and the
    path it was most often found at (ties: the first by name). ``errors`` holds ``reason:path`` strings; a reason counts once an answer, answers without
    errors (or with NULL) only in the share. Combined map-side; the paths of a reason are counted before they are compared."""
    n_all = validated.groupBy(*by).agg(F.count("*").alias("n_all"))
    parts = F.transform(F.array_distinct(errors), lambda e: F.struct(
        F.substring_index(e, ":", 1).alias("reason"), F.when(F.contains(e, F.lit(":")), F.substring(e, F.instr(e, ":") + 1, F.length(e)))
        .otherwise("").alias("at")))
    rows = validated.select(*by, F.explode(F.map_entries(F.aggregate(
        parts, F.create_map().cast("map<string,array<string>>"), lambda m, x: F.map_concat(
            F.map_filter(m, lambda k, v: k != x["reason"]),
            F.create_map(x["reason"], F.concat(F.coalesce(F.try_element_at(m, x["reason"]), F.array()), F.array(x["at"]))))))).alias("e")) \
        .select(*by, F.col("e.key").alias("reason"), F.col("e.value").alias("places"))
    places = rows.select(*by, "reason", F.explode("places").alias("place")).groupBy(*by, "reason", "place").agg(F.count("*").alias("k"))
    top = places.groupBy(*by, "reason").agg(F.min(F.struct((-F.col("k")).alias("k"), "place")).alias("t"))
    counts = rows.groupBy(*by, "reason").agg(F.count("*").alias("n"))
    return counts.join(top, [*by, "reason"]).join(n_all, list(by)).select(
        *by, "reason", "n", (F.col("n") / F.col("n_all")).alias("share"), F.col("t.place").alias("most_at"))


def task_outcome(events: DataFrame, key: str = "task_id", ts: str = "ts",
                 status: str = "status", tie: str | None = None, bucket_s: int = 3600) -> DataFrame:
    """WN4: per task, the first terminal status (success/failure), when it happened, how
    many polls came before it, and first/last poll time; later states are ignored. A task
    without a terminal event is ``running``. Of terminal events at one instant the lowest ``tie``
    (a column, e.g. the event id) counts, else the lowest status.

    One shuffle by (task, time bucket) for the rows, then one row per bucket by task: a bucket
    knows its polls before its own first terminal event, the task adds up the buckets before the
    ending one. No join of the events with themselves, no window over a whole task."""
    terminal = F.col(status).isin(R.TASK_SUCCESS, R.TASK_FAILURE)
    end = F.struct(F.col(ts).alias("ts"), (F.col(tie) if tie else F.lit(0)).alias("tie"), F.col(status).alias("status"))

    def bucket(t: Column) -> Column:
        return F.floor(F.unix_micros(t) / (bucket_s * 1_000_000))

    w = Window.partitionBy(key, "_b")
    rows = events.withColumn("_b", bucket(F.col(ts))) \
        .withColumn("_end_here", F.min(F.when(terminal, F.col(ts))).over(w))
    parts = rows.groupBy(key, "_b").agg(
        F.min(F.when(terminal, end)).alias("_end"), F.min(ts).alias("_first"), F.count("*").alias("_n"),
        F.count_if(F.col("_end_here").isNull() | (F.col(ts) < F.col("_end_here"))).alias("_before"))
    out = parts.groupBy(key).agg(
        F.min("_end").alias("_end"), F.min("_first").alias("first_ts"), F.sum("_n").alias("n_events"),
        F.collect_list(F.struct("_b", "_n", "_before")).alias("_parts"))
    last = bucket(F.col("_end.ts"))
    counted = F.transform("_parts", lambda p: F.when(F.col("_end").isNull() | (p["_b"] < last), p["_n"])
                          .when(p["_b"] == last, p["_before"]).otherwise(F.lit(0)))
    return (out.withColumn("end_ts", F.col("_end.ts"))
               .withColumn("polls_before_end", F.aggregate(counted, F.lit(0).cast("bigint"), lambda a, x: a + x))
               .withColumn("outcome", F.coalesce(F.col("_end.status"), F.lit("running")))
               .drop("_end", "_parts"))
