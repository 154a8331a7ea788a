"""Streaming queries (ST1-ST3 over SRC5/SRC6 file streams) and the batch task outcome (WN4).

Each stream query writes its input as parquet files under the shared checkpoint folder,
runs the streaming job with ``trigger(availableNow=True)`` into a file sink and returns a
batch read of the sink, so the result is comparable with the batch oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from inferframe.operators import ops as OP
from inferframe.plans.catalog import query
from inferframe.plans.fixtures import (
    SQL_CHUNKS, SQL_TASK_EVENTS, SQL_TOOL_CHUNKS, content_chunks, ntz_as_utc, task_events, tbl,
    tool_chunks,
)
from inferframe.session import shared_dir
from inferframe.sources.streams import stream_chunks, stream_task_events
from inferframe.streaming.assemble import (
    stream_assemble_content, stream_assemble_tool_calls, stream_tool_call_snapshots,
)
from inferframe.streaming.tasks import join_tasks, track_tasks

TASK_TIMEOUT = "1 day"


def _land(df, name, spark):
    """Write a frame as the files of a stream, as many as the writer's tasks make; rows inside a
    file are shuffled, so fragments arrive out of order within and across micro-batches."""
    path = shared_dir(spark, name)
    df.sortWithinPartitions(F.xxhash64(*df.columns[:2])).write.parquet(path)
    return path


def _own_session(spark):
    """A session of its own for a stream: its state partitions (fixed when a checkpoint is
    first used) follow the cluster's parallelism, and no other query's settings change."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", str(max(1, spark.sparkContext.defaultParallelism)))
    own.conf.set("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return own


def _run(query_writer):
    """Run a stream with ``availableNow`` to its end."""
    q = query_writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


@query("st_content", sql=f"""
WITH {SQL_CHUNKS},
f AS (SELECT request_id, min(seq) FILTER (WHERE finish_reason = 'stop') AS fin FROM chunks GROUP BY request_id)
SELECT request_id, md5(string_agg(content, '' ORDER BY seq)) AS content_md5, count(*)::BIGINT AS n_chunks,
       TRUE AS complete
FROM chunks JOIN f USING (request_id) WHERE seq <= fin GROUP BY request_id""")
def st_content(spark, sf):
    """Fragments arrive as a file stream in shuffled order, some of them twice, with a pause of
    ten minutes inside every fourth message; each message is emitted once, when its finish
    fragment and all fragments before it are there."""
    ch = content_chunks(spark, sf)
    pause = F.when((F.col("request_id") % 4 == 0) & (F.col("seq") >= 20), F.expr("INTERVAL 10 MINUTES")) \
        .otherwise(F.expr("INTERVAL 0 MINUTES"))
    ch = ch.withColumn("ts", F.col("ts") + pause)
    again = ch.filter(F.col("seq") % 11 == 0)
    own = _own_session(spark)
    src = _land(ch.unionByName(again), "st-content-src", spark)
    out, ck = shared_dir(spark, "st-content-out"), shared_dir(spark, "st-content-ck")
    res = stream_assemble_content(stream_chunks(own, src, ch.schema, max_files_per_trigger=4), watermark="1 day")
    _run(res.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append"))
    back = spark.read.schema(res.schema).parquet(out)
    return back.select("request_id", F.md5("content").alias("content_md5"), "n_chunks", "complete")


def _stream_tool_chunks(spark, sf):
    """Fragments of a call one second apart, every fifth call's first fragment delivered twice."""
    e = tbl(spark, sf, "events").select(F.col("event_id").alias("tool_index"), ntz_as_utc("ts").alias("ts"))
    ch = tool_chunks(spark, sf).join(e, "tool_index")
    p = (F.col("seq") % 1000).cast("int")
    ch = ch.withColumn("ts", F.col("ts") + F.make_dt_interval(secs=p))
    return ch.unionByName(ch.filter((p == 0) & (F.col("tool_index") % 5 == 0)))


SQL_ST_TOOL_CALLS = f"""
WITH {SQL_TOOL_CHUNKS}
SELECT request_id, tool_index, max(tool_id) AS tool_id, max(tool_name) AS tool_name,
       string_agg(tool_args, '' ORDER BY seq) AS arguments, count(*)::BIGINT AS n_fragments
FROM tool_chunks GROUP BY request_id, tool_index"""


def _latest_calls(spark, sf, assemble):
    """Run an update-mode stream of calls; each micro-batch is appended to a change log, the result is the latest row per call."""
    ch = _stream_tool_chunks(spark, sf)
    own = _own_session(spark)
    src = _land(ch, "st-tools-src", spark)
    log, ck = shared_dir(spark, "st-tools-log"), shared_dir(spark, "st-tools-ck")
    res = assemble(stream_chunks(own, src, ch.schema, max_files_per_trigger=4))

    def append(batch, batch_id):
        # one partition per micro-batch, overwritten on retry: a re-run batch replaces
        # its own rows instead of duplicating them
        batch.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    _run(res.writeStream.foreachBatch(append).option("checkpointLocation", ck).outputMode("update"))
    latest = spark.read.parquet(log).groupBy("request_id", "tool_index").agg(
        F.max_by(F.struct("tool_id", "tool_name", "arguments", "n_fragments"), "batch_id").alias("r"))
    return latest.select("request_id", "tool_index", "r.tool_id", "r.tool_name", "r.arguments",
                         F.col("r.n_fragments").cast("bigint").alias("n_fragments"))


@query("st_tool_calls", sql=SQL_ST_TOOL_CALLS)
def st_tool_calls(spark, sf):
    """Tool-call fragments as a file stream that ends: aggregation in update mode."""
    return _latest_calls(spark, sf, stream_tool_call_snapshots)


@query("st_tool_calls_endless", sql=SQL_ST_TOOL_CALLS)
def st_tool_calls_endless(spark, sf):
    """The same stream in the form for endless streams: a state per call that event time drops."""
    return _latest_calls(spark, sf, lambda s: stream_assemble_tool_calls(s, watermark="40 days"))  # the files are in no order of time


SQL_TASKS = f"""
s AS (SELECT task_id, min(ts) AS st FROM task_events GROUP BY task_id),
r AS (SELECT task_id, min(ts) FILTER (WHERE status IN ('success', 'failure')) AS rt,
             arg_min(status, (ts, event_id)) FILTER (WHERE status IN ('success', 'failure')) AS rs
      FROM task_events GROUP BY task_id)"""


@query("st_tasks", sql=f"""
WITH {SQL_TASK_EVENTS}, {SQL_TASKS}
SELECT task_id, CASE WHEN rt IS NOT NULL AND rt <= st + INTERVAL {TASK_TIMEOUT.split()[0]} DAY THEN rs ELSE 'timeout' END AS outcome
FROM s JOIN r USING (task_id)""")
def st_tasks(spark, sf):
    """The raw log of polls as a stream; each task is answered once, by its first terminal state
    within a day or as ``timeout``. A last far-future poll moves the watermark past all deadlines."""
    te = task_events(spark, sf)
    own = _own_session(spark)
    src = _land(te, "st-tasks-src", spark)
    flush = spark.createDataFrame([(-1, -1, "2090-01-01 00:00:00", "running")], "task_id bigint, event_id bigint, ts string, status string")
    out, ck = shared_dir(spark, "st-tasks-out"), shared_dir(spark, "st-tasks-ck")

    def run():
        res = track_tasks(stream_task_events(own, src, te.schema), timeout=TASK_TIMEOUT, watermark="40 days", tie="event_id")
        _run(res.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).outputMode("append"))
        return res.schema

    run()
    flush.select(*[F.col(f.name).cast(f.dataType) for f in te.schema.fields]).write.mode("append").parquet(src)
    schema = run()  # availableNow also runs the no-data batch that answers what the watermark passed
    return spark.read.schema(schema).parquet(out).filter(F.col("task_id") >= 0)


@query("st_tasks_join", sql=f"""
WITH {SQL_TASK_EVENTS}, {SQL_TASKS}
SELECT task_id, epoch_us(st) AS submit_us,
       CASE WHEN rt <= st + INTERVAL {TASK_TIMEOUT.split()[0]} DAY THEN rs ELSE 'timeout' END AS outcome,
       CASE WHEN rt <= st + INTERVAL {TASK_TIMEOUT.split()[0]} DAY THEN epoch_us(rt)::VARCHAR ELSE 'none' END AS result_us
FROM s JOIN r USING (task_id)""")
def st_tasks_join(spark, sf):
    """Submissions (each task's first poll) and results (its terminal states) as two streams, joined within a day. A heartbeat
    on both streams, a day and the watermark's hour after the last event, closes the log."""
    te = task_events(spark, sf)
    submits = te.groupBy("task_id").agg(F.min("ts").alias("submit_ts"))
    results = te.filter(F.col("status") != "running").select("task_id", "event_id", F.col("ts").alias("result_ts"), "status")
    own = _own_session(spark)
    paths = [_land(submits, "st-submits-src", spark), _land(results, "st-results-src", spark)]
    end = te.select((F.max("ts") + F.expr(f"INTERVAL {TASK_TIMEOUT}") + F.expr("INTERVAL 2 HOURS")).alias("t"))
    out, ck = shared_dir(spark, "st-join-out"), shared_dir(spark, "st-join-ck")

    def run():
        res = join_tasks(stream_task_events(own, paths[0], submits.schema), stream_task_events(own, paths[1], results.schema),
                         timeout=TASK_TIMEOUT, watermark="1 hour", tie="event_id")
        _run(res.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append"))
        return res.schema

    run()
    end.select(F.lit(-1).cast("bigint").alias("task_id"), F.col("t").alias("submit_ts")).write.mode("append").parquet(paths[0])
    end.select(F.lit(-1).cast("bigint").alias("task_id"), F.lit(-1).cast("bigint").alias("event_id"), F.col("t").alias("result_ts"),
               F.lit("failure").alias("status")).write.mode("append").parquet(paths[1])
    back = spark.read.schema(run()).parquet(out).filter("task_id >= 0")
    return back.select("task_id", F.unix_micros("submit_ts").alias("submit_us"), "outcome",
                       F.coalesce(F.unix_micros("result_ts").cast("string"), F.lit("none")).alias("result_us"))


@query("wn_task_outcome", sql=f"""
WITH {SQL_TASK_EVENTS},
a AS (SELECT task_id, min(ts) FILTER (WHERE status IN ('success', 'failure')) AS end_ts,
             arg_min(status, (ts, event_id)) FILTER (WHERE status IN ('success', 'failure')) AS end_status,
             min(ts) AS first_ts, count(*) AS n_events
      FROM task_events GROUP BY task_id)
SELECT a.task_id, coalesce(end_status, 'running') AS outcome,
       epoch_us(first_ts) AS first_us, epoch_us(end_ts)::VARCHAR AS end_us, n_events::BIGINT AS n_events,
       (SELECT count(*) FROM task_events t WHERE t.task_id = a.task_id AND (a.end_ts IS NULL OR t.ts < a.end_ts))::BIGINT AS polls_before_end
FROM a""")
def wn_task_outcome(spark, sf):
    """First terminal status per task, when it came and how many polls preceded it."""
    t = OP.task_outcome(task_events(spark, sf), tie="event_id")
    return t.select("task_id", "outcome", F.unix_micros("first_ts").alias("first_us"),
                    F.unix_micros("end_ts").cast("string").alias("end_us"),
                    F.col("n_events").cast("bigint").alias("n_events"),
                    F.col("polls_before_end").cast("bigint").alias("polls_before_end"))
