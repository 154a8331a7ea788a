"""Streams equal their batch counterparts."""

from tests.conftest import SF_SMALL

import __spark_entry__ as E

Q = E.queries()


def test_stream_content_equals_batch(spark):
    s = {r["request_id"]: (r["content_md5"], r["complete"]) for r in Q["st_content"](spark, SF_SMALL).collect()}
    b = {r["request_id"]: (r["content_md5"], r["round_trip"]) for r in Q["ag_content"](spark, SF_SMALL).collect()}
    assert s.keys() == b.keys()
    assert all(s[k][0] == b[k][0] and s[k][1] and b[k][1] for k in s)


def test_stream_tool_calls_equal_batch(spark):
    cols = ["request_id", "tool_index", "tool_id", "tool_name", "arguments", "n_fragments"]
    s = sorted(Q["st_tool_calls"](spark, SF_SMALL).select(cols).collect())
    b = sorted(Q["ag_tool_calls"](spark, SF_SMALL).select(cols).collect())
    assert s == b


def test_stream_tasks_equal_batch_with_timeout(spark):
    """One-day deadline: tasks without a terminal result by then come out as timeout."""
    day_us = 24 * 3600 * 1_000_000
    got = {r["task_id"]: r["outcome"] for r in Q["st_tasks"](spark, SF_SMALL).collect()}
    want = {}
    for r in Q["wn_task_outcome"](spark, SF_SMALL).collect():
        end = None if r["end_us"] is None else int(r["end_us"])
        in_time = end is not None and end - r["first_us"] <= day_us
        want[r["task_id"]] = r["outcome"] if in_time else "timeout"
    assert got == want


def test_finish_marker_state_processor_equals_batch(spark):
    """The Python state-processor variant (emit on finish marker + all fragments) over a
    shuffled file stream with a duplicated file."""
    from pyspark.sql import functions as F
    from inferframe.plans.fixtures import content_chunks
    from inferframe.plans.q_streams import _land, _run
    from inferframe.session import shared_dir
    from inferframe.streaming.assemble import stream_assemble_content

    ch = content_chunks(spark, SF_SMALL)
    src = _land(ch, "t-src", spark)
    ch.filter(F.col("seq") % 5 == 0).write.mode("append").parquet(src)  # duplicate deliveries
    out, ck = shared_dir(spark, "t-out"), shared_dir(spark, "t-ck")
    stream = spark.readStream.schema(ch.schema).option("maxFilesPerTrigger", 3).parquet(src)
    _run(stream_assemble_content(stream, watermark="2 days").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck).outputMode("append"))
    got = {r["request_id"]: (r["m"], r["complete"]) for r in
           spark.read.parquet(out).select("request_id", F.md5("content").alias("m"), "complete").collect()}
    want = {r["request_id"]: r["content_md5"] for r in Q["ag_content"](spark, SF_SMALL).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == (want[k], True) for k in want)


def test_session_stream_drops_redelivered_fragments(spark):
    from pyspark.sql import functions as F
    from inferframe.plans.fixtures import content_chunks
    from inferframe.plans.q_streams import _land, _run
    from inferframe.session import shared_dir
    from inferframe.streaming.assemble import stream_assemble_content_sessions

    ch = content_chunks(spark, SF_SMALL)
    src = _land(ch, "t-dup-src", spark)
    ch.filter(F.col("seq") % 3 == 0).write.mode("append").parquet(src)  # re-sent fragments
    out, ck = shared_dir(spark, "t-dup-out"), shared_dir(spark, "t-dup-ck")
    stream = spark.readStream.schema(ch.schema).option("maxFilesPerTrigger", 3).parquet(src)
    res = stream_assemble_content_sessions(stream, gap="5 minutes", watermark="1 hour")
    _run(res.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append"))
    # a late far-future fragment closes the remaining sessions
    spark.createDataFrame([(-1, 0, "", None, 0)],
                          "request_id bigint, seq bigint, content string, finish_reason string, created bigint") \
        .withColumn("ts", F.lit("2030-01-01 00:00:00").cast("timestamp")).write.mode("append").parquet(src)
    _run(res.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append"))
    got = {r["request_id"]: r["m"] for r in spark.read.parquet(out).filter("request_id >= 0")
           .select("request_id", F.md5("content").alias("m")).collect()}
    want = {r["request_id"]: r["content_md5"] for r in Q["ag_content"](spark, SF_SMALL).collect()}
    assert got == want


def test_tool_call_fragments_at_different_times_make_one_call(spark):
    """Fragments of one call seconds apart, in several micro-batches, one of them twice."""
    from pyspark.sql import functions as F
    from inferframe.plans.q_streams import _run
    from inferframe.session import shared_dir
    from inferframe.streaming.assemble import stream_assemble_tool_calls

    schema = "request_id long, seq long, tool_index long, tool_id string, tool_name string, tool_args string, ts timestamp"
    src = shared_dir(spark, "t-call-src")
    parts = [[(1, 0, 0, "c1", "f", "{")], [(1, 2, 0, None, None, "}"), (1, 0, 0, "c1", "f", "{")], [(1, 1, 0, None, None, "x")]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema.replace(", ts timestamp", "")) \
            .withColumn("ts", F.lit(f"2024-01-01 00:0{i}:00").cast("timestamp")).coalesce(1).write.mode("append").parquet(src)
    log, ck = shared_dir(spark, "t-call-log"), shared_dir(spark, "t-call-ck")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)

    def append(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    _run(stream_assemble_tool_calls(stream).writeStream.foreachBatch(append).option("checkpointLocation", ck).outputMode("update"))
    last = spark.read.parquet(log).orderBy(F.desc("batch_id")).first()
    assert (last.tool_id, last.tool_name, last.arguments, last.n_fragments) == ("c1", "f", "{x}", 3)


def test_first_terminal_state_answers_a_task_once(spark):
    from pyspark.sql import functions as F
    from inferframe.plans.q_streams import _run
    from inferframe.session import shared_dir
    from inferframe.streaming.tasks import track_tasks

    rows = [(1, "2024-01-01 00:00:00", "running"), (1, "2024-01-01 01:00:00", "failure"), (1, "2024-01-01 02:00:00", "success"),
            (2, "2024-01-01 00:00:00", "running"), (2, "2024-01-05 00:00:00", "success"), (-1, "2025-01-01 00:00:00", "running")]
    src = shared_dir(spark, "t-task-src")
    df = spark.createDataFrame(rows, "task_id long, t string, status string").select("task_id", F.col("t").cast("timestamp").alias("ts"), "status")
    df.filter("task_id > 0").coalesce(1).write.mode("append").parquet(src)
    out, ck = shared_dir(spark, "t-task-out"), shared_dir(spark, "t-task-ck")

    def run():
        res = track_tasks(spark.readStream.schema(df.schema).parquet(src), timeout="1 day")
        _run(res.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append"))

    run()
    df.filter("task_id < 0").write.mode("append").parquet(src)
    run()
    got = sorted((r.task_id, r.outcome) for r in spark.read.parquet(out).filter("task_id > 0").collect())
    assert got == [(1, "failure"), (2, "timeout")]
