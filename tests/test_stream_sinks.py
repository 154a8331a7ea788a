"""ST3 as a stream-stream join and SNK2's streaming form."""

import pytest
from pyspark.sql import functions as F

from inferframe.plans.q_streams import _run
from inferframe.session import shared_dir
from inferframe.sources import sinks as S
from inferframe.streaming.tasks import join_tasks

SUBMIT, RESULT = "task_id long, submit_ts timestamp", "task_id long, result_ts timestamp, status string, event_id long"


def day(d, h=0, m=0):
    return f"2024-01-{d:02d} {h:02d}:{m:02d}:00"


def joined(spark, steps):
    """steps: (submissions, results) of each micro-batch."""
    src = [shared_dir(spark, f"t-join-{x}") for x in "sr"]
    out, ck = shared_dir(spark, "t-join-out"), shared_dir(spark, "t-join-ck")
    for step in steps:
        for path, schema, rows in zip(src, (SUBMIT, RESULT), step):
            df = spark.createDataFrame(rows, schema.replace("timestamp", "string"))
            df.select(*[F.col(c).cast("timestamp") if c.endswith("_ts") else c for c in df.columns]).coalesce(1).write.mode("append").parquet(path)
        res = join_tasks(spark.readStream.schema(SUBMIT).parquet(src[0]), spark.readStream.schema(RESULT).parquet(src[1]),
                         timeout="1 day", watermark="1 hour", tie="event_id")
        _run(res.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append"))
    rows = spark.read.schema(res.schema).parquet(out).filter("task_id >= 0").collect()
    return sorted((r.task_id, str(r.submit_ts), r.outcome, str(r.result_ts)) for r in rows)


END = ([(-1, day(20))], [(-1, day(20), "failure", 0)])


def test_first_terminal_result_within_the_deadline(spark):
    got = joined(spark, [
        ([(1, day(1)), (2, day(1)), (3, day(1)), (4, day(1)), (5, day(2)), (None, day(1)), (6, None)],
         [(1, day(1, 5), "success", 9), (1, day(1, 3), "failure", 8), (2, day(2), "success", 7), (3, day(2, 0, 1), "success", 6),
          (4, day(1, 1), "running", 5), (5, day(1, 23), "success", 4), (None, day(1, 2), "success", 3), (6, day(1, 2), None, 2)]),
        END, ([(-1, day(25))], [(-1, day(25), "failure", 0)])])
    assert got == [(1, day(1), "failure", day(1, 3)), (2, day(1), "success", day(2)), (3, day(1), "timeout", "None"),
                   (4, day(1), "timeout", "None"), (5, day(2), "timeout", "None")]


def test_later_batches_do_not_answer_again(spark):
    got = joined(spark, [
        ([(1, day(1)), (2, day(1))], [(1, day(1, 5), "success", 2)]),
        ([(3, day(1, 6))], [(1, day(1, 4, 30), "failure", 1), (2, day(1, 6), "success", 3), (2, day(1, 6), "failure", 2)]),
        ([(1, day(1, 7))], [(1, day(1, 8), "failure", 4)]),  # the same task, submitted again
        END, ([(-1, day(25))], [(-1, day(25), "failure", 0)])])
    assert got == [(1, day(1), "failure", day(1, 4, 30)), (1, day(1, 7), "failure", day(1, 8)), (2, day(1), "failure", day(1, 6)),
                   (3, day(1, 6), "timeout", "None")]


def test_joined_plan_is_built_in(spark):
    src = [shared_dir(spark, f"t-plan-{x}") for x in "sr"]
    for path, schema in zip(src, (SUBMIT, RESULT)):
        spark.createDataFrame([], schema).write.parquet(path)
    res = join_tasks(spark.readStream.schema(SUBMIT).parquet(src[0]), spark.readStream.schema(RESULT).parquet(src[1]))
    assert "Python" not in res._jdf.queryExecution().toString()


# ---------------------------------------------------------------- SNK2

ROWS = [(1, 200, "a"), (2, 500, "b"), (3, None, None), (4, 200, None)]


def responses(spark, rows):
    return spark.createDataFrame(rows, "request_id long, status_code int, body string")


def shown(spark, path, sink):
    df = S.read_outcomes(spark, path, sink, responses(spark, []).schema)
    return sorted((r.request_id, r.batch_id) for r in df.collect())


def test_stream_into_two_sinks(spark):
    src, out, ck = (shared_dir(spark, f"t-snk-{x}") for x in ("src", "out", "ck"))
    for part in (ROWS[:2], ROWS[2:]):
        responses(spark, part).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(responses(spark, []).schema).parquet(src)
        S.stream_outcomes(stream, out, ck, available_now=True).awaitTermination()
    assert shown(spark, out, S.OK_SINK) == [(1, 0), (4, 1)] and shown(spark, out, S.DEAD_SINK) == [(2, 0), (3, 1)]
    assert sorted(tuple(r) for r in S.read_commits(spark, out).collect()) == [(0, 1, 1), (1, 1, 1)]


def test_a_batch_run_again_changes_nothing(spark):
    out = shared_dir(spark, "t-snk-again")
    assert S.write_outcome_batch(responses(spark, ROWS), 0, out)
    assert not S.write_outcome_batch(responses(spark, ROWS * 2), 0, out)
    assert [i for i, _ in shown(spark, out, S.OK_SINK)] == [1, 4]


@pytest.mark.parametrize("broke_after", [S.OK_SINK, S.DEAD_SINK])
def test_a_broken_batch_is_hidden_then_written_whole(spark, broke_after):
    out = shared_dir(spark, "t-snk-broken")
    S.write_outcome_batch(responses(spark, ROWS[:2]), 0, out)
    left = responses(spark, [(9, 200, "half"), (9, 200, "half")])
    for sink in (S.OK_SINK, S.DEAD_SINK):  # what a crash left behind
        left.write.parquet(f"{out}/{sink}/batch_id=1")
        if sink == broke_after:
            break
    assert shown(spark, out, S.OK_SINK) == [(1, 0)]
    assert S.write_outcome_batch(responses(spark, ROWS[2:]), 1, out)
    assert shown(spark, out, S.OK_SINK) == [(1, 0), (4, 1)] and shown(spark, out, S.DEAD_SINK) == [(2, 0), (3, 1)]


def test_batches_without_rows_of_one_kind(spark):
    out = shared_dir(spark, "t-snk-empty")
    S.write_outcome_batch(responses(spark, []), 0, out)
    S.write_outcome_batch(responses(spark, [(1, 200, "a")]), 1, out)
    assert shown(spark, out, S.OK_SINK) == [(1, 1)] and shown(spark, out, S.DEAD_SINK) == []
