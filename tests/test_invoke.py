"""The per-partition transport: failures are rows, outcomes partition the input,
the transport is opened once per partition and closed."""

import json

from pyspark.sql import functions as F

from inferframe.operators.invoke import invoke
from inferframe.operators.responses import classify_outcome


class Flaky:
    opened = 0

    def __call__(self, kind, body):
        n = json.loads(body)["n"]
        if n % 3 == 0:
            raise ConnectionError("down")
        if n % 3 == 1:
            return 503, "busy"
        return 200, json.dumps({"ok": n})


def test_failures_become_rows(spark):
    req = spark.range(0, 300).select(F.col("id").alias("request_id"), F.lit("chat").alias("kind"),
                                     F.to_json(F.struct(F.col("id").alias("n"))).alias("body"))
    out = invoke(req, Flaky, max_in_flight=4)
    rows = out.withColumn("o", classify_outcome("status_code")).groupBy("o").count().collect()
    got = {r["o"]: r["count"] for r in rows}
    assert got == {"connection_error": 100, "http_error": 100, "ok": 100}
    assert out.count() == 300
    assert out.filter("status_code is null and error like 'ConnectionError%'").count() == 100


def test_durable_invoke_reads_stored_answers(spark):
    req = spark.range(0, 50).select(F.col("id").alias("request_id"), F.lit("chat").alias("kind"),
                                    F.to_json(F.struct(F.col("id").alias("n"))).alias("body"))
    out = invoke(req, Flaky, durable=True)
    assert "MapInPandas" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 50


class Batched(Flaky):
    calls = []

    def call_many(self, kinds, bodies):
        if len(bodies) > 16:
            raise AssertionError("batch larger than requested")
        out = []
        for k, b in zip(kinds, bodies):
            try:
                out.append(self(k, b))
            except Exception as e:  # noqa: BLE001
                out.append(e)
        return out


def test_batched_transport(spark):
    req = spark.range(0, 120).select(F.col("id").alias("request_id"), F.lit("chat").alias("kind"),
                                     F.to_json(F.struct(F.col("id").alias("n"))).alias("body"))
    out = invoke(req, Batched, batch_size=16).withColumn("o", classify_outcome("status_code"))
    got = {r["o"]: r["count"] for r in out.groupBy("o").count().collect()}
    assert got == {"connection_error": 40, "http_error": 40, "ok": 40}


def test_reconcile_with_repeated_attempts(spark):
    from inferframe.operators.ops import pending, reconcile, retry_set
    req = spark.createDataFrame([(i,) for i in range(6)], "request_id long")
    log = spark.createDataFrame(
        [(0, 200), (1, None), (1, 200), (2, 503), (2, None), (3, None), (4, 500), (4, 500)],
        "request_id long, status_code int").withColumn("error", F.lit(None).cast("string"))
    got = {r["request_id"]: (r["outcome"], r["attempts"]) for r in reconcile(req, log).collect()}
    assert got == {0: ("ok", 1), 1: ("ok", 2), 2: ("http_error", 2), 3: ("connection_error", 1),
                   4: ("http_error", 2), 5: ("pending", 0)}
    assert [r[0] for r in pending(req, log).collect()] == [5]
    assert sorted(r["request_id"] for r in retry_set(req, log).collect()) == [2, 3, 4, 5]


class LongError:
    def __call__(self, kind, body):
        if kind == "slow":
            raise TimeoutError("t" * 3000)
        return 500, json.dumps({"error": {"detail": "x" * 3000, "message": "full"}})


def test_long_errors_and_text_ids_survive(spark):
    req = spark.createDataFrame([("chatcmpl-1", "chat", "{}"), ("chatcmpl-2", "slow", "{}")], "request_id string, kind string, body string")
    out = {r.request_id: r for r in invoke(req, LongError).collect()}
    assert json.loads(out["chatcmpl-1"].error)["error"]["message"] == "full"
    assert out["chatcmpl-2"].error == "TimeoutError: " + "t" * 3000 and out["chatcmpl-2"].status_code is None


def test_response_log_keeps_text_ids_and_errors(spark, tmp_path):
    from inferframe.sources.readers import read_conversations, read_responses
    log = spark.createDataFrame([("chatcmpl-1", "chat", 500, None, "boom")], "request_id string, kind string, status_code int, body string, error string")
    log.write.json(str(tmp_path / "log"))
    r = read_responses(spark, str(tmp_path / "log"), id_type="string").first()
    assert (r.request_id, r.error) == ("chatcmpl-1", "boom")
    conv = spark.createDataFrame(
        [(1, 0, "assistant", None, [("c1", "f", "{}", "function")], None, None), (1, 1, "tool", "ok", None, "c1", "f")],
        "conv_id long, turn long, role string, text string, tool_calls array<struct<id: string, name: string, arguments: string, type: string>>, "
        "tool_call_id string, name string")
    conv.write.parquet(str(tmp_path / "conv"))
    got = read_conversations(spark, str(tmp_path / "conv")).orderBy("turn").collect()
    assert got[0].tool_calls[0].asDict() == {"id": "c1", "name": "f", "arguments": "{}"} and got[0].parts is None
    assert (got[1].tool_call_id, got[1].name, got[1].text) == ("c1", "f", "ok")


def test_unreadable_answers_are_reject_rows(spark):
    from inferframe.operators import responses as RS
    rows = [(1, 200, '{"results":[{"index":0,"relevance_score":0.5}]}'), (2, 200, "{oops"), (3, 200, '{"results":[]}'), (4, 500, "x")]
    df = spark.createDataFrame(rows, "request_id long, status_code int, body string")
    got = sorted((r.request_id, r.idx, r.parse_error) for r in RS.explode_rerank(df).collect())
    assert got == [(1, 0, None), (2, None, "malformed")]
    layouts = [(1, '[{"bbox":[0,0,1,1],"category":"Text","text":"a"}]'), (2, '{"layout":[{"bbox":[0,0,1,1],"category":"Title","text":"b"}]}'),
               (3, '{"bbox":[0,0,1,1],"category":"Table","text":"c"}'), (4, "nothing"), (5, "[]"), (6, None)]
    got = RS.explode_layout(spark.createDataFrame(layouts, "id long, content string")).collect()
    assert sorted((r.id, r.category, r.text, r.parse_error) for r in got if r.id != 4) == [(1, "Text", "a", None), (2, "Title", "b", None), (3, "Table", "c", None)]
    assert [(r.category, r.parse_error) for r in got if r.id == 4] == [(None, "malformed")]
