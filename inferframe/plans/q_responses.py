"""Invoke and response queries: UDF1, RSP1, RSP2, RSP5, RSP8, SRC4, JN7, AG7, SNK2.

Responses come from `plans.answers`: logs built with Spark expressions from md5 of the
request's payload text, so DuckDB can state every expected answer from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from inferframe.functions.scalars import base64_nolines
from inferframe.operators import ops as OP
from inferframe.operators import requests as RQ
from inferframe.operators import responses as RS
from inferframe.operators.invoke import invoke, invoke_resumable
from inferframe.plans import answers as AN
from inferframe.plans.catalog import query
from inferframe.plans.fixtures import tbl
from inferframe.plans.q_requests import base_requests
from inferframe.session import shared_dir
from inferframe.sources.readers import read_responses
from inferframe.sources.sinks import DEAD_SINK, OK_SINK, read_outcomes, stream_outcomes, write_outcome_batch, write_outcomes
from inferframe.sources.streams import stream_chunks

SQL_OUTCOME = ("CASE substr(md5({p}), 1, 1) WHEN '0' THEN 'connection_error' "
               "WHEN '1' THEN 'http_error' ELSE 'ok' END")


def chat_requests(spark, sf):
    r = RQ.chat_request(base_requests(spark, sf))
    think = F.when(F.col("lang") == "en", F.lit(True))
    opts = RQ.options_json(temperature=F.lit(1.0), top_p=F.lit(0.95), top_k=F.lit(64),
                           presence_penalty=F.lit(None).cast("double"),
                           max_tokens=F.lit(32768), max_completion_tokens=F.lit(None).cast("int"),
                           enable_thinking=think)
    return (r.withColumn("body", RQ.chat_body("model", "messages", opts))
             .withColumn("kind", F.lit("chat")))


def docs_as_requests(spark, sf):
    return tbl(spark, sf, "documents").select(F.col("doc_id").alias("request_id"), "text", "lang", "source")


def chat_responses(spark, sf, requests=None):
    r = docs_as_requests(spark, sf) if requests is None else requests
    return AN.chat_answers(r, "text", F.col("lang") == "en").drop("text")


class Audit:
    """A transport that sends nothing: it reads each request body and answers with what it
    found, the dry run before a paid one. Unreadable bodies raise, as a client would."""

    def __call__(self, kind: str, body: str):
        import json
        req = json.loads(body)
        text = "".join(m.get("content") or "" for m in req.get("messages", []))
        if not text.strip():
            return 422, json.dumps({"error": {"message": "empty request"}})
        return 200, json.dumps({"kind": kind, "messages": len(req["messages"]), "chars": len(text)})


SQL_INVOKE = f"""
WITH d AS (SELECT doc_id, text, substr(md5(text), 1, 1) = '0' AS cut FROM documents)
SELECT doc_id AS request_id,
       CASE WHEN cut THEN NULL WHEN trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN '422' ELSE '200' END AS status,
       CASE WHEN NOT cut AND trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> '' THEN length(text)::VARCHAR END AS chars,
       CASE WHEN cut THEN 'JSONDecodeError'
            WHEN trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 'empty request' END AS error_kind
FROM d"""


@query("udf_invoke", sql=SQL_INVOKE)
def udf_invoke(spark, sf):
    """Chat requests through a per-partition transport (a dry run that audits each body); bodies
    cut short and refused requests become rows with the error text."""
    return audited(invoke(audit_requests(spark, sf), Audit))


@query("udf_invoke_resumed", sql=SQL_INVOKE)
def udf_invoke_resumed(spark, sf):
    """The same calls by three runs on one answer log: the first two end after a round, the third sends what is left. Refused
    bodies (no status) are sent again by each run and stay errors."""
    req, log = audit_requests(spark, sf), shared_dir(spark, "answer-log")
    size = max(1, req.count() // 4)
    for rounds in (1, 1, None):
        r = invoke_resumable(req, Audit, log, round_size=size, max_rounds=rounds)
    return audited(r)


def audit_requests(spark, sf):
    cut = F.substring(F.md5("text"), 1, 1) == "0"
    body = F.when(cut, F.substring("body", F.lit(1), F.length("body") - 3)).otherwise(F.col("body"))
    return chat_requests(spark, sf).withColumn("body", body)


def audited(r):
    err = (F.when(F.col("status_code").isNull(), F.regexp_extract("error", r"^(\w+):", 1))
           .when(F.col("status_code") != 200, F.get_json_object("error", "$.error.message")))
    return r.select("request_id", F.col("status_code").cast("string").alias("status"),
                    F.when(F.col("status_code") == 200, F.get_json_object("body", "$.chars")).alias("chars"),
                    err.alias("error_kind"))


@query("rsp_chat", sql=f"""
SELECT doc_id AS request_id, {SQL_OUTCOME.format(p='text')} AS outcome,
       CASE WHEN substr(md5(text), 1, 1) NOT IN ('0', '1') THEN md5(text) END AS content,
       CASE WHEN substr(md5(text), 1, 1) NOT IN ('0', '1') AND lang = 'en'
            THEN 'thought:' || substr(md5(text), 1, 8) END AS reasoning
FROM documents""")
def rsp_chat(spark, sf):
    """First choice's content and reasoning (absent reasoning => NULL)."""
    r = RS.parse_chat(RS.with_outcome(chat_responses(spark, sf)))
    return r.select("request_id", "outcome", "content", "reasoning")


@query("rsp_completion", sql=f"""
SELECT doc_id AS request_id, {SQL_OUTCOME.format(p='text')} AS outcome,
       CASE WHEN substr(md5(text), 1, 1) NOT IN ('0', '1') THEN md5(text) END AS completion
FROM documents""")
def rsp_completion(spark, sf):
    """Text completions: ``choices[0].text``."""
    r = RS.parse_completion(RS.with_outcome(AN.completion_answers(docs_as_requests(spark, sf), "text")))
    return r.select("request_id", "outcome", "completion")


@query("rsp_transcript", sql=f"""
WITH t AS (SELECT doc_id, to_base64(encode(text)) AS f FROM documents)
SELECT doc_id AS request_id, {SQL_OUTCOME.format(p='f')} AS outcome,
       CASE WHEN substr(md5(f), 1, 1) NOT IN ('0', '1') THEN md5(f) END AS transcript
FROM t""")
def rsp_transcript(spark, sf):
    """Transcription answers (JSON text with ``text``)."""
    files = docs_as_requests(spark, sf).withColumn("file", base64_nolines(F.col("text")))
    r = RS.parse_transcript(RS.with_outcome(AN.transcript_answers(files, "file")))
    return r.select("request_id", "outcome", "transcript")


def all_responses(spark, sf):
    """Answers of three kinds per document, from one scan: the kinds are exploded with the
    payload each of them would have sent."""
    d = docs_as_requests(spark, sf)
    kinds = F.array(F.struct(F.lit("chat").alias("kind"), F.col("text").alias("payload")),
                    F.struct(F.lit("completion").alias("kind"), F.col("text").alias("payload")),
                    F.struct(F.lit("transcribe").alias("kind"), base64_nolines(F.col("text")).alias("payload")))
    r = d.select("request_id", F.explode(kinds).alias("k")).select("request_id", "k.payload", F.col("k.kind").alias("_kind"))
    out = AN.answered(r, "any", F.to_json(F.struct(F.col("_h").alias("text"))))
    return out.select("request_id", F.col("_kind").alias("kind"), "status_code", "body", "error")


SQL_ALL_OUTCOMES = f"""
all_out AS (
  SELECT doc_id AS request_id, 'chat' AS kind, {SQL_OUTCOME.format(p='text')} AS outcome FROM documents
  UNION ALL
  SELECT doc_id, 'completion', {SQL_OUTCOME.format(p='text')} FROM documents
  UNION ALL
  SELECT doc_id, 'transcribe', {SQL_OUTCOME.format(p='to_base64(encode(text))')} FROM documents)"""


@query("rsp_outcome", sql=f"WITH {SQL_ALL_OUTCOMES} SELECT request_id, kind, outcome FROM all_out")
def rsp_outcome(spark, sf):
    """ok / http_error / connection_error for every call of three kinds."""
    r = RS.with_outcome(all_responses(spark, sf))
    return r.select("request_id", "kind", "outcome")


@query("ag_outcomes", sql=f"""
WITH {SQL_ALL_OUTCOMES} SELECT kind, outcome, count(*)::BIGINT AS n FROM all_out GROUP BY kind, outcome""")
def ag_outcomes(spark, sf):
    """Calls per kind and outcome."""
    return OP.outcome_summary(all_responses(spark, sf))


@query("snk_outcomes", sql=f"""
WITH {SQL_ALL_OUTCOMES}
SELECT outcome, count(*)::BIGINT AS n, count(DISTINCT kind)::BIGINT AS n_kinds FROM all_out GROUP BY outcome""")
def snk_outcomes(spark, sf):
    """Ok rows and dead letters written in one pass, partitioned by outcome, read back."""
    path = shared_dir(spark, "outcomes")
    write_outcomes(RS.with_outcome(all_responses(spark, sf)), path)
    back = spark.read.parquet(path)
    return back.groupBy("outcome").agg(F.count("*").alias("n"),
                                       F.countDistinct("kind").alias("n_kinds"))


@query("snk_outcomes_stream", sql=f"""
WITH {SQL_ALL_OUTCOMES}
SELECT CASE WHEN outcome = 'ok' THEN 'ok' ELSE 'dead' END AS sink, kind, outcome, count(*)::BIGINT AS n FROM all_out GROUP BY 1, 2, 3""")
def snk_outcomes_stream(spark, sf):
    """The same responses as a file stream into two sinks with a commit record per micro-batch; one batch is sent
    to the sink once more, as after a crash, and changes nothing."""
    src, path, ck = (shared_dir(spark, f"outcome-stream-{x}") for x in ("src", "out", "ck"))
    rows = all_responses(spark, sf).select("kind", "status_code")
    rows.write.parquet(src)
    stream_outcomes(stream_chunks(spark, src, rows.schema, max_files_per_trigger=4), path, ck, available_now=True).awaitTermination()
    write_outcome_batch(spark.read.parquet(src), 0, path)
    back = [read_outcomes(spark, path, sink, rows.schema).select(F.lit(sink).alias("sink"), "kind", "status_code") for sink in (OK_SINK, DEAD_SINK)]
    return RS.with_outcome(back[0].union(back[1])).groupBy("sink", "kind", "outcome").agg(F.count("*").alias("n"))


@query("src_responses", sql=f"""
SELECT doc_id AS request_id, 'chat' AS kind, {SQL_OUTCOME.format(p='text')} AS outcome,
       CASE WHEN substr(md5(text), 1, 1) NOT IN ('0', '1') THEN md5(text) END AS content
FROM documents""")
def src_responses(spark, sf):
    """A JSON response log read back with a fixed schema (no inference)."""
    path = shared_dir(spark, "responses")
    chat_responses(spark, sf).select("request_id", "kind", "status_code", "body") \
        .write.mode("overwrite").json(path)
    r = RS.parse_chat(RS.with_outcome(read_responses(spark, path)))
    return r.select("request_id", "kind", "outcome", "content")


def earlier_log(spark, sf):
    """The response log of an earlier run that covered sources src0..src14 only."""
    r = docs_as_requests(spark, sf)
    return chat_responses(spark, sf, r.filter(F.regexp_extract("source", r"(\d+)$", 1).cast("int") < 15))


SQL_RECONCILE = f"""
rec AS (
  SELECT doc_id AS request_id,
         CASE WHEN regexp_extract(source, '(\\d+)$', 1)::INTEGER >= 15 THEN 'pending'
              ELSE {SQL_OUTCOME.format(p='text')} END AS outcome
  FROM documents)"""


@query("jn_reconcile", sql=f"WITH {SQL_RECONCILE} SELECT request_id, outcome FROM rec")
def jn_reconcile(spark, sf):
    """All current requests against the earlier response log: outcome or pending."""
    req = docs_as_requests(spark, sf).select("request_id")
    return OP.reconcile(req, earlier_log(spark, sf)).select("request_id", "outcome")


@query("jn_pending", sql=f"WITH {SQL_RECONCILE} SELECT request_id FROM rec WHERE outcome = 'pending'")
def jn_pending(spark, sf):
    """Requests never answered (anti join against the log's ids)."""
    return OP.pending(docs_as_requests(spark, sf).select("request_id"), earlier_log(spark, sf))


@query("jn_retry", sql=f"WITH {SQL_RECONCILE} SELECT request_id, outcome AS reason FROM rec WHERE outcome <> 'ok'")
def jn_retry(spark, sf):
    """The retry set: never answered plus failed calls, from one reconcile pass (the
    response log is read once)."""
    rs = OP.retry_set(docs_as_requests(spark, sf).select("request_id"), earlier_log(spark, sf))
    return rs.select("request_id", F.col("outcome").alias("reason"))


@query("rsp_errors", sql="""
SELECT doc_id AS request_id, 'overloaded, request refused' AS message, 1500 AS detail_len
FROM documents WHERE substr(md5(text), 1, 1) = '1'""")
def rsp_errors(spark, sf):
    """Failed calls keep their whole error body, however long."""
    r = chat_responses(spark, sf).filter(F.col("status_code") != 200)
    return r.select("request_id", F.get_json_object("error", "$.error.message").alias("message"),
                    F.length(F.get_json_object("error", "$.error.detail")).alias("detail_len"))
