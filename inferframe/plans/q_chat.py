"""Conversation, fragment and tool-call queries: AG3, AG4, AG5, WN2, WN3, FL2, RSP6, JN5,
JN6, UDF2, VAL6, SE1."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from inferframe import refdata as R
from inferframe.operators import chat as CH
from inferframe.operators import responses as RS
from inferframe.operators.validate import check_tool_args
from inferframe.plans.answers import tool_answers
from inferframe.plans.catalog import query
from inferframe.plans.fixtures import (
    SQL_CHUNKS, SQL_TOOL_CHUNKS, content_chunks, tbl, tool_chunks,
)

# ------------------------------------------------------------------ streamed content


@query("ag_content", sql=f"""
WITH {SQL_CHUNKS}
SELECT request_id, md5(string_agg(content, '' ORDER BY seq)) AS content_md5,
       count(*)::BIGINT AS n_chunks, count(*) FILTER (WHERE content = '')::BIGINT AS n_heartbeats,
       min(created) AS first_created, max(created) AS last_created, max(finish_reason) AS finish_reason,
       md5(string_agg(content, '' ORDER BY seq)) = md5(any_value(d.text)) AS round_trip
FROM chunks JOIN documents d ON d.doc_id = chunks.request_id GROUP BY request_id""")
def ag_content(spark, sf):
    """Streamed fragments assembled per request in sequence order (two-level concat)."""
    ch = content_chunks(spark, sf)
    a = CH.assemble_content(ch)
    docs = tbl(spark, sf, "documents").select(F.col("doc_id").alias("request_id"),
                                              F.md5("text").alias("_text_md5"))
    return (a.join(docs, "request_id")
             .select("request_id", F.md5("content").alias("content_md5"),
                     F.col("n_chunks").cast("bigint").alias("n_chunks"),
                     F.col("n_heartbeats").cast("bigint").alias("n_heartbeats"),
                     "first_created", "last_created", "finish_reason",
                     (F.md5("content") == F.col("_text_md5")).alias("round_trip")))


@query("fl_deltas", sql=f"""
WITH {SQL_CHUNKS} SELECT request_id, seq, content FROM chunks WHERE content IS NOT NULL AND content <> ''""")
def fl_deltas(spark, sf):
    """Fragments that carry text (heartbeats removed)."""
    return CH.content_deltas(content_chunks(spark, sf)).select("request_id", "seq", "content")


@query("ag_tool_calls", sql=f"""
WITH {SQL_TOOL_CHUNKS}
SELECT request_id, tool_index, max(tool_id) AS tool_id, max(tool_name) AS tool_name,
       string_agg(tool_args, '' ORDER BY seq) AS arguments, count(*)::BIGINT AS n_fragments
FROM tool_chunks GROUP BY request_id, tool_index""")
def ag_tool_calls(spark, sf):
    """Streamed tool-call fragments assembled per (request, index): id, name, arguments."""
    a = CH.assemble_tool_calls(tool_chunks(spark, sf))
    return a.select("request_id", "tool_index", "tool_id", "tool_name", "arguments",
                    F.col("n_fragments").cast("bigint").alias("n_fragments"))


@query("wn_boundaries", sql=f"""
WITH {SQL_TOOL_CHUNKS}
SELECT request_id, seq, tool_index,
       dense_rank() OVER (PARTITION BY request_id ORDER BY tool_index)::BIGINT AS call_ordinal
FROM tool_chunks""")
def wn_boundaries(spark, sf):
    """Running call number: a new call starts whenever the index changes."""
    b = CH.tool_call_boundaries(tool_chunks(spark, sf))
    return b.select("request_id", "seq", "tool_index", "call_ordinal")


# ----------------------------------------------------------------------- conversations

@query("ag_conversation", sql="""
SELECT conv_id, count(*)::BIGINT AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
       md5(string_agg(role || ':' || text, chr(30) ORDER BY turn)) AS history_md5
FROM conversations GROUP BY conv_id""")
def ag_conversation(spark, sf):
    """Each conversation packed as its ordered message list."""
    p = CH.pack_conversation(tbl(spark, sf, "conversations"))
    m = F.col("messages")
    return p.select("conv_id", F.col("n_messages").cast("bigint").alias("n_messages"),
                    F.array_join(F.transform(m, lambda x: x["role"]), ",").alias("roles"),
                    F.md5(F.array_join(F.transform(m, lambda x: CH.msg_digest(x["role"], x["text"])),
                                       "\u001e")).alias("history_md5"))


@query("wn_history", sql="""
WITH h AS (
  SELECT conv_id, turn, role,
         count(*) OVER w AS n_history,
         md5(string_agg(role || ':' || text, chr(30)) OVER w) AS history_md5
  FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT conv_id, turn, n_history::BIGINT AS n_history, history_md5 FROM h WHERE role = 'assistant'""")
def wn_history(spark, sf):
    """For every assistant turn, the history the client sent to obtain it."""
    h = CH.history_prefix(tbl(spark, sf, "conversations"))
    return h.select("conv_id", "turn", F.col("n_history").cast("bigint").alias("n_history"),
                    F.md5(F.array_join(F.transform("history", lambda x: CH.msg_digest(x["role"], x["text"])),
                                       "\u001e")).alias("history_md5"))


@query("wn_history_bounded", sql="""
WITH c AS (SELECT conv_id, turn * 10 + conv_id % 7 AS turn, role, text FROM conversations),
h AS (
  SELECT conv_id, turn, role, count(*) OVER w AS n_history,
         md5(string_agg(role || ':' || text, chr(30)) OVER w) AS history_md5
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
SELECT conv_id, turn::BIGINT AS turn, n_history::BIGINT AS n_history, coalesce(history_md5, md5('')) AS history_md5
FROM h WHERE role = 'assistant'""")
def wn_history_bounded(spark, sf):
    """The last three messages before every assistant turn; turn numbers have gaps."""
    conv = tbl(spark, sf, "conversations").withColumn("turn", F.col("turn") * 10 + F.col("conv_id") % 7)
    h = CH.history_prefix(conv, max_turns=3, bucket_size=4)
    return h.select("conv_id", "turn", F.col("n_history").cast("bigint").alias("n_history"),
                    F.md5(F.array_join(F.transform("history", lambda x: CH.msg_digest(x["role"], x["text"])),
                                       "\u001e")).alias("history_md5"))


# --------------------------------------------------------------------------- tool round

def packed_requests(spark, sf):
    """One request per conversation, with the text of its last user message."""
    packed = CH.pack_conversation(tbl(spark, sf, "conversations"))
    users = F.filter("messages", lambda m: m["role"] == "user")
    last = F.coalesce(F.try_element_at(users, F.lit(-1))["text"], F.lit(""))
    return packed.select(F.col("conv_id").alias("request_id"), last.alias("payload"))


def tool_calls(spark, sf):
    calls = RS.explode_tool_calls(tool_answers(packed_requests(spark, sf)))
    return calls.filter(F.col("parse_error").isNull()).select(
        "request_id", F.col("call_idx").cast("bigint").alias("call_idx"), "tool_call_id",
        "tool_name", "arguments")


SQL_TOOL_CALLS = """
lu AS (
  SELECT conv_id, md5(coalesce(max_by(text, turn) FILTER (WHERE role = 'user'), '')) AS h
  FROM conversations GROUP BY conv_id),
calls AS (
  SELECT conv_id AS request_id, i::BIGINT AS call_idx,
         'call_' || substr(h, 3 + 4*i, 4) AS tool_call_id,
         CASE WHEN substr(h, 11 + i, 1) = 'f' THEN 'get_stock_price' ELSE 'get_current_weather' END AS tool_name,
         '{"city":"c' || substr(h, 13, 4) || '","state":"' || upper(substr(h, 17, 2)) || '"' ||
           CASE WHEN substr(h, 21 + i, 1) = '0' THEN ''
                ELSE ',"unit":"' || CASE WHEN substr(h, 19 + i, 1) < '8' THEN 'celsius' ELSE 'fahrenheit' END || '"' END
           || '}' AS arguments,
         substr(h, 21 + i, 1) = '0' AS no_unit
  FROM lu, LATERAL (SELECT unnest(generate_series(0, ('0x' || substr(h, 2, 1))::INTEGER % 2)) AS i)
  WHERE substr(h, 1, 1) NOT IN ('0', '1'))"""


@query("rsp_tool_calls", sql=f"""
WITH {SQL_TOOL_CALLS} SELECT request_id, call_idx, tool_call_id, tool_name, arguments FROM calls""")
def rsp_tool_calls(spark, sf):
    """Tool calls of the assistant message, one row per call (arguments as JSON text)."""
    return tool_calls(spark, sf)


@query("rsp_tool_errors", sql="""
WITH lu AS (
  SELECT conv_id, md5(coalesce(max_by(text, turn) FILTER (WHERE role = 'user'), '')) AS h
  FROM conversations GROUP BY conv_id)
SELECT conv_id AS request_id, 'malformed' AS parse_error FROM lu WHERE substr(h, 1, 1) = '2'""")
def rsp_tool_errors(spark, sf):
    """Successful answers without a readable message come out as reject rows."""
    calls = RS.explode_tool_calls(tool_answers(packed_requests(spark, sf), broken="2"))
    return calls.filter(F.col("parse_error").isNotNull()).select("request_id", "parse_error")


@query("jn_dispatch", sql=f"""
WITH {SQL_TOOL_CALLS}
SELECT request_id, call_idx, tool_name, {("'" + R.WEATHER_TOOL['description'] + "'")} AS description
FROM calls WHERE tool_name = 'get_current_weather'""")
def jn_dispatch(spark, sf):
    """Calls whose name is in the registry, joined to it (broadcast)."""
    known, _ = CH.dispatch_tools(tool_calls(spark, sf), R.tool_registry_df(spark))
    return known.select("request_id", "call_idx", "tool_name", "description")


@query("jn_unknown_tools", sql=f"""
WITH {SQL_TOOL_CALLS} SELECT request_id, call_idx, tool_name FROM calls WHERE tool_name <> 'get_current_weather'""")
def jn_unknown_tools(spark, sf):
    """Calls naming a tool that is not registered (left anti join)."""
    _, unknown = CH.dispatch_tools(tool_calls(spark, sf), R.tool_registry_df(spark))
    return unknown.select("request_id", "call_idx", "tool_name")


SQL_ARG_CHECK = """
checked AS (
  SELECT *, CASE WHEN tool_name <> 'get_current_weather' THEN 'unknown_tool'
                 WHEN no_unit THEN 'missing:unit' ELSE '' END AS errors
  FROM calls)"""


@query("val_tool_args", sql=f"""
WITH {SQL_TOOL_CALLS}, {SQL_ARG_CHECK}
SELECT request_id, call_idx, errors = '' AS args_valid, errors FROM checked""")
def val_tool_args(spark, sf):
    """Arguments checked against the schema of the named tool (required keys, enum)."""
    c = check_tool_args(tool_calls(spark, sf), R.tool_registry_df(spark))
    return c.select("request_id", "call_idx", "args_valid",
                    F.array_join("arg_errors", ";").alias("errors"))


def weather_tool(args: pd.DataFrame) -> pd.Series:
    """The sample weather tool: ignores its arguments, returns a fixed sentence."""
    return pd.Series([R.WEATHER_TOOL_RESULT] * len(args), dtype=object)


TOOLS = {"get_current_weather": weather_tool}
TOOL_ARGS = {"city": "string", "state": "string", "unit": "string"}


def tool_results(spark, sf):
    checked = check_tool_args(tool_calls(spark, sf), R.tool_registry_df(spark))
    ok = checked.filter("args_valid")
    return CH.run_tools(ok, TOOLS, TOOL_ARGS), checked


@query("udf_tools", sql=f"""
WITH {SQL_TOOL_CALLS}, {SQL_ARG_CHECK}
SELECT request_id, call_idx, tool_call_id, {("'" + R.WEATHER_TOOL_RESULT.replace("'", "''") + "'")} AS tool_result
FROM checked WHERE errors = ''""")
def udf_tools(spark, sf):
    """Registered Python tools run on their valid calls (vectorised pandas UDF per tool)."""
    res, _ = tool_results(spark, sf)
    return res.select("request_id", "call_idx", "tool_call_id", "tool_result")


@query("jn_tool_results", sql=f"""
WITH {SQL_TOOL_CALLS}, {SQL_ARG_CHECK}
SELECT request_id, call_idx, tool_call_id, errors = '' AS has_result FROM checked""")
def jn_tool_results(spark, sf):
    """Every call with its tool result attached (by request and tool-call id)."""
    res, checked = tool_results(spark, sf)
    j = CH.attach_tool_results(checked, res.select("request_id", "call_idx", "tool_call_id", "tool_result"))
    return j.select("request_id", "call_idx", "tool_call_id",
                    F.col("tool_result").isNotNull().alias("has_result"))


@query("se_append", sql=f"""
WITH {SQL_TOOL_CALLS}, {SQL_ARG_CHECK},
last AS (SELECT conv_id, max(turn) AS t FROM conversations GROUP BY conv_id),
added AS (
  SELECT DISTINCT c.request_id AS conv_id, l.t + 1 AS turn, 'assistant' AS role, NULL AS tool_call_id,
         NULL AS name, NULL AS text_md5
  FROM checked c JOIN last l ON l.conv_id = c.request_id
  UNION ALL
  SELECT c.request_id, l.t + 2 + c.call_idx, 'tool', c.tool_call_id, c.tool_name,
         md5(CASE WHEN errors = '' THEN {("'" + R.WEATHER_TOOL_RESULT.replace("'", "''") + "'")}
                  ELSE 'error: ' || errors END)
  FROM checked c JOIN last l ON l.conv_id = c.request_id)
SELECT conv_id, turn::BIGINT AS turn, role, tool_call_id, name, text_md5 FROM added
UNION ALL
SELECT conv_id, turn, role, NULL, NULL, md5(text) FROM conversations""")
def se_append(spark, sf):
    """History + the assistant tool-call message + one tool message per call."""
    conv = tbl(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    res, checked = tool_results(spark, sf)
    r = res.select("request_id", "call_idx", "tool_result")
    calls = checked.join(r, ["request_id", "call_idx"], "left")
    asst = (calls.groupBy("request_id").agg(F.count("*").alias("_n"))
            .select(F.col("request_id").alias("conv_id"), F.lit("assistant").alias("role"),
                    F.lit(0).cast("bigint").alias("_ord")))
    text = F.coalesce(F.col("tool_result"),
                      F.concat(F.lit("error: "), F.array_join("arg_errors", ";")))
    tool_msgs = calls.select(F.col("request_id").alias("conv_id"), F.lit("tool").alias("role"),
                             F.col("tool_call_id"), F.col("tool_name").alias("name"),
                             text.alias("text"), (F.col("call_idx") + 1).alias("_ord"))
    out = CH.append_messages(conv, asst, tool_msgs)
    return out.select("conv_id", "turn", "role", "tool_call_id", "name",
                      F.md5("text").alias("text_md5"))
