"""Conversations, streamed fragments and tool calls: AG3-AG5, WN2, WN3, JN5, JN6, SE1,
UDF2, FL2."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inferframe.operators.ordered import change_ordinal, dense_ordinal, ordered_collect, ordered_concat
from inferframe.operators.sizing import broadcast_if_small


def content_deltas(chunks: DataFrame, content: str = "content") -> DataFrame:
    """FL2: keep fragments carrying text; empty/NULL fragments are heartbeats."""
    return chunks.filter(F.col(content).isNotNull() & (F.col(content) != ""))


def assemble_content(chunks: DataFrame, key: str = "request_id", seq: str = "seq",
                     content: str = "content", created: str = "created") -> DataFrame:
    """AG4: per request, the fragments concatenated in ``seq`` order, plus chunk and
    heartbeat counts, first/last ``created`` and whether a finish marker arrived. A fragment
    delivered twice counts once."""
    hb = (F.col(content).isNull() | (F.col(content) == "")).cast("bigint")
    return ordered_concat(
        chunks, [key], seq, content, "", out="content", unique=True, extra={
            "n_chunks": (F.count("*"), "sum"),
            "n_heartbeats": (F.sum(hb), "sum"),
            "first_created": (F.min(created), "min"),
            "last_created": (F.max(created), "max"),
            "finish_reason": (F.max("finish_reason"), "max"),
        })


def assemble_tool_calls(chunks: DataFrame, key: str = "request_id", seq: str = "seq",
                        index: str = "tool_index") -> DataFrame:
    """AG5: per (request, tool index): first non-NULL id, first non-NULL name, and the
    argument fragments concatenated in order. Grouping (not a stateful fold) means an index
    that reappears later is merged, and a skipped index is harmless. A fragment delivered twice
    counts once. One aggregation: the first id and name travel as (seq, value) minima."""
    def first(c: str) -> Column:
        return F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(seq).alias("s"), F.col(c).alias("v"))))

    out = ordered_concat(
        chunks, [key, index], seq, "tool_args", "", out="arguments", unique=True, extra={
            "_id": (first("tool_id"), "min"), "_name": (first("tool_name"), "min"),
            "n_fragments": (F.count("*"), "sum"),
        })
    return (out.withColumn("tool_id", F.col("_id.v")).withColumn("tool_name", F.col("_name.v"))
               .drop("_id", "_name"))


def tool_call_boundaries(chunks: DataFrame, key: str = "request_id", seq: str = "seq",
                         index: str = "tool_index") -> DataFrame:
    """WN3: a new call starts whenever the tool index changes between consecutive
    fragments; ``call_ordinal`` is the 1-based running call number per request."""
    return change_ordinal(chunks, key, seq, index, out="call_ordinal")


def pack_conversation(messages: DataFrame, key: str = "conv_id", turn: str = "turn",
                      bucket_size: int = 1024) -> DataFrame:
    """AG3: the ordered message list of each conversation (turn order; the key and turn
    are dropped from the elements). Two-level: messages are first packed per
    (conversation, turn bucket), so a very long conversation is not gathered row by row
    in one task."""
    cols = [c for c in ("role", "text", "tool_call_id", "name") if c in messages.columns]
    packed = ordered_collect(messages, [key], turn, F.struct(*cols), out="messages",
                             bucket_size=bucket_size)
    return packed.withColumn("n_messages", F.size("messages"))


def history_prefix(messages: DataFrame, key: str = "conv_id", turn: str = "turn",
                   at_role: str | None = "assistant", max_turns: int | None = None,
                   bucket_size: int = 4096) -> DataFrame:
    """WN2: for each turn (of role ``at_role``), the messages before it - what the client
    sends to obtain that turn.

    Unbounded (the client's behaviour) the output is quadratic in a conversation's length
    by definition. With ``max_turns`` the frame is bounded and a long conversation is split:
    rows are numbered densely (``dense_ordinal``; turn numbers may have gaps), bucketed by
    ``ordinal div bucket_size``, and the last ``max_turns`` rows of each bucket are copied into
    the next one (halo), so each window runs per (conversation, bucket) and no task holds a
    whole hot conversation."""
    item = F.struct(F.col(turn).alias("turn"), F.col("role").alias("role"),
                    F.col("text").alias("text"))
    if max_turns is None:
        w = Window.partitionBy(key).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
        out = messages.withColumn("history", F.collect_list(item).over(w))
    else:
        bucket_size = max(bucket_size, max_turns)  # the halo reaches one bucket back
        rows = dense_ordinal(messages, key, turn, out="_ord")
        b = F.floor(F.col("_ord") / F.lit(bucket_size))
        halo = (F.col("_ord") - b * bucket_size) >= (bucket_size - max_turns)
        rows = rows.withColumn("_b", b).withColumn(
            "_copies", F.when(halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        rows = (rows.select("*", F.explode("_copies").alias("_shift"))
                .withColumn("_wb", F.col("_b") + F.col("_shift")))
        w = Window.partitionBy(key, "_wb").orderBy("_ord").rowsBetween(-max_turns, -1)
        out = (rows.withColumn("history", F.collect_list(item).over(w))
                   .filter(F.col("_shift") == 0)
                   .drop("_b", "_copies", "_shift", "_wb", "_ord"))
    if at_role:
        out = out.filter(F.col("role") == at_role)
    return out.withColumn("n_history", F.size("history"))


def dispatch_tools(calls: DataFrame, registry: DataFrame, name_col: str = "tool_name"
                   ) -> tuple[DataFrame, DataFrame]:
    """JN5: (known calls joined to the registry, unknown calls). The registry is a small
    dimension: broadcast inner join for known, broadcast left-anti for unknown."""
    reg = broadcast_if_small(registry.select(F.col("name").alias(name_col), "description",
                                             "params_schema"))
    return calls.join(reg, name_col, "inner"), calls.join(reg, name_col, "left_anti")


def attach_tool_results(calls: DataFrame, results: DataFrame,
                        keys=("request_id", "call_idx", "tool_call_id")) -> DataFrame:
    """JN6: tool results joined to the calls that produced them. The call's position is part of
    the key: ids may repeat inside one answer, and every call keeps its row."""
    return calls.join(results, list(keys), "left")


def run_tools(calls: DataFrame, tools: dict[str, Callable[[pd.DataFrame], pd.Series]],
              arg_fields: dict[str, str], name_col: str = "tool_name",
              args_col: str = "arguments", one_by_one: bool = False) -> DataFrame:
    """UDF2: run registered Python tools on their calls, in one pass: calls of unregistered
    tools are filtered out, the JSON arguments are parsed JVM-side into a struct, and one
    vectorised pandas UDF hands each tool the rows of its name in the Arrow batch.

    Columns ``tool_result`` and ``tool_error``. A tool that raises, or returns another number of results than it had calls, fails its
    own calls of that batch only: their result is NULL and the error says why; other tools and batches go
    on. With ``one_by_one`` such calls are then run again one at a time, so that only the failing
    ones fail; that is for tools that may be called twice."""
    schema = ", ".join(f"{k} {v}" for k, v in arg_fields.items())

    def attempt(fn, args: pd.DataFrame) -> tuple[list, str | None]:
        try:
            got = list(fn(args))
        except Exception as e:  # noqa: BLE001 - every failure becomes rows
            return [None] * len(args), f"{type(e).__name__}: {e}"
        if len(got) != len(args):
            return [None] * len(args), f"ValueError: {len(got)} results for {len(args)} calls"
        return [None if x is None else str(x) for x in got], None

    def switch(names: pd.Series, args: pd.DataFrame) -> pd.DataFrame:
        result = np.full(len(names), None, dtype=object)
        error = result.copy()
        for name, fn in tools.items():
            mine = np.flatnonzero((names == name).to_numpy())
            if not len(mine):
                continue
            own = args.iloc[mine].reset_index(drop=True)
            got, failed = attempt(fn, own)
            if failed and one_by_one and len(mine) > 1:
                for i, at in enumerate(mine):
                    (result[at],), error[at] = attempt(fn, own.iloc[i:i + 1].reset_index(drop=True))
            else:
                result[mine], error[mine] = got, failed
        return pd.DataFrame({"tool_result": result, "tool_error": error})

    udf = F.pandas_udf(switch, "tool_result string, tool_error string")
    return (calls.filter(F.col(name_col).isin(*tools))
            .withColumn("_t", udf(F.col(name_col), F.from_json(F.col(args_col), schema)))
            .select("*", "_t.tool_result", "_t.tool_error").drop("_t"))


def append_messages(history: DataFrame, *new: DataFrame, key: str = "conv_id",
                    turn: str = "turn", order: str = "_ord") -> DataFrame:
    """SE1: history + new messages (assistant tool-call message, tool results ...), each
    new frame carrying ``order`` (its position among the new messages); new turns are
    numbered after the conversation's last turn."""
    last = history.groupBy(key).agg(F.max(turn).alias("_last_turn"))
    added = None
    for n in new:
        added = n if added is None else added.unionByName(n, allowMissingColumns=True)
    added = (added.join(last, key, "left")
                  .withColumn(turn, (F.coalesce(F.col("_last_turn"), F.lit(-1)) + 1
                                     + F.col(order)).cast("bigint"))
                  .drop("_last_turn", order))
    return history.unionByName(added, allowMissingColumns=True)


def msg_digest(role: Column, text: Column) -> Column:
    return F.concat(role, F.lit(":"), F.coalesce(text, F.lit("")))
