"""Response logs derived from the driver tables, as Spark expressions: what a run of requests
would have left behind, including failures and unreadable bodies. Test data for the response
operators; nothing here calls or imitates a service.

The first hex digit of md5(payload) picks the outcome (0: no status, 1: HTTP 500, otherwise
200), further digits fill the values, so DuckDB can state every parsed answer from the tables.
``broken`` names digits whose 200 body is cut in the middle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_TEXT = "overloaded, request refused"
CONNECTION_TEXT = "TransportError: connection refused"
#: error bodies are long in practice: this one must survive whole
ERROR_DETAIL = "x" * 1500


def _one(h: Column, at: int) -> Column:
    return F.substring(h, at, 1)


def answered(df: DataFrame, kind: str, body: Column, payload: str = "payload", broken: str = "") -> DataFrame:
    """df with kind, status_code, body and error of each request's answer; ``body`` is the
    text of a 200 answer and may use ``_h``, the md5 of the payload."""
    df = df.withColumn("_h", F.md5(payload)).withColumn("kind", F.lit(kind))
    first = _one(F.col("_h"), 1)
    status = F.when(first == "0", F.lit(None).cast("int")).when(first == "1", F.lit(500)).otherwise(F.lit(200))
    failed = F.to_json(F.struct(F.struct(F.lit(ERROR_DETAIL).alias("detail"), F.lit(ERROR_TEXT).alias("message"),
                                         F.lit(500).alias("code")).alias("error")))
    whole = body
    if broken:
        whole = F.when(first.isin(*broken), F.substring(body, F.lit(1), F.floor(F.length(body) / 2).cast("int"))).otherwise(body)
    return (df.withColumn("status_code", status)
            .withColumn("body", F.when(F.col("status_code") == 200, whole).when(F.col("status_code") == 500, failed))
            .withColumn("error", F.when(F.col("status_code").isNull(), F.lit(CONNECTION_TEXT))
                        .when(F.col("status_code") != 200, failed))
            .drop("_h"))


def _choice(message: Column, finish: str) -> Column:
    return F.to_json(F.struct(F.array(F.struct(F.lit(0).alias("index"), message.alias("message"),
                                               F.lit(finish).alias("finish_reason"))).alias("choices")))


def chat_answers(df: DataFrame, payload: str, thinking: Column, broken: str = "") -> DataFrame:
    """Content is the payload's md5; with thinking a reasoning text comes along."""
    h = F.col("_h")
    message = F.struct(F.lit("assistant").alias("role"), h.alias("content"),
                       F.when(thinking, F.concat(F.lit("thought:"), F.substring(h, 1, 8))).alias("reasoning"))
    return answered(df, "chat", _choice(message, "stop"), payload, broken)


def completion_answers(df: DataFrame, payload: str) -> DataFrame:
    body = F.to_json(F.struct(F.array(F.struct(F.lit(0).alias("index"), F.col("_h").alias("text"))).alias("choices")))
    return answered(df, "completion", body, payload)


def transcript_answers(df: DataFrame, payload: str) -> DataFrame:
    return answered(df, "transcribe", F.to_json(F.struct(F.col("_h").alias("text"))), payload)


def tool_answers(df: DataFrame, payload: str = "payload", broken: str = "") -> DataFrame:
    """One or two tool calls: some name an unknown tool, some lack a required argument."""
    h = F.col("_h")

    def call(i: int) -> Column:
        unit = F.when(_one(h, 21 + i) != "0", F.when(_one(h, 19 + i) < "8", "celsius").otherwise("fahrenheit"))
        args = F.to_json(F.struct(F.concat(F.lit("c"), F.substring(h, 13, 4)).alias("city"),
                                  F.upper(F.substring(h, 17, 2)).alias("state"), unit.alias("unit")))
        name = F.when(_one(h, 11 + i) != "f", "get_current_weather").otherwise("get_stock_price")
        return F.struct(F.concat(F.lit("call_"), F.substring(h, 3 + 4 * i, 4)).alias("id"), F.lit("function").alias("type"),
                        F.struct(name.alias("name"), args.alias("arguments")).alias("function"))

    both = F.array(call(0), call(1))
    n = (1 + F.conv(_one(h, 2), 16, 10).cast("int") % 2).cast("int")
    message = F.struct(F.lit("assistant").alias("role"), F.slice(both, F.lit(1), n).alias("tool_calls"))
    return answered(df, "tool", _choice(message, "tool_calls"), payload, broken)


def embedding_answers(df: DataFrame, texts: str, payload: str, broken: str = "") -> DataFrame:
    """Four numbers per text from its md5, listed last text first (the index tells which is which)."""
    def vector(t: Column, i: Column) -> Column:
        m = F.md5(t)
        return F.struct(i.alias("index"), F.lit("embedding").alias("object"), F.array(*[
            F.conv(F.substring(m, 2 * j + 1, 2), 16, 10).cast("double") / 256.0 for j in range(4)]).alias("embedding"))

    data = F.reverse(F.transform(texts, vector))
    body = F.to_json(F.struct(F.lit("list").alias("object"), data.alias("data")))
    return answered(df, "embedding", body, payload, broken)


def rerank_answers(df: DataFrame, query: str, documents: str, broken: str = "") -> DataFrame:
    """A score per submitted document from md5 of query and document, best first."""
    def scored(d: Column, i: Column) -> Column:
        m = F.md5(F.concat(F.col(query), F.lit("\n"), d))
        score = F.conv(F.substring(m, 1, 8), 16, 10).cast("double") / float(1 << 32)
        return F.struct((-score).alias("o"), i.alias("index"), score.alias("relevance_score"))

    results = F.transform(F.array_sort(F.transform(documents, scored)),
                          lambda r: F.struct(r["index"].alias("index"), r["relevance_score"].alias("relevance_score")))
    return answered(df, "rerank", F.to_json(F.struct(results.alias("results"))), query, broken)
