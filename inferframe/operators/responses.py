"""Response parsing (RSP1-RSP9). Bodies are parsed with explicit schemas (``from_json``) or
as VARIANT; every accessor is ANSI-safe (``try_element_at``), so a malformed or empty
answer gives NULLs instead of a task failure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHAT_SCHEMA = ("struct<choices: array<struct<index: int, finish_reason: string, "
               "message: struct<role: string, content: string, reasoning: string, "
               "tool_calls: array<struct<id: string, type: string, "
               "function: struct<name: string, arguments: string>>>>>>>")
COMPLETION_SCHEMA = "struct<choices: array<struct<index: int, text: string>>>"
EMBEDDING_SCHEMA = "struct<data: array<struct<index: int, embedding: array<float>>>>"
RERANK_SCHEMA = "struct<results: array<struct<index: int, relevance_score: double>>>"
TRANSCRIPT_SCHEMA = "struct<text: string>"
LAYOUT_SCHEMA = "array<struct<bbox: array<double>, category: string, text: string>>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def classify_outcome(status="status_code") -> Column:
    """RSP8: ``ok`` for 200, ``http_error`` for another status, ``connection_error`` when
    the call produced no status."""
    s = _c(status)
    return (F.when(s == 200, F.lit("ok")).when(s.isNotNull(), F.lit("http_error"))
            .otherwise(F.lit("connection_error")))


def with_outcome(df: DataFrame, status: str = "status_code", out: str = "outcome") -> DataFrame:
    return df.withColumn(out, classify_outcome(status))


def first_choice(body="body") -> Column:
    return F.try_element_at(F.from_json(_c(body), CHAT_SCHEMA)["choices"], F.lit(1))


def parse_chat(df: DataFrame, body: str = "body") -> DataFrame:
    """RSP1: first choice's ``content`` and ``reasoning`` (missing reasoning => NULL),
    only for successful calls."""
    ch = F.when(F.col("status_code") == 200, first_choice(body))
    return (df.withColumn("_ch", ch)
            .withColumn("content", F.col("_ch.message.content"))
            .withColumn("reasoning", F.col("_ch.message.reasoning"))
            .withColumn("finish_reason", F.col("_ch.finish_reason"))
            .drop("_ch"))


def parse_completion(df: DataFrame, body: str = "body") -> DataFrame:
    """RSP2: ``choices[0].text``."""
    ch = F.try_element_at(F.from_json(F.col(body), COMPLETION_SCHEMA)["choices"], F.lit(1))
    return df.withColumn("completion", F.when(F.col("status_code") == 200, ch["text"]))


def _parse_error(status: Column, parsed: Column) -> Column:
    """Why an answer gave no row: ``malformed`` where a 200 body lacks the expected list."""
    return F.when((status == 200) & parsed.isNull(), F.lit("malformed"))


def explode_embeddings(df: DataFrame, ids: str = "ids", body: str = "body") -> DataFrame:
    """RSP3: one row per packed item: the response's ``data`` array is matched to the
    request's id list by ``index`` (not by arrival order), all vectors kept. A 200 answer that
    can't be parsed is one row with ``parse_error`` set and no item; an empty list gives no row."""
    data = F.from_json(F.col(body), EMBEDDING_SCHEMA)["data"]
    ok = df.filter(F.col("status_code") == 200).withColumn("_data", data)
    ex = (ok.withColumn("parse_error", _parse_error(F.col("status_code"), F.col("_data")))
            .select("*", F.posexplode_outer("_data").alias("_p", "_d")).drop("_data")
            .filter(F.col("_p").isNotNull() | F.col("parse_error").isNotNull()).drop("_p"))
    return (ex.withColumn("item_id", F.try_element_at(F.col(ids), F.col("_d.index") + 1))
              .withColumn("embedding", F.col("_d.embedding"))
              .withColumn("pos", F.col("_d.index"))
              .drop("_d"))


def explode_rerank(df: DataFrame, body: str = "body") -> DataFrame:
    """RSP4: ``results[]`` -> rows ``(idx, relevance_score)``; ``idx`` refers to the position
    in the submitted document list (kept for JN2). A 200 answer that can't be parsed is one row
    with ``parse_error`` set; an empty result list gives no row."""
    res = F.from_json(F.col(body), RERANK_SCHEMA)["results"]
    ok = df.filter(F.col("status_code") == 200).withColumn("_res", res)
    return (ok.withColumn("parse_error", _parse_error(F.col("status_code"), F.col("_res")))
              .select("*", F.posexplode_outer("_res").alias("_p", "_r")).drop("_res")
              .filter(F.col("_p").isNotNull() | F.col("parse_error").isNotNull()).drop("_p")
              .withColumn("idx", F.col("_r.index"))
              .withColumn("relevance_score", F.col("_r.relevance_score"))
              .drop("_r"))


def parse_transcript(df: DataFrame, body: str = "body") -> DataFrame:
    """RSP5: JSON text -> ``text``."""
    return df.withColumn("transcript", F.when(F.col("status_code") == 200,
                                              F.from_json(F.col(body), TRANSCRIPT_SCHEMA)["text"]))


def explode_tool_calls(df: DataFrame, body: str = "body") -> DataFrame:
    """RSP6: the assistant message's tool calls as rows ``(call_idx, tool_call_id,
    tool_name, arguments, args VARIANT)``; ``arguments`` is JSON text, parsed leniently
    (bad JSON => NULL ``args``). A 200 answer without a message is one row with
    ``parse_error`` set; a message that calls no tool gives no row."""
    ok = df.filter(F.col("status_code") == 200).withColumn("_m", first_choice(body)["message"])
    ex = (ok.withColumn("parse_error", _parse_error(F.col("status_code"), F.col("_m")))
            .select("*", F.posexplode_outer("_m.tool_calls").alias("call_idx", "_c")).drop("_m")
            .filter(F.col("call_idx").isNotNull() | F.col("parse_error").isNotNull()))
    return (ex.withColumn("tool_call_id", F.col("_c.id"))
              .withColumn("tool_name", F.col("_c.function.name"))
              .withColumn("arguments", F.col("_c.function.arguments"))
              .withColumn("args", F.try_parse_json(F.col("_c.function.arguments")))
              .drop("_c"))


def layout_elements(content) -> Column:
    """The element list of a layout answer: a JSON array, or the first array-valued field of a
    single JSON object (the prompt asks for one object), or an object that is itself an
    element. NULL when neither can be read."""
    c = F.trim(_c(content))
    elements = F.from_json(c, LAYOUT_SCHEMA)
    fields = F.from_json(c, "map<string,string>")
    lists = F.filter(F.map_values(fields), lambda v: F.startswith(F.trim(v), F.lit("[")))
    # "bbox" of a lone element is a list as well, but not one of elements
    lone = F.map_contains_key(fields, "bbox") | F.map_contains_key(fields, "category")
    wrapped = F.from_json(F.try_element_at(lists, F.lit(1)), LAYOUT_SCHEMA)
    one = F.from_json(F.concat(F.lit("["), c, F.lit("]")), LAYOUT_SCHEMA)
    return (F.when(F.startswith(c, F.lit("[")), elements)
            .when(fields.isNull(), F.lit(None).cast(LAYOUT_SCHEMA))
            .when(F.coalesce(lone, F.lit(False)), one).otherwise(wrapped))


def explode_layout(df: DataFrame, content: str = "content", with_text: bool = True) -> DataFrame:
    """RSP7: layout JSON (list of ``{bbox, category, text}``, bare or inside one object) -> one
    row per element; position in the list is the reading order (``elem_idx``). Content that
    can't be read as such is one row with ``parse_error`` set; an empty list gives no row."""
    ex = (df.withColumn("_a", layout_elements(content))
            .withColumn("parse_error", F.when(F.col(content).isNotNull() & F.col("_a").isNull(), F.lit("malformed")))
            .select("*", F.posexplode_outer("_a").alias("elem_idx", "_e")).drop("_a")
            .filter(F.col("elem_idx").isNotNull() | F.col("parse_error").isNotNull()))
    ex = (ex.withColumn("bbox", F.col("_e.bbox")).withColumn("category", F.col("_e.category")))
    if with_text:
        ex = ex.withColumn("text", F.col("_e.text"))
    return ex.drop("_e")


def parse_struct(df: DataFrame, col: str, fields: dict[str, str], valid_col: str = "valid",
                 out: str = "parsed") -> DataFrame:
    """RSP9: typed struct from a validated JSON answer: each field read from the VARIANT
    with ``try_variant_get``; NULL struct when the answer did not pass validation."""
    v = F.try_parse_json(F.col(col))
    st = F.struct(*[F.try_variant_get(v, f"$.{name}", typ).alias(name)
                    for name, typ in fields.items()])
    return df.withColumn(out, F.when(F.col(valid_col), st))
