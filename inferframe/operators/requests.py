"""Request building (PRJ1-PRJ12), template lookup (JN3), profile expansion (JN4),
model resolution (JN8) and request de-duplication (SE2).

Requests are columns, not driver objects: ``messages`` is an array of message structs with
union-typed content held as two nullable fields (``content`` text, ``parts`` list); the
body is JSON text produced JVM-side by ``to_json`` and spliced without re-parsing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inferframe import refdata as R
from inferframe.functions.scalars import data_uri
from inferframe.operators.sizing import broadcast_if_small

PART = T.StructType([T.StructField("type", T.StringType()),
                     T.StructField("text", T.StringType()),
                     T.StructField("url", T.StringType())])
TOOL_CALL = T.StructType([T.StructField("id", T.StringType()),
                          T.StructField("name", T.StringType()),
                          T.StructField("arguments", T.StringType())])
MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("parts", T.ArrayType(PART)),
    T.StructField("tool_calls", T.ArrayType(TOOL_CALL)),
    T.StructField("tool_call_id", T.StringType()),
    T.StructField("name", T.StringType()),
])



def _null_parts() -> Column:
    return F.lit(None).cast(T.ArrayType(PART))


def _null_calls() -> Column:
    return F.lit(None).cast(T.ArrayType(TOOL_CALL))


def _null_str() -> Column:
    return F.lit(None).cast("string")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def message(role, content=None, parts=None, tool_calls=None, tool_call_id=None,
            name=None) -> Column:
    """A canonical message struct; absent pieces are NULL."""
    return F.struct(
        (F.lit(role) if isinstance(role, str) else role).alias("role"),
        (_c(content) if content is not None else _null_str()).cast("string").alias("content"),
        (_c(parts) if parts is not None else _null_parts()).alias("parts"),
        (_c(tool_calls) if tool_calls is not None else _null_calls()).alias("tool_calls"),
        (_c(tool_call_id) if tool_call_id is not None else _null_str()).alias("tool_call_id"),
        (_c(name) if name is not None else _null_str()).alias("name"),
    )


def text_part(text) -> Column:
    return F.struct(F.lit("text").alias("type"), _c(text).cast("string").alias("text"),
                    _null_str().alias("url"))


def url_part(kind: str, url) -> Column:
    """kind: ``image_url`` or ``video_url``."""
    return F.struct(F.lit(kind).alias("type"), _null_str().alias("text"),
                    _c(url).cast("string").alias("url"))


# --------------------------------------------------------------------------- JSON text

def _part_json_struct(p: Column) -> Column:
    return F.struct(
        p["type"].alias("type"),
        F.when(p["type"] == "text", p["text"]).alias("text"),
        F.when(p["type"] == "image_url", F.struct(p["url"].alias("url"))).alias("image_url"),
        F.when(p["type"] == "video_url", F.struct(p["url"].alias("url"))).alias("video_url"),
    )


def _call_json_struct(c: Column) -> Column:
    return F.struct(c["id"].alias("id"), F.lit("function").alias("type"),
                    F.struct(c["name"].alias("name"),
                             c["arguments"].alias("arguments")).alias("function"))


def message_json(m: Column) -> Column:
    """API JSON of one message. ``content`` is a string or a list of typed parts (exactly
    one of the two struct fields named ``content`` is non-NULL; ``to_json`` drops NULLs);
    an assistant tool-call message has no content key at all."""
    return F.to_json(F.struct(
        m["role"].alias("role"),
        m["content"].alias("content"),
        F.transform(m["parts"], _part_json_struct).alias("content"),
        F.transform(m["tool_calls"], _call_json_struct).alias("tool_calls"),
        m["tool_call_id"].alias("tool_call_id"),
        m["name"].alias("name"),
    ))


def messages_json(messages) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(_c(messages), message_json), ","),
                    F.lit("]"))


def merge_json_objects(*objs: Column) -> Column:
    """Concatenate JSON object texts into one object (keys in argument order); NULL or
    empty objects are skipped. Inputs must be JSON objects produced by ``to_json``."""
    pieces = [F.when(o.isNotNull() & (o != F.lit("{}")),
                     F.substring(o, F.lit(2), F.length(o) - F.lit(2))) for o in objs]
    return F.concat(F.lit("{"), F.concat_ws(",", *pieces), F.lit("}"))


def json_field(name: str, raw_json: Column) -> Column:
    """``{"name": <raw JSON>}`` text; NULL when the value is NULL."""
    return F.when(raw_json.isNotNull(),
                  F.concat(F.lit("{" + json.dumps(name) + ":"), raw_json, F.lit("}")))


# ------------------------------------------------------------------------ PRJ builders

def chat_request(df: DataFrame, text: str = "text", out: str = "messages") -> DataFrame:
    """PRJ1: one user message with string content."""
    return df.withColumn(out, F.array(message("user", content=F.col(text))))


def multimodal_request(df: DataFrame, text: str, url: str, order: str | Column = "image_text",
                       out: str = "messages") -> DataFrame:
    """PRJ2: one user message with typed parts. ``order`` (literal or column): ``image_text``
    (image then text), ``text_image`` (text then image) or ``text_video``."""
    o = F.lit(order) if isinstance(order, str) else order
    parts = (F.when(o == "text_image", F.array(text_part(F.col(text)), url_part("image_url", F.col(url))))
             .when(o == "text_video", F.array(text_part(F.col(text)), url_part("video_url", F.col(url))))
             .otherwise(F.array(url_part("image_url", F.col(url)), text_part(F.col(text)))))
    return df.withColumn(out, F.array(message("user", parts=parts)))


def system_user_request(df: DataFrame, url: str, mode: str | Column = "text",
                        layout: str | Column = "httpx", system: str = R.OCR_SYSTEM_INSTRUCTION,
                        out: str = "messages") -> DataFrame:
    """PRJ3: the two message layouts of the markdown OCR client.
    ``httpx``: system message (fixed instruction as a text part) + user (mode text, image).
    ``sdk``: no system message; the fixed instruction goes in the user turn, mode ignored."""
    modes = F.create_map(*[x for k, v in R.RECOGNITION_MODES.items() for x in (F.lit(k), F.lit(v))])
    m = F.lit(mode) if isinstance(mode, str) else mode
    lay = F.lit(layout) if isinstance(layout, str) else layout
    mode_text = F.try_element_at(modes, m)
    sys_msg = message("system", parts=F.array(text_part(F.lit(system))))
    user_httpx = message("user", parts=F.array(text_part(mode_text), url_part("image_url", F.col(url))))
    user_sdk = message("user", parts=F.array(text_part(F.lit(system)), url_part("image_url", F.col(url))))
    msgs = F.when(lay == "sdk", F.array(user_sdk)).otherwise(F.array(sys_msg, user_httpx))
    return df.withColumn(out, msgs).withColumn("mode_known", mode_text.isNotNull())


def completion_request(df: DataFrame, prompt: str = "text", model: str | Column = "model",
                       out: str = "body") -> DataFrame:
    """PRJ4: text completion body ``{"model", "prompt"}`` (no messages)."""
    mc = F.col(model) if isinstance(model, str) else model
    return df.withColumn(out, F.to_json(F.struct(mc.alias("model"), F.col(prompt).alias("prompt"))))


def options_json(temperature="temperature", top_p="top_p", top_k="top_k",
                 presence_penalty="presence_penalty", max_tokens="max_tokens",
                 max_completion_tokens="max_completion_tokens",
                 enable_thinking="enable_thinking") -> Column:
    """PRJ5: sampling options as JSON text. Absent option => absent key. ``top_k`` and the
    thinking flag are extra-body fields merged into the top level of the body; the
    ``chat_template_kwargs`` object is only written when the flag is set."""
    et = _c(enable_thinking)
    return F.to_json(F.struct(
        _c(max_tokens).alias("max_tokens"),
        _c(max_completion_tokens).alias("max_completion_tokens"),
        _c(temperature).alias("temperature"),
        _c(top_p).alias("top_p"),
        _c(presence_penalty).alias("presence_penalty"),
        _c(top_k).alias("top_k"),
        F.when(et.isNotNull(), F.struct(et.alias("enable_thinking"))).alias("chat_template_kwargs"),
    ))


def with_options(df: DataFrame, out: str = "options_json") -> DataFrame:
    """PRJ5 over a frame carrying profile columns (see ``refdata.profiles_df``)."""
    return df.withColumn(out, options_json())


def constraint_json(kind, spec=None) -> Column:
    """PRJ6: structured-output constraint fields as JSON text, by kind:
    ``choice``, ``regex`` (+ stop), ``json`` (guided_json schema), ``grammar``,
    ``response_format`` (json_schema + decoding backend).

    ``spec`` is the caller's own constraint, a literal or a column of JSON text: an array of choices, an
    object ``{"pattern", "stop"}`` or a plain pattern string, a JSON Schema, a grammar string, or
    ``{"name", "schema"}``. Where it is NULL or absent the built-in constraint of the kind is attached."""
    k = _c(kind)
    if isinstance(spec, (dict, list)):
        spec = F.lit(json.dumps(spec))
    elif isinstance(spec, str):
        spec = F.col(spec)
    s = F.lit(None).cast("string") if spec is None else spec.cast("string")

    def own(default: str) -> Column:
        return F.coalesce(s, F.lit(default))

    pattern = F.coalesce(F.get_json_object(s, "$.pattern"), s, F.lit(R.EMAIL_REGEX))
    # a pattern of one's own has a stop string only if it says so
    stop = F.when(s.isNull(), F.array(F.lit(R.EMAIL_STOP))) \
        .when(F.get_json_object(s, "$.stop").isNotNull(), F.array(F.get_json_object(s, "$.stop")))
    grammar = F.to_json(F.struct(own(R.SELECT_GRAMMAR).alias("guided_grammar")))
    regex = F.to_json(F.struct(pattern.alias("guided_regex"), stop.alias("stop")))
    choice = json_field("guided_choice", own(json.dumps(R.CHOICES, separators=(",", ":"))))
    guided = json_field("guided_json", own(json.dumps(R.CAR_DESCRIPTION_SCHEMA)))
    named = own(json.dumps({"name": "CityInfo", "schema": R.CITY_INFO_SCHEMA}))
    rf = F.concat(F.lit('{"response_format":{"type":"json_schema","json_schema":'), named,
                  F.lit('},"guided_decoding_backend":"outlines"}'))
    return (F.when(k == "choice", choice).when(k == "regex", regex).when(k == "json", guided)
            .when(k == "grammar", grammar).when(k == "response_format", rf))


def with_constraint(df: DataFrame, kind, spec=None, out: str = "constraint_json") -> DataFrame:
    """PRJ6 over a frame: ``kind`` is a column or one kind for all, ``spec`` as in `constraint_json`."""
    return df.withColumn(out, constraint_json(F.lit(kind) if isinstance(kind, str) and
                                              kind not in df.columns else F.col(kind), spec))


def tools_json(registry: DataFrame) -> DataFrame:
    """Registry rows -> one ``tools_json`` text (JSON array of function tools), ordered by
    name. The registry is a small dimension; it is aggregated to a single row."""
    fn = merge_json_objects(F.to_json(F.struct("name", "description")),
                            json_field("parameters", F.col("params_schema")))
    tool = F.concat(F.lit('{"type":"function","function":'), fn, F.lit("}"))
    return (registry.select(F.col("name"), tool.alias("t"))
            .agg(F.concat(F.lit("["), F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("name", "t"))), lambda x: x["t"]),
                ","), F.lit("]")).alias("tools_json"),
                 F.count("*").alias("n_tools")))


def with_tools(df: DataFrame, registry: DataFrame, out: str = "tools_json") -> DataFrame:
    """PRJ7: attach the tool list to every request. The list is part of every request, so it is
    small by nature; it is packed into one JSON text by a scalar subquery, evaluated once when
    the query runs (no join, no job while the plan is built)."""
    packed = tools_json(registry)
    return (df.withColumn(out, packed.select("tools_json").scalar())
              .withColumn("n_tools", packed.select("n_tools").scalar()))


def with_data_uri(df: DataFrame, content: str, mime: str | Column, out: str = "url") -> DataFrame:
    """PRJ8: ``data:<mime>;base64,<payload>`` from a BINARY (or STRING) column."""
    m = F.lit(mime) if isinstance(mime, str) and mime not in df.columns else _c(mime)
    return df.withColumn(out, data_uri(F.col(content), m))


def bbox_text(bbox) -> Column:
    """``[x1, y1, x2, y2]`` text of a numeric array: each number as it is (whole ones without decimals)."""
    number = lambda v: F.regexp_replace(v.cast("string"), r"\.0$", "")
    return F.concat(F.lit("["), F.array_join(F.transform(_c(bbox), number), ", "), F.lit("]"))


def with_prompt(df: DataFrame, prompts: DataFrame, mode: str = "mode", bbox: str | None = None,
                prefix: str = R.IMAGE_TOKEN_PREFIX, out: str = "prompt") -> DataFrame:
    """PRJ9 + JN3: template lookup by mode (broadcast left join on a tiny dimension),
    image-token prefix, and the box appended for the grounding template. Unknown modes
    and grounding without a box give ``prompt`` NULL and ``prompt_error`` set."""
    t = broadcast_if_small(prompts.select(F.col("mode").alias("_mode"),
                                          F.col("template").alias("_template")))
    j = df.join(t, F.col(mode) == F.col("_mode"), "left")
    grounding = F.col(mode) == "prompt_grounding_ocr"
    box = bbox_text(F.col(bbox)) if bbox else _null_str()
    err = (F.when(F.col("_template").isNull(), F.lit("unknown_mode"))
           .when(grounding & box.isNull(), F.lit("missing_bbox")))
    text = F.when(err.isNull(), F.concat(F.lit(prefix), F.col("_template"),
                                         F.when(grounding, box).otherwise(F.lit(""))))
    return j.withColumn(out, text).withColumn("prompt_error", err).drop("_mode", "_template")


def conversion_defaults_map() -> Column:
    return F.create_map(*[x for k, v in R.CONVERSION_DEFAULTS.items() for x in (F.lit(k), F.lit(v))])


def with_conversion_options(df: DataFrame, overrides: str, out: str = "options") -> DataFrame:
    """PRJ10: defaults updated by per-row overrides, last wins (dict.update semantics),
    without relying on the session's map-key dedup policy."""
    o = F.col(overrides)
    d = conversion_defaults_map()
    merged = F.map_concat(F.map_filter(d, lambda k, v: ~F.array_contains(F.map_keys(o), k)), o)
    return df.withColumn(out, F.when(o.isNull(), d).otherwise(merged))


def repeat_samples(df: DataFrame, n: int, out: str = "sample_idx") -> DataFrame:
    """PRJ11: the same request n times (sampling at temperature > 0), ``sample_idx`` 0..n-1."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def request_key(*cols) -> Column:
    """PRJ12: a stable request identity: md5 over the unit-separated canonical fields."""
    return F.md5(F.concat_ws("\u001f", *[F.coalesce(_c(c).cast("string"), F.lit("\u0000"))
                                         for c in cols]))


def chat_body(model, messages, *extra_json: Column) -> Column:
    """Full chat body text: ``{"model", "messages", <options/constraint/tools...>}``."""
    head = F.to_json(F.struct(_c(model).alias("model")))
    msgs = json_field("messages", messages_json(messages))
    return merge_json_objects(head, msgs, *extra_json)


# -------------------------------------------------------------------------- JN4 / JN8 / SE2

def expand_profiles(requests: DataFrame, profiles: DataFrame, on: str = "family") -> DataFrame:
    """JN4: run each request under every profile of its family. Profiles are a small
    dimension (size checked), joined by equi-key with a broadcast hint."""
    return requests.join(broadcast_if_small(profiles), on, "inner")


def resolve_model(requests: DataFrame, catalog: DataFrame, endpoint: str = "endpoint",
                  pinned: str | None = "pinned_model") -> DataFrame:
    """JN8: default model of an endpoint = first listed (``min_by(model_id, pos)``), once per
    endpoint, broadcast to the requests; a pinned model wins."""
    first = catalog.groupBy("endpoint").agg(F.min_by("model_id", "pos").alias("_default_model"))
    first = broadcast_if_small(first)
    j = requests.join(first, requests[endpoint] == first["endpoint"], "left") \
        .drop(first["endpoint"])
    model = F.coalesce(F.col(pinned), F.col("_default_model")) if pinned else F.col("_default_model")
    return j.withColumn("model", model).drop("_default_model")


def unique_requests(requests: DataFrame, key: str = "request_key", id_col: str = "request_id",
                    temperature: str | None = None, hot_keys: int = 1000) -> DataFrame:
    """SE2: map every request to a representative with the same key (lowest id). Only the
    representatives need to be sent; answers are joined back by key.

    Sharing an answer is only right where sampling is deterministic: with ``temperature`` (a
    column; NULL means the server's default, which samples) rows above 0 represent themselves.

    One repeated request may be a third of all rows. Representatives come from a partial + final
    aggregation; those of the ``hot_keys`` most repeated keys (that many rows at most) are
    broadcast to the requests, so only keys with a small share each go through the shuffle join."""
    shared = F.lit(True) if temperature is None else F.coalesce(F.col(temperature) <= 0, F.lit(False))
    rows = requests.withColumn("_shared", shared)
    reps = (rows.filter("_shared").groupBy(F.col(key).cast("string").alias("_k"))
            .agg(F.min(id_col).alias("_rep"), F.count("*").alias("_n")))
    top = reps.orderBy(F.desc("_n"), "_k").limit(hot_keys).select(
        F.col("_k").alias("_hk"), F.col("_rep").alias("_hrep"), F.col("_n").alias("_hn"))
    rows = rows.join(F.broadcast(top), F.col("_shared") & (F.col(key).cast("string") == F.col("_hk")), "left")
    # rows already answered, or not shared, take a key of their own that matches nothing
    apart = F.concat(F.lit("\u0001"), F.col(id_col).cast("string"))
    rows = rows.withColumn("_jk", F.when(F.col("_shared") & F.col("_hk").isNull(), F.col(key).cast("string")).otherwise(apart))
    j = rows.join(reps, F.col("_jk") == F.col("_k"), "left")
    return (j.withColumn("rep_request_id", F.coalesce("_hrep", "_rep", F.col(id_col)))
             .withColumn("n_copies", F.coalesce("_hn", "_n", F.lit(1).cast("bigint")))
             .drop("_shared", "_jk", "_k", "_rep", "_n", "_hk", "_hrep", "_hn"))


# ------------------------------------------------------------------------ other bodies

def embedding_body(model, texts, encoding_format: str | None = None) -> Column:
    """Body of an embedding request for an array of texts."""
    fields = [_c(model).alias("model"), _c(texts).alias("input")]
    if encoding_format:
        fields.append(F.lit(encoding_format).alias("encoding_format"))
    return F.to_json(F.struct(*fields))


def rerank_body(model, query, documents, top_n=None) -> Column:
    """Body of a rerank request: one query, an array of documents."""
    fields = [_c(model).alias("model"), _c(query).alias("query"), _c(documents).alias("documents")]
    if top_n is not None:
        fields.append((F.lit(top_n) if isinstance(top_n, int) else _c(top_n)).alias("top_n"))
    return F.to_json(F.struct(*fields))


def transcription_body(model, file, language=None) -> Column:
    """Fields of a transcription request; ``file`` is text or a data URI (the transport turns the
    fields into a form upload)."""
    fields = [_c(model).alias("model"), _c(file).alias("file")]
    if language is not None:
        fields.append(_c(language).alias("language"))
    return F.to_json(F.struct(*fields))


def conversion_body(options_json, url, kind: str = "http") -> Column:
    """PRJ10, URL source: ``{"options": <nested options>, "sources": [{"kind", "url"}]}``. Options
    are JSON text and keep their nesting."""
    sources = F.to_json(F.struct(F.array(F.struct(F.lit(kind).alias("kind"), _c(url).alias("url"))).alias("sources")))
    return merge_json_objects(json_field("options", _c(options_json)), sources)
