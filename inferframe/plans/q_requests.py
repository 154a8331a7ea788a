"""Request-building queries: PRJ1-PRJ12, JN3, JN4, JN8, SE2.

Oracles never compare JSON escaping of raw text: the Spark side parses its own body back
and reports structure plus md5 of the embedded text, which DuckDB computes from the
table directly."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from inferframe import refdata as R
from inferframe.functions.scalars import base64_nolines, canonical_options, flatten_options
from inferframe.operators import requests as RQ
from inferframe.plans.catalog import query
from inferframe.plans.fixtures import (
    ENDPOINT_OF_FAMILY, SQL_FAMILY, SQL_PAGE_PLANS, SQL_SELECTED_PAGES, catalog_df,
    family_of_lang, page_plans, sql_values, tbl,
)
from inferframe.operators.pages import select_pages
from inferframe.operators.sizing import broadcast_if_small


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --------------------------------------------------------------------- base requests

def base_requests(spark, sf):
    """documents -> requests(request_id, lang, text, family, endpoint, pinned_model, model)."""
    d = tbl(spark, sf, "documents").select(F.col("doc_id").alias("request_id"), "lang", "text")
    ep = F.create_map(*[x for k, v in ENDPOINT_OF_FAMILY.items() for x in (F.lit(k), F.lit(v))])
    fam = family_of_lang()
    req = (d.withColumn("family", fam)
            .withColumn("endpoint", F.element_at(ep, F.col("family")))
            .withColumn("pinned_model", F.when(F.col("family") == "ocr", F.lit(R.OCR_PINNED_MODEL))))
    return RQ.resolve_model(req, catalog_df(spark))


SQL_MODEL = (f"CASE {SQL_FAMILY} WHEN 'chat_a' THEN 'chat-a-large' "
             f"WHEN 'chat_b' THEN 'chat-b-large' ELSE {_sq(R.OCR_PINNED_MODEL)} END")
SQL_ENDPOINT = f"CASE {SQL_FAMILY} WHEN 'chat_a' THEN 'chat-a' WHEN 'chat_b' THEN 'chat-b' ELSE 'ocr' END"

MSG_SCHEMA = "array<struct<role: string, content: string, tool_call_id: string, name: string>>"
PARTS_SCHEMA = ("array<struct<type: string, text: string, image_url: struct<url: string>, "
                "video_url: struct<url: string>>>")


def body_keys(body="body"):
    return F.array_join(F.json_object_keys(F.col(body)), ",")


def parsed_messages(body="body"):
    return F.from_json(F.get_json_object(F.col(body), "$.messages"), MSG_SCHEMA)


@query("jn_model", sql=f"""
SELECT doc_id AS request_id, {SQL_ENDPOINT} AS endpoint, {SQL_MODEL} AS model_id FROM documents""")
def jn_model(spark, sf):
    """Default model per endpoint (first listed) unless the client pins one."""
    r = base_requests(spark, sf)
    return r.select("request_id", "endpoint", F.col("model").alias("model_id"))


@query("prj_chat", sql=f"""
SELECT doc_id AS request_id, 'model,messages' AS keys, {SQL_MODEL} AS model, 'user' AS role,
       md5(text) AS content_md5, 1::BIGINT AS n_messages
FROM documents""")
def prj_chat(spark, sf):
    """One user message with string content per document, model resolved."""
    r = RQ.chat_request(base_requests(spark, sf))
    r = r.withColumn("body", RQ.chat_body("model", "messages"))
    m = parsed_messages()
    return r.select("request_id", body_keys().alias("keys"),
                    F.get_json_object("body", "$.model").alias("model"),
                    m[0]["role"].alias("role"), F.md5(m[0]["content"]).alias("content_md5"),
                    F.size(m).cast("bigint").alias("n_messages"))


def _order_of_lang():
    return (F.when(F.col("lang") == "de", "text_image").when(F.col("lang") == "fr", "text_video")
            .otherwise("image_text"))


@query("prj_multimodal", sql="""
WITH m AS (SELECT doc_id, text, CASE lang WHEN 'de' THEN 'text_image' WHEN 'fr' THEN 'text_video' ELSE 'image_text' END AS o,
                  CASE lang WHEN 'fr' THEN 'video/mp4' ELSE 'image/png' END AS mime FROM documents)
SELECT doc_id AS request_id,
       CASE o WHEN 'image_text' THEN 'image_url' ELSE 'text' END AS p0_type,
       CASE o WHEN 'image_text' THEN 'text' WHEN 'text_image' THEN 'image_url' ELSE 'video_url' END AS p1_type,
       md5(text) AS text_md5,
       md5('data:' || mime || ';base64,' || to_base64(encode(text))) AS url_md5
FROM m""")
def prj_multimodal(spark, sf):
    """User message with a media part (document bytes as a data URI) and a text part, part
    order by layout: image then text, text then image, text then video."""
    d = tbl(spark, sf, "documents").select(F.col("doc_id").alias("request_id"), "lang", "text")
    mime = F.when(F.col("lang") == "fr", "video/mp4").otherwise("image/png")
    d = RQ.with_data_uri(d.withColumn("mime", mime), "text", F.col("mime"))
    r = RQ.multimodal_request(d, "text", "url", _order_of_lang())
    r = r.withColumn("body", RQ.chat_body(F.lit("vlm"), "messages"))
    parts = F.from_json(F.col("parsed")[0]["content"], PARTS_SCHEMA)
    r = r.withColumn("parsed", parsed_messages()).withColumn("p", parts)
    p = F.col("p")
    text_part = F.filter(p, lambda x: x["type"] == "text")[0]
    media = F.filter(p, lambda x: x["type"] != "text")[0]
    url = F.coalesce(media["image_url"]["url"], media["video_url"]["url"])
    return r.select("request_id", p[0]["type"].alias("p0_type"), p[1]["type"].alias("p1_type"),
                    F.md5(text_part["text"]).alias("text_md5"), F.md5(url).alias("url_md5"))


def _mode_of_lang():
    return (F.when(F.col("lang") == "en", "text").when(F.col("lang") == "fr", "formula")
            .when(F.col("lang") == "de", "table").otherwise("handwriting"))


@query("prj_system_user", sql=f"""
WITH m AS (SELECT doc_id, text, CASE lang WHEN 'en' THEN 'Text Recognition:' WHEN 'fr' THEN 'Formula Recognition:'
                                          WHEN 'de' THEN 'Table Recognition:' END AS mode_text FROM documents),
     l AS (SELECT unnest(['httpx', 'sdk']) AS layout)
SELECT doc_id AS request_id, layout,
       CASE layout WHEN 'sdk' THEN 1 ELSE 2 END::BIGINT AS n_messages,
       CASE layout WHEN 'sdk' THEN 'user' ELSE 'system,user' END AS roles,
       CASE layout WHEN 'sdk' THEN {_sq(R.OCR_SYSTEM_INSTRUCTION)} ELSE mode_text END AS user_text,
       CASE layout WHEN 'sdk' THEN NULL ELSE md5({_sq(R.OCR_SYSTEM_INSTRUCTION)}) END AS system_md5,
       md5('data:image/png;base64,' || to_base64(encode(text))) AS url_md5,
       (layout = 'sdk' OR mode_text IS NOT NULL) AS mode_known
FROM m, l""")
def prj_system_user(spark, sf):
    """Markdown-OCR requests in both client layouts (system+user, or user only)."""
    d = tbl(spark, sf, "documents").select(F.col("doc_id").alias("request_id"), "lang", "text")
    d = RQ.with_data_uri(d, "text", "image/png")
    d = d.withColumn("layout", F.explode(F.array(F.lit("httpx"), F.lit("sdk"))))
    r = RQ.system_user_request(d, "url", _mode_of_lang(), F.col("layout"))
    r = r.withColumn("body", RQ.chat_body(F.lit(R.OCR_PINNED_MODEL), "messages"))
    r = r.withColumn("m", parsed_messages())
    last = F.element_at(F.col("m"), -1)
    up = F.from_json(last["content"], PARTS_SCHEMA)
    first = F.col("m")[0]
    sysp = F.when(first["role"] == "system", F.from_json(first["content"], PARTS_SCHEMA)[0]["text"])
    return r.select("request_id", "layout", F.size("m").cast("bigint").alias("n_messages"),
                    F.array_join(F.transform("m", lambda x: x["role"]), ",").alias("roles"),
                    up[0]["text"].alias("user_text"), F.md5(sysp).alias("system_md5"),
                    F.md5(up[1]["image_url"]["url"]).alias("url_md5"),
                    (F.col("mode_known") | (F.col("layout") == "sdk")).alias("mode_known"))


@query("prj_completion", sql=f"""
SELECT doc_id AS request_id, 'model,prompt' AS keys, {SQL_MODEL} AS model, md5(text) AS prompt_md5 FROM documents""")
def prj_completion(spark, sf):
    """Text-completion bodies (prompt, no messages)."""
    r = RQ.completion_request(base_requests(spark, sf), "text", "model")
    return r.select("request_id", body_keys().alias("keys"),
                    F.get_json_object("body", "$.model").alias("model"),
                    F.md5(F.get_json_object("body", "$.prompt")).alias("prompt_md5"))


PROFILE_COLS = ["profile", "p_family", "temperature", "top_p", "top_k", "presence_penalty",
                "max_tokens", "max_completion_tokens", "enable_thinking"]
SQL_PROFILES = sql_values(R.SAMPLING_PROFILES, PROFILE_COLS, alias="p")


def profiled(spark, sf):
    return RQ.expand_profiles(base_requests(spark, sf), R.profiles_df(spark), on="family")


@query("jn_profiles", sql=f"""
SELECT d.doc_id AS request_id, p.profile, p.temperature, p.max_tokens::VARCHAR AS max_tokens
FROM documents d JOIN {SQL_PROFILES} ON p_family = {SQL_FAMILY}""")
def jn_profiles(spark, sf):
    """Each request under every sampling profile of its model family."""
    r = profiled(spark, sf)
    return r.select("request_id", "profile", "temperature",
                    F.col("max_tokens").cast("string").alias("max_tokens"))


SQL_OPTIONS = """'{' || concat_ws(',',
   CASE WHEN max_tokens IS NOT NULL THEN '"max_tokens":' || max_tokens END,
   CASE WHEN max_completion_tokens IS NOT NULL THEN '"max_completion_tokens":' || max_completion_tokens END,
   CASE WHEN temperature IS NOT NULL THEN '"temperature":' || temperature::DOUBLE::VARCHAR END,
   CASE WHEN top_p IS NOT NULL THEN '"top_p":' || top_p::DOUBLE::VARCHAR END,
   CASE WHEN presence_penalty IS NOT NULL THEN '"presence_penalty":' || presence_penalty::DOUBLE::VARCHAR END,
   CASE WHEN top_k IS NOT NULL THEN '"top_k":' || top_k END,
   CASE WHEN enable_thinking IS NOT NULL THEN '"chat_template_kwargs":{"enable_thinking":' || enable_thinking::VARCHAR || '}' END
 ) || '}'"""


@query("prj_options", sql=f"""
SELECT d.doc_id AS request_id, p.profile, {SQL_OPTIONS} AS options_json
FROM documents d JOIN {SQL_PROFILES} ON p_family = {SQL_FAMILY}""")
def prj_options(spark, sf):
    """Sampling options as JSON (absent option => absent key; nested thinking flag)."""
    r = RQ.with_options(profiled(spark, sf))
    return r.select("request_id", "profile", "options_json")


@query("prj_repeat", sql=f"""
SELECT d.doc_id AS request_id, p.profile, s.sample_idx
FROM documents d JOIN {SQL_PROFILES} ON p_family = {SQL_FAMILY},
     (SELECT unnest([0, 1]) AS sample_idx) s
WHERE p.temperature >= 1.0""")
def prj_repeat(spark, sf):
    """Requests sampled at temperature >= 1 are sent twice (sample_idx 0, 1)."""
    r = profiled(spark, sf).filter(F.col("temperature") >= 1.0)
    return RQ.repeat_samples(r, 2).select("request_id", "profile",
                                          F.col("sample_idx").cast("int").alias("sample_idx"))


CONSTRAINT_KINDS = ["choice", "regex", "json", "grammar", "response_format"]


def _constraint_value():
    c = F.col("constraint_json")
    k = F.col("ckind")
    return (F.when(k == "choice", F.array_join(F.from_json(F.get_json_object(c, "$.guided_choice"),
                                                           "array<string>"), "|"))
            .when(k == "regex", F.concat(F.get_json_object(c, "$.guided_regex"), F.lit("|"),
                                         F.get_json_object(c, "$.stop[0]")))
            .when(k == "json", F.concat(F.get_json_object(c, "$.guided_json.title"), F.lit("|"),
                                        F.get_json_object(c, "$.guided_json.required")))
            .when(k == "grammar", F.md5(F.get_json_object(c, "$.guided_grammar")))
            .when(k == "response_format", F.concat(
                F.get_json_object(c, "$.response_format.json_schema.name"), F.lit("|"),
                F.get_json_object(c, "$.guided_decoding_backend"))))


_CONSTRAINT_EXPECT = [
    ("choice", "guided_choice", "|".join(R.CHOICES)),
    ("regex", "guided_regex,stop", R.EMAIL_REGEX + "|" + R.EMAIL_STOP),
    ("json", "guided_json", "CarDescription|" + json.dumps(R.CAR_DESCRIPTION_SCHEMA["required"],
                                                           separators=(",", ":"))),
    ("grammar", "guided_grammar", None),
    ("response_format", "response_format,guided_decoding_backend", "CityInfo|outlines"),
]


@query("prj_constraint", sql="""
SELECT d.doc_id AS request_id, c.ckind, c.keys, coalesce(c.val, md5(c.grammar)) AS value
FROM documents d, """ + sql_values(
    [(k, keys, v, R.SELECT_GRAMMAR if k == "grammar" else None) for k, keys, v in _CONSTRAINT_EXPECT],
    ["ckind", "keys", "val", "grammar"], alias="c"))
def prj_constraint(spark, sf):
    """Every request with each structured-output constraint kind attached."""
    d = tbl(spark, sf, "documents").select(F.col("doc_id").alias("request_id"))
    d = d.withColumn("ckind", F.explode(F.array(*[F.lit(k) for k in CONSTRAINT_KINDS])))
    r = RQ.with_constraint(d, "ckind")
    return r.select("request_id", "ckind", body_keys("constraint_json").alias("keys"),
                    _constraint_value().alias("value"))


@query("prj_constraint_own", sql="""
SELECT doc_id AS request_id, 'choice' AS ckind, 'guided_choice' AS keys, lang || ',' || source AS value FROM documents
UNION ALL SELECT doc_id, 'regex', 'guided_regex', '^' || lang || '$' FROM documents
UNION ALL SELECT doc_id, 'json', 'guided_json', source FROM documents
UNION ALL SELECT doc_id, 'grammar', 'guided_grammar', 'start: "' || lang || '"' FROM documents
UNION ALL SELECT doc_id, 'response_format', 'response_format,guided_decoding_backend', source FROM documents""")
def prj_constraint_own(spark, sf):
    """Every request with constraints of the caller's own, one of each kind, given as a column."""
    d = tbl(spark, sf, "documents").select(F.col("doc_id").alias("request_id"), "lang", "source")
    schema = F.to_json(F.struct(F.lit("object").alias("type"), F.col("source").alias("title")))
    own = F.array(
        F.struct(F.lit("choice").alias("ckind"), F.to_json(F.array("lang", "source")).alias("spec")),
        F.struct(F.lit("regex").alias("ckind"), F.concat(F.lit("^"), F.col("lang"), F.lit("$")).alias("spec")),
        F.struct(F.lit("json").alias("ckind"), schema.alias("spec")),
        F.struct(F.lit("grammar").alias("ckind"), F.concat(F.lit('start: "'), F.col("lang"), F.lit('"')).alias("spec")),
        F.struct(F.lit("response_format").alias("ckind"), F.concat(F.lit('{"name":"Own","schema":'), schema, F.lit("}")).alias("spec")))
    r = RQ.with_constraint(d.select("request_id", F.explode(own).alias("o")).select("request_id", "o.*"), "ckind", "spec")
    c = lambda path: F.get_json_object("constraint_json", path)
    value = F.coalesce(F.array_join(F.from_json(c("$.guided_choice"), "array<string>"), ","), c("$.guided_regex"),
                       c("$.guided_json.title"), c("$.guided_grammar"), c("$.response_format.json_schema.schema.title"))
    return r.select("request_id", "ckind", body_keys("constraint_json").alias("keys"), value.alias("value"))


@query("prj_conversion_body", sql="""
SELECT page_id, 'options,sources' AS keys, url, 'http' AS kind, 'ppdoclayout-v3' AS layout, 'json,doctags' AS formats FROM pages""")
def prj_conversion_body(spark, sf):
    """URL-source conversion bodies with nested options."""
    options = F.lit(json.dumps({"to_formats": ["json", "doctags"], "layout_custom_config": {"kind": "ppdoclayout-v3"}}))
    p = tbl(spark, sf, "pages").select("page_id", "url").withColumn("body", RQ.conversion_body(options, "url"))
    g = lambda path: F.get_json_object("body", path)
    return p.select("page_id", body_keys().alias("keys"), g("$.sources[0].url").alias("url"), g("$.sources[0].kind").alias("kind"),
                    g("$.options.layout_custom_config.kind").alias("layout"),
                    F.array_join(F.from_json(g("$.options.to_formats"), "array<string>"), ",").alias("formats"))


@query("prj_tools", sql=f"""
SELECT conv_id, count(*)::BIGINT AS n_messages, 1::BIGINT AS n_tools,
       {_sq(R.WEATHER_TOOL['name'])} AS tool_name,
       {_sq(','.join(R.WEATHER_TOOL['parameters']['required']))} AS required,
       'model,messages,tools' AS keys,
       md5(string_agg(role || ':' || text, chr(30) ORDER BY turn)) AS history_md5
FROM conversations GROUP BY conv_id""")
def prj_tools(spark, sf):
    """Each packed conversation sent with the tool list attached."""
    from inferframe.operators.chat import pack_conversation
    conv = tbl(spark, sf, "conversations")
    packed = pack_conversation(conv)
    msgs = F.transform("messages", lambda m: RQ.message(m["role"], content=m["text"]))
    r = RQ.with_tools(packed.withColumn("messages", msgs), R.tool_registry_df(spark))
    r = r.withColumn("body", RQ.chat_body(F.lit("chat"), "messages",
                                          RQ.json_field("tools", F.col("tools_json"))))
    m = parsed_messages()
    return r.select(
        "conv_id", F.size(m).cast("bigint").alias("n_messages"),
        F.json_array_length(F.get_json_object("body", "$.tools")).cast("bigint").alias("n_tools"),
        F.get_json_object("body", "$.tools[0].function.name").alias("tool_name"),
        F.array_join(F.from_json(F.get_json_object("body", "$.tools[0].function.parameters.required"),
                                 "array<string>"), ",").alias("required"),
        body_keys().alias("keys"),
        F.md5(F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit(":"), x["content"])),
                           "\u001e")).alias("history_md5"))


@query("prj_data_uri", sql="""
SELECT doc_id, md5('data:image/png;base64,' || to_base64(encode(text))) AS uri_md5,
       length('data:image/png;base64,' || to_base64(encode(text)))::BIGINT AS uri_len
FROM documents""")
def prj_data_uri(spark, sf):
    """Whole document bytes as a PNG data URI (no line breaks in the payload)."""
    d = RQ.with_data_uri(tbl(spark, sf, "documents"), "text", "image/png")
    return d.select("doc_id", F.md5("url").alias("uri_md5"),
                    F.length("url").cast("bigint").alias("uri_len"))


@query("sc_base64", sql="""
SELECT doc_id, md5(to_base64(encode(text))) AS b64_md5, length(to_base64(encode(text)))::BIGINT AS b64_len,
       FALSE AS has_break
FROM documents""")
def sc_base64(spark, sf):
    """Standard base64 of the UTF-8 text, without line breaks."""
    d = tbl(spark, sf, "documents").withColumn("b", base64_nolines(F.col("text")))
    return d.select("doc_id", F.md5("b").alias("b64_md5"), F.length("b").cast("bigint").alias("b64_len"),
                    F.col("b").contains("\n").alias("has_break"))


PROMPT_MODES = list(R.OCR_PROMPTS) + ["prompt_table_en"]  # the last one is not a template


def prompt_pages(spark, sf):
    pages = select_pages(page_plans(spark, sf).drop("text"))
    modes = F.array(*[F.lit(m) for m in PROMPT_MODES])
    mode = F.element_at(modes, ((F.col("doc_id") + F.col("page_idx")) % len(PROMPT_MODES) + 1).cast("int"))
    # boxes as fractions of a point: the prompt must show the numbers as they are
    bbox = F.when(F.col("doc_id") % 2 == 1, F.array(F.lit(0.0), F.lit(0.5), F.col("w_pt") + F.lit(0.25), F.col("h_pt").cast("double")))
    return pages.withColumn("mode", mode).withColumn("bbox", bbox)


SQL_PROMPTS = sql_values([(k, v) for k, v in R.OCR_PROMPTS.items()], ["pmode", "template"])
SQL_PROMPT_PAGES = f"""
pp AS (
  SELECT doc_id, page_idx,
         ({'[' + ', '.join(_sq(m) for m in PROMPT_MODES) + ']'})[((doc_id + page_idx) % {len(PROMPT_MODES)} + 1)::INTEGER] AS mode,
         CASE WHEN doc_id % 2 = 1 THEN '[0, 0.5, ' || w_pt || '.25, ' || h_pt || ']' END AS box
  FROM {{sel}})"""


@query("prj_prompt", sql=f"""
WITH {SQL_PAGE_PLANS}, {SQL_SELECTED_PAGES},
{SQL_PROMPT_PAGES.format(sel="selected_pages JOIN page_plans USING (doc_id, text, n_pages)")}
SELECT doc_id, page_idx, mode,
       CASE WHEN template IS NULL OR (mode = 'prompt_grounding_ocr' AND box IS NULL) THEN NULL
            ELSE md5({_sq(R.IMAGE_TOKEN_PREFIX)} || template || CASE WHEN mode = 'prompt_grounding_ocr' THEN box ELSE '' END) END AS prompt_md5,
       CASE WHEN template IS NULL THEN 'unknown_mode'
            WHEN mode = 'prompt_grounding_ocr' AND box IS NULL THEN 'missing_bbox' END AS prompt_error
FROM pp LEFT JOIN {SQL_PROMPTS} ON pmode = mode""")
def prj_prompt(spark, sf):
    """OCR prompt per selected page: image-token prefix + template (+ box for grounding)."""
    r = RQ.with_prompt(prompt_pages(spark, sf), R.prompts_df(spark), "mode", "bbox")
    return r.select("doc_id", "page_idx", "mode", F.md5("prompt").alias("prompt_md5"),
                    "prompt_error")


@query("jn_prompt", sql=f"""
WITH {SQL_PAGE_PLANS}, {SQL_SELECTED_PAGES},
{SQL_PROMPT_PAGES.format(sel="selected_pages JOIN page_plans USING (doc_id, text, n_pages)")}
SELECT mode, count(*)::BIGINT AS n_pages, count(template)::BIGINT AS n_found,
       coalesce(max(length(template)), 0)::BIGINT AS template_len
FROM pp LEFT JOIN {SQL_PROMPTS} ON pmode = mode GROUP BY mode""")
def jn_prompt(spark, sf):
    """Template lookup by mode (broadcast join): pages per mode, how many found a template."""
    p = prompt_pages(spark, sf)
    t = broadcast_if_small(R.prompts_df(spark).select(F.col("mode").alias("pmode"), "template"))
    j = p.join(t, F.col("mode") == F.col("pmode"), "left")
    return j.groupBy("mode").agg(F.count("*").alias("n_pages"),
                                 F.count("template").alias("n_found"),
                                 F.coalesce(F.max(F.length("template")), F.lit(0))
                                 .cast("bigint").alias("template_len"))


def _override_set():
    return (F.when(F.col("lang") == "en", "ocr_only").when(F.col("lang") == "fr", "layout_only")
            .when(F.col("lang") == "de", "combined").otherwise("formats"))


_FLAT_OVERRIDES = []
for _set, _ov in R.CONVERSION_OVERRIDES.items():
    for _k, _v in _ov.items():
        if isinstance(_v, dict):
            for _k2, _v2 in _v.items():
                _FLAT_OVERRIDES.append((_set, f"{_k}.{_k2}", _v2))
        elif isinstance(_v, list):
            _FLAT_OVERRIDES.append((_set, _k, json.dumps(_v, separators=(",", ":"))))
        else:
            _FLAT_OVERRIDES.append((_set, _k, _v))


@query("prj_conv_options", sql=f"""
WITH docs AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'ocr_only' WHEN 'fr' THEN 'layout_only'
                                       WHEN 'de' THEN 'combined' ELSE 'formats' END AS oset FROM documents),
     ov AS (SELECT * FROM {sql_values(_FLAT_OVERRIDES, ['oset', 'k', 'v'])}),
     df AS (SELECT * FROM {sql_values(list(R.CONVERSION_DEFAULTS.items()), ['k', 'v'])}),
     merged AS (
       SELECT docs.doc_id, ov.k, ov.v FROM docs JOIN ov USING (oset)
       UNION ALL
       SELECT docs.doc_id, df.k, df.v FROM docs, df
       WHERE NOT EXISTS (SELECT 1 FROM ov WHERE ov.oset = docs.oset AND ov.k = df.k))
SELECT doc_id, count(*)::BIGINT AS n_options, string_agg(k || '=' || v, ';' ORDER BY k) AS options
FROM merged GROUP BY doc_id""")
def prj_conv_options(spark, sf):
    """Converter form fields: defaults updated by the document's override set (given as
    nested JSON, flattened to dotted keys), last wins."""
    d = tbl(spark, sf, "documents").select("doc_id", "lang")
    sets = F.create_map(*[x for k, v in R.CONVERSION_OVERRIDES.items()
                          for x in (F.lit(k), F.lit(json.dumps(v)))])
    d = d.withColumn("ov", flatten_options(F.element_at(sets, _override_set())))
    r = RQ.with_conversion_options(d, "ov")
    return r.select("doc_id", F.size("options").cast("bigint").alias("n_options"),
                    canonical_options("options").alias("options"))


@query("prj_request_key", sql=f"""
SELECT doc_id AS request_id, md5(concat_ws(chr(31), 'chat', {SQL_MODEL}, text)) AS request_key FROM documents""")
def prj_request_key(spark, sf):
    """Stable request identity over (kind, model, text)."""
    r = base_requests(spark, sf)
    return r.select("request_id", RQ.request_key(F.lit("chat"), "model", "text").alias("request_key"))


@query("se_unique", sql=f"""
WITH k AS (SELECT doc_id, md5(concat_ws(chr(31), 'chat', {SQL_MODEL}, text)) AS request_key FROM documents)
SELECT doc_id AS request_id, request_key,
       min(doc_id) OVER (PARTITION BY request_key) AS rep_request_id,
       count(*) OVER (PARTITION BY request_key) AS n_copies
FROM k""")
def se_unique(spark, sf):
    """Identical requests share one representative (the only one that needs sending)."""
    r = base_requests(spark, sf).withColumn(
        "request_key", RQ.request_key(F.lit("chat"), "model", "text"))
    u = RQ.unique_requests(r)
    return u.select("request_id", "request_key", "rep_request_id", "n_copies")


@query("se_unique_sampled", sql=f"""
WITH k AS (SELECT doc_id, lang, md5(concat_ws(chr(31), 'chat', {SQL_MODEL}, text)) AS request_key FROM documents)
SELECT doc_id AS request_id,
       CASE WHEN lang = 'en' THEN min(doc_id) OVER (PARTITION BY request_key, lang = 'en') ELSE doc_id END AS rep_request_id,
       CASE WHEN lang = 'en' THEN count(*) OVER (PARTITION BY request_key, lang = 'en') ELSE 1 END AS n_copies
FROM k""")
def se_unique_sampled(spark, sf):
    """Requests that sample (temperature above 0) are never merged, deterministic ones are."""
    r = base_requests(spark, sf).withColumn("request_key", RQ.request_key(F.lit("chat"), "model", "text")) \
        .withColumn("temperature", F.when(F.col("lang") == "en", 0.0).otherwise(1.0))
    u = RQ.unique_requests(r, temperature="temperature", hot_keys=2)
    return u.select("request_id", "rep_request_id", "n_copies")
