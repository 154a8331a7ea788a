"""Inputs derived from the driver tables (FIXTURES.md part C), each written twice: as a
Spark function and as a DuckDB SQL fragment producing the same rows. All derivations cover
whole tables; hex digits of md5 or arithmetic on keys only pick *values* (a mode, a size,
a failure kind), never which rows take part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inferframe.sources.tables import load_table

EPOCH = 1704067200  # 2024-01-01T00:00:00Z, base of the fragment clock
CHUNK_CHARS = 40


def tbl(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return load_table(spark, sf, name)


# ------------------------------------------------------------------ D1 content chunks

def content_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """D1: each document streamed as 40-character fragments; after every 7th fragment an
    empty heartbeat. ``seq`` is dense per request (fragment j sits at j + j div 7, its
    heartbeat right after); the last text fragment carries ``finish_reason='stop'``;
    ``created`` = epoch + seq seconds.

    The text is cut in one linear regex pass (``substring`` at growing offsets would
    rescan UTF-8 text from its start for every fragment: quadratic per document); the
    heartbeats are generated from the fragment count alone."""
    d = tbl(spark, sf, "documents").select("doc_id", "text")
    cut = d.select("doc_id", F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % CHUNK_CHARS), 0).alias("a"))
    # *_outer + explicit filter: a plain posexplode lets Catalyst infer size(a) > 0 and
    # push the regex into the scan filter, evaluating it twice
    c = (cut.select("doc_id", (F.size("a") - 1).alias("last"), F.posexplode_outer("a").alias("j", "content"))
         .filter(F.col("j").isNotNull()))
    text_rows = c.select(F.col("doc_id").alias("request_id"),
                         (F.col("j") + F.floor(F.col("j") / 7)).cast("bigint").alias("seq"), "content",
                         F.when(F.col("j") == F.col("last"), F.lit("stop")).alias("finish_reason"))
    last = F.floor((F.length("text") - 1) / CHUNK_CHARS)
    beats = d.select("doc_id", F.explode(F.when(last >= 6, F.sequence(
        F.lit(0).cast("bigint"), F.floor((last - 6) / 7)))).alias("h"))
    beat_rows = beats.select(F.col("doc_id").alias("request_id"), (F.col("h") * 8 + 7).cast("bigint").alias("seq"),
                             F.lit("").alias("content"), F.lit(None).cast("string").alias("finish_reason"))
    rows = text_rows.unionByName(beat_rows)
    return rows.select("request_id", "seq", "content", "finish_reason",
                       (F.lit(EPOCH) + F.col("seq")).alias("created"),
                       F.timestamp_seconds(F.lit(EPOCH) + F.col("seq")).alias("ts"))


SQL_CHUNKS = f"""
chunks AS (
  SELECT doc_id AS request_id, (j + j//7 + hb)::BIGINT AS seq,
         CASE WHEN hb = 1 THEN '' ELSE substring(text, (j*{CHUNK_CHARS}+1)::INTEGER, {CHUNK_CHARS}) END AS content,
         CASE WHEN hb = 0 AND j = (length(text)-1)//{CHUNK_CHARS} THEN 'stop' END AS finish_reason,
         ({EPOCH} + j + j//7 + hb)::BIGINT AS created
  FROM (SELECT doc_id, text, unnest(generate_series(0, (length(text)-1)//{CHUNK_CHARS})) AS j FROM documents) s,
       (SELECT unnest([0, 1]) AS hb) h
  WHERE hb = 0 OR j % 7 = 6
)"""


# --------------------------------------------------------------------- D2 tool chunks

def tool_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """D2: per user (request), each event is one streamed tool call: index = event_id,
    name = event_type and id ``call_<event_id>`` on the first fragment only, arguments =
    ``props`` cut in 4-character fragments; ``seq`` orders fragments within the request."""
    e = tbl(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    last = F.floor((F.length("props") - 1) / 4)
    ex = e.select("*", F.explode(F.when(last >= 0, F.sequence(F.lit(0).cast("bigint"), last))).alias("p"))
    return ex.select(
        F.col("user_id").alias("request_id"),
        (F.col("event_id") * 1000 + F.col("p")).alias("seq"),
        F.col("event_id").alias("tool_index"),
        F.when(F.col("p") == 0, F.concat(F.lit("call_"), F.col("event_id").cast("string"))).alias("tool_id"),
        F.when(F.col("p") == 0, F.col("event_type")).alias("tool_name"),
        F.substring("props", (F.col("p") * 4 + 1).cast("int"), 4).alias("tool_args"),
    )


SQL_TOOL_CHUNKS = """
tool_chunks AS (
  SELECT user_id AS request_id, event_id*1000 + p AS seq, event_id AS tool_index,
         CASE WHEN p = 0 THEN 'call_' || event_id END AS tool_id,
         CASE WHEN p = 0 THEN event_type END AS tool_name,
         substring(props, (p*4+1)::INTEGER, 4) AS tool_args
  FROM (SELECT *, unnest(generate_series(0, (length(props)-1)//4)) AS p FROM events) s
)"""


# -------------------------------------------------------------------- D7 task events

def task_events(spark: SparkSession, sf: str) -> DataFrame:
    """D7: the event log as task polls: task = user, purchase => success,
    error => failure, anything else => running."""
    e = tbl(spark, sf, "events")
    status = (F.when(F.col("event_type") == "purchase", "success")
              .when(F.col("event_type") == "error", "failure").otherwise("running"))
    return e.select(F.col("user_id").alias("task_id"), F.col("event_id"),
                    ntz_as_utc("ts").alias("ts"), status.alias("status"))


def ntz_as_utc(col: str):
    """TIMESTAMP_NTZ -> TIMESTAMP reading the wall clock as UTC, whatever the session time
    zone (a plain cast would use the session zone). Stream operators need TIMESTAMP."""
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})")
    return F.timestamp_micros(micros)


SQL_TASK_EVENTS = """
task_events AS (
  SELECT user_id AS task_id, event_id, ts,
         CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failure' ELSE 'running' END AS status
  FROM events
)"""


# --------------------------------------------------------------------- D8 page plans

def page_plans(spark: SparkSession, sf: str) -> DataFrame:
    """D8: each document as a PDF: pages of 1000 characters, a requested page range
    (start -1..2; end NULL for every third id, else -1..3), page size in points and an
    image size in pixels (including degenerate ones)."""
    d = tbl(spark, sf, "documents").select("doc_id", "text", "n_chars")
    return d.select(
        "doc_id", "text",
        F.floor((F.length("text") + 999) / 1000).cast("bigint").alias("n_pages"),
        (F.col("doc_id") % 4 - 1).alias("start"),
        F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("doc_id") % 5 - 1).alias("end"),
        (F.lit(200) + (F.col("doc_id") * 37) % 1400).alias("w_pt"),
        (F.lit(200) + (F.col("doc_id") * 53) % 1800).alias("h_pt"),
        F.when(F.col("doc_id") % 17 == 0, F.lit(2))
         .when(F.col("doc_id") % 13 == 0, F.lit(1) + F.col("doc_id") % 50)
         .otherwise(F.lit(1) + (F.col("doc_id") * 7919) % 6000).cast("int").alias("h"),
        F.when(F.col("doc_id") % 19 == 0, F.lit(0))
         .when(F.col("doc_id") % 13 == 0, F.lit(1) + F.col("n_chars") % 60)
         .otherwise(F.lit(1) + (F.col("n_chars") * 31) % 6000).cast("int").alias("w"),
    )


SQL_PAGE_PLANS = """
page_plans AS (
  SELECT doc_id, text, ((length(text) + 999) // 1000)::BIGINT AS n_pages,
         doc_id % 4 - 1 AS start,
         CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id % 5 - 1 END AS "end",
         200 + (doc_id * 37) % 1400 AS w_pt, 200 + (doc_id * 53) % 1800 AS h_pt,
         (CASE WHEN doc_id % 17 = 0 THEN 2 WHEN doc_id % 13 = 0 THEN 1 + doc_id % 50
               ELSE 1 + (doc_id * 7919) % 6000 END)::INTEGER AS h,
         (CASE WHEN doc_id % 19 = 0 THEN 0 WHEN doc_id % 13 = 0 THEN 1 + n_chars % 60
               ELSE 1 + (n_chars * 31) % 6000 END)::INTEGER AS w
  FROM documents
)"""

SQL_SELECTED_PAGES = """
selected_pages AS (
  SELECT doc_id, text, n_pages, page_idx FROM (
    SELECT *, greatest(coalesce(start, 0), 0) AS st,
           least(coalesce(CASE WHEN "end" >= 0 THEN "end" END, n_pages - 1), n_pages - 1) AS en
    FROM page_plans) b,
  LATERAL (SELECT unnest(CASE WHEN st <= en THEN generate_series(st, en) ELSE [] END)::BIGINT AS page_idx)
)"""


# ----------------------------------------------------------- D4 validation candidates

def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """D4: model answers to check, derived from ``part`` (and ``labels`` for choices):
    kinds email / city_json / car_json / city_array / grammar / code_json, one row per part
    and kind."""
    p = tbl(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    brand = F.lower(F.regexp_replace("p_brand", r"[^A-Za-z0-9]", ""))
    word = F.lower(F.split("p_type", " ").getItem(0))
    email = (F.when(F.col("p_size") % 4 == 0, F.concat(brand, F.lit("@"), word, F.lit(".com\n")))
             .when(F.col("p_size") % 4 == 1, F.concat(brand, F.lit("@"), word, F.lit(".com")))
             .when(F.col("p_size") % 4 == 2, F.concat(F.lit("x."), brand, F.lit("@"), word, F.lit(".com")))
             .otherwise(F.concat(brand, F.lit("@"), word, F.lit(".org"))))
    pop = (F.when(F.col("p_size") % 5 == 0, F.lit("12")).when(F.col("p_size") % 5 == 1, F.lit("12.0"))
           .when(F.col("p_size") % 5 == 2, F.lit('"12"')).when(F.col("p_size") % 5 == 3, F.lit("true"))
           .otherwise(F.lit("null")))
    city_full = F.concat(F.lit('{"city":"'), F.col("p_brand"), F.lit('","population":'), pop, F.lit("}"))
    city = F.when(F.col("p_partkey") % 7 == 0,
                  F.expr("substring(_cf, 1, length(_cf) - 1)")).otherwise(F.col("_cf"))
    car_type = F.element_at(F.array(*[F.lit(x) for x in ("sedan", "SUV", "Truck", "Coupe", "van")]),
                            (F.col("p_size") % 5 + 1).cast("int"))
    car = F.concat(F.lit('{"brand":"'), F.col("p_brand"), F.lit('","model":"'), word,
                   F.lit('","car_type":"'), car_type, F.lit('"}'))
    arr = F.when(F.col("p_size") % 3 == 0, F.col("_cf")).otherwise(
        F.concat(F.lit("["), F.col("_cf"), F.lit(","),
                 F.concat(F.lit('{"city":"x'), F.col("p_brand"), F.lit('","population":7}')),
                 F.lit(","), F.lit('{"city":"y","population":'), F.col("p_size").cast("string"),
                 F.lit("}]")))
    cols = F.transform(F.split("p_type", " "), lambda x: F.lower(x))
    grammar = (F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("SELECT "), F.array_join(cols, ", "),
                                                         F.lit(" FROM "), brand))
               .when(F.col("p_size") % 4 == 1, F.concat(F.lit("SELECT "), F.array_join(cols, ","),
                                                        F.lit(" FROM "), brand, F.lit(";")))
               .otherwise(F.concat(F.lit("SELECT "), F.array_join(cols, ","), F.lit(" FROM "), brand)))
    code_num = (F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(',"dog_code_number":'), F.col("p_size").cast("string")))
                .when(F.col("p_size") % 3 == 1, F.concat(F.lit(',"dog_code_number":"'), F.col("p_size").cast("string"), F.lit('"')))
                .otherwise(F.lit("")))
    code = F.concat(F.lit('{"cat":"'), F.col("p_brand"), F.lit('","dog":"'), word, F.lit('"'), code_num, F.lit("}"))
    base = p.withColumn("_cf", city_full)
    kinds = F.array(
        F.struct(F.lit("email").alias("kind"), email.alias("content")),
        F.struct(F.lit("city_json").alias("kind"), city.alias("content")),
        F.struct(F.lit("car_json").alias("kind"), car.alias("content")),
        F.struct(F.lit("city_array").alias("kind"), arr.alias("content")),
        F.struct(F.lit("grammar").alias("kind"), grammar.alias("content")),
        F.struct(F.lit("code_json").alias("kind"), code.alias("content")),
    )
    return base.select(F.col("p_partkey").alias("id"), F.explode(kinds).alias("k")) \
        .select("id", "k.kind", "k.content")


SQL_CANDIDATES = r"""
cand_base AS (
  SELECT p_partkey, p_brand, p_type, p_size,
         lower(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) AS brand,
         lower(string_split(p_type, ' ')[1]) AS word,
         '{"city":"' || p_brand || '","population":' ||
           CASE p_size % 5 WHEN 0 THEN '12' WHEN 1 THEN '12.0' WHEN 2 THEN '"12"' WHEN 3 THEN 'true' ELSE 'null' END
           || '}' AS cf,
         list_transform(string_split(p_type, ' '), lambda x: lower(x)) AS cols
  FROM part
),
candidates AS (
  SELECT p_partkey AS id, 'email' AS kind,
         CASE p_size % 4 WHEN 0 THEN brand || '@' || word || '.com' || chr(10)
                         WHEN 1 THEN brand || '@' || word || '.com'
                         WHEN 2 THEN 'x.' || brand || '@' || word || '.com'
                         ELSE brand || '@' || word || '.org' END AS content FROM cand_base
  UNION ALL
  SELECT p_partkey, 'city_json', CASE WHEN p_partkey % 7 = 0 THEN substring(cf, 1, length(cf) - 1) ELSE cf END FROM cand_base
  UNION ALL
  SELECT p_partkey, 'car_json', '{"brand":"' || p_brand || '","model":"' || word || '","car_type":"' ||
         (['sedan','SUV','Truck','Coupe','van'])[p_size % 5 + 1] || '"}' FROM cand_base
  UNION ALL
  SELECT p_partkey, 'city_array', CASE WHEN p_size % 3 = 0 THEN cf ELSE
         '[' || cf || ',' || '{"city":"x' || p_brand || '","population":7}' || ',' ||
         '{"city":"y","population":' || p_size || '}]' END FROM cand_base
  UNION ALL
  SELECT p_partkey, 'grammar', CASE p_size % 4
         WHEN 0 THEN 'SELECT ' || array_to_string(cols, ', ') || ' FROM ' || brand
         WHEN 1 THEN 'SELECT ' || array_to_string(cols, ',') || ' FROM ' || brand || ';'
         ELSE 'SELECT ' || array_to_string(cols, ',') || ' FROM ' || brand END FROM cand_base
  UNION ALL
  SELECT p_partkey, 'code_json', '{"cat":"' || p_brand || '","dog":"' || word || '"' ||
         CASE p_size % 3 WHEN 0 THEN ',"dog_code_number":' || p_size
                         WHEN 1 THEN ',"dog_code_number":"' || p_size || '"' ELSE '' END || '}' FROM cand_base
)"""


def choice_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Choice answers from ``labels``: quality 1 => positive, toxic => neutral (not an
    allowed choice), else negative."""
    lab = tbl(spark, sf, "labels")
    content = (F.when(F.col("quality") == 1, "positive").when(F.col("toxic") == 1, "neutral")
               .otherwise("negative"))
    return lab.select(F.col("doc_id").alias("id"), content.alias("content"))


SQL_CHOICE = """
choice_answers AS (
  SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'positive' WHEN toxic = 1 THEN 'neutral' ELSE 'negative' END AS content
  FROM labels
)"""


# ---------------------------------------------------------------- request families

def family_of_lang(lang_col="lang"):
    """Which model family serves a document: en/fr -> chat_a, de -> chat_b, else ocr."""
    return (F.when(F.col(lang_col).isin("en", "fr"), "chat_a")
            .when(F.col(lang_col) == "de", "chat_b").otherwise("ocr"))


SQL_FAMILY = "CASE WHEN lang IN ('en','fr') THEN 'chat_a' WHEN lang = 'de' THEN 'chat_b' ELSE 'ocr' END"

# D6 model catalogue: endpoint per family, two listed models each; the OCR endpoint is not
# listed (its client pins a model).
MODEL_CATALOG = [
    ("chat-a", 0, "chat-a-large"), ("chat-a", 1, "chat-a-small"),
    ("chat-b", 0, "chat-b-large"), ("chat-b", 1, "chat-b-small"),
    ("embed", 0, "embed-large"), ("embed", 1, "embed-small"),
]
ENDPOINT_OF_FAMILY = {"chat_a": "chat-a", "chat_b": "chat-b", "ocr": "ocr"}


def catalog_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODEL_CATALOG, "endpoint string, pos int, model_id string")


def sql_values(rows, cols, alias: str = "t") -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return repr(v)
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(cols)})"
