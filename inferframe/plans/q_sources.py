"""Source and sink queries: SRC2 media files, SRC3 conversations, SNK1 request files."""

from __future__ import annotations

from pyspark.sql import functions as F

from inferframe.functions.scalars import mime_of
from inferframe.plans.catalog import query
from inferframe.plans.q_requests import base_requests
from inferframe.operators import requests as RQ
from inferframe.session import shared_dir
from inferframe.sources.readers import md5_of_pieces, read_conversations, read_media, read_media_pieces
from inferframe.sources.sinks import write_requests


@query("src_media", sql="""
SELECT regexp_extract(filename, '([^/]+)$', 1) AS file_name, 'parquet' AS ext, size::BIGINT AS length,
       md5(content) AS content_md5, 'application/vnd.apache.parquet' AS mime
FROM read_blob('/root/testdata/sf0.01/*.parquet')""")
def src_media(spark, sf):
    """The sf directory's files read as binary media rows (name, size, bytes, MIME type); a large file's bytes
    come in pieces."""
    m = read_media(spark, sf, "*.parquet", with_content=True, large=False).withColumn("content_md5", F.md5("content"))
    large = md5_of_pieces(read_media_pieces(spark, sf, "*.parquet"))
    cols = ["file_name", "ext", "length", "content_md5", mime_of("path").alias("mime")]
    return m.select(*cols).unionByName(large.select(*cols))


@query("src_conversations", sql="""
SELECT conv_id, turn, role, md5(text) AS text_md5, TRUE AS parts_null, TRUE AS calls_null FROM conversations""")
def src_conversations(spark, sf):
    """Conversation messages in the canonical message shape (union content, tool fields)."""
    c = read_conversations(spark, f"{sf}/conversations.parquet")
    return c.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"),
                    F.col("parts").isNull().alias("parts_null"),
                    F.col("tool_calls").isNull().alias("calls_null"))


@query("snk_requests", sql="""
SELECT 'chat' AS kind, doc_id AS request_id, '/v1/chat/completions' AS url, md5(text) AS content_md5 FROM documents
UNION ALL
SELECT 'completion', doc_id, '/v1/completions', md5(text) FROM documents""")
def snk_requests(spark, sf):
    """Requests written as batch files (one JSON request per line, partitioned by kind)
    and read back by partition."""
    r = base_requests(spark, sf)
    chat = RQ.chat_request(r).withColumn("body", RQ.chat_body("model", "messages")) \
        .withColumn("kind", F.lit("chat")).withColumn("url", F.lit("/v1/chat/completions"))
    comp = RQ.completion_request(r, "text", "model").withColumn("kind", F.lit("completion")) \
        .withColumn("url", F.lit("/v1/completions"))
    both = chat.select("request_id", "kind", "url", "body").unionByName(
        comp.select("request_id", "kind", "url", "body"))
    line = RQ.merge_json_objects(
        F.to_json(F.struct(F.col("request_id").cast("string").alias("custom_id"),
                           F.lit("POST").alias("method"), F.col("url"))),
        RQ.json_field("body", F.col("body")))
    path = shared_dir(spark, "requests")
    write_requests(both.withColumn("line", line), path, body_col="line", partition_by="kind")
    back = spark.read.text(path)
    content = F.coalesce(F.get_json_object("value", "$.body.messages[0].content"),
                         F.get_json_object("value", "$.body.prompt"))
    return back.select("kind", F.get_json_object("value", "$.custom_id").cast("bigint").alias("request_id"),
                       F.get_json_object("value", "$.url").alias("url"),
                       F.md5(content).alias("content_md5"))
