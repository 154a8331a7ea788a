"""SRC1-SRC4: readers that produce the engine's canonical shapes.

All readers use an explicit schema or a parquet footer, never JSON schema inference, so
column pruning and predicate pushdown reach the scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: bytes up to which a media file is read as one value; longer files can be read in pieces
WHOLE_BYTES = 64 << 20


def response_schema(id_type: str = "bigint") -> T.StructType:
    """Columns of a response log, as `invoke` writes it. `id_type` is the type of the request
    ids: logs keyed by text ids are read with "string"."""
    return T._parse_datatype_string(
        f"request_id {id_type}, kind string, status_code int, body string, error string")


PART = T.StructType([T.StructField("type", T.StringType()),
                     T.StructField("text", T.StringType()),
                     T.StructField("url", T.StringType())])
CALL = T.StructType([T.StructField("id", T.StringType()),
                     T.StructField("name", T.StringType()),
                     T.StructField("arguments", T.StringType())])


def read_items(spark: SparkSession, path: str, id_col: str = "doc_id",
               text_col: str = "text", fmt: str = "parquet") -> DataFrame:
    """SRC1: an item list (documents or queries) as ``(item_id BIGINT, text STRING)``.
    Only the two columns are read (ReadSchema is pruned to them)."""
    df = spark.read.format(fmt).load(path)
    return df.select(F.col(id_col).cast("bigint").alias("item_id"),
                     F.col(text_col).cast("string").alias("text"))


def _in_pieces() -> Column:
    """Whether a file is left to `read_media_pieces`. Spark's text reader unpacks files with the ending of a
    codec, so these stay whole. Only file metadata is used: other files are not even planned."""
    return ((F.col("_metadata.file_size") > WHOLE_BYTES)
            & ~F.lower("_metadata.file_name").rlike(r"\.(gz|bz2|deflate|snappy|lz4|zst|zstd)$"))


def _media_names() -> list[Column]:
    return [F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
            F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("ext")]


def read_media(spark: SparkSession, path: str, glob: str = "*", with_content: bool = True,
               recursive: bool = False, large: bool = True) -> DataFrame:
    """SRC2: media files as rows ``(path, file_name, ext, length, modificationTime[, content])``.

    The binaryFile source only reads bytes for the columns that are selected, so callers
    that need metadata pass ``with_content=False`` and no file body is read. A content is one value in an
    executor's memory (2 GB at most); ``large=False`` leaves out the files that `read_media_pieces` reads."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(path)
    if not large:
        df = df.filter(~_in_pieces())
    cols = ["path", *_media_names(), "length", "modificationTime"]
    if with_content:
        cols.append("content")
    return df.select(*cols)


def read_media_pieces(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """SRC2 for files longer than `WHOLE_BYTES`: ``(path, file_name, ext, length, modificationTime, piece)``, the
    bytes between newlines, without these, in the order of the file and all in one partition. A task holds
    a batch of pieces, however long its file is; only a stretch without a newline is one value (2 GB at most).
    The text reader leaves out a UTF-8 byte order mark at a file's start."""
    own = spark.newSession()  # its own splits: one file a partition, and whole
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    for k in ("maxPartitionBytes", "openCostInBytes"):
        own.conf.set(f"spark.sql.files.{k}", str(1 << 50))
    reader = own.read.option("pathGlobFilter", glob).option("lineSep", "\n")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.text(path).filter(_in_pieces()).select(
        # the metadata column escapes what a URL can't hold; a plus stays as it is
        F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"),
        F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_modification_time").alias("modificationTime"),
        F.col("value").cast("binary").alias("piece"))
    return df.select("path", *_media_names(), "length", "modificationTime", "piece")


class _Digest:
    """MD5 of a file from its pieces. The length tells, at the end, whether a mark at the start was left out and
    whether the last piece ends with a newline."""

    MARK = b"\xef\xbb\xbf"

    def __init__(self, path: str, length: int):
        self.path, self.length, self.seen = path, length, -1
        self.forms = (hashlib.md5(), hashlib.md5(self.MARK))

    def add(self, pieces: pa.Array) -> None:
        rows = pa.LargeListArray.from_arrays(pa.array([0, len(pieces)], pa.int64()), pieces.cast(pa.large_binary()))
        data = pc.binary_join(rows, pa.scalar(b"\n", pa.large_binary()))[0].as_buffer()
        for form in self.forms:
            if self.seen >= 0:
                form.update(b"\n")
            form.update(data)
        self.seen += 1 + data.size

    def result(self) -> str:
        marked, newline = divmod(self.length - self.seen, len(self.MARK))
        if marked not in (0, 1) or newline not in (0, 1):
            raise ValueError(f"{self.path}: {self.seen} bytes came of {self.length}")
        form = self.forms[marked]
        if newline:
            form.update(b"\n")
        return form.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"path": now.path, "length": now.length, "content_md5": now.result()}])

    for batch in batches:
        paths = batch["path"].dictionary_encode()
        at = paths.indices.to_numpy()
        starts = [0, *(i + 1 for i in (at[1:] != at[:-1]).nonzero()[0].tolist())] if len(at) else []
        for start, end in zip(starts, [*starts[1:], len(at)]):
            path = batch["path"][start].as_py()
            if now is None or now.path != path:
                if now is not None:
                    yield done()
                now = _Digest(path, batch["length"][start].as_py())
            now.add(batch["piece"].slice(start, end - start))
    if now is not None:
        yield done()


def md5_of_pieces(pieces: DataFrame) -> DataFrame:
    """``(path, file_name, ext, length, content_md5)`` per file of `read_media_pieces`: one chain over the file's bytes,
    so one task reads it, a batch of pieces at a time."""
    found = pieces.select("path", "length", "piece").mapInArrow(_digests, "path string, length bigint, content_md5 string")
    return found.select("path", *_media_names(), "length", "content_md5")


def read_conversations(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC3: conversation messages normalised to the ``messages`` shape: one row per message
    with union-typed content kept as two nullable columns (``text``, ``parts``) and the tool
    columns. Columns the source has are kept (fields of parts and calls are matched by name);
    absent ones are NULL. Text sources such as JSON lines are read with the fixed schema."""
    shape = {"parts": T.ArrayType(PART), "tool_calls": T.ArrayType(CALL),
             "tool_call_id": T.StringType(), "name": T.StringType()}
    if fmt == "json":
        fields = [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                  T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                  *(T.StructField(k, v) for k, v in shape.items())]
        df = spark.read.schema(T.StructType(fields)).json(path)
    else:
        df = spark.read.format(fmt).load(path)

    def kept(name: str, to: T.DataType):
        if name not in df.columns:
            return F.lit(None).cast(to).alias(name)
        have = df.schema[name].dataType
        if isinstance(to, T.ArrayType) and isinstance(have, T.ArrayType) and isinstance(have.elementType, T.StructType):
            names = have.elementType.fieldNames()
            return F.transform(name, lambda x: F.struct(*[
                (x[f.name] if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in to.elementType.fields])).alias(name)
        return F.col(name).cast(to).alias(name)

    return df.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.col("role").cast("string"), F.col("text").cast("string"),
        *(kept(k, v) for k, v in shape.items()))


def read_responses(spark: SparkSession, path: str, fmt: str = "json",
                   id_type: str = "bigint") -> DataFrame:
    """SRC4: a response log ``(request_id, kind, status_code, body, error)`` with a fixed schema.
    Response logs are never schema-inferred: the body stays text and is parsed per kind."""
    schema = response_schema(id_type)
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    return spark.read.format(fmt).schema(schema).load(path)
