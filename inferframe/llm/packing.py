"""Packing by concatenate and cut: all documents' tokens form one long line that is cut into
windows of fixed length, so only the last sequence can be short.

Pass 1 encodes every text once and writes ids (as 16-bit numbers while the vocabulary allows, else
32-bit) with the number of the task that wrote them and the document's start inside that task. Pass 2 sums tokens
per task, prefix-sums those few totals (one row per input task, not per document) into global offsets, and
cuts each document where its global position crosses a window edge. No text or id is shuffled.

`sequences` builds the padded windows: a window inside one task is assembled there; only the
fragments of windows that span tasks (boundary records) are shuffled, by sequence number.

Encoding: see `TextEncoder`; a cache bounded in bytes (two generations of `CACHE_BYTES`) lets the tokenizer run once
per new piece of text. `end_id` follows every document.

Defined results: null and empty texts are the single end id. A null doc_id is carried through.
Repeated rows are packed each. An empty table gives no piece. Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inferframe.llm.shared import ship, written
from inferframe.llm.token_counts import byte_letters

WINDOW = 4096
END_ID = 2
#: bytes of one generation of the cache, with what Python adds to an entry (two strings, a slot, its share of the table)
CACHE_BYTES = 48 << 20
ENTRY_BYTES = 180
_encoders: dict = {}


class Generations(dict):
    """A bounded cache filled by `make`: when it is full its entries become the old generation."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old, self.held = make, {}, 0

    def __missing__(self, key: str) -> bytes:
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= 64:
            self.held += ENTRY_BYTES + len(key) + len(got)
            if self.held > CACHE_BYTES:
                self.old, self.held = dict(self), 0
                self.clear()
            self[key] = got
        return got


class TextEncoder:
    """Packed ids of texts, equal to the library's for the whole text.

    Tokenizers of the form "compose, squeeze white space, lower case; cut at a pattern that never takes white space;
    byte-level pairs" are read chunk by chunk: chunks between white space, cached, and inside a
    chunk the pattern's pieces, cached too, so the library's pair merging runs once per new piece. A piece is
    a chunk that the pattern leaves whole, so both share one cache and a plain word is held once. Chunks
    outside plain Latin letters, where composing or letter classes could matter, go through the library whole. So
    do texts with one of the tokenizer's special strings, and every text of a tokenizer of another form."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pattern = regex.compile(self._cut_pattern(spec)) if self._cut_pattern(spec) else None
        self.plain = re.compile("[\x21-\x7e\u00a1-\u012f]+")
        self.letters = {b: c for c, b in byte_letters().items()}
        self.known = Generations(self._chunk)

    @staticmethod
    def _cut_pattern(spec: dict) -> str | None:
        normal = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        cut = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if normal != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cut] != ["Split", "ByteLevel"]:
            return None
        found = cut[0]["pattern"].get("Regex")
        keeps = cut[0]["behavior"] == "Removed" and cut[0]["invert"] and not cut[1]["add_prefix_space"] and not cut[1]["use_regex"]
        return found if keeps and found == SPACE_FREE else None

    def ids(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        # the letters of printable ASCII bytes are those characters themselves
        spelled = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        return array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            low = chunk.lower()
            return self._piece(chunk) if low == chunk else self.known[low]
        if self.plain.fullmatch(chunk):
            pieces = self.pattern.findall(chunk.lower())
            return self._piece(chunk) if pieces == [chunk] else b"".join([self.known[p] for p in pieces])
        return self.ids(chunk)

    def text(self, text: str) -> bytes:
        if self.pattern is None or any(s in text for s in self.special):
            return self.ids(text)
        # str.split cuts at all Unicode white space, and at four control characters that are none
        chunks = ASCII_SPACE.split(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        return b"".join([self.known[c] for c in chunks])


#: fixed: a cutting pattern that never takes white space
SPACE_FREE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")


def encoder(path: str) -> TextEncoder:
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def _encode_batches(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, start = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            ids = batch.column(0)
            for i in range(0, len(ids), 256):
                packed = [enc.text(x or "") + end for x in batch.column(1).slice(i, 256).to_pylist()]
                counts = np.array([len(p) // enc.dtype.itemsize for p in packed], np.int64)
                at = start + np.cumsum(counts) - counts
                start += int(counts.sum())
                n = len(packed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), ids.slice(i, n), pa.array(at), pa.array(counts),
                     pa.array([enc.dtype.itemsize] * n, pa.int32()), pa.array(packed, pa.binary())],
                    names=["part", "doc_id", "at", "doc_tokens", "width", "ids"])
    return run


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Pass 1, written: part, doc_id, at (start inside the part), doc_tokens, width, ids."""
    ship(docs.sparkSession)
    return written(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _encode_batches(tokenizer, end_id),
        "part int, doc_id long, at long, doc_tokens long, width int, ids binary"), "tokens")


def with_global_start(tokens: DataFrame) -> DataFrame:
    """tokens with `begin`, the document's first position in the line of all tokens: an exclusive
    prefix sum over the parts' totals. One row per task of pass 1 meets in one task and is broadcast."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return tokens.join(F.broadcast(offsets), "part").withColumn("begin", F.col("offset") + F.col("at")).drop("offset", "at")


def _cut_batches(window: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, start, length, crc, total, seq, offset, piece = ([] for _ in range(8))
            for d, begin, n, width, ids in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                wide = np.frombuffer(ids, "<u2" if width == 2 else "<u4").astype("<u4")
                a = 0
                while a < n:
                    at = (begin + a) % window
                    b = min(n, a + window - at)
                    raw = wide[a:b].tobytes()
                    for out, v in zip((doc, start, length, crc, total, seq, offset),
                                      (d, a, b - a, zlib.crc32(raw), n, (begin + a) // window, at), strict=True):
                        out.append(v)
                    if keep_ids:
                        piece.append(raw)
                    a = b
            columns = [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total, seq, offset)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if keep_ids:
                columns, names = [*columns, pa.array(piece, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece of a document: where it starts in the document, where it lies in which
    sequence, and the crc32 of its ids as little-endian unsigned 32-bit numbers (`ids` too if asked)."""
    placed = with_global_start(encoded(docs, tokenizer, end_id)).select("doc_id", "begin", "doc_tokens", "width", "ids")
    return placed.mapInArrow(_cut_batches(window, keep_ids), _PIECE + (", ids binary" if keep_ids else ""))


def _window_batches(window: int, final: bool):
    """Join neighbouring fragments (seq, offset, ids) into full windows; what stays partial is handed on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, list[tuple[int, bytes]]] = {}
        have: dict[int, int] = {}
        for batch in batches:
            done = []
            for s, o, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                open_.setdefault(s, []).append((o, raw))
                have[s] = have.get(s, 0) + len(raw) // 4
                if have[s] == window:
                    done.append((s, 0, b"".join(r for _, r in sorted(open_.pop(s))), True))
                    del have[s]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), _TYPES, strict=True)], names=_NAMES)
        rest = []
        for s, parts in open_.items():
            if final:
                rest.append((s, 0, b"".join(r for _, r in sorted(parts)), True))
            else:
                rest += [(s, o, r, False) for o, r in parts]
        if rest:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rest, strict=True), _TYPES, strict=True)], names=_NAMES)
    return run


_NAMES, _TYPES = ["sequence_id", "offset", "ids", "whole"], [pa.int64(), pa.int64(), pa.binary(), pa.bool_()]


def sequences(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """sequence_id and its ids (32-bit little-endian), full windows but for the last one."""
    schema = "sequence_id long, offset long, ids binary, whole boolean"
    parts = pieces(docs, tokenizer, window, end_id, keep_ids=True).select("sequence_id", "offset", "ids")
    local = written(parts.mapInArrow(_window_batches(window, final=False), schema), "windows")
    border = local.where("not whole").select("sequence_id", "offset", "ids") \
        .repartition("sequence_id").mapInArrow(_window_batches(window, final=True), schema)
    return local.where("whole").unionByName(border).select("sequence_id", "ids")
