"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and turned into code points; every 1-, 2- and 3-gram is hashed into
`BUCKETS` buckets. Training counts buckets per language; the smoothed log-probability matrix
(BUCKETS x languages) is shipped with the scoring closure and applied to Arrow batches with numpy
gathers and segment sums, so each text costs one pass.

Training set: documents with a non-null language whose crc32(doc_id as text) mod `FOLDS` is not
`HELD`. Its size per language is counted first; a language with more than `MAX_DOCS` documents
is thinned by a hash of doc_id to about that many (documented bound of the fit; scoring covers
every text). Counts are summed by Spark; the driver receives the matrix, whose size depends only on
BUCKETS and on the number of languages, which must not exceed `MAX_LANGS` (more raises an error).

`score` is the posterior probability of the predicted language. Equal scores go to the first
language by code point.

Defined results: `und` with score 0 where the text is null, has no letter, or nothing was learned.
lang, source and doc_id never enter a prediction. A null doc_id is neither held out nor used for
training. Repeated rows get equal answers. An empty table gives an empty result; extra columns
are ignored by `predict` and kept by `keep_languages`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from inferframe.llm import textcore as T
from inferframe.llm.shared import crc_mod, ship

FOLDS, HELD = 3, 1
BUCKETS = 1 << 15
MAX_DOCS = 4000
MAX_LANGS = 400
SMOOTH = 0.5
MIN_SCORE = 0.5
PIECE = 1 << 18
_SALT = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def grams(points: np.ndarray) -> list[np.ndarray]:
    """Bucket numbers of the 1-, 2- and 3-grams of one piece of text (code points)."""
    c = points.astype(np.uint32)
    c = c * np.uint32(0x85EBCA6B) + np.uint32(0xC2B2AE35)
    out, h = [], np.zeros(len(c), np.uint32)
    for n, salt in enumerate(_SALT):
        h = (h[:len(c) - n] if n else h)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F) + c[n:] + np.uint32(salt & 0xFFFFFFFF)
        x = h ^ (h >> np.uint32(13))
        x = x * np.uint32(0x9E3779B1)
        out.append((x >> np.uint32(17)).astype(np.int32))  # the top 15 bits: BUCKETS buckets
    return out


def pieces(text: str) -> Iterator[np.ndarray]:
    """Code points of the lower-cased text, in pieces that overlap by two (long texts stay bounded)."""
    low = text.lower()
    for i in range(0, max(1, len(low) - 2), PIECE):
        yield np.frombuffer(low[i:i + PIECE + 2].encode("utf-32-le", "surrogatepass"), np.uint32)


def _pieces_without_overlap(text: str) -> Iterator[list[np.ndarray]]:
    """Bucket arrays of each piece; the overlap's shorter grams are counted once."""
    parts = list(pieces(text)) if len(text) <= PIECE else pieces(text)
    held = None
    for p in parts:
        if held is not None:
            yield _cut(held)
        held = p
    if held is not None:
        yield grams(held)


def _cut(points: np.ndarray) -> list[np.ndarray]:
    g = grams(points)
    return [g[0][:PIECE], g[1][:PIECE], g[2]]


def text_counts(text: str) -> np.ndarray:
    """Bucket counts of one text."""
    out = np.zeros(BUCKETS, np.int64)
    for parts in _pieces_without_overlap(text):
        for g in parts:
            out += np.bincount(g, minlength=BUCKETS)
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if letters(text):
                acc = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for parts in _pieces_without_overlap(text):
                    for g in parts:
                        np.add.at(acc, g, 1) if len(g) < 512 else np.add(acc, np.bincount(g, minlength=BUCKETS), out=acc)
    for lang, acc in total.items():
        some = np.flatnonzero(acc)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)),
                                          pa.array(acc[some])], names=["lang", "bucket", "n"])


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-probabilities (BUCKETS, languages), log priors) from docs (doc_id, text, lang)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text")) \
        .where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", FOLDS) != HELD))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not sizes:
        return [], np.zeros((BUCKETS, 0)), np.zeros(0)
    rate = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, max_docs / n))])
    draw = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(draw < rate[F.col("lang")]).select("lang", "text")
    found = sample.mapInArrow(_count_batches, "lang string, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sizes)
    counts = np.zeros((BUCKETS, len(langs)))
    counts[found["bucket"].to_numpy(np.int64), [langs.index(x) for x in found["lang"]]] = found["n"]
    learned = [i for i in range(len(langs)) if counts[:, i].sum() > 0]
    langs, counts = [langs[i] for i in learned], counts[:, learned] + SMOOTH
    size = np.array([sizes[x] for x in langs], float)
    return langs, np.log(counts / counts.sum(0)), np.log(size / size.sum()) if langs else size


def _predict_batches(langs: list[str], matrix: np.ndarray, prior: np.ndarray):
    table = np.ascontiguousarray(matrix, np.float32)

    def score(text: str | None) -> tuple[str, float]:
        if not langs or not letters(text):
            return "und", 0.0
        total = prior.copy()
        for parts in _pieces_without_overlap(text):
            joined = np.concatenate(parts)
            if len(joined) > BUCKETS // 2:
                total += np.bincount(joined, minlength=BUCKETS) @ table
            else:
                total += table[joined].sum(0, dtype=np.float64)
        best = int(total.argmax())
        return langs[best], float(1 / np.exp(total - total[best]).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            for i in range(0, len(column), 512):
                found = [score(x) for x in column.slice(i, 512).to_pylist()]
                rest = [c.slice(i, 512) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                    names=[*batch.schema.names[1:], "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs."""
    ship(docs.sparkSession)
    found = docs.select(F.col("text").cast("string"), F.col("doc_id").cast("long")) \
        .mapInArrow(_predict_batches(*model), "doc_id long, lang_pred string, score double")
    held = F.coalesce(crc_mod("doc_id", FOLDS) == HELD, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def keep_languages(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of docs whose language is recognised with at least `min_score`, columns unchanged."""
    ship(docs.sparkSession)
    hidden = [ST.StructField(f"__c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    made = ST._parse_datatype_string("lang_pred string, score double")
    found = docs.select(F.col("text").cast("string").alias("__text"),
                        *(docs[f"`{c}`"].alias(h.name) for c, h in zip(docs.columns, hidden, strict=True))) \
        .mapInArrow(_predict_batches(*model), ST.StructType([*hidden, *made.fields]))
    good = (F.col("lang_pred") != "und") & (F.col("score") >= min_score)
    return found.where(good).select(*(F.col(h.name).alias(c) for c, h in zip(docs.columns, hidden, strict=True)))
