"""The corpus pipeline: documents in, packed training sequences out.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns the rows the
next stage works on. All but the last return the columns of `documents`. Each stage fits what it
needs (labels, languages, thresholds) on its own input. Between stages the rows are written as
Parquet to the cluster's shared folder and reread, so a lost executor never costs a finished stage.
The stages with Python workers ask for small Arrow batches where the session names no size, so that
an executor's memory doesn't follow the length of texts times 10,000 rows.

1. quality: lines are labelled by a linear-chain CRF; documents failing the base rules or with too
   small a share of content words go.
2. language: documents without a recognised language go.
3. near duplicates: one document of each class of 5-word-shingle similarity >= 0.8 stays.
4. mixing: rows are taken 0, 1 or 2 times so that sources meet their target shares.
5. packing: pieces of 4096-token sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from inferframe.llm import langid, line_crf, minhash, mixing, packing
from inferframe.llm.shared import small_batches, table, written

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return line_crf.keep_quality(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return langid.keep_languages(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return minhash.drop_near_duplicates(docs, shingle_words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pieces(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: trained stages and a tokenizer: not expressible in SQL, tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's result over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
