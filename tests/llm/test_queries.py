"""Registered queries: SQL parity where SQL can express them, plan shape, and the pipeline against its parts."""

import math

import pytest

import __spark_entry__ as E
import corpus_pipeline
from inferframe.llm import langid, line_crf, minhash, mixing, packing, queries
from tests._compare import digest, kinds
from tests.conftest import SF_SMALL


def test_one_query_per_operator():
    found = [k for k in E.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in found) == list(range(1, 14))
    assert E.queries().keys() >= {"pipeline", *queries.QUERIES}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "mix", "pack"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_parity(spark, duck, name):
    have, want = queries.QUERIES[name](spark, SF_SMALL).toPandas(), duck.execute(queries.ORACLE[name]).df()
    assert digest(have)[:2] == digest(want)[:2]
    assert kinds(have) == kinds(want)
    assert digest(have)[2] == digest(want)[2]


@pytest.mark.parametrize("name", ["op1_url_reputation", "op8_pareto_mixing", "op9_warc_revisits"])
def test_native_plans_hold_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_pipeline_equals_its_parts(spark):
    docs, labels = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = [r.asDict() for r in docs.collect()]
    judged = {r.doc_id: r.kept for r in line_crf.line_quality(docs, line_crf.train(docs, labels)).collect()}
    rows = [r for r in rows if judged[r["doc_id"]]]
    one = spark.createDataFrame(rows, docs.schema)
    lang = {r.doc_id: r for r in langid.predict(one, langid.train(one)).collect()}
    rows = [r for r in rows if lang[r["doc_id"]].lang_pred != "und" and lang[r["doc_id"]].score >= langid.MIN_SCORE]
    two = spark.createDataFrame(rows, docs.schema)
    kept = {r.doc_id for r in minhash.near_duplicates(two, shingle_words=5, percent=80).collect() if r.kept}
    rows = [r for r in rows if r["doc_id"] in kept]
    three = spark.createDataFrame(rows, docs.schema)
    taken = {r.doc_id: r.taken // r.size if r.size else 0 for r in mixing.mix_sizes(three).collect()}
    tokens = {r.doc_id: r.doc_tokens for r in packing.pieces(three, queries.public_tokenizers.path("word_bpe_49k.json")).collect()}
    total = sum(tokens[d] * n for d, n in taken.items())
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sum(r.length for r in out) == total
    assert {r.doc_id for r in out} == {d for d, n in taken.items() if n}
    assert max(r.sequence_id for r in out) == math.ceil(total / 4096) - 1


def test_stages_return_document_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == 0


def test_pipeline_asks_for_small_batches(spark):
    own = spark.newSession()
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = own.range(2500).selectExpr("id as doc_id", "concat('word ', id, ' and some more') as text", "'en' as lang", "'a' as source", "1L as n_chars")
    for _, stage in corpus_pipeline.STAGES:
        own.conf.unset(name)
        stage(own, docs, SF_SMALL)
        assert stage.__name__ == "mix" or own.conf.get(name) == "1000"
    own.conf.set(name, "7")
    corpus_pipeline.language(own, docs, SF_SMALL)
    assert own.conf.get(name) == "7"
