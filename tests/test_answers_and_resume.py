"""RSP9's schema compiler, AG8's reasons, UDF1 that resumes."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inferframe.operators import ops as OP
from inferframe.operators import struct_schema as ST
from inferframe.operators.invoke import TransportError, invoke_resumable, read_log
from inferframe.operators.validate import check_json_schema
from inferframe.session import shared_dir

SCHEMA = {
    "type": "object", "required": ["name", "parts"], "$defs": {"part": {"type": "object", "properties": {
        "size": {"type": "integer"}, "weight": {"type": ["number", "null"]}}}},
    "properties": {
        "name": {"type": "string"}, "kind": {"enum": ["a", "b", None]}, "on": {"type": "boolean"}, "level": {"const": 3},
        "parts": {"type": "array", "items": {"$ref": "#/$defs/part"}}, "grid": {"type": "array", "items": {"type": "array", "items": {"type": "number"}}},
        "note": {"anyOf": [{"type": "string"}, {"type": "null"}]}, "mixed": {"type": ["string", "integer"]}, "extra": {"type": "object"},
        "either": {"anyOf": [{"type": "integer"}, {"type": "string"}]}, "any": {}},
}


def test_types_of_a_schema():
    assert ST.struct_type(SCHEMA).simpleString() == (
        "struct<name:string,kind:string,on:boolean,level:bigint,parts:array<struct<size:bigint,weight:double>>,grid:array<array<double>>,"
        "note:string,mixed:variant,extra:map<string,variant>,either:variant,any:variant>")
    tree = {"$defs": {"n": {"type": "object", "properties": {"v": {"type": "integer"}, "kids": {"type": "array", "items": {"$ref": "#/$defs/n"}}}}},
            "$ref": "#/$defs/n"}
    assert ST.struct_type(tree).simpleString() == "struct<v:bigint,kids:array<variant>>"
    assert ST.struct_type({"enum": [1, 2.5]}).simpleString() == "double" and ST.struct_type({"enum": [True, "a"]}).simpleString() == "variant"


def test_schema_of_a_type_and_back(spark):
    kind = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.ArrayType(T.StringType(), False)),
                         T.StructField("c", T.StructType([T.StructField("d", T.DoubleType(), False)]), False)])
    schema = ST.json_schema(kind)
    assert schema["required"] == ["a", "c"] and schema["properties"]["b"] == {"type": ["array", "null"], "items": {"type": "string"}}
    assert ST.struct_type(schema).simpleString() == kind.simpleString()
    rows = [('{"a":1,"b":["x"],"c":{"d":1.5}}',), ('{"a":1,"b":null,"c":{"d":2}}',), ('{"a":1}',), ('{"a":1,"c":{"d":1},"x":0}',)]
    got = check_json_schema(spark.createDataFrame(rows, "t string"), "t", schema).collect()
    assert [r.valid for r in got] == [True, True, False, False]
    with pytest.raises(ValueError):
        ST.json_schema(T.BinaryType())


def test_a_filter_on_the_answer_does_not_read_it_again(spark):
    """The texts come as one split and go to all cores; the plan holds one parse, not one for every use of the value."""
    texts = spark.range(40).coalesce(1).select("id", F.concat(F.lit('{"name":"n'), F.col("id").cast("string"), F.lit('","parts":[]}')).alias("t"))
    df = ST.parse_answer(texts, "t", SCHEMA).filter("parsed is not null").select("id", "parsed.name", F.size("parsed.parts").alias("n"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().replace("_", "").count("parsejson") == 1
    assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted((r.id, r.name, r.n) for r in df.collect()) == [(i, f"n{i}", 0) for i in range(40)]


def test_answers_into_a_nested_struct(spark):
    full = {"name": "x", "kind": "a", "on": True, "level": 3, "parts": [{"size": 1, "weight": 2}, {"size": 2, "weight": None}, {}],
            "grid": [[1, 2.5], []], "note": None, "mixed": 7, "extra": {"k": [1]}, "either": "e", "any": {"z": 1}}
    rows = [(0, json.dumps(full)), (1, '{"name":"y","parts":[]}'), (2, '{"name":"y"}'), (3, "no json"), (4, None), (5, '{"name":1,"parts":[{"size":"1"}]}')]
    df = ST.parse_answer(spark.createDataFrame(rows, "id int, t string"), "t", SCHEMA)
    got = {r.id: r for r in df.collect()}
    p = got[0].parsed
    assert (p.name, p.kind, p.on, p.level, p.note) == ("x", "a", True, 3, None)
    assert [tuple(x) for x in p.parts] == [(1, 2.0), (2, None), (None, None)] and p.grid == [[1.0, 2.5], []]
    assert got[1].parsed.parts == [] and got[1].parsed.grid is None
    assert [got[i].parsed for i in (2, 3, 4, 5)] == [None] * 4
    assert got[2].errors == ["missing:parts"] and got[3].errors == ["invalid_json"] and sorted(got[5].errors) == ["type:name", "type:parts[].size"]
    kept = df.filter("id = 0").select(F.to_json(F.struct("parsed.mixed", "parsed.extra", "parsed.either", "parsed.any"))).first()[0]
    assert json.loads(kept) == {"mixed": 7, "extra": {"k": [1]}, "either": "e", "any": {"z": 1}}


def test_reasons_of_failures(spark):
    rows = [("a", ["type:x", "type:y", "missing:z"]), ("a", ["type:x"]), ("a", ["type:y", "type:y"]), ("a", []), ("a", None), ("b", ["invalid_json"]),
            ("c", [])]
    got = OP.constraint_errors(spark.createDataFrame(rows, "kind string, errors array<string>")).collect()
    assert sorted((r.kind, r.reason, r.n, r.share, r.most_at) for r in got) == [
        ("a", "missing", 1, 0.2, "z"), ("a", "type", 3, 0.6, "x"), ("b", "invalid_json", 1, 1.0, "")]
    assert OP.constraint_errors(spark.createDataFrame([], "kind string, errors array<string>")).collect() == []


# ---------------------------------------------------------------- UDF1

class Paid:
    """Counts calls by appending to one file per request; request 13 brings its executor down while `trap` exists."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, kind, body):
        with open(f"{self.folder}/{body}", "a") as f:
            f.write("x")
        if body == "13" and os.path.exists(f"{self.folder}/trap"):
            raise KeyboardInterrupt  # not an answer and not an error of the call: the task dies
        if body == "7":
            raise TransportError("no route")
        return (500, "bad") if body == "9" else (200, f"re:{body}")


def paid(folder):
    return {f: os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f != "trap"}


def test_a_second_run_sends_what_the_log_does_not_answer(spark, tmp_path):
    folder = str(tmp_path)
    req = spark.createDataFrame([(i, "chat", str(i)) for i in range(40)] + [(3, "chat", "3"), (None, "chat", "99")],
                                "request_id long, kind string, body string")
    log = shared_dir(spark, "t-answers")
    open(f"{folder}/trap", "w").close()
    with pytest.raises(Exception):
        invoke_resumable(req, lambda: Paid(folder), log, round_size=10, unit=4)
    os.remove(f"{folder}/trap")
    before = paid(folder)
    stored = read_log(spark, log, T.LongType())
    kept = set() if stored is None else {r.request_id for r in stored.filter("status_code is not null").collect()}
    out = {r.request_id: (r.status_code, r.body, r.error) for r in invoke_resumable(req, lambda: Paid(folder), log, round_size=10, unit=4).collect()}
    assert out.keys() == set(range(40)) and out[5] == (200, "re:5", None) and out[9] == (500, "bad", "bad")
    assert out[7] == (None, None, "TransportError: no route")
    after = paid(folder)
    assert "99" not in after and all(after[str(i)] == before[str(i)] for i in kept)  # nothing answered is paid again
    sent = sum(after.values())
    again = {r.request_id: r.status_code for r in invoke_resumable(req, lambda: Paid(folder), log).collect()}
    assert again == {k: v[0] for k, v in out.items()} and sum(paid(folder).values()) == sent + 1  # only the call without a status


def test_rounds_are_a_budget_and_done_is_the_callers(spark, tmp_path):
    folder, log = str(tmp_path), shared_dir(spark, "t-budget")
    req = spark.createDataFrame([(f"r{i}", "chat", str(i)) for i in range(30)], "request_id string, kind string, body string")
    first = invoke_resumable(req, lambda: Paid(folder), log, round_size=10, max_rounds=1).collect()
    assert 0 < len(first) < 30 and sum(paid(folder).values()) == len(first)
    ok = F.col("status_code") == 200
    assert len(invoke_resumable(req, lambda: Paid(folder), log, done=ok).collect()) == 30
    invoke_resumable(req, lambda: Paid(folder), log, done=ok)
    calls = paid(folder)
    assert calls["9"] >= 2 and calls["7"] >= 2 and all(n == 1 for b, n in calls.items() if b not in ("7", "9"))
    none = invoke_resumable(req.limit(0), lambda: Paid(folder), shared_dir(spark, "t-none"))
    assert none.collect() == [] and none.columns == ["request_id", "kind", "status_code", "body", "error"]
