"""Schemas as data: every keyword, recursion, alternatives, unusable schemas; tools that fail."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from inferframe.operators import schema_rules as SR
from inferframe.operators import validate as V
from inferframe.operators.chat import run_tools
from inferframe.session import shared_dir

RULES = {
    "flat": {"type": "object", "properties": {"n": {"type": "integer", "minimum": 1}, "s": {"type": ["string", "null"]},
                                              "p": {"type": "string", "pattern": "^a"}}, "additionalProperties": False},
    "tree": {"$defs": {"node": {"type": "object", "required": ["v"], "properties": {
        "v": {"type": "integer"}, "kids": {"type": "array", "items": {"$ref": "#/$defs/node"}}}}}, "$ref": "#/$defs/node"},
    "any": {"anyOf": [{"type": "string"}, {"type": "object", "required": ["x"], "properties": {
        "x": {"anyOf": [{"type": "integer"}, {"type": "null"}, {"type": "array", "items": {"type": "string"}}]}}}]},
    "lists": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"anyOf": [{"const": 1}, {"enum": ["a", None, True]}]}},
    "all": {"allOf": [{"type": "number", "exclusiveMinimum": 0}, {"maximum": 10, "exclusiveMaximum": 9.5}]},
    "text": {"type": "string", "minLength": 2, "maxLength": 3},
    "open": {}, "yes": True, "no": False,
    "unknown": {"uniqueItems": True, "properties": {"a": {"format": "date"}}},
    "deepref": {"properties": {"a": {"$ref": "#/nowhere"}, "b": {"$ref": "other.json"}, "c": {"$ref": "#/properties/c"}}},
    "beside": {"$defs": {"t": {"type": "string"}}, "$ref": "#/$defs/t", "maxLength": 1},
    "objects": {"enum": [{"a": 1}]},
}


def deep(n, leaf):
    return leaf if not n else '{"v":1,"kids":[%s]}' % deep(n - 1, leaf)


CASES = [
    ("flat", '{"n":-5,"s":12,"p":"zzz","extra":1}', ["extra:extra", "pattern:p", "range:n", "type:s"]),
    ("flat", '{"n":1,"s":null,"p":"ab"}', []), ("flat", '{"n":1.0}', ["type:n"]), ("flat", '{"n":null}', []), ("flat", "[]", ["not_object"]),
    ("flat", "nope", ["invalid_json"]), ("flat", None, ["invalid_json"]),
    ("tree", deep(25, '{"v":2}'), []), ("tree", deep(25, '{"v":"x"}'), ["type:" + "kids[]." * 25 + "v"]),
    ("tree", deep(2, '{"kids":[1,1]}'), ["missing:kids[].kids[].v", "type:kids[].kids[].kids[]"]),
    ("any", '"x"', []), ("any", "5", ["any:value"]), ("any", '{"x":null}', []), ("any", '{"x":"s"}', ["any:value"]),
    ("any", '{"x":["a",1]}', ["any:value"]), ("any", '{"x":["a"]}', []), ("any", "{}", ["any:value"]),
    ("lists", "[]", ["items:value"]), ("lists", '[1,"a",null]', []), ("lists", "[1,2,true,false]", ["any:[]", "items:value"]),
    ("all", "9.5", ["range:value"]), ("all", "9", []), ("all", "0", ["range:value"]), ("all", '"9"', ["type:value"]),
    ("text", '"a"', ["length:value"]), ("text", '"abcd"', ["length:value"]), ("text", '"abc"', []),
    ("open", "[1]", []), ("yes", "1", []), ("no", "1", ["type:value"]),
    ("unknown", '{"a":"x"}', ["unsupported:format:a", "unsupported:uniqueItems:value"]), ("unknown", "[]", ["unsupported:uniqueItems:value"]),
    ("deepref", '{"a":1,"b":1,"c":1}', ["unsupported:$ref:a", "unsupported:$ref:b", "unsupported:$ref:c"]), ("deepref", "{}", []),
    ("beside", '"a"', []), ("beside", '"ab"', ["length:value"]), ("beside", "1", ["type:value"]),
    ("objects", '{"a":1}', ["unsupported:enum:value"]),
    ("text_only", "{}", ["unsupported:schema:value"]), ("twice", "{}", ["ambiguous_schema"]), ("repeated", "{}", []),
    ("missing", "{}", ["unknown_schema"]), (None, "{}", ["unknown_schema"]),
]


def registry(spark):
    rows = [(k, json.dumps(v)) for k, v in RULES.items()]
    rows += [("text_only", "no json"), ("twice", "{}"), ("twice", '{"type":"string"}'), ("repeated", "{}"), ("repeated", "{}"), (None, "{}")]
    return spark.createDataFrame(rows, "name string, params_schema string")


def test_every_keyword_and_case(spark):
    calls = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(CASES)], "id long, tool_name string, arguments string")
    calls = calls.withColumn("schema", F.lit("x")).withColumn("row", F.lit(1)).withColumn("v", F.lit("y"))  # clashing names
    got = {r.id: (r.arg_errors, r.args_valid) for r in SR.check_args(calls.repartition(3), registry(spark)).collect()}
    assert [(c, got[i]) for i, c in enumerate(CASES) if got[i] != (c[2], not c[2])] == []


def test_calls_of_one_split_are_walked_by_many_tasks(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(SR, "shared_dir", lambda s, name: kept.setdefault(name, shared_dir(s, name)) if name == "schema-calls" else shared_dir(s, name))
    calls = spark.range(64).select(F.lit("open").alias("tool_name"), F.lit("{}").alias("arguments")).coalesce(1)
    assert SR.check_args(calls, registry(spark)).filter("args_valid").count() == 64
    held = spark.read.parquet(kept["schema-calls"]).groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(held) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in held) <= 32


def test_repeated_calls_keep_their_rows_and_empty_tables_work(spark):
    calls = spark.createDataFrame([("open", "{}")] * 3 + [("text", "1")] * 2, "tool_name string, arguments string")
    got = sorted((r.tool_name, r.args_valid) for r in SR.check_args(calls, registry(spark)).collect())
    assert got == [("open", True)] * 3 + [("text", False)] * 2
    assert SR.check_args(calls.limit(0), registry(spark)).collect() == []
    assert [r.arg_errors for r in SR.check_args(calls, registry(spark).limit(0)).collect()] == [["unknown_schema"]] * 5


def test_agrees_with_the_expression_form(spark):
    """VAL3's two forms give the same verdicts (the deep one sorts its errors)."""
    spec = {"type": "object", "required": ["a", "b"], "properties": {
        "a": {"type": "array", "items": {"type": "object", "required": ["k"], "properties": {"k": {"enum": ["x", 1]}}}},
        "b": {"type": "string", "maxLength": 2}, "c": {"anyOf": [{"type": "null"}, {"type": "integer", "maximum": 3}]}}}
    texts = ['{"a":[{"k":"x"},{"k":1},{"k":2},{}],"b":"abc"}', '{"a":[],"b":"a","c":4}', '{"a":[],"b":null,"c":null}', "[]", "x",
             '{"a":{},"b":1}', '{"a":[{"k":1}],"b":"ab","c":3}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    one = {r.id: sorted(r.errors) for r in V.check_json_schema(df, "t", spec).collect()}
    two = {r.id: r.errors for r in V.check_json_schema_deep(df, "t", spec).collect()}
    assert one == two and any(two.values()) and not all(two.values())


def test_recursive_schema_by_the_deep_form(spark):
    df = spark.createDataFrame([(deep(12, '{"v":0}'),), (deep(12, '{"v":false}'),)], "t string")
    got = V.check_json_schema_deep(df, "t", RULES["tree"]).collect()
    assert sorted(r.valid for r in got) == [False, True]


def test_tool_names_in_errors(spark):
    calls = spark.createDataFrame([("missing", "{}"), ("twice", "{}")], "tool_name string, arguments string")
    got = {r.tool_name: r.arg_errors for r in V.check_tool_args(calls, registry(spark)).collect()}
    assert got == {"missing": ["unknown_tool"], "twice": ["ambiguous_tool"]}


# ---------------------------------------------------------------- UDF2

def _good(args: pd.DataFrame) -> pd.Series:
    return args["x"] * 2


def _picky(args: pd.DataFrame) -> pd.Series:
    if (args["x"] == 3).any():
        raise ValueError("no threes")
    return args["x"]


def _short(args: pd.DataFrame) -> pd.Series:
    return args["x"].iloc[:1]


@pytest.mark.parametrize("one_by_one", [False, True])
def test_a_failing_tool_fails_its_own_calls(spark, one_by_one):
    rows = [(i, t, json.dumps({"x": i})) for i in range(5) for t in ("good", "picky", "short", "other")]
    df = spark.createDataFrame(rows, "id int, tool_name string, arguments string").coalesce(1)
    got = {(r.tool_name, r.id): (r.tool_result, r.tool_error) for r in run_tools(
        df, {"good": _good, "picky": _picky, "short": _short}, {"x": "int"}, one_by_one=one_by_one).collect()}
    assert len(got) == 15 and all(got["good", i] == (str(2 * i), None) for i in range(5))
    for i in range(5):
        if one_by_one:
            assert got["picky", i] == ((None, "ValueError: no threes") if i == 3 else (str(i), None))
            assert got["short", i] == (str(i), None)
        else:
            assert got["picky", i] == (None, "ValueError: no threes")
            assert got["short", i] == (None, "ValueError: 1 results for 5 calls")
