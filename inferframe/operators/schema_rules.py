"""JSON Schema as data: schemas become a table of rules, answers a table of values, and the two are joined level by level.

``compile_schemas`` turns a registry (name, JSON Schema text) into one row per schema node. ``schema_errors``
starts with a row per answer at its schema's root; each level joins the current values with the rules of their nodes and
explodes them into their errors and the values one level below with the nodes they have to meet. A level with no
values left ends the walk, so any depth and recursive references work, and the plan's size does not depend on the
schemas. Nothing is collected; a registry of any size costs a join per level (a broadcast, while it is small).

Every keyword that VAL3 knows is checked. A keyword that is not known gives ``unsupported:<keyword>:<path>`` wherever a value
meets it, a registry text that is no usable schema ``unsupported:schema:value``: neither ever passes.

Error texts: ``invalid_json``, ``unknown_schema``, ``ambiguous_schema`` (two different texts under one name), ``not_object``
(the root, where only an object is allowed), else ``<kind>:<path>`` with kinds ``type enum any pattern length range
items missing extra unsupported`` and paths like ``a.b`` and ``a[]`` (``value`` is the root). As in VAL3 an explicit null of a
property counts as absent unless the property allows null.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inferframe.operators.sizing import broadcast_if_small, spread
from inferframe.session import shared_dir

NOTES = {"title", "description", "default", "examples", "$schema", "$id", "$defs", "definitions", "$comment"}
KNOWN = {"type", "properties", "required", "enum", "const", "items", "$ref", "anyOf", "allOf", "additionalProperties", "minimum", "maximum",
         "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "minItems", "maxItems", "pattern"}
TYPES = {"string", "integer", "number", "boolean", "object", "array", "null"}

RULE = ("schema string, node int, types array<string>, allowed array<struct<kind: string, text: string, number: double>>, pattern string, "
        "min_length bigint, max_length bigint, low double, high double, above double, below double, min_items bigint, max_items bigint, "
        "required array<string>, properties map<string, struct<node: int, nullable: boolean>>, closed boolean, items int, "
        "all_of array<int>, any_of array<int>, unsupported array<string>")
_VALUE = "node int, path string, at string, v variant, alternatives array<struct<at: string, branch: int, branches: int>>"


# ---------------------------------------------------------------- schemas to rules

class _Unusable(Exception):
    pass


def _pointer(root, ref: str):
    if not isinstance(ref, str) or ref != "#" and not ref.startswith("#/"):
        raise _Unusable("$ref")  # only references into the schema itself
    at = root
    for part in ref[2:].split("/") if ref != "#" else ():
        part = part.replace("~1", "/").replace("~0", "~")
        try:
            at = at[int(part)] if isinstance(at, list) else at[part]
        except (KeyError, IndexError, ValueError, TypeError):
            raise _Unusable("$ref") from None
    return at


def _literal(x) -> dict:
    if x is None or isinstance(x, bool):
        return {"kind": "null" if x is None else "boolean", "text": None if x is None else str(x).lower(), "number": None}
    if isinstance(x, (int, float)):
        return {"kind": "number", "text": None, "number": float(x)}
    if isinstance(x, str):
        return {"kind": "string", "text": x, "number": None}
    raise _Unusable("enum")  # objects and lists are not compared


def compile_schema(text: str) -> list[dict]:
    """One dict per schema node, node 0 the root. A reference is its target's node, so recursion ends."""
    try:
        root = json.loads(text)
    except (TypeError, ValueError):
        root = None
    if not isinstance(root, (dict, bool)):
        return [{"node": 0, "unsupported": ["schema"]}]
    number, nodes, known = count(), [], {}

    def types(spec) -> list[str]:
        want = spec.get("type", []) if isinstance(spec, dict) else []
        return [want] if isinstance(want, str) else list(want)

    def target(spec):
        for _ in range(64):
            if not (isinstance(spec, dict) and "$ref" in spec):
                return spec
            spec = _pointer(root, spec["$ref"])
        raise _Unusable("$ref")  # a reference that only names itself

    def nullable(spec) -> bool:
        try:
            spec = target(spec)
        except _Unusable:  # said where a value meets it
            return True
        return isinstance(spec, dict) and ("null" in types(spec) or "anyOf" in spec)

    def node(spec) -> int:
        if isinstance(spec, dict) and "$ref" in spec and not set(spec) - NOTES - {"$ref"}:
            try:
                spec = target(spec)  # nothing beside the reference: its target's node
            except _Unusable:
                pass
        if id(spec) in known:
            return known[id(spec)]
        mine = {"node": next(number), "unsupported": []}
        known[id(spec)] = mine["node"]
        nodes.append(mine)
        keep.append(spec)
        try:
            fill(spec, mine)
        except _Unusable as e:
            mine["unsupported"].append(str(e))
        except (TypeError, ValueError, AttributeError):
            mine["unsupported"].append("schema")
        return mine["node"]

    keep: list = []  # ids stay unique while the objects live

    def fill(spec, mine: dict) -> None:
        if spec is True:
            return
        if spec is False:
            mine["types"] = []  # no type is allowed
            return
        if not isinstance(spec, dict):
            raise _Unusable("schema")
        mine["unsupported"] += sorted(set(spec) - KNOWN - NOTES)
        want = types(spec)
        if set(want) - TYPES:
            raise _Unusable("type")
        mine["types"] = want if "type" in spec else None
        if "enum" in spec or "const" in spec:
            mine["allowed"] = [_literal(x) for x in spec.get("enum", [spec.get("const")])]
        mine["pattern"] = spec.get("pattern")
        for name, word, kind in (("min_length", "minLength", int), ("max_length", "maxLength", int), ("low", "minimum", float),
                                 ("high", "maximum", float), ("above", "exclusiveMinimum", float), ("below", "exclusiveMaximum", float),
                                 ("min_items", "minItems", int), ("max_items", "maxItems", int)):
            mine[name] = kind(spec[word]) if word in spec else None
        mine["required"] = [str(r) for r in spec.get("required", [])]
        mine["properties"] = {k: {"node": node(s), "nullable": nullable(s)} for k, s in spec.get("properties", {}).items()}
        more = spec.get("additionalProperties", True)
        mine["closed"] = more is False
        if not isinstance(more, bool):
            mine["unsupported"].append("additionalProperties")
        mine["items"] = node(spec["items"]) if "items" in spec else None
        parts = [_pointer(root, spec["$ref"])] if "$ref" in spec else []
        if "$ref" in spec:
            target(spec)
        mine["all_of"] = [node(s) for s in [*parts, *spec.get("allOf", [])]]
        mine["any_of"] = [node(s) for s in spec.get("anyOf", [])]

    node(root)
    return nodes


def compile_schemas(registry: DataFrame, name: str = "name", schema: str = "params_schema") -> DataFrame:
    """The registry (name, schema text) as rules, one row per schema node. Different texts under one name
    are an ambiguous schema that no answer passes; a repeated row counts once."""
    one = registry.filter(F.col(name).isNotNull()).groupBy(F.col(name).cast("string").alias("schema")).agg(
        F.min(schema).alias("text"), (F.countDistinct(F.coalesce(schema, F.lit(""))) > 1).alias("many"))
    names = [f.split()[0] for f in ("schema,node,types,allowed,pattern,min_length,max_length,low,high,above,below,min_items,max_items,"
                                    "required,properties,closed,items,all_of,any_of,unsupported").split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for who, text, many in zip(pdf["schema"], pdf["text"], pdf["many"]):
                found = [{"node": 0, "unsupported": ["ambiguous"]}] if many else compile_schema(text)
                rows += [{"schema": who, **{k: x.get(k) for k in names[1:]}} for x in found]
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return one.mapInPandas(run, RULE)


# ---------------------------------------------------------------- values against rules

_INTEGERS = ("BIGINT", "INT", "SMALLINT", "TINYINT")


def _kind(v: Column) -> Column:
    """JSON type of a VARIANT: an integral number without a fraction is an integer."""
    t = F.schema_of_variant(v)
    return (F.when(t == "STRING", "string").when(t.isin(*_INTEGERS), "integer").when(t == "BOOLEAN", "boolean")
            .when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array").when(t == "VOID", "null")
            .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "number"))


def _local_errors() -> Column:
    """Errors of a value at its own node (columns of a value row joined with its rule)."""
    v, kind, name = F.col("v"), F.col("kind"), F.when(F.col("path") == "", "value").otherwise(F.col("path"))
    text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
    is_text, is_number = kind == "string", kind.isin("integer", "number")
    of_type = F.array_contains("types", kind) | (kind.eqNullSafe(F.lit("integer")) & F.array_contains("types", F.lit("number")))
    same = F.exists("allowed", lambda a: F.when(is_number, (a["kind"] == "number") & (a["number"] == number)).otherwise(
        (a["kind"] == kind) & a["text"].eqNullSafe(F.when(kind.isin("string", "boolean"), text))))
    members, keys, size = F.col("members"), F.map_keys("members"), F.size("elements")
    within = F.when(F.col("path") == "", "").otherwise(F.concat("path", F.lit(".")))
    absent = F.filter("required", lambda r: ~F.array_contains(keys, r) | (
        (F.schema_of_variant(F.try_element_at(members, r)) == "VOID") & ~F.coalesce(F.try_element_at("properties", r)["nullable"], F.lit(False))))
    extra = F.array_except(keys, F.map_keys("properties"))

    def bad(what: str, wrong: Column) -> Column:
        return F.when(F.coalesce(wrong, F.lit(False)), F.concat(F.lit(f"{what}:"), name))

    wrong_type = F.col("types").isNotNull() & ~F.coalesce(of_type, F.lit(False))
    root_object = (F.col("path") == "") & (F.size("types") == 1) & (F.col("types")[0] == "object")
    checks = F.array(
        bad("enum", F.col("allowed").isNotNull() & ~F.coalesce(same, F.lit(False))),
        bad("pattern", is_text & ~F.regexp_like(text, F.col("pattern"))),
        bad("length", is_text & (F.length(text) < F.col("min_length"))),
        bad("length", is_text & (F.length(text) > F.col("max_length"))),
        bad("range", is_number & (number < F.col("low"))), bad("range", is_number & (number > F.col("high"))),
        bad("range", is_number & (number <= F.col("above"))), bad("range", is_number & (number >= F.col("below"))),
        bad("items", (kind == "array") & (size < F.col("min_items"))), bad("items", (kind == "array") & (size > F.col("max_items"))))
    members_bad = F.when(kind == "object", F.concat(
        F.coalesce(F.transform(absent, lambda r: F.concat(F.lit("missing:"), within, r)), F.array()),
        F.when(F.col("closed"), F.transform(extra, lambda k: F.concat(F.lit("extra:"), within, k))).otherwise(F.array().cast("array<string>")))) \
        .otherwise(F.array().cast("array<string>"))
    unsupported = F.transform(F.coalesce("unsupported", F.array()), lambda k: F.when(k == "ambiguous", F.lit("ambiguous_schema"))
                              .otherwise(F.concat(F.lit("unsupported:"), k, F.lit(":"), name)))
    typed = F.when(wrong_type, F.array(F.when(root_object, F.lit("not_object")).otherwise(F.concat(F.lit("type:"), name)))) \
        .otherwise(F.concat(F.filter(checks, lambda e: e.isNotNull()), members_bad))
    return F.concat(unsupported, typed)


def _follow() -> Column:
    """What a row of (row, schema, error, <value>) joined with its rule becomes: an error found before stays, a value
    gives way to its own errors and the values that follow it."""
    of_type = F.array_contains("types", F.col("kind")) | ((F.col("kind") == "integer") & F.array_contains("types", F.lit("number")))
    fits = F.col("types").isNull() | F.coalesce(of_type, F.lit(False))
    none = F.lit(None)

    def row(error=none.cast("string"), node=none.cast("int"), path=F.col("path"), at=F.col("at"), v=none.cast("variant"),
            alternatives=F.col("alternatives")) -> Column:
        return F.struct(error.alias("error"), node.alias("node"), path.alias("path"), at.alias("at"), v.alias("v"), alternatives.alias("alternatives"))

    v, kind = F.col("v"), F.col("kind")
    own = F.concat("at", F.lit("#"), F.col("node").cast("string"))
    all_of = F.transform("all_of", lambda n: row(node=n, v=v))
    any_of = F.transform("any_of", lambda n, i: row(node=n, v=v, alternatives=F.concat("alternatives", F.array(F.struct(
        own.alias("at"), i.alias("branch"), F.size("any_of").alias("branches"))))))
    within = F.when(F.col("path") == "", "").otherwise(F.concat("path", F.lit(".")))
    named = F.filter(F.map_entries("members"), lambda e: F.coalesce(
        F.try_element_at("properties", e["key"])["nullable"] | (F.schema_of_variant(e["value"]) != "VOID"), F.lit(False)))
    members = F.transform(named, lambda e: row(node=F.try_element_at("properties", e["key"])["node"], path=F.concat(within, e["key"]),
                                               at=F.concat("at", F.lit("/"), e["key"]), v=e["value"]))
    elements = F.transform("elements", lambda x, i: row(
        node=F.col("items"), path=F.concat("path", F.lit("[]")), at=F.concat("at", F.lit("/#"), i.cast("string")), v=x))
    empty = F.array().cast(f"array<struct<error: string, {_VALUE}>>")
    follow = F.when(fits, F.concat(
        F.coalesce(all_of, empty), F.coalesce(any_of, empty),
        F.when((kind == "object") & (F.size("properties") > 0), members).when((kind == "array") & F.col("items").isNotNull(), elements)
        .otherwise(empty))).otherwise(empty)
    errors = F.transform(_local_errors(), lambda e: row(error=e))
    return F.when(F.col("error").isNotNull(), F.array(row(error=F.col("error")))).otherwise(F.concat(errors, follow))


def schema_errors(values: DataFrame, rules: DataFrame, levels_per_job: int = 3) -> DataFrame:
    """(row, errors): the sorted, distinct errors of each row of ``values`` (row bigint, schema string, v VARIANT)
    that has any. ``levels_per_job`` levels are planned together, later twice as many; each such step is stored in
    the shared folder."""
    spark = values.sparkSession
    rules = broadcast_if_small(rules)
    none = F.array().cast("array<struct<at: string, branch: int, branches: int>>")
    state = values.select("row", "schema", F.lit(None).cast("string").alias("error"), F.lit(0).alias("node"), F.lit("").alias("path"),
                          F.lit("").alias("at"), "v", none.alias("alternatives"))
    found: DataFrame | None = None
    # built once, used at every level; read once a value, not once a use
    kind, follow = _kind(F.col("v")).alias("kind"), F.explode(_follow()).alias("x")
    parts = [F.try_variant_get("v", "$", t).alias(name) for name, t in (("members", "map<string,variant>"), ("elements", "array<variant>"))]
    while True:
        for _ in range(levels_per_job):
            here = state.join(rules, ["schema", "node"], "left").select("*", kind, *parts)
            state = here.select("row", "schema", follow).select("row", "schema", "x.*")  # one generator a level
        path = shared_dir(spark, "schema-walk")
        state.write.parquet(path)
        stored = spark.read.schema(state.schema).parquet(path)
        errors = stored.filter("error is not null").select("row", "error", "path", "alternatives")
        found = errors if found is None else found.unionByName(errors)
        state = stored.filter("error is null")
        if state.isEmpty():
            break
        levels_per_job = min(2 * levels_per_job, 8)
    return _resolved_alternatives(found).groupBy("row").agg(F.array_sort(F.collect_set("error")).alias("errors"))


def _resolved_alternatives(found: DataFrame) -> DataFrame:
    """Errors below an ``anyOf`` count only if every branch has one; then they are one ``any`` error where the
    ``anyOf`` stands, which may itself be in a branch: the deepest ones go first."""
    spark = found.sparkSession
    while True:
        deepest = found.agg(F.max(F.size("alternatives"))).first()[0] or 0
        if not deepest:
            return found.select("row", "error")
        inner = found.filter(F.size("alternatives") == deepest).withColumn("last", F.element_at("alternatives", -1))
        outer = F.slice("alternatives", 1, deepest - 1)
        failed = inner.groupBy("row", outer.alias("alternatives"), F.col("last.at").alias("at"), F.col("last.branches").alias("branches")).agg(
            F.countDistinct("last.branch").alias("n")).filter("n = branches")
        place = F.regexp_replace(F.regexp_replace(F.regexp_replace("at", r"#\d+$", ""), r"/#\d+", "[]"), "^/", "")
        place = F.regexp_replace(place, "/", ".")
        path = shared_dir(spark, "schema-any")
        step = found.filter(F.size("alternatives") < deepest).unionByName(failed.select(
            "row", F.concat(F.lit("any:"), F.when(place == "", "value").otherwise(place)).alias("error"), place.alias("path"), "alternatives"))
        step.write.parquet(path)
        found = spark.read.schema(step.schema).parquet(path)


def check_args(calls: DataFrame, registry: DataFrame, *, schema_col: str = "tool_name", json_col: str = "arguments",
               name: str = "name", schema: str = "params_schema", errors: str = "arg_errors", valid: str = "args_valid") -> DataFrame:
    """``calls`` with ``errors`` (sorted) and ``valid``: the JSON text against the schema named by ``schema_col``. The calls are stored
    once with a number of their own, by which errors come back to them, so they need no key and each keeps its row. They are dealt
    evenly: what they are checked by weighs more than their bytes."""
    spark = calls.sparkSession
    path = shared_dir(spark, "schema-calls")
    numbered = spread(calls).withColumn("__row", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    calls = spark.read.schema(numbered.schema).parquet(path)
    rule_path = shared_dir(spark, "schema-rules")
    compile_schemas(registry, name, schema).write.parquet(rule_path)
    rules = spark.read.schema(RULE).parquet(rule_path)
    given = calls.select(F.col("__row").alias("row"), F.col(schema_col).cast("string").alias("schema"), F.try_parse_json(json_col).alias("v"))
    roots = rules.filter("node = 0").select("schema", F.lit(True).alias("known"))
    judged = given.join(broadcast_if_small(roots), "schema", "left")
    own = judged.select("row", F.when(F.col("known").isNull(), "unknown_schema").when(F.col("v").isNull(), "invalid_json").alias("own"))
    walked = schema_errors(judged.filter("known and v is not null").select("row", "schema", "v"), rules)
    both = own.join(walked, "row", "left").select(
        F.col("row").alias("__row"), F.when(F.col("own").isNotNull(), F.array("own")).otherwise(F.coalesce("errors", F.array())).alias(errors))
    return calls.join(both, "__row").drop("__row").withColumn(valid, F.size(errors) == 0)
