"""Structured-output checks (VAL1-VAL7), run after the fact on returned text.

JSON typing is strict: field types come from ``schema_of_variant`` of the parsed VARIANT
(``"12"`` is a STRING, ``12.0`` a DECIMAL, ``true`` a BOOLEAN; only an integral number
without a fraction is an integer). Explicit JSON null counts as missing; extra keys are
allowed. Errors are reported as ``kind:field`` strings in schema order.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inferframe import refdata as R
from inferframe.operators.schema_rules import KNOWN as _CHECKED, NOTES as _NOTES, check_args

_INT_TYPES = ["BIGINT", "INT", "SMALLINT", "TINYINT"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def check_choice(col, choices=R.CHOICES) -> Column:
    """VAL1: exact membership (no trim, case-sensitive)."""
    return F.coalesce(_c(col).isin(list(choices)), F.lit(False))


def strip_stop(col, stop: str | None) -> Column:
    """Remove one trailing stop string (servers cut the stop sequence from the output)."""
    c = _c(col)
    if not stop:
        return c
    return F.when(F.endswith(c, F.lit(stop)),
                  F.substring(c, F.lit(1), F.length(c) - F.lit(len(stop)))).otherwise(c)


def full_match(col, pattern: str) -> Column:
    """Whole-string regex match (``\\A(?:p)\\z``; ``^...$`` would accept a trailing newline)."""
    return F.coalesce(_c(col).rlike(r"\A(?:" + pattern + r")\z"), F.lit(False))


def check_regex(col, pattern: str = R.EMAIL_REGEX, stop: str | None = R.EMAIL_STOP) -> Column:
    """VAL2: the text (trailing stop removed) fully matches the pattern (trailing stop
    removed from the pattern too)."""
    p = pattern
    if stop:
        esc = stop.replace("\n", r"\n")
        if p.endswith(esc):
            p = p[: -len(esc)]
    return full_match(strip_stop(col, stop), p)


def _resolved(spec: dict, root: dict) -> dict:
    """spec with its ``$ref`` (into the same document) replaced by what it names."""
    seen = 0
    while "$ref" in spec:
        ref = spec["$ref"]
        if not ref.startswith("#/"):
            raise ValueError(f"only references into the schema itself are supported: {ref}")
        target = root
        for part in ref[2:].split("/"):
            target = target[part.replace("~1", "/").replace("~0", "~")]
        spec = {**target, **{k: v for k, v in spec.items() if k != "$ref"}}
        seen += 1
        if seen > 32:
            raise ValueError("circular reference")
    return spec


def _has_type(t: Column, want: str) -> Column:
    number = t.isin(_INT_TYPES) | t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT")
    kinds = {"string": t == "STRING", "integer": t.isin(_INT_TYPES), "number": number, "boolean": t == "BOOLEAN",
             "object": t.startswith("OBJECT"), "array": t.startswith("ARRAY"), "null": t == "VOID"}
    if want not in kinds:
        raise ValueError(f"unknown JSON type: {want}")
    return kinds[want]


def _errors(v: Column, spec: dict, root: dict, path: str, depth: int = 0) -> Column:
    """``array<string>`` of errors of the VARIANT ``v`` under ``spec``; ``path`` names it in them. A
    keyword this check doesn't know raises: it never passes silently."""
    if depth > 16:
        raise ValueError("schema nested deeper than 16 levels")
    spec = _resolved(spec, root)
    unknown = set(spec) - _CHECKED - _NOTES
    if unknown:
        raise ValueError(f"unsupported schema keywords: {sorted(unknown)}")
    t = F.schema_of_variant(v)
    none = F.array().cast("array<string>")
    name = path or "value"

    def bad(kind: str, wrong: Column) -> Column:
        return F.when(F.coalesce(wrong, F.lit(False)), F.array(F.lit(f"{kind}:{name}"))).otherwise(none)

    parts: list[Column] = []
    if "enum" in spec or "const" in spec:
        allowed = spec.get("enum", [spec.get("const")])
        text = [x for x in allowed if isinstance(x, str)]
        rest = [x for x in allowed if not isinstance(x, str)]
        ok = (t == "STRING") & F.coalesce(F.try_variant_get(v, "$", "string").isin(text), F.lit(False)) if text else F.lit(False)
        for x in rest:
            if x is None:
                ok = ok | (t == "VOID")
            elif isinstance(x, bool):
                ok = ok | F.coalesce((t == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == x), F.lit(False))
            else:
                ok = ok | F.coalesce(_has_type(t, "number") & (F.try_variant_get(v, "$", "double") == float(x)), F.lit(False))
        parts.append(bad("enum", ~ok))
    if "anyOf" in spec:
        fits = [F.size(_errors(v, s, root, path, depth + 1)) == 0 for s in spec["anyOf"]]
        ok = fits[0]
        for f in fits[1:]:
            ok = ok | f
        parts.append(bad("any", ~ok))
    for s in spec.get("allOf", []):
        parts.append(_errors(v, s, root, path, depth + 1))
    text, num = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
    if "pattern" in spec:
        parts.append(bad("pattern", (t == "STRING") & ~text.rlike(spec["pattern"])))
    for word, wrong in (("minLength", lambda x: F.length(text) < x), ("maxLength", lambda x: F.length(text) > x)):
        if word in spec:
            parts.append(bad("length", (t == "STRING") & wrong(spec[word])))
    for word, wrong in (("minimum", lambda x: num < x), ("maximum", lambda x: num > x),
                        ("exclusiveMinimum", lambda x: num <= x), ("exclusiveMaximum", lambda x: num >= x)):
        if word in spec:
            parts.append(bad("range", _has_type(t, "number") & wrong(float(spec[word]))))
    if "properties" in spec or "required" in spec:
        props, required = spec.get("properties", {}), list(spec.get("required", []))
        fields = []
        for f in [*props, *(r for r in required if r not in props)]:
            where = f"{path}.{f}" if path else f
            inner = F.variant_get(v, f'$["{f}"]', "variant")
            absent = F.schema_of_variant(inner).isNull() | (F.schema_of_variant(inner) == "VOID")
            nullable = "null" in _types(_resolved(props.get(f, {}), root)) or "anyOf" in _resolved(props.get(f, {}), root)
            if f in required:
                gone = F.array(F.lit(f"missing:{where}"))
            else:
                gone = none
            if nullable:  # an explicit null is a value here
                absent = F.schema_of_variant(inner).isNull()
            fields.append(F.when(absent, gone).otherwise(_errors(inner, props.get(f, {}), root, where, depth + 1)))
        if spec.get("additionalProperties") is False:
            extra = F.array_except(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), F.array(*[F.lit(p) for p in props]))
            fields.append(F.transform(F.coalesce(extra, none), lambda k: F.concat(F.lit("extra:" + (path + "." if path else "")), k)))
        if fields:
            parts.append(F.when(t.startswith("OBJECT"), F.flatten(F.array(*fields))).otherwise(none))
    if "items" in spec or "minItems" in spec or "maxItems" in spec:
        elements = F.try_variant_get(v, "$", "array<variant>")
        if "items" in spec:
            each = F.flatten(F.transform(elements, lambda x: _errors(x, spec["items"], root, f"{path}[]", depth + 1)))
            parts.append(F.when(t.startswith("ARRAY"), F.coalesce(F.array_distinct(each), none)).otherwise(none))
        for word, wrong in (("minItems", lambda x: F.size(elements) < x), ("maxItems", lambda x: F.size(elements) > x)):
            if word in spec:
                parts.append(bad("items", t.startswith("ARRAY") & wrong(spec[word])))
    rest = F.flatten(F.array(*parts)) if parts else none
    types = _types(spec)
    if not types:
        return rest
    ok = _has_type(t, types[0])
    for w in types[1:]:
        ok = ok | _has_type(t, w)
    return F.when(~F.coalesce(ok, F.lit(False)), F.array(F.lit(f"type:{name}"))).otherwise(rest)


def _types(spec: dict) -> list[str]:
    want = spec.get("type", [])
    return [want] if isinstance(want, str) else list(want)


def variant_errors(v: Column, schema: dict) -> Column:
    """VAL3 over a parsed VARIANT column: ``array<string>`` of errors (empty = valid)."""
    schema = _resolved(schema, schema)
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    checked = _errors(v, schema, schema, "")
    if _types(schema) == ["object"]:
        checked = F.when(~is_obj, F.array(F.lit("not_object"))).otherwise(checked)
    return F.when(v.isNull(), F.array(F.lit("invalid_json"))).otherwise(checked)


def json_schema_errors(col, schema: dict) -> Column:
    """VAL3: ``array<string>`` of errors (empty = valid): ``invalid_json``, ``not_object``,
    ``missing:f``, ``type:f``, ``enum:f`` and, for nested values, the same with paths (``a.b``,
    ``a[]``). ``$ref``/``$defs``, nested objects, arrays, unions and bounds are checked; a keyword
    outside the supported set raises when the plan is built."""
    return variant_errors(F.try_parse_json(_c(col)), schema)


def check_json_schema(df: DataFrame, col: str, schema: dict, prefix: str = "") -> DataFrame:
    """VAL3 as columns ``errors`` and ``valid``; the text is parsed once."""
    parsed = df.withColumn("_v", F.try_parse_json(F.col(col)))
    return (parsed.withColumn(f"{prefix}errors", variant_errors(F.col("_v"), schema))
                  .withColumn(f"{prefix}valid", F.size(F.col(f"{prefix}errors")) == 0).drop("_v"))


def array_check(v: Column, item_schema: dict, accept: str = "array") -> tuple[Column, Column, Column]:
    """VAL4 over a parsed VARIANT: (n_items, n_bad_items, valid)."""
    kind = F.schema_of_variant(v)
    is_arr = F.coalesce(kind.startswith("ARRAY"), F.lit(False))
    is_obj = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    items = F.try_variant_get(v, "$", "array<variant>")
    bad_items = F.size(F.filter(items, lambda it: F.size(variant_errors(it, item_schema)) > 0))
    n_items = F.when(is_arr, F.size(items)).when(is_obj, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    lone = F.when(F.size(variant_errors(v, item_schema)) > 0, F.lit(1)).otherwise(F.lit(0))
    n_bad = F.when(is_arr, bad_items).when(is_obj, lone).otherwise(F.lit(0)).cast("bigint")
    shape_ok = {"array": is_arr, "object": is_obj, "both": is_arr | is_obj}[accept]
    return n_items, n_bad, shape_ok & (n_bad == 0)


def check_json_array(df: DataFrame, col: str, item_schema: dict, accept: str = "array"
                     ) -> DataFrame:
    """VAL4: the answer must be a JSON array whose every element passes the item schema
    (``accept='array'``), or a single object (``accept='object'``), or either
    (``accept='both'``). Output ``n_items``, ``n_bad_items``, ``valid``."""
    n_items, n_bad, valid = array_check(F.col("_v"), item_schema, accept)
    return (df.withColumn("_v", F.try_parse_json(F.col(col)))
              .withColumn("n_items", n_items).withColumn("n_bad_items", n_bad)
              .withColumn("valid", valid).drop("_v"))


def check_select_grammar(df: DataFrame, col: str) -> DataFrame:
    """VAL5: the (regular) grammar ``SELECT c(,c)* FROM t`` with identifiers
    ``[a-zA-Z_][a-zA-Z0-9_]*``, single blanks exactly as in the grammar, no blank after a
    comma. Also extracts ``columns`` and ``table`` of valid statements."""
    ident = R.SQL_IDENTIFIER
    pat = f"SELECT {ident}(?:,{ident})* FROM {ident}"
    ok = full_match(col, pat)
    cols = F.regexp_extract(F.col(col), r"\ASELECT (.*) FROM ", 1)
    table = F.regexp_extract(F.col(col), r" FROM (" + ident + r")\z", 1)
    return (df.withColumn("valid", ok)
              .withColumn("columns", F.when(ok, F.split(cols, ",")))
              .withColumn("table", F.when(ok, table)))


def check_tool_args(calls: DataFrame, registry: DataFrame, name_col: str = "tool_name",
                    args_col: str = "arguments") -> DataFrame:
    """VAL6: arguments checked against the schema of the named tool, every keyword VAL3 knows included, at any depth:
    ``arg_errors`` (sorted) and ``args_valid``. Schemas are data (``schema_rules``). What is not known of a schema
    is ``unsupported:...``, two different schemas of one name ``ambiguous_tool``: never passed."""
    checked = check_args(calls, registry, schema_col=name_col, json_col=args_col)
    return checked.withColumn("arg_errors", F.transform("arg_errors", lambda e: F.when(e == "unknown_schema", "unknown_tool")
                                                        .when(e == "ambiguous_schema", "ambiguous_tool").otherwise(e)))


def check_json_schema_deep(df: DataFrame, col: str, schema: dict, prefix: str = "") -> DataFrame:
    """VAL3 for schemas of any depth, recursive references included: columns ``errors`` (sorted) and ``valid``. Works level
    by level over stored tables (``schema_rules``); ``check_json_schema`` is one expression for schemas that end."""
    registry = df.sparkSession.createDataFrame([("schema", json.dumps(schema))], "name string, params_schema string")
    return check_args(df.withColumn("__schema", F.lit("schema")), registry, schema_col="__schema", json_col=col,
                      errors=f"{prefix}errors", valid=f"{prefix}valid").drop("__schema")


def check_layout(df: DataFrame) -> DataFrame:
    """VAL7: category in the fixed list, bbox of 4 numbers, Picture without text,
    x1 <= x2 and y1 <= y2."""
    b = F.col("bbox")
    four = F.coalesce(F.size(b) == 4, F.lit(False))
    cat_ok = F.coalesce(F.col("category").isin(R.LAYOUT_CATEGORIES), F.lit(False))
    pic_ok = ~((F.col("category") == "Picture") & F.col("text").isNotNull())
    order_ok = F.when(four, (b[0] <= b[2]) & (b[1] <= b[3])).otherwise(F.lit(False))
    return (df.withColumn("cat_ok", cat_ok).withColumn("bbox_ok", four)
              .withColumn("picture_ok", F.coalesce(pic_ok, F.lit(True)))
              .withColumn("order_ok", F.coalesce(order_ok, F.lit(False)))
              .withColumn("valid", F.col("cat_ok") & F.col("bbox_ok") & F.col("picture_ok")
                          & F.col("order_ok")))
