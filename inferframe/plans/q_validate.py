"""Validation queries: VAL1-VAL5, AG8, RSP9 over the D4 candidate answers."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from inferframe import refdata as R
from inferframe.operators import ops as OP
from inferframe.operators import responses as RS
from inferframe.operators import validate as V
from inferframe.operators.struct_schema import parse_answer
from inferframe.operators.validate import check_tool_args
from inferframe.plans.catalog import query
from inferframe.plans.fixtures import SQL_CANDIDATES, SQL_CHOICE, candidates, choice_answers, tbl


def cands(spark, sf, kind):
    return candidates(spark, sf).filter(F.col("kind") == kind)


@query("val_choice", sql=f"""
WITH {SQL_CHOICE} SELECT id, content, content IN ('positive', 'negative') AS valid FROM choice_answers""")
def val_choice(spark, sf):
    """Answer must be exactly one of the allowed choices."""
    c = choice_answers(spark, sf)
    return c.select("id", "content", V.check_choice("content").alias("valid"))


@query("val_regex", sql=f"""
WITH {SQL_CANDIDATES}
SELECT id, regexp_full_match(CASE WHEN suffix(content, chr(10)) THEN substring(content, 1, length(content) - 1)
                                  ELSE content END, '\\w+@\\w+\\.com') AS valid
FROM candidates WHERE kind = 'email'""")
def val_regex(spark, sf):
    """E-mail answers fully match the pattern (stop string cut from text and pattern)."""
    c = cands(spark, sf, "email")
    return c.select("id", V.check_regex("content").alias("valid"))


def _sql_field_err(name, typ, vc="vc"):
    t = f"json_type({vc}, '$.{name}')"
    if typ == "string":
        bad = f"{t} <> 'VARCHAR'"
    else:
        bad = f"{t} NOT IN ('BIGINT', 'UBIGINT')"
    return (f"CASE WHEN {t} IS NULL OR {t} = 'NULL' THEN 'missing:{name}' "
            f"WHEN {bad} THEN 'type:{name}' END")


def _sql_errors(fields, vc="vc", enum=None):
    parts = []
    for name, typ in fields:
        e = _sql_field_err(name, typ, vc)
        if enum and enum[0] == name:
            allowed = ", ".join(f"'{x}'" for x in enum[1])
            e = (f"coalesce({e}, CASE WHEN json_extract_string({vc}, '$.{name}') NOT IN ({allowed}) "
                 f"THEN 'enum:{name}' END)")
        parts.append(e)
    return (f"CASE WHEN {vc} IS NULL THEN 'invalid_json' WHEN json_type({vc}) <> 'OBJECT' THEN 'not_object' "
            f"ELSE concat_ws(';', {', '.join(parts)}) END")


CITY_FIELDS = [("city", "string"), ("population", "integer")]
CAR_FIELDS = [("brand", "string"), ("model", "string"), ("car_type", "string")]
CODE_FIELDS = [("cat", "string"), ("dog", "string"), ("dog_code_number", "integer")]

SQL_JSON_CHECK = f"""
vcand AS (SELECT *, CASE WHEN json_valid(content) THEN content END AS vc FROM candidates),
jcheck AS (
  SELECT id, kind, {_sql_errors(CITY_FIELDS)} AS errors FROM vcand WHERE kind = 'city_json'
  UNION ALL
  SELECT id, kind, {_sql_errors(CAR_FIELDS, enum=('car_type', R.CAR_TYPES))} FROM vcand WHERE kind = 'car_json'
  UNION ALL
  SELECT id, kind, {_sql_errors(CODE_FIELDS)} FROM vcand WHERE kind = 'code_json')"""


SCHEMAS = {"city_json": R.CITY_INFO_SCHEMA, "car_json": R.CAR_DESCRIPTION_SCHEMA, "code_json": R.PYTHON_R_CODE_SCHEMA}


def schema_errors(v, kind="kind"):
    """Errors of each answer under the schema of its kind (NULL for kinds without one)."""
    out = None
    for name, schema in SCHEMAS.items():
        e = V.variant_errors(v, schema)
        out = F.when(F.col(kind) == name, e) if out is None else out.when(F.col(kind) == name, e)
    return out


def json_checked(spark, sf):
    """All schema-bound answers from one scan: parsed once, checked by kind."""
    c = candidates(spark, sf).filter(F.col("kind").isin(*SCHEMAS))
    return (c.withColumn("_v", F.try_parse_json("content")).withColumn("errors", schema_errors(F.col("_v")))
            .withColumn("valid", F.size("errors") == 0).drop("_v"))


@query("val_json_schema", sql=f"""
WITH {SQL_CANDIDATES}, {SQL_JSON_CHECK}
SELECT id, kind, errors = '' AS valid, errors FROM jcheck""")
def val_json_schema(spark, sf):
    """CityInfo / CarDescription / PythonRCode answers: required fields, strict JSON types,
    enum."""
    c = json_checked(spark, sf)
    return c.select("id", "kind", "valid", F.array_join("errors", ";").alias("errors"))


SQL_ARRAY_CHECK = f"""
acand AS (SELECT *, CASE WHEN json_valid(content) THEN content END AS vc FROM candidates WHERE kind = 'city_array'),
items AS (SELECT id, unnest(json_extract(vc, '$[*]')) AS it FROM acand WHERE json_type(vc) = 'ARRAY'),
bad AS (SELECT id, count(*) FILTER (WHERE {_sql_errors(CITY_FIELDS, vc='it')} <> '') AS n_bad FROM items GROUP BY id),
acheck AS (
  SELECT a.id,
         CASE WHEN json_type(vc) = 'ARRAY' THEN json_array_length(vc) WHEN json_type(vc) = 'OBJECT' THEN 1 ELSE 0 END::BIGINT AS n_items,
         CASE WHEN json_type(vc) = 'ARRAY' THEN coalesce(b.n_bad, 0)
              WHEN json_type(vc) = 'OBJECT' THEN CASE WHEN {_sql_errors(CITY_FIELDS)} <> '' THEN 1 ELSE 0 END
              ELSE 0 END::BIGINT AS n_bad_items,
         coalesce(json_type(vc) = 'ARRAY', FALSE) AS is_array
  FROM acand a LEFT JOIN bad b USING (id))"""


@query("val_json_array", sql=f"""
WITH {SQL_CANDIDATES}, {SQL_ARRAY_CHECK}
SELECT id, n_items, n_bad_items, is_array AND n_bad_items = 0 AS valid FROM acheck""")
def val_json_array(spark, sf):
    """Answers asked as 'a JSON array of CityInfo': must be an array, every item valid."""
    c = V.check_json_array(cands(spark, sf, "city_array"), "content", R.CITY_INFO_SCHEMA, "array")
    return c.select("id", "n_items", "n_bad_items", "valid")


GRAMMAR_RE = f"SELECT {R.SQL_IDENTIFIER}(?:,{R.SQL_IDENTIFIER})* FROM {R.SQL_IDENTIFIER}"


@query("val_grammar", sql=f"""
WITH {SQL_CANDIDATES}
SELECT id, v AS valid, CASE WHEN v THEN regexp_extract(content, '^SELECT (.*) FROM ', 1) END AS columns,
       CASE WHEN v THEN regexp_extract(content, ' FROM ({R.SQL_IDENTIFIER})$', 1) END AS "table"
FROM (SELECT *, regexp_full_match(content, '{GRAMMAR_RE}') AS v FROM candidates WHERE kind = 'grammar')""")
def val_grammar(spark, sf):
    """SELECT statements checked against the (regular) grammar; columns and table parsed."""
    c = V.check_select_grammar(cands(spark, sf, "grammar"), "content")
    return c.select("id", "valid", F.array_join("columns", ",").alias("columns"), "table")


@query("ag_pass_rate", sql=f"""
WITH {SQL_CANDIDATES}, {SQL_CHOICE}, {SQL_JSON_CHECK}, {SQL_ARRAY_CHECK},
v AS (
  SELECT 'choice' AS kind, content IN ('positive', 'negative') AS valid FROM choice_answers
  UNION ALL
  SELECT 'email', regexp_full_match(CASE WHEN suffix(content, chr(10)) THEN substring(content, 1, length(content) - 1)
                                         ELSE content END, '\\w+@\\w+\\.com') FROM candidates WHERE kind = 'email'
  UNION ALL SELECT kind, errors = '' FROM jcheck
  UNION ALL SELECT 'city_array', is_array AND n_bad_items = 0 FROM acheck
  UNION ALL SELECT 'grammar', regexp_full_match(content, '{GRAMMAR_RE}') FROM candidates WHERE kind = 'grammar')
SELECT kind, count(*)::BIGINT AS n, sum(valid::INTEGER)::BIGINT AS n_valid,
       sum(valid::INTEGER)::BIGINT / count(*) AS pass_rate
FROM v GROUP BY kind""")
def ag_pass_rate(spark, sf):
    """Share of answers meeting their constraint, per constraint kind: one scan of the answers,
    the check picked by kind."""
    kind, v = F.col("kind"), F.col("_v")
    valid = (F.when(kind == "email", V.check_regex("content"))
             .when(kind == "grammar", V.full_match("content", GRAMMAR_RE))
             .when(kind == "city_array", V.array_check(v, R.CITY_INFO_SCHEMA, "array")[2])
             .otherwise(F.size(schema_errors(v)) == 0))
    parsed = F.when(~kind.isin("email", "grammar"), F.try_parse_json("content"))
    c = candidates(spark, sf).withColumn("_v", parsed).select("kind", valid.alias("valid"))
    return OP.constraint_pass_rate(val_choice(spark, sf).select(F.lit("choice").alias("kind"), "valid").unionByName(c))


NESTED_SCHEMA = {
    "type": "object",
    "$defs": {"CarType": {"type": "string", "enum": R.CAR_TYPES},
              "Part": {"type": "object", "required": ["size"],
                       "properties": {"size": {"type": "integer", "maximum": 25}, "tags": {"type": "array", "items": {"type": "string"}}}}},
    "properties": {"car_type": {"$ref": "#/$defs/CarType"}, "part": {"$ref": "#/$defs/Part"},
                   "note": {"anyOf": [{"type": "string"}, {"type": "null"}]}},
    "required": ["car_type", "part"],
}


@query("val_json_nested", sql=f"""
WITH p AS (
  SELECT p_partkey AS id, p_size, ({['sedan', 'SUV', 'Truck', 'Coupe', 'van']})[(p_size % 5 + 1)::INTEGER] AS car FROM part)
SELECT id, concat_ws(';',
    CASE WHEN p_size % 5 = 0 AND p_size % 7 = 0 THEN 'type:car_type' WHEN car NOT IN ({', '.join(f"'{c}'" for c in R.CAR_TYPES)}) THEN 'enum:car_type' END,
    CASE WHEN p_size % 6 = 0 THEN 'missing:part.size' WHEN p_size > 25 THEN 'range:part.size' END,
    CASE WHEN p_size % 4 = 0 THEN 'type:part.tags[]' END,
    CASE WHEN p_size % 3 = 0 THEN 'any:note' END) AS errors
FROM p""")
def val_json_nested(spark, sf):
    """A schema with references, nested objects, lists and unions."""
    p = tbl(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_size")
    n = F.col("p_size")
    car = F.element_at(F.array(*[F.lit(x) for x in ("sedan", "SUV", "Truck", "Coupe", "van")]), (n % 5 + 1).cast("int"))
    car = F.when((n % 5 == 0) & (n % 7 == 0), F.lit("7")).otherwise(F.concat(F.lit('"'), car, F.lit('"')))
    size = F.when(n % 6 == 0, F.lit("")).otherwise(F.concat(F.lit('"size":'), n.cast("string"), F.lit(",")))
    tags = F.when(n % 4 == 0, F.lit('["a",1]')).otherwise(F.lit('["a","b"]'))
    note = F.when(n % 3 == 0, F.lit("5")).when(n % 3 == 1, F.lit("null")).otherwise(F.lit('"x"'))
    body = F.concat(F.lit('{"car_type":'), car, F.lit(',"part":{'), size, F.lit('"tags":'), tags, F.lit('},"note":'), note, F.lit("}"))
    c = V.check_json_schema(p.withColumn("content", body), "content", NESTED_SCHEMA)
    return c.select("id", F.array_join("errors", ";").alias("errors"))


@query("rsp_struct", sql=f"""
WITH {SQL_CANDIDATES}, {SQL_JSON_CHECK}
SELECT j.id, json_extract_string(c.content, '$.city') AS city,
       json_extract(c.content, '$.population')::BIGINT AS population
FROM jcheck j JOIN candidates c ON c.id = j.id AND c.kind = j.kind
WHERE j.kind = 'city_json' AND j.errors = ''""")
def rsp_struct(spark, sf):
    """Validated CityInfo answers parsed into a typed struct (city, population)."""
    c = V.check_json_schema(cands(spark, sf, "city_json"), "content", R.CITY_INFO_SCHEMA)
    p = RS.parse_struct(c, "content", {"city": "string", "population": "bigint"})
    return p.filter("valid").select("id", F.col("parsed.city").alias("city"),
                                    F.col("parsed.population").alias("population"))


#: stand-in tools: one with nested rules, one whose schema refers to itself
RULED_TOOLS = [
    ("order", {
        "type": "object", "required": ["n", "p"], "additionalProperties": False,
        "properties": {
            "n": {"type": "integer", "minimum": 1, "maximum": 40},
            "s": {"type": ["string", "null"], "maxLength": 13},
            "p": {"type": "string", "pattern": "^Brand#[1-3]"},
            "dim": {"$ref": "#/$defs/size"},
            "tags": {"type": "array", "maxItems": 2, "items": {"enum": ["STANDARD", "SMALL", "BRUSHED", "TIN", "COPPER"]}}},
        "$defs": {"size": {"type": "object", "required": ["w", "h"], "additionalProperties": False,
                           "properties": {"w": {"type": "number", "exclusiveMinimum": 3}, "h": {"type": "number"}}}}}),
    ("tree", {"$ref": "#/$defs/node", "$defs": {"node": {
        "type": "object", "required": ["value"],
        "properties": {"value": {"anyOf": [{"type": "integer"}, {"type": "null"}]},
                       "children": {"type": "array", "items": {"$ref": "#/$defs/node"}}}}}}),
]

SQL_RULED_CALLS = """
calls AS (
  SELECT p_partkey AS id, p_partkey % 3 AS leaf, (p_size % 6)::INTEGER AS depth,
    CASE WHEN p_partkey % 4 = 3 THEN 'tree' ELSE 'order' END AS tool_name,
    CASE WHEN p_partkey % 4 = 3 THEN
      repeat('{"value":1,"children":[', (p_size % 6)::INTEGER)
      || CASE p_partkey % 3 WHEN 0 THEN '{"value":"x"}' WHEN 1 THEN '{"value":null}' ELSE '{"children":[]}' END
      || repeat(']}', (p_size % 6)::INTEGER)
    ELSE
      '{"n":' || (p_size - 5) || CASE WHEN p_partkey % 8 = 0 THEN '.5' ELSE '' END || ',"p":"' || p_brand || '"'
      || CASE p_partkey % 3 WHEN 0 THEN ',"s":12' WHEN 1 THEN ',"s":null' ELSE ',"s":"' || p_name || p_size || '"' END
      || CASE WHEN p_partkey % 5 = 0 THEN ',"extra":1' ELSE '' END
      || ',"dim":{"w":' || (p_size % 9) || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE ',"h":1.5' END
      || CASE WHEN p_partkey % 11 = 0 THEN ',"d":0' ELSE '' END || '}'
      || ',"tags":["' || replace(CASE WHEN p_size % 2 = 0 THEN p_type ELSE split_part(p_type, ' ', 1) END, ' ', '","') || '"]}'
    END AS arguments
  FROM part)"""


def ruled_calls(spark, sf):
    """Arguments for ``RULED_TOOLS`` from the columns of ``part``, many of them against a rule."""
    k, z = F.col("p_partkey"), F.col("p_size")
    depth = (z % 6).cast("int")
    tree = F.concat(F.repeat(F.lit('{"value":1,"children":['), depth),
                    F.when(k % 3 == 0, '{"value":"x"}').when(k % 3 == 1, '{"value":null}').otherwise('{"children":[]}'),
                    F.repeat(F.lit("]}"), depth))
    order = F.concat(
        F.lit('{"n":'), (z - 5).cast("string"), F.when(k % 8 == 0, ".5").otherwise(""), F.lit(',"p":"'), "p_brand", F.lit('"'),
        F.when(k % 3 == 0, ',"s":12').when(k % 3 == 1, ',"s":null').otherwise(F.concat(F.lit(',"s":"'), "p_name", z.cast("string"), F.lit('"'))),
        F.when(k % 5 == 0, ',"extra":1').otherwise(""), F.lit(',"dim":{"w":'), (z % 9).cast("string"),
        F.when(k % 7 == 0, "").otherwise(',"h":1.5'), F.when(k % 11 == 0, ',"d":0').otherwise(""), F.lit("}"),
        F.lit(',"tags":["'), F.replace(F.when(z % 2 == 0, F.col("p_type")).otherwise(F.split_part("p_type", F.lit(" "), F.lit(1))),
                                       F.lit(" "), F.lit('","')), F.lit('"]}'))
    tool = F.when(k % 4 == 3, "tree").otherwise("order")
    return tbl(spark, sf, "part").select(k.alias("id"), tool.alias("tool_name"), F.when(tool == "tree", tree).otherwise(order).alias("arguments"))


@query("val_tool_args_full", sql=f"""
WITH {SQL_RULED_CALLS},
o AS (
  SELECT id, arguments AS a, json_extract_string(arguments, '$.s') AS s, json_extract_string(arguments, '$.p') AS p,
    json_type(arguments, '$.n') AS nt, (arguments->>'$.n')::DOUBLE AS n, json_type(arguments, '$.s') AS st,
    (arguments->>'$.tags[*]') AS tags, (arguments->>'$.dim.w')::DOUBLE AS w
  FROM calls WHERE tool_name = 'order'),
e AS (
  SELECT id, [
    CASE WHEN nt NOT IN ('BIGINT', 'UBIGINT') THEN 'type:n' WHEN n < 1 OR n > 40 THEN 'range:n' END,
    CASE WHEN st NOT IN ('VARCHAR', 'NULL') THEN 'type:s' WHEN st = 'VARCHAR' AND length(s) > 13 THEN 'length:s' END,
    CASE WHEN NOT regexp_matches(p, '^Brand#[1-3]') THEN 'pattern:p' END,
    CASE WHEN json_exists(a, '$.extra') THEN 'extra:extra' END,
    CASE WHEN w <= 3 THEN 'range:dim.w' END, CASE WHEN NOT json_exists(a, '$.dim.h') THEN 'missing:dim.h' END,
    CASE WHEN json_exists(a, '$.dim.d') THEN 'extra:dim.d' END,
    CASE WHEN len(tags) > 2 THEN 'items:tags' END,
    CASE WHEN len(list_filter(tags, lambda x: x NOT IN ('STANDARD', 'SMALL', 'BRUSHED', 'TIN', 'COPPER'))) > 0 THEN 'enum:tags[]' END] AS errs
  FROM o
  UNION ALL
  SELECT id, [CASE leaf WHEN 0 THEN 'any:' || repeat('children[].', depth) || 'value'
                        WHEN 2 THEN 'missing:' || repeat('children[].', depth) || 'value' END]
  FROM calls WHERE tool_name = 'tree')
SELECT id, tool_name, array_to_string(list_sort(list_filter(errs, lambda x: x IS NOT NULL)), ';') AS errors,
  len(list_filter(errs, lambda x: x IS NOT NULL)) = 0 AS args_valid
FROM e JOIN calls USING (id)""")
def val_tool_args_full(spark, sf):
    """Arguments against whole tool schemas: bounds, type lists, patterns, closed objects, nested objects and arrays,
    references and a schema that refers to itself."""
    registry = spark.createDataFrame([(n, json.dumps(s)) for n, s in RULED_TOOLS], "name string, params_schema string")
    c = check_tool_args(ruled_calls(spark, sf), registry)
    return c.select("id", "tool_name", F.array_join("arg_errors", ";").alias("errors"), "args_valid")


#: stand-in: the arguments of the first tool as an answer to be read into a nested type
ORDER_ANSWER = {
    "type": "object", "required": ["n", "dim"], "$defs": RULED_TOOLS[0][1]["$defs"],
    "properties": {"n": {"type": ["integer", "number"]}, "s": {"anyOf": [{"type": "string"}, {"type": "null"}]}, "p": {"type": "string"},
                   "dim": {"$ref": "#/$defs/size"}, "tags": {"type": "array", "items": {"type": "string"}}},
}


@query("rsp_struct_nested", sql=f"""
WITH {SQL_RULED_CALLS}
SELECT id, (arguments->>'$.n')::DOUBLE AS n, coalesce(arguments->>'$.s', '') AS s, arguments->>'$.p' AS p,
  (arguments->>'$.dim.w')::DOUBLE AS w, (arguments->>'$.dim.h')::DOUBLE AS h,
  array_to_string(arguments->>'$.tags[*]', '|') AS tags
FROM calls WHERE tool_name = 'order' AND id % 3 <> 0 AND id % 7 <> 0 AND id % 11 <> 0 AND (arguments->>'$.dim.w')::DOUBLE > 3""")
def rsp_struct_nested(spark, sf):
    """Valid answers read into a nested struct (objects, a list, a union with null) compiled from their JSON Schema."""
    a = parse_answer(ruled_calls(spark, sf).filter("tool_name = 'order'"), "arguments", ORDER_ANSWER)
    p = F.col("parsed")
    return a.filter("parsed is not null").select(
        "id", p["n"].alias("n"), F.coalesce(p["s"], F.lit("")).alias("s"), p["p"].alias("p"), p["dim"]["w"].alias("w"),
        p["dim"]["h"].alias("h"), F.array_join(p["tags"], "|").alias("tags"))


@query("ag_error_reasons", sql=f"""
WITH {SQL_CANDIDATES}, {SQL_JSON_CHECK},
e AS (SELECT kind, id, unnest(string_split(errors, ';')) AS e FROM jcheck WHERE errors <> ''),
p AS (SELECT kind, id, split_part(e, ':', 1) AS reason, CASE WHEN contains(e, ':') THEN substr(e, instr(e, ':') + 1) ELSE '' END AS place FROM e),
c AS (SELECT kind, reason, count(DISTINCT id)::BIGINT AS n FROM p GROUP BY 1, 2),
t AS (SELECT kind, reason, place, row_number() OVER (PARTITION BY kind, reason ORDER BY count(DISTINCT id) DESC, place) AS rn FROM p GROUP BY 1, 2, 3),
a AS (SELECT kind, count(*) AS n_all FROM jcheck GROUP BY 1)
SELECT kind, reason, n, n / n_all AS share, place AS most_at FROM c JOIN t USING (kind, reason) JOIN a USING (kind) WHERE rn = 1""")
def ag_error_reasons(spark, sf):
    """Why structured answers fail: count, share and commonest place of each reason, per kind."""
    c = candidates(spark, sf).filter(~F.col("kind").isin("email", "grammar", "city_array")).withColumn("_v", F.try_parse_json("content"))
    return OP.constraint_errors(c.select("kind", schema_errors(F.col("_v")).alias("errors")))
