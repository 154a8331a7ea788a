"""JSON Schema <-> Spark types, and answers read into them in one typed read (RSP9).

``struct_type`` compiles a schema: objects with properties become structs, arrays arrays, objects without properties
maps of VARIANT, ``integer`` BIGINT, ``number`` DOUBLE, enums the type of their values. A union with null is the
other type (every Spark field is nullable). What has no single Spark type (unions of several types, no type, a reference
back to a schema that is still open) stays a VARIANT, so no value is lost or bent. ``json_schema`` is the way back, for
requests that carry the schema of the wanted answer (PRJ6, PRJ7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inferframe.operators.sizing import settled, spread
from inferframe.operators.validate import _resolved, _types, variant_errors

_SIMPLE = {"string": T.StringType(), "integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}


def struct_type(schema: dict) -> T.DataType:
    """The Spark type of a JSON Schema's values."""
    return _compiled(schema, schema, ())


def _compiled(spec, root: dict, open_: tuple[str, ...]) -> T.DataType:
    if not isinstance(spec, dict):
        return T.VariantType()
    ref = spec.get("$ref")
    if ref in open_:
        return T.VariantType()
    inner = (*open_, ref) if ref else open_
    spec = _resolved(spec, root)
    if "enum" in spec or "const" in spec:
        return _of_values(spec.get("enum", [spec.get("const")]))
    if "anyOf" in spec:
        others = [s for s in spec["anyOf"] if _types(_resolved(s, root)) != ["null"]]
        kinds = {str(k): k for k in (_compiled(s, root, inner) for s in others)}
        return next(iter(kinds.values())) if len(kinds) == 1 else T.VariantType()
    if len(spec.get("allOf", [])) == 1 and not _types(spec):
        return _compiled(spec["allOf"][0], root, inner)
    kinds = [t for t in _types(spec) if t != "null"]
    if not kinds and spec.get("properties"):
        kinds = ["object"]
    if set(kinds) == {"integer", "number"}:
        kinds = ["number"]
    if len(kinds) != 1:
        return T.VariantType()
    if kinds[0] == "array":
        return T.ArrayType(_compiled(spec.get("items"), root, inner))
    if kinds[0] == "object":
        fields = spec.get("properties")
        if not fields:
            return T.MapType(T.StringType(), T.VariantType())
        return T.StructType([T.StructField(name, _compiled(s, root, inner)) for name, s in fields.items()])
    return _SIMPLE.get(kinds[0], T.VariantType())


def _of_values(values: list) -> T.DataType:
    some = [x for x in values if x is not None]
    for kind, spark in ((bool, T.BooleanType()), (str, T.StringType()), (int, T.LongType()), ((int, float), T.DoubleType())):
        if some and all(isinstance(x, kind) and (kind is bool or not isinstance(x, bool)) for x in some):
            return spark
    return T.VariantType()


def json_schema(kind: T.DataType, nullable: bool = False) -> dict:
    """The JSON Schema of a Spark type: fields that can't be null are required, others may be null; structs are closed."""
    if isinstance(kind, T.StructType):
        out = {"type": "object", "properties": {f.name: json_schema(f.dataType, f.nullable) for f in kind.fields},
               "required": [f.name for f in kind.fields if not f.nullable], "additionalProperties": False}
    elif isinstance(kind, T.ArrayType):
        out = {"type": "array", "items": json_schema(kind.elementType, kind.containsNull)}
    elif isinstance(kind, T.MapType):
        out = {"type": "object"}
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        out = {"type": "integer"}
    elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        out = {"type": "number"}
    elif isinstance(kind, T.BooleanType):
        out = {"type": "boolean"}
    elif isinstance(kind, T.StringType):
        out = {"type": "string"}
    elif isinstance(kind, T.VariantType):
        return {}
    else:
        raise ValueError(f"no JSON form for {kind.simpleString()}")
    if nullable:
        out["type"] = [out["type"], "null"]
    return out


def typed(v: Column, kind: T.DataType) -> Column:
    """A VARIANT that passed its schema as a value of ``kind``; explicit nulls and absent fields are NULL."""
    return F.try_variant_get(v, "$", kind.simpleString()) if not isinstance(kind, T.VariantType) else v


def parse_answer(df: DataFrame, col: str, schema: dict, out: str = "parsed", errors: str = "errors") -> DataFrame:
    """RSP9: ``df`` with the errors of the JSON text under ``schema`` (VAL3) and ``out``, the answer as a typed value of
    ``struct_type(schema)``; NULL where there are errors. The text is parsed once and read once, whatever filters follow, by
    as many tasks as run at once."""
    parsed = settled(spread(df), "__v", F.try_parse_json(F.col(col)))
    checked = settled(parsed, errors, variant_errors(F.col("__v"), schema))
    return settled(checked, out, F.when(F.size(errors) == 0, typed(F.col("__v"), struct_type(schema)))).drop("__v")
