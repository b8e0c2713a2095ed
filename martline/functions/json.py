"""JSON helpers on VARIANT values (Spark 4): shape detection, path walking,
schema inference as a distributed aggregate, and flattening to dotted names.

* ``flatten``          nested structs -> ``a.b.c`` columns; arrays stay arrays (F-J1).
* ``infer_schema``     ``schema_of_variant_agg`` over a variant column: one
                       aggregate job, one small row back (the schema text).
* ``walk_path``        dotted-path drill that stops at the last step that
                       exists (F-J3).
* ``rows_of``          document -> record variants: array -> its elements,
                       object -> itself, ``{"records": [...]}`` unwrap,
                       dict-of-dicts (orient='index') -> entries; scalars raise.
* ``unnest``           a list column -> one row per element, on request.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ddl(dt: T.DataType) -> str:
    """Type text with every field name quoted (keys may hold blanks, hyphens, dots)."""
    if isinstance(dt, T.StructType):
        return "struct<" + ", ".join(f"{_q(f.name)}: {ddl(f.dataType)}" for f in dt.fields) + ">"
    if isinstance(dt, T.ArrayType):
        return f"array<{ddl(dt.elementType)}>"
    if isinstance(dt, T.MapType):
        return f"map<{ddl(dt.keyType)}, {ddl(dt.valueType)}>"
    return dt.simpleString()


def path_of(steps: Sequence[str]) -> str:
    """Variant path of some keys."""
    return "$" + "".join('["' + s + '"]' if "'" in s else f"['{s}']" for s in steps)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Expand every struct column into ``parent<sep>child`` columns, recursively."""
    cols: list[Column] = []

    def walk(path: list[str], dt: T.DataType, expr: Column):
        if isinstance(dt, T.StructType):
            for f in dt.fields:
                walk(path + [f.name], f.dataType, expr.getField(f.name))
        else:
            cols.append(expr.alias(sep.join(path)))

    for f in df.schema.fields:
        walk([f.name], f.dataType, F.col(_q(f.name)))
    return df.select(cols)


def _doubles_for_decimals(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.VariantType):
        return T.StringType()  # values of mixed types are kept as text, which can be grouped and compared
    if isinstance(dt, T.DecimalType):
        return T.DoubleType()
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _doubles_for_decimals(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_doubles_for_decimals(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(dt.keyType, _doubles_for_decimals(dt.valueType), True)
    return dt


def variant_type_to_ddl(text: str) -> str:
    """Variant schema text -> DDL type text: OBJECT<...> is STRUCT<...>, VOID (only
    JSON nulls seen) becomes STRING. Backquoted field names are left alone."""
    out, i = [], 0
    for part in re.split(r"(`(?:[^`]|``)*`)", text):
        if part.startswith("`"):
            out.append(part)
        else:
            out.append(re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", part)))
        i += 1
    return "".join(out)


def _to_type(text: str | None, prefer_decimal: bool) -> T.DataType | None:
    if text is None or text.upper() == "VOID":
        return None
    dt = T.DataType.fromDDL(variant_type_to_ddl(text))
    return dt if prefer_decimal else _doubles_for_decimals(dt)


def infer_schemas(df: DataFrame, columns: Sequence[str], prefer_decimal: bool = False) -> dict[str, T.DataType | None]:
    """Merged types of several variant columns in ONE aggregate pass."""
    if not columns:
        return {}
    row = df.agg(*[F.schema_of_variant_agg(F.col(c)).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: _to_type(row[f"s{i}"] if row else None, prefer_decimal) for i, c in enumerate(columns)}


def infer_schema(df: DataFrame, column: str, prefer_decimal: bool = False) -> T.DataType | None:
    """Merged type of all variant values in ``column`` (None when there are none)."""
    return infer_schemas(df, [column], prefer_decimal)[column]


def typed(df: DataFrame, column: str, alias: str, schema: T.DataType | None = None) -> DataFrame:
    """Replace a variant column by a typed one (struct -> later flattened)."""
    schema = schema or infer_schema(df, column)
    if schema is None:
        return df.drop(column)
    return df.withColumn(alias, F.variant_get(F.col(column), "$", ddl(schema))) \
             .drop(*([column] if alias != column else []))


def _is_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def walk_path(v: Column, path: str | None) -> Column:
    """Value at the dotted ``path``; if a step is missing, the value reached so far."""
    if not path:
        return v
    steps = path.split(".")
    candidates = [F.variant_get(v, path_of(steps[:i]), "variant")
                  for i in range(len(steps), 0, -1)]
    return F.coalesce(*candidates, v)


def path_complete(v: Column, path: str | None) -> Column:
    if not path:
        return F.lit(True)
    return F.variant_get(v, path_of(path.split(".")), "variant").isNotNull()


def rows_of(v: Column, orient: str = "records", allow_scalar: bool = False) -> Column:
    """Array<variant> of the records a document holds (explode it next)."""
    as_array = F.try_variant_get(v, "$", "array<variant>")
    records = F.try_variant_get(v, "$.records", "array<variant>")
    entries = F.try_variant_get(v, "$", "map<string,variant>")
    obj = _is_object(v)
    by_index = F.transform(F.map_entries(entries),
                           lambda e: F.to_variant_object(F.struct(e["key"].alias("index"), e["value"].alias("value"))))
    scalar = F.array(v) if allow_scalar else F.raise_error(F.lit("Unsupported JSON structure: top-level scalar")).cast("array<variant>")
    expr = F.when(as_array.isNotNull(), as_array)
    if orient == "records":
        expr = expr.when(obj & records.isNotNull(), records)
    if orient == "index":
        expr = expr.when(obj & F.forall(F.map_values(entries), lambda x: _is_object(x)), by_index)
    return expr.when(obj, F.array(v)).otherwise(scalar)


def records_to_frame(df: DataFrame, record: str = "__rec", keep: Sequence[str] = (),
                     schema: T.DataType | None = None) -> DataFrame:
    """Record variants -> typed, flattened columns (objects) or one ``value`` column (scalars)."""
    schema = schema or infer_schema(df, record)
    if schema is None:
        return df.select(*keep).limit(0) if keep else df.sparkSession.createDataFrame([], T.StructType([]))
    if isinstance(schema, T.StructType):
        out = df.select(*keep, F.variant_get(F.col(record), "$", ddl(schema)).alias("__obj"))
        return flatten(out.select(*keep, "__obj.*"))
    return df.select(*keep, F.variant_get(F.col(record), "$", ddl(schema)).alias("value"))


def unnest(df: DataFrame, column: str, position: str | None = None, keep_empty: bool = True) -> DataFrame:
    """One row per element of a list column, which takes the element's value; ``position`` names a column for its place from 0. With
    ``keep_empty`` rows with a null or empty list stay once, with null for both; without it they go. Narrow."""
    if column not in df.columns or not isinstance(df.schema[column].dataType, T.ArrayType):
        raise ValueError(f"{column!r} is not a list column")
    explode = F.posexplode_outer if keep_empty else F.posexplode
    out = df.select(*[F.col(_q(c)) for c in df.columns if c != column], explode(F.col(_q(column))).alias("__at", "__element"))
    keep = [F.col("__element").alias(c) if c == column else F.col(_q(c)) for c in df.columns]
    return out.select(*keep, *([F.col("__at").alias(position)] if position else []))
