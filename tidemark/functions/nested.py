"""JSON text, structs and arrays of structs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import col


def parse_json(c: str | Column, schema: str) -> Column:
    return F.from_json(col(c), schema)


def struct_fields(df: DataFrame, name: str, fields: Sequence[str], keep: bool = False) -> DataFrame:
    """Fields of a struct column as ``<struct>_<field>`` columns."""
    out = [c for c in df.columns if keep or c != name]
    return df.select(*out, *[F.col(f"{name}.{f}").alias(f"{name}_{f}") for f in fields])


def at(c: str | Column, n: int, field: str | None = None) -> Column:
    """Element n (0-based) of an array, or one of its fields; null past the end."""
    item = F.get(col(c), F.lit(n))
    return item if field is None else item.getField(field)


# ---- payloads whose fields change ------------------------------------------------------

def with_variant(df: DataFrame, text: str, name: str = "payload") -> DataFrame:
    """JSON text as a variant column, whatever its fields; a text that is no JSON gives null."""
    return df.withColumn(name, F.try_parse_json(F.col(text)))


def variant_fields(df: DataFrame, payload: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Named fields of a variant as columns: name -> (path, type). A missing field, or one that does not
    fit its type, is null."""
    return df.withColumns({n: F.try_variant_get(F.col(payload), path, kind) for n, (path, kind) in fields.items()})


def variant_schema(df: DataFrame, payload: str) -> T.DataType:
    """The type that holds every payload seen: the union of all their fields."""
    text = df.agg(F.schema_of_variant_agg(F.col(payload)).alias("s")).first()["s"]
    kind = T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<")) if text else T.NullType()
    return kind


def variant_columns(df: DataFrame, payload: str, prefix: str = "") -> DataFrame:
    """Every field that some payload has becomes a column, structs inside by ``<field>_<inner>``; fields
    that come up in later files appear by themselves. What has several types over the payloads stays a variant."""
    def paths(kind: T.StructType, path: str, name: str):
        for f in kind.fields:
            at, called = f"{path}['{f.name}']", f"{name}{f.name}"
            if isinstance(f.dataType, T.StructType):
                yield from paths(f.dataType, at, f"{called}_")
            else:
                yield called, at, "string" if isinstance(f.dataType, T.NullType) else f.dataType.simpleString()

    kind = variant_schema(df, payload)
    found = list(paths(kind, "$", prefix)) if isinstance(kind, T.StructType) else []
    clash = {n for n, _, _ in found} & set(df.columns) - {payload}
    if clash:
        raise ValueError(f"payload fields named like columns: {sorted(clash)}")
    rest = [c for c in df.columns if c != payload]
    return df.select(*rest, *[F.try_variant_get(F.col(payload), at, t).alias(n) for n, at, t in found])


def variant_rows(df: DataFrame, payload: str, path: str = "$") -> DataFrame:
    """One row per element of the array at ``path``, as variant ``payload``; other columns are repeated."""
    items = F.try_variant_get(F.col(payload), path, "array<variant>")
    return df.withColumn(payload, F.explode(items))
