"""Wide to long, long to wide, lists and structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import col
from tidemark.functions.text import pieces


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
         variable: str = "variable", value: str = "value", drop_nulls: bool = False,
         value_type: str = "string") -> DataFrame:
    """All non-id columns as (variable, value) rows, cast to one type."""
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    typed = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in values])
    out = typed.unpivot(list(ids), values, variable, value)
    return out.filter(F.col(value).isNotNull()) if drop_nulls else out


def list_to_rows(df: DataFrame, list_col: str, name: str, sep: str = ",") -> DataFrame:
    """One row per non-empty piece of a delimited text; empty texts give no row."""
    rest = [c for c in df.columns if c != list_col]
    return df.select(*rest, F.explode(pieces(list_col, sep)).alias(name)).filter(F.col(name) != "")


def list_to_columns(df: DataFrame, array: str | Column, n: int, prefix: str) -> DataFrame:
    """First n array elements as columns, null past the end."""
    return df.withColumns({f"{prefix}{i + 1}": F.get(col(array), F.lit(i)) for i in range(n)})


def map_labels(df: DataFrame, labels: DataFrame, on: str) -> DataFrame:
    """Week or period labels replaced by their calendar row."""
    return df.join(labels, on, "left")
