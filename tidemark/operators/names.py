"""Column naming and projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import plain_name


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional rename; the new names must be unique and as many as the columns."""
    names = list(names)
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    _unique(names)
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    out = df.withColumnsRenamed(dict(mapping))
    _unique(out.columns)
    return out


def lower_names(df: DataFrame) -> DataFrame:
    return rename_all(df, [c.lower() for c in df.columns])


def clean_names(df: DataFrame) -> DataFrame:
    """Accents, blanks and punctuation removed from the column names."""
    return rename_all(df, [plain_name(c) for c in df.columns])


def load_names(df: DataFrame) -> DataFrame:
    """Names as every table load writes them: cleaned, then lower case."""
    return lower_names(clean_names(df))


def prefix_names(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return rename_all(df, [c if c in keep else prefix + c for c in df.columns])


def without(df: DataFrame, *names: str) -> DataFrame:
    """Every column but these; an unknown name is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {missing}")
    return df.drop(*names)


def tag(df: DataFrame, **constants) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def _unique(names: Sequence[str]) -> None:
    seen, twice = set(), set()
    for n in names:
        (twice if n in seen else seen).add(n)
    if twice:
        raise ValueError(f"column names occur twice: {sorted(twice)}")
