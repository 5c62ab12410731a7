"""Sinks. Every write is one columnar job; a write never replaces what it reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.names import load_names
from tidemark.operators.quality import assert_unique, gated, not_empty

# Load options by number.
LOAD_MODES = {1: "errorifexists", 2: "append", 3: "overwrite"}


def audited(df: DataFrame, as_of, name: str = "inserted_at") -> DataFrame:
    """Load time as a column; the time is an argument so a repeated run gives the same rows."""
    return df.withColumn(name, F.lit(as_of).cast("timestamp_ntz"))


def load(df: DataFrame, path: str, option: int, partition_by: Sequence[str] = ()) -> None:
    """Write under normalised names: 1 fail if present, 2 append, 3 replace."""
    if option not in LOAD_MODES:
        raise ValueError("option is 1, 2 or 3")
    writer = load_names(df).write.mode(LOAD_MODES[option])
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_all(df: DataFrame, path: str) -> None:
    """Truncate and insert; an empty extract leaves the table alone by raising."""
    gated(df, "refresh", [not_empty()]).write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Only the partitions present in the frame are replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def gated_load(df: DataFrame, path: str, option: int, keys: Sequence[str]) -> None:
    """Non-empty and unique, or nothing is written. The rows are computed once, into a staging
    table; they are counted while it is written, and only its keys are read for uniqueness."""
    load(assert_unique(gated(df, "gate", [not_empty()]), keys), path, option)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", "true").mode("errorifexists").csv(path)


def export_json(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    (df.select(*columns) if columns else df).write.mode("errorifexists").json(path)
