"""Data-quality gates and profiles."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class QualityError(AssertionError):
    """A gate failed; nothing should be written."""


@dataclass(frozen=True)
class Gate:
    """An aggregate that is measured while rows are written, and what it must be."""

    name: str
    metric: Column
    passes: Callable[[object], bool]

    def check(self, seen: Observation) -> None:
        value = seen.get[self.name]
        if not self.passes(value):
            raise QualityError(f"{self.name}: {value}")


def not_empty() -> Gate:
    return Gate("rows", F.count(F.lit(1)), lambda n: n > 0)


def no_nulls(columns: Sequence[str]) -> Gate:
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(f"`{c}`").isNull()
    return Gate(f"rows without {', '.join(columns)}", F.count_if(missing), lambda n: n == 0)


def declared_rows(total: int) -> Gate:
    """As many rows as a payload declared."""
    return Gate("rows against the declared number", F.count(F.lit(1)), lambda n: n == total)


def observed(df: DataFrame, gates: Sequence[Gate], seen: Observation) -> DataFrame:
    """The frame, measured by whatever job computes it next."""
    return df.observe(seen, *[g.metric.alias(g.name) for g in gates])


def gated(df: DataFrame, name: str, gates: Sequence[Gate]) -> DataFrame:
    """The frame written once as a staging table, if all gates pass on the rows as they are written."""
    from tidemark.sources.scratch import written
    if not gates:
        return written(df, name)
    seen = Observation()
    staged = written(observed(df, gates, seen), name)
    for gate in gates:
        gate.check(seen)
    return staged


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not duplicate_keys(df, keys).isEmpty():
        raise QualityError(f"key {list(keys)} is not unique")
    return df


def assert_not_empty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise QualityError("no rows to load")
    return df


def is_complete(df: DataFrame, declared_total: int) -> bool:
    """Page check: as many rows as the payload declared."""
    return df.count() == declared_total


def page_completeness(rows: DataFrame, page: Sequence[str], declared: str) -> DataFrame:
    """Per page: the rows it holds, the number it declares, and whether they agree."""
    return (rows.groupBy(*page).agg(F.count(F.lit(1)).alias("rows"), F.max(declared).alias("declared"))
            .withColumn("complete", F.col("rows") == F.col("declared")))


def split_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is repeated: the side table written next to a report.

    Keys are counted first and joined back, so a hot key stays split over tasks.
    """
    from tidemark.operators.joins import semi
    return semi(df, duplicate_keys(df, keys), list(keys), null_safe=True)


def reconcile(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups whose row counts differ between two frames, with both counts."""
    counts = (a.select(*by, F.lit(1).alias("a"), F.lit(0).alias("b"))
              .unionByName(b.select(*by, F.lit(0).alias("a"), F.lit(1).alias("b"))))
    return (counts.groupBy(*by).agg(F.sum("a").alias("rows_a"), F.sum("b").alias("rows_b"))
            .filter("rows_a <> rows_b"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count per column in one pass, one output row per column."""
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "nulls")


# Column types of the generated table definition.
DDL_TYPES = {
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "TIMESTAMP",
    "bigint": "BIGINT", "int": "BIGINT", "smallint": "BIGINT", "tinyint": "BIGINT",
    "double": "NUMERIC(24)", "float": "NUMERIC(24)",
    "string": "VARCHAR(100)", "boolean": "BOOLEAN",
}


def table_definition(df: DataFrame) -> str:
    """Column list of a table definition matching the frame."""
    def kind(name: str) -> str:
        return "NUMERIC(24)" if name.startswith("decimal") else DDL_TYPES.get(name, "VARCHAR(100)")
    return "\n".join(f"{name} {kind(dtype)} NULL," for name, dtype in df.dtypes)
