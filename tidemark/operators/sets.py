"""Set operations and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import col
from tidemark.operators.joins import anti, equi
from tidemark.operators.windows import earliest, latest


def union_by_name(frames: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """Union aligned by name, missing columns null; optionally without copies."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.distinct() if distinct else out


def symmetric_difference(*frames: DataFrame) -> DataFrame:
    """Rows occurring exactly once in the concatenation of all frames."""
    both = union_by_name(frames)
    return (both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("__copies"))
            .filter("__copies = 1").drop("__copies"))


def key_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of a that b does not have."""
    return anti(a.select(*keys).distinct(), b, keys)


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (),
          keep: str = "first") -> DataFrame:
    """One row per key (first or last under a total order), or only keys that occur once."""
    if keep == "first":
        return earliest(df, keys, order)
    if keep == "last":
        return latest(df, keys, order)
    if keep != "none":
        raise ValueError("keep is first, last or none")
    rest = [c for c in df.columns if c not in keys]
    once = (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("__copies"), F.any_value(F.struct(F.lit(1), *rest)).alias("__row"))
            .filter("__copies = 1"))
    return once.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def mark_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (),
                    keep: str = "first", name: str = "duplicated") -> DataFrame:
    """Boolean column: is the row a repeat under the same rule as ``dedup``?"""
    if keep == "none":
        counts = df.groupBy(*keys).agg((F.count(F.lit(1)) > 1).alias(name))
        return equi(df, counts, list(keys), "left", null_safe=True)
    if keep not in ("first", "last"):
        raise ValueError("keep is first, last or none")
    place = F.struct(*[col(c) for c in order])
    kept = F.min(place) if keep == "first" else F.max(place)
    marks = df.groupBy(*keys).agg(kept.alias("__kept"))
    out = equi(df, marks, list(keys), "left", null_safe=True)
    return out.withColumn(name, ~place.eqNullSafe(F.col("__kept"))).drop("__kept")
