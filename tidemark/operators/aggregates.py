"""Aggregations. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.numbers import col, money, zero_sum
from tidemark.operators.joins import equi


def group_sum(df: DataFrame, keys: Sequence[str | Column], sums: Sequence[str] = (),
              maxs: Sequence[str] = (), mins: Sequence[str] = (), places: int = 2) -> DataFrame:
    """Sums, maxima and minima in one pass; null keys form groups of their own.

    Amounts are summed as decimals and a group of nulls sums to 0.
    """
    aggs = [zero_sum(money(c, places)).alias(c) for c in sums]
    aggs += [F.max(c).alias(c) for c in maxs] + [F.min(c).alias(c) for c in mins]
    return df.groupBy(*keys).agg(*aggs)


def aggregate(df: DataFrame, keys: Sequence[str], how: Mapping[str, str]) -> DataFrame:
    """Group-by with one function name per column, null keys kept."""
    known = {"sum": lambda c: zero_sum(c), "max": F.max, "min": F.min, "count": F.count,
             "mean": F.avg, "nunique": F.count_distinct}
    return df.groupBy(*keys).agg(*[known[f](c).alias(c) for c, f in how.items()])


def cond_pivot(df: DataFrame, keys: Sequence[str | Column], category: str | Column,
               values: Mapping[object, str] | Sequence, measure: str | Column,
               places: int = 2) -> DataFrame:
    """One sum column per listed category; ``values`` maps a category to its column name.

    A category may be a list of codes (several codes feeding one column).
    """
    named = values if isinstance(values, Mapping) else {v: str(v) for v in values}

    def test(v) -> Column:
        return col(category).isin(*v) if isinstance(v, tuple) else col(category) == F.lit(v)

    amount = money(measure, places)
    return df.groupBy(*keys).agg(*[
        zero_sum(F.when(test(v), amount).otherwise(F.lit(0))).alias(name) for v, name in named.items()])


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value combination, null included."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("counts"))


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).distinct()


def first_values(df: DataFrame, keys: Sequence[str], value: str, n: int = 3,
                 prefix: str | None = None) -> DataFrame:
    """The first n distinct values per group, in value order, as columns ``<prefix>1..n``, and
    ``<prefix>_count``, the number of all distinct values.

    Duplicates go in a partial aggregation and the rank limit is applied before the
    shuffle, so no group is ever gathered as a list.
    """
    prefix = prefix or value
    distinct = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(value))
    top = distinct.withColumn("__n", rank).filter(F.col("__n") <= n)
    counts = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{prefix}_count"))
    wide = top.groupBy(*keys).agg(*[
        F.max(F.when(F.col("__n") == i, F.col(value))).alias(f"{prefix}{i}") for i in range(1, n + 1)])
    return equi(wide, counts, list(keys), "inner", null_safe=True)


def all_members(df: DataFrame, keys: Sequence[str], item: str | Column, members: Sequence,
                name: str = "all_members") -> DataFrame:
    """Per group: do all rows carry a listed item?"""
    listed = F.coalesce(col(item).isin(*members), F.lit(False))
    return df.groupBy(*keys).agg(F.bool_and(listed).alias(name))


def word_count(df: DataFrame, text: str, sep: str = " ") -> DataFrame:
    """Occurrences of each piece of the texts, empty pieces included."""
    words = df.select(F.explode(F.split(F.col(text), sep)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))


def high_water(df: DataFrame, name: str) -> Column:
    """Greatest stored value, as a scalar subquery."""
    return df.agg(F.max(name)).scalar()
