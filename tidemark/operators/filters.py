"""Row filters and predicates."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import col


def where_equal(df: DataFrame, **values) -> DataFrame:
    """Rows matching every given column value."""
    return df.filter(reduce(and_, [F.col(k) == F.lit(v) for k, v in values.items()], F.lit(True)))


def missing(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNull())


def present(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNotNull())


def complete(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows without a null in the named columns."""
    return df.dropna(subset=names)


def starts_with(c: str | Column, prefix: str) -> Column:
    return col(c).startswith(prefix)


def not_starting_with(c: str | Column, prefix: str) -> Column:
    """Null rows pass, as they do when frames are compared element by element."""
    return ~F.coalesce(col(c).startswith(prefix), F.lit(False))


def differs_from(c: str | Column, value) -> Column:
    """``!=`` under which a null differs from every value."""
    return ~col(c).eqNullSafe(F.lit(value))


def blank(c: str | Column) -> Column:
    return col(c).rlike(r"^\s*$")


def changed(old: str | Column, new: str | Column) -> Column:
    """Old and new differ, null being a value of its own."""
    return ~col(old).eqNullSafe(col(new))


def any_rule(*rules: Column) -> Column:
    return reduce(or_, rules)


def all_rules(*rules: Column) -> Column:
    return reduce(and_, rules)
