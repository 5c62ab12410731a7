"""Numeric helpers: money, coercion, rounding, signs, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column, places: int = 2) -> Column:
    """Exact decimal form of an amount, so that sums do not depend on row order."""
    return col(c).cast(f"decimal(18,{places})")


def zero_sum(c: str | Column) -> Column:
    """Sum that is 0, not null, for a group holding nulls only."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def to_number(c: str | Column, kind: str = "double") -> Column:
    """Number from text with blanks and thousands commas removed; bad text gives null."""
    return F.regexp_replace(col(c).cast("string"), "[ ,]", "").try_cast(kind)


def flag(c: str | Column) -> Column:
    """1 when the amount is above zero, else 0 (null counts as 0)."""
    return F.coalesce((col(c) > 0).cast("int"), F.lit(0))


def ratio(a: str | Column, b: str | Column) -> Column:
    """Division that gives null on a zero divisor."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def percent(a: str | Column, b: str | Column, places: int = 0) -> Column:
    """100 * a / b, rounded half up; null on a zero divisor."""
    return F.round(F.try_divide(col(a).cast("double") * 100, col(b).cast("double")), places)


def round_half_up(c: str | Column, places: int = 0) -> Column:
    """SQL rounding."""
    return F.round(col(c), places)


def round_half_even(c: str | Column, places: int = 0) -> Column:
    """Dataframe-library rounding (banker's)."""
    return F.bround(col(c), places)


def by_unit(qty: str | Column, rate: str | Column, op: str | Column) -> Column:
    """Quantity in the base unit: times the rate for ``M``, divided by it otherwise."""
    q, r = col(qty).cast("double"), col(rate).cast("double")
    return F.when(col(op) == "M", q * r).otherwise(F.try_divide(q, r))


def signed(c: str | Column, code: str | Column, plus=(), minus=()) -> Column:
    """The measure with the sign its document code carries; other codes count 0."""
    value, code = col(c), col(code)
    return (F.when(code.isin(*plus), value)
            .when(code.isin(*minus), -value)
            .otherwise(F.lit(0).cast("int")))
