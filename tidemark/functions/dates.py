"""Date helpers on naive (zone-less) timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import col

# Fixed values.
NO_DATE = dt.date(1900, 1, 1)      # stands for "no date" in reports
LAST_DATE = dt.date(2262, 4, 11)   # later dates are clamped to this one


def as_date(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def day(c: str | Column) -> Column:
    return F.to_date(col(c))


def on_days(c: str | Column, first, last=None) -> Column:
    """Whole days first..last, kept as a range on the raw column so it is pushed down."""
    c, first = col(c), as_date(first)
    cond = c >= F.lit(first)
    if last is not None:
        cond = cond & (c < F.lit(as_date(last) + dt.timedelta(days=1)))
    return cond


def month_start(c: str | Column) -> Column:
    return F.trunc(col(c), "month")


def month_end(c: str | Column) -> Column:
    return F.last_day(col(c))


def month_name3(c: str | Column) -> Column:
    return F.upper(F.date_format(col(c), "MMM"))


def month_key(c: str | Column) -> Column:
    """Sortable, unambiguous month text."""
    return F.date_format(col(c), "yyyy-MM")


def month_label(c: str | Column) -> Column:
    """Month and year without padding, as stored by the monthly loads (ambiguous: output only)."""
    return F.concat(F.month(col(c)).cast("string"), F.year(col(c)).cast("string"))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Minute boundaries crossed from start to end (not minutes elapsed)."""
    def tick(c):
        return F.unix_seconds(F.date_trunc("minute", col(c)).cast("timestamp"))
    return ((tick(end) - tick(start)) / 60).cast("bigint")


def duration_text(minutes: str | Column) -> Column:
    """h:mm."""
    m = col(minutes)
    return F.concat(F.floor(m / 60).cast("string"), F.lit(":"),
                    F.lpad(F.pmod(m, F.lit(60)).cast("string"), 2, "0"))


def workday_weight(c: str | Column) -> Column:
    """Sunday 0, Saturday one half, any other day 1."""
    weekday = F.dayofweek(col(c))
    return F.when(weekday == 1, F.lit(0.0)).when(weekday == 7, F.lit(0.5)).otherwise(F.lit(1.0))


def parse_date(c: str | Column, pattern: str = "dd/MM/yyyy") -> Column:
    """Date from the first characters of a text; text that does not fit gives null."""
    head = F.substring(col(c), 1, len(pattern))
    return F.to_date(F.try_to_timestamp(head, F.lit(pattern)))


def parse_date_or_sentinel(c: str | Column, pattern: str = "dd/MM/yyyy") -> Column:
    return F.coalesce(parse_date(c, pattern), F.lit(NO_DATE))


def clamp_date(c: str | Column, last: dt.date = LAST_DATE) -> Column:
    return F.least(col(c), F.lit(last))


def date_from_parts(month: str | Column, day_of_month: str | Column) -> Column:
    """Date from a ``yyyy-MM`` text and a day number; null where no such day exists."""
    text = F.concat(col(month), F.lit("-"), F.lpad(col(day_of_month).cast("string"), 2, "0"))
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))


def key_day(c: str | Column) -> Column:
    """yymmdd, as used inside composite keys."""
    return F.date_format(col(c), "yyMMdd")


def key_time(c: str | Column) -> Column:
    """HHmmss, as used inside composite keys."""
    return F.date_format(col(c), "HHmmss")


def calendar(bounds: DataFrame, first: str, last: str, name: str = "day") -> DataFrame:
    """One row per day between two columns of a one-row frame."""
    return bounds.select(F.explode(F.sequence(day(first), day(last))).alias(name))


def workdays(days: DataFrame, as_of, day_col: str = "day") -> DataFrame:
    """Working days per month and those strictly before ``as_of``."""
    weight = workday_weight(day_col)
    return (days.groupBy(month_start(day_col).alias("month"))
            .agg(F.sum(weight).alias("month_days"),
                 F.sum(F.when(F.col(day_col) < F.lit(as_date(as_of)), weight).otherwise(F.lit(0.0)))
                 .alias("elapsed_days")))
