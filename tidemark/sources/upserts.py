"""Table maintenance: each function returns the table's new state.

Nothing is collected: key sets are compared by joins. A small change set is broadcast by
the optimizer, so the stored table is scanned once without a shuffle; a large one is
shuffled on the key. Pass ``order`` when a change set may hold a key twice: the last row
under it counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date, month_key
from tidemark.functions.numbers import col
from tidemark.operators.joins import anti, equi, one_per_key
from tidemark.operators.windows import latest


def _one_each(source: DataFrame, keys: Sequence[str], order) -> DataFrame:
    return source if order is None else latest(source, keys, order)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Not-a-number in float columns becomes null before a load."""
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in floats}) if floats else df


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order: Sequence[str | Column] | None = None) -> DataFrame:
    """Insert; on a key conflict every non-key column takes the new value."""
    rows = _one_each(nan_to_null(source), keys, order).select(*target.columns)
    return anti(target, rows, keys).unionByName(rows)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str],
          order: Sequence[str | Column] | None = None) -> DataFrame:
    """Matched rows change in the ``update`` columns only; unmatched source rows are inserted."""
    keys = list(keys)
    rows = _one_each(source, keys, order).select(*target.columns)
    fresh = anti(rows, target, keys)
    news = rows.select(*keys, F.struct(*update).alias("__new"))
    matched = equi(target, news, keys, "left")
    kept = matched.select(*[
        F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c)
        if c in update else F.col(c) for c in target.columns])
    return kept.unionByName(fresh)


def merge_into_table(source: DataFrame, table: str, keys: Sequence[str], update: Sequence[str]) -> None:
    """The same merge run by the table's own catalog, for table formats that support it."""
    match = reduce(and_, [F.col(f"{table}.{k}") == source[k] for k in keys])
    (source.mergeInto(table, match).whenMatched().update({c: source[c] for c in update})
     .whenNotMatched().insertAll().merge())


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str],
                columns: Sequence[str]) -> DataFrame:
    """Staged update: the new value where the staging table has one, else the old one."""
    keys = list(keys)
    side = one_per_key(source.select(*keys, *columns), keys)
    side = side.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    out = equi(target, side, keys, "left")
    return out.select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in columns else F.col(c)
                        for c in target.columns])


def window_replace(target: DataFrame, source: DataFrame, date: str, first, last=None) -> DataFrame:
    """Rows dated first..last (or from first on) deleted, the extract appended."""
    c, first = F.col(date), as_date(first)
    outside = c < F.lit(first)
    if last is not None:
        outside = outside | (c >= F.lit(as_date(last) + dt.timedelta(days=1)))
    # A missing date is in no window, so such rows stay.
    return target.filter(outside | c.isNull()).unionByName(source.select(*target.columns))


def month_replace(target: DataFrame, source: DataFrame, date: str) -> DataFrame:
    """The months present in the extract replaced as a whole, keyed by a sortable month."""
    return anti(target.withColumn("__month", month_key(date)),
                source.select(month_key(date).alias("__month")), ["__month"]) \
        .drop("__month").unionByName(source.select(*target.columns))


def key_date_replace(target: DataFrame, source: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Rows whose day and key both occur among the touched ones deleted, the extract appended.

    The two conditions are independent, as in the stored delete: a touched key on another
    touched day goes too. Both lists are distinct and usually small enough to be broadcast,
    so the stored table is scanned without a shuffle.
    """
    days = source.select(F.to_date(date).alias("__day"))
    marked = target.withColumn("__day", F.to_date(date))
    days = days.filter(F.col("__day").isNotNull()).distinct().withColumn("__day_hit", F.lit(True))
    touched = source.select(*keys).distinct().withColumn("__key_hit", F.lit(True))
    out = equi(equi(marked, days, ["__day"], "left"), touched, list(keys), "left")
    keep = ~(F.coalesce("__day_hit", F.lit(False)) & F.coalesce("__key_hit", F.lit(False)))
    return out.filter(keep).select(*target.columns).unionByName(source.select(*target.columns))


def newer_than(source: DataFrame, stored: DataFrame, mark: str) -> DataFrame:
    """Source rows above the stored high-water mark (all of them for an empty table)."""
    top = stored.agg(F.max(mark).alias("top")).scalar()
    return source.filter((F.col(mark) > top) | top.isNull())


def copy_new(target: DataFrame, source: DataFrame, mark: str) -> DataFrame:
    return target.unionByName(newer_than(source, target, mark).select(*target.columns))


def refresh_open(target: DataFrame, source: DataFrame, keys: Sequence[str], date: str, is_open: Column,
                 as_of, update: Sequence[str]) -> DataFrame:
    """Order-list refresh: source rows of the days with open stored rows, and of the as-of
    day, are merged; columns outside ``update`` keep their first value."""
    today = F.to_date(date) == F.lit(as_date(as_of))
    days = target.filter(is_open).select(F.to_date(date).alias("__day")).distinct()
    marked = source.withColumn("__day", F.to_date(date))
    hits = equi(marked, days.withColumn("__hit", F.lit(True)), ["__day"], "left")
    fetched = hits.filter(F.coalesce("__hit", F.lit(False)) | today).select(*source.columns)
    return merge(target, fetched, keys, update)


def latest_version(history: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Current rows of an append-only history."""
    return latest(history, keys, [col(c) for c in order])
