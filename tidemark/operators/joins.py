"""Joins.

No join is forced to broadcast: the optimizer broadcasts a side when its measured size
is under the session's threshold and shuffles otherwise, and adaptive execution splits a
hot key's partition. Sides used only for membership are collapsed to distinct keys
first, and lookup sides to one row per key, so no join here multiplies rows by copies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.numbers import col
from tidemark.functions.text import pieces
from tidemark.operators.quality import assert_unique

Keys = str | Sequence[str]


def names_of(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def equi(left: DataFrame, right: DataFrame, keys: Keys, how: str = "left",
         null_safe: bool = False) -> DataFrame:
    """Equi join on same-named keys, which appear once in the result.

    SQL equality by default; ``null_safe`` lets null match null, as frame merges do.
    """
    keys = names_of(keys)
    if not null_safe:
        return left.join(right, keys, how)
    right_keys = {k: f"__right_{k}" for k in keys}
    renamed = right.withColumnsRenamed(right_keys)
    cond = reduce(and_, [left[k].eqNullSafe(renamed[right_keys[k]]) for k in keys])
    return left.join(renamed, cond, how).drop(*right_keys.values())


def facts(left: DataFrame, right: DataFrame, keys: Keys, how: str = "inner") -> DataFrame:
    """Equi join of two tables that both grow with the data (lines and their orders).

    Neither side is ever broadcast, however small a test table is: both are shuffled on the
    key and a hot key's partition is split at run time.
    """
    return left.hint("merge").join(right, names_of(keys), how)


def semi(df: DataFrame, other: DataFrame, keys: Keys, null_safe: bool = False) -> DataFrame:
    """Rows whose key occurs in the other frame."""
    keys = names_of(keys)
    return equi(df, other.select(*keys).distinct(), keys, "left_semi", null_safe)


def anti(df: DataFrame, other: DataFrame, keys: Keys, null_safe: bool = False) -> DataFrame:
    """Rows whose key does not occur in the other frame."""
    keys = names_of(keys)
    return equi(df, other.select(*keys).distinct(), keys, "left_anti", null_safe)


def mark(df: DataFrame, other: DataFrame, keys: Keys, name: str = "_merge") -> DataFrame:
    """Each row tagged ``both`` or ``left_only``."""
    keys = names_of(keys)
    seen = other.select(*keys).distinct().withColumn(name, F.lit("both"))
    return equi(df, seen, keys, "left").withColumn(name, F.coalesce(F.col(name), F.lit("left_only")))


def one_per_key(dim: DataFrame, keys: Keys, order: str | Column | None = None) -> DataFrame:
    """A dimension with one row per key: the last one under ``order``.

    Without an order the greatest row wins, which is arbitrary but repeatable.
    """
    keys = names_of(keys)
    rest = [c for c in dim.columns if c not in keys]
    row = F.struct(*rest)
    chosen = F.max(row) if order is None else F.max_by(row, col(order))
    return dim.groupBy(*keys).agg(chosen.alias("__row")).select(*keys, "__row.*")


def lookup(df: DataFrame, dim: DataFrame, on: str, key: str, value: str, default=None,
           order: str | Column | None = None, name: str | None = None) -> DataFrame:
    """Dictionary lookup: ``dim[key] -> value`` for ``df[on]``, default for unknown keys."""
    name = name or value
    picks = [F.col(key).alias("__key"), F.col(value).alias("__value")]
    if order is not None:
        picks.append(col(order).alias("__order"))
    flat = dim.select(*picks)
    chosen = F.max("__value") if order is None else F.max_by("__value", "__order")
    unique = flat.groupBy("__key").agg(chosen.alias("__value"))
    out = df.join(unique, df[on] == unique["__key"], "left")
    found = F.col("__value") if default is None else F.coalesce(F.col("__value"), F.lit(default))
    return out.withColumn(name, found).drop("__key", "__value")


def alias_dimension(df: DataFrame, dim: DataFrame, on: str, key: str, prefix: str,
                    columns: Sequence[str]) -> DataFrame:
    """The same dimension joined once more under a prefix (staff, supervisor, area …)."""
    side = dim.select(F.col(key).alias("__key"), *[F.col(c).alias(prefix + c) for c in columns])
    return df.join(side, df[on] == side["__key"], "left").drop("__key")


@dataclass(frozen=True)
class Dimension:
    """A dimension of a star: its rows, the columns it is looked up by (column of the rows -> key of the
    dimension, any number), and what it brings (its column -> name in the result)."""

    frame: DataFrame
    on: Mapping[str, str]
    columns: Mapping[str, str]
    inner: bool = False              # rows without a match leave
    where: str | Column | None = None  # rows of the dimension that count
    order: str | Column | None = None  # of several rows of a key the last under it, else the greatest
    defaults: Mapping[str, object] = field(default_factory=dict)  # for keys that are not found


def star(rows: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """The rows with all dimensions, one after the other: a later one may be looked up by what an earlier
    one brought, and a list may come several times under different names. No dimension multiplies rows."""
    out = rows
    for n, d in enumerate(dimensions):
        keys = {c: f"__key{n}_{i}" for i, c in enumerate(d.on)}
        frame = d.frame if d.where is None else d.frame.filter(d.where)
        picked = [F.col(d.on[c]).alias(k) for c, k in keys.items()] + [F.col(c).alias(f"__val{n}_{i}") for i, c in enumerate(d.columns)]
        picked += [] if d.order is None else [col(d.order).alias("__order")]
        side = one_per_key(frame.select(*picked), list(keys.values()), None if d.order is None else "__order").drop("__order")
        cond = reduce(and_, [out[c] == side[k] for c, k in keys.items()])
        out = out.join(side, cond, "inner" if d.inner else "left")
        brought = {name: F.coalesce(F.col(f"__val{n}_{i}"), F.lit(d.defaults[name])) if name in d.defaults else F.col(f"__val{n}_{i}")
                   for i, name in enumerate(d.columns.values())}
        out = out.withColumns(brought).drop(*keys.values(), *[f"__val{n}_{i}" for i in range(len(d.columns))])
    return out


def left_where(left: DataFrame, right: DataFrame, keys: Keys, condition: Column) -> DataFrame:
    """Left join with a predicate on the right side inside ON."""
    return equi(left, right.filter(condition), keys, "left")


def checked(df: DataFrame, dim: DataFrame, keys: Keys, how: str = "left") -> DataFrame:
    """Many-to-one join: a repeated key on the right raises before the join."""
    assert_unique(dim, names_of(keys))
    return equi(df, dim, keys, how)


def groupwise_max(df: DataFrame, keys: Keys, by: str, null_safe: bool = True) -> DataFrame:
    """All rows carrying their group's greatest value; ties stay.

    A rank limit, which Spark applies on each input partition before the shuffle, so a hot key
    sends no more than its ties and the frame is read once. Null keys are a group under
    ``null_safe`` and leave otherwise.
    """
    keys = names_of(keys)
    rows = df.filter(F.col(by).isNotNull())
    rows = rows if null_safe else rows.dropna(subset=keys)
    rank = F.rank().over(W.partitionBy(*keys).orderBy(F.col(by).desc()))
    return rows.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def membership(left: DataFrame, lists: DataFrame, keys: Keys, item: str, list_col: str,
               sep: str = ",") -> DataFrame:
    """Inner join where ``left[item]`` is one of the pieces of a delimited list.

    The lists become rows first, so the join stays a hash join.
    """
    keys = names_of(keys)
    rest = [c for c in lists.columns if c not in keys and c != list_col]
    rows = lists.select(*keys, *rest, F.explode(F.array_distinct(pieces(list_col, sep))).alias(item))
    return equi(left, rows.filter(F.col(item) != ""), [*keys, item], "inner")


def fill_from(df: DataFrame, other: DataFrame, keys: Keys, columns: Sequence[str],
              order: str | Column | None = None) -> DataFrame:
    """Nulls of the left columns filled from the matching row of another frame."""
    keys = names_of(keys)
    side = one_per_key(other.select(*keys, *columns) if order is None
                       else other.select(*keys, *columns, order), keys, order)
    side = side.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    out = equi(df, side, keys, "left")
    return (out.withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in columns})
            .drop(*[f"__{c}" for c in columns]))


def span_of(df: DataFrame, date: str) -> Column:
    """First and last day of a column as one scalar subquery (fields ``lo`` and ``hi``)."""
    return df.agg(F.struct(F.to_date(F.min(date)).alias("lo"), F.to_date(F.max(date)).alias("hi")).alias("s")).scalar()


LEVEL_GROWTH = 16  # how much longer the buckets of the next level are
LONGEST = 4_000_000  # days; more than dates can be apart


def _day_number(c: Column) -> Column:
    return F.datediff(c, F.lit("1970-01-01").cast("date"))


def on_levels(df: DataFrame, low: str, high: str, bucket_days: int) -> DataFrame:
    """Intervals of days with the ``__size`` of their level's buckets and a ``__bucket`` they meet: one row
    for an interval, two where it crosses a border."""
    sizes = [bucket_days]
    while sizes[-1] < LONGEST:
        sizes.append(sizes[-1] * LEVEL_GROWTH)
    length, size = F.datediff(high, low) + 1, F.lit(sizes[-1])
    for s in reversed(sizes[:-1]):
        size = F.when(length <= s, F.lit(s)).otherwise(size)
    sized = df.withColumn("__size", size)
    ends = F.array_distinct(F.array(*[F.floor(_day_number(F.col(c)) / F.col("__size")) for c in (low, high)]))
    return sized.withColumn("__bucket", F.explode(ends))


def range_join(left: DataFrame, right: DataFrame, keys: Keys, point: str, start: str, end: str,
               how: str = "inner", bucket_days: int = 30, span: Column | None = None) -> DataFrame:
    """Equi keys plus ``point BETWEEN start AND end`` (days, both ends included).

    Buckets of days come in levels, each ``LEVEL_GROWTH`` times as long as the one before. An
    interval goes to the first level whose buckets are no shorter than itself, so it is one row
    there, or two where it crosses a border, however long it is; a point is looked up once on
    every level that some interval is on. The join is a hash join on (keys, level, bucket), so a
    hot key is spread over its buckets; the interval test is the residual. Intervals are first
    cut to the span of the points; pass ``span`` (see ``span_of``) when the points are known to
    lie in that of a cheaper frame.

    ``how="left"`` keeps an unmatched left row once, with nulls; it has a single level, and an
    interval is a row for each bucket that it meets.
    """
    keys = names_of(keys)
    span = span_of(left, point) if span is None else span
    low = F.greatest(F.to_date(start), span.getField("lo"))
    high = F.least(F.to_date(end), span.getField("hi"))
    cut = (right.withColumns({"__low": low, "__high": high}).filter("__low <= __high")
           .withColumnsRenamed({k: f"__right_{k}" for k in keys}))

    if how == "left":
        bucket = lambda c: F.floor(_day_number(c) / F.lit(bucket_days))
        cut = cut.withColumn("__bucket", F.explode(F.sequence(bucket(F.col("__low")), bucket(F.col("__high")))))
        points, same = left.withColumn("__point_bucket", bucket(F.to_date(point))), ()
    else:
        cut = on_levels(cut, "__low", "__high", bucket_days)
        levels = cut.agg(F.collect_set("__size").alias("s")).scalar()  # a handful at most
        points = left.withColumn("__levels", levels).withColumn("__point_size", F.explode("__levels")).drop("__levels")
        points = points.withColumn("__point_bucket", F.floor(_day_number(F.to_date(point)) / F.col("__point_size")))
        same = (points["__point_size"] == cut["__size"],)
    cond = reduce(and_, [points[k] == cut[f"__right_{k}"] for k in keys] + [*same], points["__point_bucket"] == cut["__bucket"])
    cond = cond & (F.to_date(points[point]) >= F.to_date(cut[start])) \
        & (F.to_date(points[point]) <= F.to_date(cut[end]))
    return (points.join(cut, cond, how)
            .drop("__point_bucket", "__bucket", "__point_size", "__size", "__low", "__high", *[f"__right_{k}" for k in keys]))
