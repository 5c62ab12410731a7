"""Latest rows and order-dependent columns.

``latest`` relies on the rank limit Spark applies before the shuffle. The numbering,
running and neighbour columns take a *bucket*: an expression that never decreases along
the order (a month, a day). Rows are then windowed per (key, bucket) and the buckets are
chained through a small per-bucket summary, so a key holding a large share of the rows
is spread over its buckets instead of being sorted in one task. Every order must be
total; callers add a unique tie-break.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.numbers import col
from tidemark.operators.joins import equi


def _order(order: Sequence[str | Column], descending: bool = False) -> list[Column]:
    return [col(c).desc_nulls_last() if descending else col(c).asc_nulls_first() for c in order]


def _filled(name: str, kind: str) -> Column:
    """The column with nulls replaced by some value of its type."""
    plain = {"string": "", "boolean": False, "date": dt.date(1970, 1, 1)}
    if kind in plain:
        return F.coalesce(F.col(name), F.lit(plain[kind]))
    if kind.startswith("timestamp"):
        return F.coalesce(F.col(name), F.lit("1970-01-01").cast(kind))
    return F.coalesce(F.col(name), F.lit(0).cast(kind))


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1,
           name: str | None = None) -> DataFrame:
    """The n last rows per key under a total order; ``name`` keeps the position (1 = last)."""
    position = name or "__position"
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*_order(order, descending=True)))
    out = df.withColumn(position, rank).filter(F.col(position) <= n)
    return out if name else out.drop(position)


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*_order(order)))
    return df.withColumn("__position", rank).filter(F.col("__position") <= n).drop("__position")


def latest_two(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str) -> DataFrame:
    """Last and second-last value per key, side by side."""
    top = latest(df, keys, order, n=2, name="__position")
    return top.groupBy(*keys).agg(
        F.max(F.when(F.col("__position") == 1, F.col(value))).alias(f"{value}_1"),
        F.max(F.when(F.col("__position") == 2, F.col(value))).alias(f"{value}_2"))


def group_value(df: DataFrame, keys: Sequence[str], agg: Column, name: str) -> DataFrame:
    """A group aggregate on every row (partial aggregation, joined back)."""
    return equi(df, df.groupBy(*keys).agg(agg.alias(name)), list(keys), "left", null_safe=True)


def ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], bucket: str | Column,
            sums: Mapping[str, str | Column] | None = None, previous: Mapping[str, str] | None = None,
            following: Mapping[str, str] | None = None) -> DataFrame:
    """Running sums and neighbouring values along a total order, all in one pass.

    ``sums`` maps a new column to the value summed from the first row of the key up to this
    one; ``previous`` / ``following`` map a new column to the column of the row before / after.
    One partial aggregation gives a summary per (key, bucket), a window over the summaries
    chains the buckets, and one join and one window per (key, bucket) finish the rows.
    """
    sums, previous, following = dict(sums or {}), dict(previous or {}), dict(following or {})
    values = {f"__v{i}": col(v) for i, v in enumerate(sums.values())}
    work = df.withColumns({"__bucket": col(bucket), **values})
    # Null-free stand-ins for key and bucket: a plain equi join then serves null keys too, and
    # the window finds its rows already partitioned by the join.
    kinds = dict(work.select(*keys, "__bucket").dtypes)
    key_part = [f"__k{i}" for i in range(len(keys))] + ["__key_nulls"]
    part = [*key_part, "__filled_bucket", "__has_bucket"]
    key_nulls = sum((F.col(k).isNull().cast("int") * 2 ** i for i, k in enumerate(keys)), F.lit(0))
    stand_ins = [*[_filled(k, kinds[k]) for k in keys], key_nulls, _filled("__bucket", kinds["__bucket"]),
                 F.col("__bucket").isNotNull()]
    work = work.withColumns(dict(zip(part, stand_ins)))
    place = F.struct(*[col(c) for c in order])
    before_row = F.struct(*previous.values()) if previous else None
    after_row = F.struct(*following.values()) if following else None
    aggs = [F.sum(v).alias(v) for v in values]
    if previous:
        aggs.append(F.max_by(before_row, place).alias("__last"))
    if following:
        aggs.append(F.min_by(after_row, place).alias("__first"))
    summary = work.groupBy(*part).agg(*aggs)
    across = W.partitionBy(*key_part).orderBy("__has_bucket", "__filled_bucket")
    so_far = across.rowsBetween(W.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum(v).over(so_far), F.lit(0)).alias(f"__carried{v}") for v in values]
    if previous:
        carried.append(F.lag("__last").over(across).alias("__before"))
    if following:
        carried.append(F.lead("__first").over(across).alias("__after"))
    out = work.join(summary.select(*part, *carried), part)

    inside = W.partitionBy(*part).orderBy(*_order(order))
    running = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    new = {name: F.col(f"__carried{v}") + F.coalesce(F.sum(v).over(running), F.lit(0)) for name, v in zip(sums, values)}
    if previous:
        new["__previous"] = F.coalesce(F.lag(before_row).over(inside), F.col("__before"))
    if following:
        new["__following"] = F.coalesce(F.lead(after_row).over(inside), F.col("__after"))
    out = out.withColumns(new)
    picked = [F.col(f"__previous.{c}").alias(name) for name, c in previous.items()]
    picked += [F.col(f"__following.{c}").alias(name) for name, c in following.items()]
    return out.select(*df.columns, *sums, *picked)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str,
             bucket: str | Column) -> DataFrame:
    """1-based position within the key."""
    return ordered(df, keys, order, bucket, sums={name: F.lit(1)})


def neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              columns: Sequence[str], bucket: str | Column, prefix: str = "previous_",
              forward: bool = False) -> DataFrame:
    """Columns of the row before (or after) within the key; null at the end."""
    wanted = {prefix + c: c for c in columns}
    return ordered(df, keys, order, bucket, **({"following": wanted} if forward else {"previous": wanted}))


def islands(days: DataFrame, keys: Sequence[str], day: str, max_gap_days: int = 1,
            name: str = "island", position: str | None = None) -> DataFrame:
    """Chains of days with gaps of at most ``max_gap_days``; chains are numbered from 0.

    The input holds one row per (key, day): rows are collapsed to days beforehand, so a
    key's window is bounded by the calendar and not by its row count.
    """
    w = W.partitionBy(*keys).orderBy(day)
    gap = F.datediff(F.col(day), F.lag(day).over(w)) > max_gap_days
    out = days.withColumn("__gap", F.coalesce(gap.cast("int"), F.lit(0)))
    out = out.withColumn(name, F.sum("__gap").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    out = out.drop("__gap")
    if position:
        out = out.withColumn(position, F.row_number().over(W.partitionBy(*keys, name).orderBy(day)))
    return out
