"""Versions, attribute changes and snapshot differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.filters import changed
from tidemark.operators.joins import anti, equi, mark, one_per_key
from tidemark.operators.reshape import melt
from tidemark.operators.sets import symmetric_difference
from tidemark.operators.windows import latest, neighbour, numbered

# Text that stands for a blank attribute in the change log.
UNKNOWN = "Unknow"


def versions(changes: DataFrame, history: DataFrame | None, keys: Sequence[str],
             order: Sequence[str | Column], bucket: str | Column, name: str = "version_id") -> DataFrame:
    """Changed rows numbered per key, continuing from the last stored version (0 if none)."""
    keys = list(keys)
    out = numbered(changes, keys, order, "__n", bucket)
    if history is not None:
        last = history.groupBy(*keys).agg(F.max(name).alias("__last"))
        out = equi(out, last, keys, "left")
        out = out.withColumn("__n", F.col("__n") + F.coalesce("__last", F.lit(0))).drop("__last")
    return out.withColumn(name, F.col("__n").cast("bigint")).drop("__n")


def attribute_changes(history: DataFrame, keys: Sequence[str], version: str, attributes: Sequence[str],
                      keep: Sequence[str] = (), bucket: str | Column | None = None,
                      keep_nulls: bool = True) -> DataFrame:
    """One row per attribute whose value differs from the version before.

    The previous row is taken beside the current one before the attributes become rows,
    so versions are shuffled once and not once per attribute. With ``keep_nulls`` a change
    to or from null is logged; without, only changes between two values are. Texts of one
    blank count as unknown.
    """
    keys, attributes = list(keys), list(attributes)
    step = bucket if bucket is not None else F.floor(F.col(version) / 100_000)
    both = neighbour(history.select(*keys, version, *keep, *attributes), keys, [version],
                     [version, *attributes], step, prefix="__old_")
    both = both.filter(F.col(f"__old_{version}").isNotNull())

    def shown(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.when(text == " ", F.lit(UNKNOWN)).otherwise(text)

    pairs = F.array(*[F.struct(F.lit(a).alias("attribute"), shown(f"__old_{a}").alias("old_value"),
                               shown(a).alias("new_value")) for a in attributes])
    rows = both.select(*keys, version, *keep, F.inline(pairs))
    if not keep_nulls:
        rows = rows.filter(F.col("old_value").isNotNull() & F.col("new_value").isNotNull())
    return rows.filter(changed("old_value", "new_value"))


def attribute_rows(history: DataFrame, keys: Sequence[str], version: str,
                   attributes: Sequence[str]) -> DataFrame:
    """Versions as (attribute, value) rows, nulls dropped as the stored operator does."""
    return melt(history, [*keys, version], attributes, "attribute", "value", drop_nulls=True)


def snapshot_diff(latest_rows: DataFrame, current: DataFrame, key: str, status: str, gone: str) -> DataFrame:
    """Rows to append to a history after comparing it with the current list.

    A key missing from the list is appended once with status ``gone``; new and changed
    rows are appended as they are; null keys are ignored.
    """
    columns = current.columns
    stored = latest_rows.select(*columns)
    marked = mark(stored, current.select(key), key)
    left = marked.filter(F.col("_merge") == "left_only").drop("_merge")
    leaving = (left.filter(~F.col(status).eqNullSafe(F.lit(gone)))
               .withColumn(status, F.lit(gone)).select(*columns))
    staying = marked.filter(F.col("_merge") == "both").drop("_merge")
    # Of a changed key the difference holds the old and the new row; the new one counts.
    new_rows = anti_rows(current.filter(F.col(key).isNotNull()), staying)
    new_rows = one_per_key(new_rows, key).select(*columns)
    return leaving.filter(F.col(key).isNotNull()).unionByName(new_rows)


def anti_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a that b does not hold, null matching null."""
    return anti(a, b, a.columns, null_safe=True)


def current_list(history: DataFrame, key: str, loaded: Sequence[str | Column]) -> DataFrame:
    """Latest stored row per key."""
    return latest(history, [key], loaded)


def list_changes(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Rows in one of two lists only."""
    return symmetric_difference(stored, current)
