"""Order-independent fingerprints of tables, compared as a tree.

A row's hash depends on its values, on which of them are null and on nothing else; a group's
fingerprint is its row count and two exact sums of hashes, so neither row order nor partitioning
matters and a row that occurs twice counts twice. Days are compared first; only differing days
are divided into key buckets, and only differing buckets need their rows looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import semi
from tidemark.operators.sets import union_by_name

_SEEDS = (17, 92821)  # two hashes of 64 bits


def row_hashes(columns: Sequence[tuple[str, str]]) -> list[Column]:
    """Two hashes of a row. Null marks are hashed too, since a null value leaves a hash as it is;
    floats are normalised so that equal values have equal hashes."""
    parts = []
    for name, kind in columns:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = F.when(F.isnan(c), F.lit(float("nan"))).otherwise(c + F.lit(0.0)).cast("double")
        elif kind.startswith(("timestamp", "date")):
            c = c.cast("string")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind.startswith(("struct", "map", "array")):
            c = F.to_json(c) if not kind.startswith("array<string") else F.concat_ws("\x1f", c)
        parts += [c.isNull(), c]
    return [F.xxhash64(F.lit(seed), *parts) for seed in _SEEDS]


def fingerprint(df: DataFrame, by: dict[str, Column], columns: Sequence[str] | None = None) -> DataFrame:
    """Per group: ``rows`` and the exact sums ``h1`` and ``h2`` of the rows' hashes."""
    kinds = dict(df.dtypes)
    hashes = row_hashes([(c, kinds[c]) for c in sorted(columns or df.columns)])
    marked = df.select(*[c.alias(n) for n, c in by.items()], *[h.cast("decimal(20,0)").alias(f"h{i}") for i, h in enumerate(hashes, 1)])
    return marked.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(f"h{i}").alias(f"h{i}") for i in (1, 2)])


def unequal(a: DataFrame, b: DataFrame, by: dict[str, Column], columns: Sequence[str] | None = None) -> DataFrame:
    """The groups whose fingerprints differ, with the rows on both sides (0 where there are none)."""
    prints = [fingerprint(df, by, columns) for df in (a, b)]
    sides = union_by_name([p.withColumn("side", F.lit(s)) for s, p in zip("ab", prints)])
    of = lambda c, s: F.coalesce(F.max(F.when(F.col("side") == s, F.col(c))), F.lit(0))
    both = sides.groupBy(*by).agg(*[of(c, s).alias(f"{c}_{s}") for c in ("rows", "h1", "h2") for s in "ab"])
    return both.filter("rows_a <> rows_b or h1_a <> h1_b or h2_a <> h2_b").select(*by, "rows_a", "rows_b")


def leaf_of(date: str, keys: Sequence[str], buckets: int) -> dict[str, Column]:
    """The day and key bucket of a row; rows without a date have none."""
    return {"day": F.to_date(date), "bucket": F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")}


def differing_days(a: DataFrame, b: DataFrame, date: str, columns: Sequence[str] | None = None) -> DataFrame:
    return unequal(a, b, {"day": F.to_date(date)}, columns)


def differing(a: DataFrame, b: DataFrame, date: str, keys: Sequence[str], buckets: int = 64,
              columns: Sequence[str] | None = None) -> DataFrame:
    """The leaves (``day``, ``bucket``) in which two tables differ, with their row counts.

    Both tables are read once for the days; the second level reads rows of differing days only.
    """
    days = differing_days(a, b, date, columns).select("day")
    days = days.withColumnRenamed("day", "__day")
    of_day = lambda df: semi(df.withColumn("__day", F.to_date(date)), days, ["__day"], null_safe=True).drop("__day")
    columns = list(columns or a.columns)
    return unequal(of_day(a), of_day(b), leaf_of(date, keys, buckets), columns)
