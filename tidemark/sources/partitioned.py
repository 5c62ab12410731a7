"""Stored tables by day or month, of which an operation reads and rewrites only what it touches.

Every operation first finds the partitions that its dates and keys fall into (a list that the
calendar bounds), reads these alone, and computes their new rows with the functions of
``upserts``. The rows are staged once in the shared folder, measured while they are written,
and then promoted by dynamic partition overwrite; partitions left without rows are removed. Files of
other partitions are neither read nor replaced.

Each operation gives the same state when it is run again, also after a promotion that was cut
off between two partitions. A key's stored rows may lie on another day than its change: they
are found by a scan of the key columns alone, unless ``fixed_dates`` says that a key never
changes its date. Rows without a date have a partition of their own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import as_date
from tidemark.operators.fingerprints import differing, leaf_of
from tidemark.operators.joins import anti, equi, semi
from tidemark.operators.quality import Gate, gated
from tidemark.operators.windows import latest
from tidemark.sources import mirror, upserts
from tidemark.sources.scratch import delete_folder, list_folders, written

PART = "part"  # the partition column; it is no column of the table's rows
UNDATED = "none"
FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


@dataclass(frozen=True)
class PartitionedTable:
    """Rows of one schema in folders by the day or month of a date column."""

    spark: SparkSession
    path: str
    schema: T.StructType
    date: str
    unit: str = "day"

    # ---- reading -----------------------------------------------------------------------

    def part_of(self, date: str | Column | None = None) -> Column:
        c = F.col(self.date if date is None else date) if not isinstance(date, Column) else date
        return F.coalesce(F.date_format(F.to_date(c), FORMATS[self.unit]), F.lit(UNDATED))

    def _label(self, day: dt.date) -> str:
        return day.strftime("%Y-%m-%d" if self.unit == "day" else "%Y-%m")

    def stored(self) -> list[str]:
        """The partitions there are, from the names of their folders."""
        return sorted(n.removeprefix(f"{PART}=") for n in list_folders(self.spark, self.path) if n.startswith(f"{PART}="))

    def read(self, parts: Sequence[str] | None = None, with_part: bool = False) -> DataFrame:
        """The rows, all of them or those of some partitions; the others are not listed or opened."""
        if not self.stored():
            df = self.spark.createDataFrame([], self.schema).withColumn(PART, F.lit(""))
        else:
            df = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(PART, T.StringType())])).parquet(self.path)
        if parts is not None:
            df = df.filter(F.col(PART).isin(list(parts)) if parts else F.lit(False))
        return df if with_part else df.select(*self.schema.names)

    def touched(self, rows: DataFrame, date: str | None = None) -> list[str]:
        """The partitions that the rows fall into; as many as there are days or months."""
        return sorted(r[0] for r in rows.select(self.part_of(date)).distinct().collect())

    def located(self, rows: DataFrame, keys: Sequence[str]) -> list[str]:
        """The partitions that hold stored rows with these keys, from the key columns alone."""
        held = semi(self.read(with_part=True).select(*keys, PART), rows, list(keys))
        return sorted(r[0] for r in held.select(PART).distinct().collect())

    # ---- writing -----------------------------------------------------------------------

    @classmethod
    def create(cls, rows: DataFrame, path: str, date: str, unit: str = "day") -> PartitionedTable:
        table = cls(rows.sparkSession, path, rows.schema, date, unit)
        table._write(rows.withColumn(PART, table.part_of()), "errorifexists")
        return table

    def _write(self, rows: DataFrame, mode: str) -> None:
        """A partition's rows come from few tasks, those of a large one from several."""
        (rows.hint("rebalance", F.col(PART)).write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd").partitionBy(PART).parquet(self.path))

    def put(self, rows: DataFrame, parts: Sequence[str], gates: Sequence[Gate] = ()) -> list[str]:
        """The partitions ``parts`` hold exactly ``rows`` from now on, provided that all gates pass.

        Rows outside the named partitions, or a failing gate, raise before anything is replaced."""
        parts = list(parts)
        if not parts:
            return []
        marked = rows.select(*self.schema.names).withColumn(PART, self.part_of())
        outside = Gate("rows outside the touched partitions", F.count_if(~F.col(PART).isin(parts)), lambda n: n == 0)
        staged = gated(marked, "touched", [outside, *gates])
        filled = {r[0] for r in staged.select(PART).distinct().collect()}
        if filled:
            self._write(staged, "overwrite")
        for part in set(parts) - filled:
            delete_folder(self.spark, f"{self.path}/{PART}={part}")
        return parts

    # ---- operations: each returns the partitions it replaced -----------------------------------

    def upsert(self, changes: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None,
               fixed_dates: bool = False, gates: Sequence[Gate] = ()) -> list[str]:
        """``upserts.upsert`` on the days that the changes and their stored keys lie on."""
        rows = changes if order is None else written(latest(changes, keys, order), "changes")
        parts = set(self.touched(rows)) | set([] if fixed_dates else self.located(rows, keys))
        return self.put(upserts.upsert(self.read(parts), rows, keys), sorted(parts), gates)

    def merge(self, changes: DataFrame, keys: Sequence[str], update: Sequence[str],
              order: Sequence[str | Column] | None = None, gates: Sequence[Gate] = ()) -> list[str]:
        """``upserts.merge``: a matched row stays on its stored day, a new one goes to its own."""
        if self.date in update:
            raise ValueError("a merge does not move rows between partitions; use upsert")
        rows = changes if order is None else written(latest(changes, keys, order), "changes")
        held = self.located(rows, keys)
        fresh = anti(rows, self.read(held), list(keys)) if held else rows
        parts = sorted({*held, *self.touched(fresh)})
        return self.put(upserts.merge(self.read(parts), rows, keys, update), parts, gates)

    def update_from(self, staging: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> list[str]:
        """``upserts.update_from`` on the days that hold the staged keys."""
        if self.date in columns:
            raise ValueError("an update does not move rows between partitions; use upsert")
        parts = self.located(staging, keys)
        return self.put(upserts.update_from(self.read(parts), staging, keys, columns), parts)

    def _between(self, first, last=None) -> list[str]:
        low, high = self._label(as_date(first)), None if last is None else self._label(as_date(last))
        return [p for p in self.stored() if p != UNDATED and p >= low and (high is None or p <= high)]

    def replace_window(self, extract: DataFrame, first, last=None, gates: Sequence[Gate] = ()) -> list[str]:
        """``upserts.window_replace`` on the stored days of the window and those of the extract."""
        parts = sorted({*self._between(first, last), *self.touched(extract)})
        return self.put(upserts.window_replace(self.read(parts), extract, self.date, first, last), parts, gates)

    def replace_months(self, extract: DataFrame) -> list[str]:
        """``upserts.month_replace``: the months present in the extract, as a whole."""
        own = self.touched(extract)
        months = {p[:7] for p in own if p != UNDATED}
        parts = sorted({*own, *(p for p in self.stored() if p[:7] in months)})
        return self.put(upserts.month_replace(self.read(parts), extract, self.date), parts)

    def replace_keys(self, extract: DataFrame, keys: Sequence[str]) -> list[str]:
        """``upserts.key_date_replace``: only the extract's days can change."""
        parts = self.touched(extract)
        return self.put(upserts.key_date_replace(self.read(parts), extract, keys, self.date), parts)

    def append_new(self, source: DataFrame) -> list[str]:
        """Source rows dated after the last stored one; only the last partition is read, none is rewritten
        but for that one's rows being kept together with the new ones."""
        dated = [p for p in self.stored() if p != UNDATED]
        top = self.read(dated[-1:]).agg(F.max(self.date)).first()[0] if dated else None
        fresh = source if top is None else source.filter(F.col(self.date) > F.lit(top))
        fresh = written(fresh.select(*self.schema.names), "new")
        parts = self.touched(fresh)
        return self.put(self.read(parts).unionByName(fresh), parts)

    def sync(self, source: DataFrame, keys: Sequence[str], updated: str, as_of, lookback_days: int | None = 45,
             floor=None, same_day: bool = False) -> list[str]:
        """A mirror run (``mirror.sync_table``) on the days of the changed rows, of their stored keys and of
        the look-back window."""
        as_of = as_date(as_of)
        changed = mirror.changed_since(self.date, updated, as_of, floor)
        changes = source.filter(changed)
        repair = None if lookback_days is None else as_of - dt.timedelta(days=lookback_days)
        parts = {*self.touched(changes), *self.located(changes, keys)}
        parts |= set(self._between(repair)) if repair is not None else set()
        parts |= set(self._between(as_of)) if same_day else set()
        parts = sorted(parts)
        return self.put(mirror.sync_table(source, self.read(parts), keys, self.date, updated, as_of, lookback_days, floor, same_day), parts)

    def reconcile(self, source: DataFrame, keys: Sequence[str], first, buckets: int = 64) -> DataFrame:
        """Rows dated from ``first`` on made equal to the source's, where their fingerprints differ.

        Days are compared first, then the key buckets of the differing days; only rows of differing buckets are
        replaced, only their partitions rewritten. Returns the differing leaves (``day``, ``bucket``,
        ``rows_a`` in the source, ``rows_b`` stored).
        """
        first = as_date(first)
        recent = F.col(self.date) >= F.lit(first)
        rows = source.filter(recent).select(*self.schema.names)
        held = self.read(self._between(first)).filter(recent)
        leaves = written(differing(rows, held, self.date, keys, buckets), "leaves")
        days = self.touched(leaves, "day")
        if not days:
            return leaves
        own = self.read(days)
        hit = leaves.select(F.col("day").alias("__day"), F.col("bucket").alias("__bucket"), F.lit(True).alias("__hit"))
        leaf = {f"__{n}": c for n, c in leaf_of(self.date, keys, buckets).items()}
        marks = lambda df: equi(df.withColumns(leaf), hit, ["__day", "__bucket"], "left")
        kept = marks(own).filter(F.col("__hit").isNull() | ~F.coalesce(recent, F.lit(False))).select(*self.schema.names)
        news = marks(rows.filter(self.part_of().isin(days))).filter(F.col("__hit").isNotNull()).select(*self.schema.names)
        self.put(kept.unionByName(news), days)
        return leaves

