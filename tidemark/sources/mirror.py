"""Mirror jobs: keep a copy of a changing source table.

``sync_table`` covers the change pull with key replace, the repair of rows deleted at the
source, the same-day variant and the reload of a window that does not reconcile.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date
from tidemark.operators.joins import facts
from tidemark.operators.quality import reconcile
from tidemark.sources.scratch import written
from tidemark.sources.upserts import window_replace


@dataclass(frozen=True)
class MirrorSpec:
    """How one table is kept in step."""

    keys: tuple[str, ...]
    repair_days: int | None = None   # look-back of the deleted-row repair
    reload_days: int | None = None   # window reloaded when counts differ
    same_day: bool = False           # today's rows replaced as a whole first
    only: str | None = None          # row condition at the source
    reconcile_by: tuple[str, ...] = ()  # columns the window's row counts are compared by


# Key, repair and reload windows of the mirrored tables.
MIRRORS = {
    "ar_adjust": MirrorSpec(("branchid", "batnbr", "adjdrefnbr", "adjgrefnbr"), 45, 180),
    "ar_adjust_detail": MirrorSpec(("branchid", "batnbr", "adjdrefnbr", "adjgrefnbr", "lineref"), 45, 90),
    "ar_doc": MirrorSpec(("branchid", "batnbr", "refnbr"), 45, 180),
    "batch": MirrorSpec(("branchid", "module", "batnbr"), 45, 180, only="module = 'AR'"),
    "customer_location": MirrorSpec(("branchid", "custid", "visittime"), 45, 90),
    "debt_allocation": MirrorSpec(("branchid", "batnbr", "invcnbr", "ordernbr", "arbatnbr"), 45, 90),
    "delivery_history": MirrorSpec(("branchid", "batnbr", "ordernbr", "shiptime"), 45, 90,
                                   only="status in ('A', 'D')"),
    "delivery_history_done": MirrorSpec(("branchid", "batnbr", "ordernbr", "shiptime"), 45, 90,
                                        only="status = 'C'"),
    "delivery": MirrorSpec(("branchid", "batnbr", "ordernbr", "sequence"), 45, 90),
    "issue_book": MirrorSpec(("branchid", "batnbr"), 15, 90),
    "issue_book_det": MirrorSpec(("branchid", "batnbr", "ordernbr"), 15, 90),
    "presale_order": MirrorSpec(("branchid", "ordernbr"), 15, 90),
    "sales_order": MirrorSpec(("branchid", "ordernbr"), 15, 90),
    "presale_order_det": MirrorSpec(("branchid", "ordernbr", "lineref"), None, 90, same_day=True),
    "sales_order_det": MirrorSpec(("branchid", "ordernbr", "lineref"), None, 90, same_day=True),
    "invoice": MirrorSpec(("branchid", "refnbr"), None, 90, same_day=True),
    "lot_trans": MirrorSpec(("branchid", "ordernbr", "lotsernbr", "omlineref"), None, 90, same_day=True),
    "order_errors": MirrorSpec(("branchid", "ordernbr"), None, 90, same_day=True),
    "carrier_keys": MirrorSpec(("branchid", "batnbr"), None, 90),
}
WORKING_HOURS = range(6, 23)
LOOKBACK_DAYS = 45


def lookback_start(now: dt.datetime, working: Sequence[int] = WORKING_HOURS,
                   days: int = LOOKBACK_DAYS) -> dt.date:
    """Today during working hours, ``days`` back otherwise."""
    return now.date() if now.hour in working else now.date() - dt.timedelta(days=days)


def changed_since(created: str, updated: str, as_of, floor=None) -> Column:
    """Rows updated on the as-of day or later, created on the floor day or later."""
    out = F.col(updated) >= F.lit(as_date(as_of))
    return F.coalesce(out if floor is None else out & (F.col(created) >= F.lit(as_date(floor))), F.lit(False))


def next_state(target: DataFrame, source: DataFrame, keys: Sequence[str], created: str, changed: Column,
               repair_from: dt.date | None) -> DataFrame:
    """Changed rows replace their keys, and rows created since ``repair_from`` that the source
    no longer has are removed.

    One join: the source's changed and recent keys, each with two marks, against the target.
    """
    keys = list(keys)
    recent = F.lit(False) if repair_from is None else F.coalesce(F.col(created) >= F.lit(repair_from), F.lit(False))
    marks = (source.filter(changed | recent).groupBy(*keys)
             .agg(F.bool_or(changed).alias("__changed"), F.bool_or(recent).alias("__recent")))
    kept = facts(target, marks, keys, "left").filter(
        ~F.coalesce("__changed", F.lit(False)) & (~recent | F.coalesce("__recent", F.lit(False))))
    return kept.select(*target.columns).unionByName(source.filter(changed).select(*target.columns))


def reload_window(target: DataFrame, source: DataFrame, created: str, start) -> DataFrame:
    return window_replace(target, source.filter(F.col(created) >= F.lit(as_date(start))), created, start)


def differs(target: DataFrame, source: DataFrame, created: str, start, by: Sequence[str]) -> bool:
    """Do the row counts since ``start`` differ for any value of ``by``?"""
    recent = F.col(created) >= F.lit(as_date(start))
    return not reconcile(source.filter(recent), target.filter(recent), by).isEmpty()


def sync_table(source: DataFrame, target: DataFrame, keys: Sequence[str], created: str, updated: str,
               as_of, lookback_days: int | None = 45, floor=None, same_day: bool = False,
               reload_days: int | None = None, reconcile_by: Sequence[str] = (),
               force: bool = False) -> DataFrame:
    """New state of the copy after one run.

    1. ``same_day``: rows created on the as-of day are dropped, so that rows created and
       deleted at the source on that day vanish.
    2. Changed rows replace their keys.
    3. Rows of the look-back window whose key the source lost are dropped.
    4. With ``reload_days``, the window is reloaded when forced or when its row counts, by
       the columns of ``reconcile_by``, still differ. The state is staged for that.
    """
    as_of = as_date(as_of)
    kept = target
    if same_day:
        kept = target.filter((F.col(created) < F.lit(as_of)) | F.col(created).isNull())
    repair_from = None if lookback_days is None else as_of - dt.timedelta(days=lookback_days)
    state = next_state(kept, source, keys, created, changed_since(created, updated, as_of, floor), repair_from)
    if reload_days is not None:
        start = as_of - dt.timedelta(days=reload_days)
        state = written(state, "mirror")
        if force or differs(state, source, created, start, reconcile_by):
            state = reload_window(state, source, created, start)
    return state


def sync_mirror(name: str, source: DataFrame, target: DataFrame, created: str, updated: str, as_of,
                **options) -> DataFrame:
    """``sync_table`` under a named table's rules."""
    spec = MIRRORS[name]
    if spec.only:
        source = source.filter(spec.only)
    return sync_table(source, target, spec.keys, created, updated, as_of,
                      lookback_days=spec.repair_days, same_day=spec.same_day,
                      reload_days=spec.reload_days, **{"reconcile_by": spec.reconcile_by, **options})


def full_refresh(source: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The whole source becomes the copy."""
    return source.select(*columns) if columns else source
