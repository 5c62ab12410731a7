"""Receivables: reversed orders, event ledger, balance, due dates, owners, overdue classes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.codes import (CARRIER_UNIT, DELIVERED, WITH_CARRIER, delivery_status,
                                      payment_class)
from tidemark.functions.dates import NO_DATE, as_date, duration_text, minutes_between, on_days
from tidemark.functions.numbers import col, flag, money, zero_sum
from tidemark.operators.aggregates import all_members
from tidemark.operators.filters import blank
from tidemark.operators.joins import anti, equi, facts, lookup, one_per_key
from tidemark.operators.sets import union_by_name
from tidemark.operators.windows import islands, latest_two
from tidemark.sources.scratch import written

# The ledger's amount columns, one per event.
AMOUNTS = ("opening_amt", "released_amt", "delivered_amt", "received_amt",
           "returned_amt", "confirmed_amt", "confirmed_released_amt")
# Legs a returned order leaves.
LEFT_WHEN_RETURNED = ("delivered_amt", "received_amt", "confirmed_amt", "confirmed_released_amt")
# Terms that run 30 days from the document date.
MONTH_TERMS = "O1"
MONTH_DAYS = 30
# Orders before this day belong to the opening balance.
OPENING_BEFORE = dt.date(2021, 5, 1)
# Open balances up to this amount are not chased.
BALANCE_FLOOR = 1000
# Owner classes by sub-channel; labels of terms, owners and due states.
CASH_CHANNELS = ("NT", "PK", "SI", "SI23", "PCL", "CTD", "PMC")
IMMEDIATE_CHANNELS = ("CHUOI", "NTC", "CCD", "ECOM")
INSTITUTION_CHANNELS = ("INS1", "INS2", "INS3")
IMMEDIATE, ON_CREDIT = "Thanh Toán Ngay", "Cho nợ"
OWNER_SALES, OWNER_INSTITUTION, OWNER_DEFAULT = "MDS", "INS", "CS"
DUE, NOT_DUE = "Đã tới hạn", "Chưa tới hạn"


# ---- reversed orders -------------------------------------------------------------------

def reversal_flags(orders: DataFrame, counterparts: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """For each order: is there a counterpart under the same invoice on the same / on another day?

    The same day means cancelled, another day returned. Only the counterpart's days per
    invoice are needed, a set no larger than the calendar, so no order pairs are formed
    however many orders share an invoice, and either side is read once.
    """
    keys = list(keys)
    day = F.to_date(date)
    days = counterparts.groupBy(*keys).agg(F.collect_set(day).alias("__days"))
    out = facts(orders, days, keys, "left")
    same = F.array_contains("__days", day)
    other = F.size("__days") > F.when(same, 1).otherwise(0)
    return (out.withColumn("same_day", F.coalesce(same, F.lit(False)))
            .withColumn("other_day", F.coalesce(other & day.isNotNull() & F.col("__days").isNotNull(), F.lit(False)))
            .select(*orders.columns, "same_day", "other_day"))


def cancelled_and_returned(credits: DataFrame, originals: DataFrame, keys: Sequence[str],
                           date: str) -> tuple[DataFrame, DataFrame]:
    """Originals cancelled on their own day, and originals returned on another day."""
    marked = reversal_flags(originals, credits, keys, date)
    return (marked.filter("same_day").drop("same_day", "other_day"),
            marked.filter("other_day").drop("same_day", "other_day"))


# ---- ledger ----------------------------------------------------------------------------

def terms_due(terms: str, doc_date: str, due: str) -> Column:
    return F.when(F.col(terms) == MONTH_TERMS, F.date_add(F.to_date(doc_date), MONTH_DAYS)) \
        .otherwise(F.to_date(due))


def ledger_leg(df: DataFrame, amount: str, value: str | Column, event_date: str | Column,
               columns: Sequence[str]) -> DataFrame:
    """One event in the common schema: its amount in its own column, the others 0."""
    if amount not in AMOUNTS:
        raise ValueError(f"unknown amount column {amount}")
    value = F.col(value) if isinstance(value, str) else value
    event = F.to_date(event_date)
    zero = F.lit(0).cast("decimal(18,2)")
    return df.select(*columns, event.alias("event_date"),
                     *[(F.coalesce(money(value), zero) if a == amount else zero).alias(a) for a in AMOUNTS])


def ledger_from_orders(orders: DataFrame, legs: Mapping[str, tuple[Column, Column, Column]],
                       columns: Sequence[str]) -> DataFrame:
    """All events of a frame that holds one row per order, in one pass.

    ``legs`` maps an amount column to (condition, value, event date). An order gives one
    row per leg whose condition holds, without scanning or joining the order again.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    events = []
    for name, (condition, value, event) in legs.items():
        if name not in AMOUNTS:
            raise ValueError(f"unknown amount column {name}")
        row = F.struct(F.lit(name).alias("leg"), F.to_date(event).alias("event_date"),
                       *[(F.coalesce(money(value), zero) if a == name else zero).alias(a) for a in AMOUNTS])
        events.append(F.when(condition, row))
    return orders.select(*columns, F.inline(F.array(*events))).filter(F.col("leg").isNotNull())


def receivables_ledger(legs: Mapping[str, DataFrame], flags: DataFrame, order_keys: Sequence[str],
                       invoice_keys: Sequence[str] | None = None,
                       stored: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Legs from separate sources in one table, reversed orders removed.

    Each leg is its stored base plus the recent rows. ``flags`` is the result of
    ``reversal_flags``: the reversed orders are matched once for all legs. Invoice keys, when
    they differ, decide about the confirmations' returned orders.
    """
    rows = []
    for amount, leg in legs.items():
        leg = union_by_name([stored[amount], leg]) if stored and amount in stored else leg
        rows.append(leg.withColumn("leg", F.lit(amount)))
    by_order = list(order_keys)
    hit = reversed_orders(flags, by_order)
    out = equi(union_by_name(rows), hit, by_order, "left")
    if invoice_keys and list(invoice_keys) != by_order:
        by_invoice = hit.filter("returned").toDF(*invoice_keys, "__c", "__invoice_returned").drop("__c")
        out = equi(out, by_invoice, list(invoice_keys), "left")
        returned = F.when(F.col("leg").startswith("confirmed"), F.col("__invoice_returned")).otherwise(F.col("returned"))
        out = out.withColumn("returned", returned).drop("__invoice_returned")
    return out.filter(leg_counts("leg", "cancelled", "returned")).drop("cancelled", "returned")


# Order types whose documents are receivables; state of finished orders, deliveries and batches.
LEDGER_TYPES = ("CO", "DI", "DM", "DP", "IN", "IR", "LO", "OO", "UP")
FINISHED, VOIDED, RECEIVABLES = "C", "V", "AR"
DOCUMENT = ("branch", "ar_batch", "ar_ref")
LEDGER_COLUMNS = ("branch", "order_nbr", "om_order", "cust_id", "staff", "unit", "invoice", "note", "terms", "order_date",
                  "due_date", "payment", "delivery_time", "reason")


@dataclass(frozen=True)
class LedgerSources:
    """The tables that the legs are made of.

    ``orders``: branch, order_nbr, om_order, cust_id, order_date, order_type, status, payment, ar_batch, ar_ref;
    ``documents``: branch, ar_batch, ar_ref, invoice, note, terms, doc_date, doc_due, amount;
    ``batches``: branch, ar_batch, module, batch_status; ``allocations``: branch, order_nbr, ar_batch, alloc_staff;
    ``books``: branch, order_nbr, staff, unit, book_status; ``deliveries``: branch, order_nbr, created, updated, status;
    ``confirmations``: invoice, note, branch, ar_batch, ar_ref, created, received, reason_code;
    ``reasons``: reason_code, reason; ``adjustments``: branch, own_batch, ar_batch, ar_ref, paid_batch, paid_ref, created,
    paid_date, amount, reversal.
    """

    orders: DataFrame
    documents: DataFrame
    batches: DataFrame
    allocations: DataFrame
    books: DataFrame
    deliveries: DataFrame
    confirmations: DataFrame
    reasons: DataFrame
    adjustments: DataFrame


def billed_orders(s: LedgerSources) -> DataFrame:
    """Orders with their receivables document: batches of the receivables module, terms and due date."""
    own = s.batches.filter(F.col("module") == RECEIVABLES).select("branch", "ar_batch").distinct()
    documents = equi(s.documents, own, ["branch", "ar_batch"], "inner").withColumn("due_date", terms_due("terms", "doc_date", "doc_due"))
    return facts(s.orders, documents, list(DOCUMENT)).withColumns({
        "delivery_time": F.lit(""), "reason": F.lit(""), "staff": F.lit(None).cast("string"), "unit": F.lit("")})


def recent(df: DataFrame, date: str, as_of, days: int = 7) -> DataFrame:
    """Rows of the last ``days`` days up to the as-of day."""
    last = as_date(as_of)
    return df.filter(on_days(date, last - dt.timedelta(days=days - 1), last))


@dataclass(frozen=True)
class LedgerRows:
    """What the legs are taken from, joined: billed orders, and of the finished ones their deliveries, the
    receipts of these, and their adjustments."""

    billed: DataFrame
    delivered: DataFrame
    received: DataFrame
    paid: DataFrame


def ledger_rows(s: LedgerSources, stage: bool = False) -> LedgerRows:
    """The joins of the legs' tables. Orders and documents are joined once for all legs; with ``stage`` the
    others are computed once too, for a caller that takes legs from them more than once."""
    kept = written if stage else lambda df, name: df
    order = ["branch", "order_nbr"]
    billed = written(billed_orders(s), "billed-orders")
    done = billed.filter((F.col("status") == FINISHED) & F.col("order_type").isin(*LEDGER_TYPES))
    allocated = one_per_key(s.allocations, [*order, "ar_batch"])
    books = one_per_key(s.books, order)

    finished = books.filter(F.col("book_status") == FINISHED).drop("book_status")
    steps = s.deliveries.filter(F.col("status") == FINISHED).drop("status")
    delivered = equi(done.drop("staff", "unit", "status"), allocated.select(*order, "ar_batch"), [*order, "ar_batch"], "left_semi")
    delivered = facts(facts(delivered, finished, order), steps, order)
    delivered = kept(delivered.select(*LEDGER_COLUMNS, "ar_batch", "ar_ref", "amount", "created", "updated"), "ledger-delivered")

    named = equi(s.confirmations, one_per_key(s.reasons, "reason_code"), "reason_code", "left")
    named = named.withColumn("reason", F.coalesce("reason", F.lit(""))).withColumnRenamed("created", "confirmed_at")
    received = facts(delivered.drop("reason", "created", "updated"), named.drop("reason_code"), ["invoice", "note", *DOCUMENT])

    live = s.adjustments.filter(blank(F.coalesce("reversal", F.lit(""))))
    live = equi(live, s.documents.select("branch", F.col("ar_batch").alias("paid_batch"), F.col("ar_ref").alias("paid_ref")).distinct(),
                ["branch", "paid_batch", "paid_ref"], "left_semi")
    own = s.batches.filter(F.col("module") == RECEIVABLES).select("branch", F.col("ar_batch").alias("own_batch"), "batch_status")
    live = equi(live, one_per_key(own, ["branch", "own_batch"]), ["branch", "own_batch"], "inner").withColumnRenamed("amount", "adjusted")
    charged = facts(done.drop("staff", "unit"), allocated, [*order, "ar_batch"])
    charged = equi(charged, books.drop("book_status"), order, "left").withColumns({
        "staff": F.coalesce("staff", "alloc_staff"), "unit": F.coalesce("unit", F.lit(""))})
    paid = facts(charged, live, list(DOCUMENT))
    return LedgerRows(billed, delivered, kept(received.select(*LEDGER_COLUMNS, "received", "confirmed_at"), "ledger-received"),
                      kept(paid.select(*LEDGER_COLUMNS, "adjusted", "created", "paid_date", "batch_status"), "ledger-paid"))


def ledger_legs(s: LedgerSources | LedgerRows, opening_before=OPENING_BEFORE, as_of=None, days: int = 7) -> dict[str, DataFrame]:
    """The seven legs from their tables, without the reversed orders' removal; with ``as_of`` the rows of the
    last days only, which are united with a stored base (``receivables_ledger(stored=…)``)."""
    r = ledger_rows(s) if isinstance(s, LedgerSources) else s

    def leg(rows, name, value, event):
        rows = rows if as_of is None else recent(rows, event, as_of, days)
        return ledger_leg(rows, name, value, event, LEDGER_COLUMNS)

    early = F.to_date("order_date") < F.lit(as_date(opening_before))
    receivable = F.col("order_type").isin(*LEDGER_TYPES)
    timed = r.delivered.withColumn("delivery_time", duration_text(minutes_between("created", "updated")))
    credits = r.billed.filter((F.col("status") == FINISHED) & ~receivable)
    return {"opening_amt": leg(r.billed.filter(early), "opening_amt", "amount", "order_date"),
            "released_amt": leg(r.billed.filter(~early & receivable), "released_amt", "amount", "order_date"),
            "delivered_amt": leg(timed, "delivered_amt", "amount", "updated"),
            "received_amt": leg(r.received, "received_amt", "received", "confirmed_at"),
            "returned_amt": leg(credits, "returned_amt", "amount", "order_date"),
            "confirmed_amt": leg(r.paid.filter(F.col("batch_status") != VOIDED), "confirmed_amt", "adjusted", "created"),
            "confirmed_released_amt": leg(r.paid.filter(F.col("batch_status") == FINISHED), "confirmed_released_amt", "adjusted", "paid_date")}


def reversed_orders(flags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Orders that are cancelled or returned, one row each."""
    return (flags.filter("same_day or other_day").groupBy(*keys)
            .agg(F.bool_or("same_day").alias("cancelled"), F.bool_or("other_day").alias("returned")))


def leg_counts(leg: str | Column, cancelled: str | Column, returned: str | Column) -> Column:
    """Does an event count? Cancelled orders leave every leg, returned ones the deliveries,
    receipts and confirmations."""
    cancelled, returned = (F.coalesce(col(c), F.lit(False)) for c in (cancelled, returned))
    return ~cancelled & ~(returned & col(leg).isin(*LEFT_WHEN_RETURNED))


def zero_account(leg: DataFrame, adjustments: DataFrame, keys: Sequence[str], account: str,
                 amount: str, closed: str = "711") -> DataFrame:
    """Option: confirmations booked on the given account count 0."""
    hit = adjustments.filter(F.col(account) == closed).select(*keys).distinct().withColumn("__hit", F.lit(True))
    out = equi(leg, hit, list(keys), "left")
    return out.withColumn(amount, F.when(F.col("__hit"), F.lit(0)).otherwise(F.col(amount))).drop("__hit")


def terms_type(due_type: str | Column, interval: str | Column) -> Column:
    """One or two days' terms mean immediate payment, anything else credit."""
    now = (col(due_type) == "D") & col(interval).isin(1, 2)
    return F.when(now, F.lit(IMMEDIATE)).otherwise(F.lit(ON_CREDIT))


def owner_by_rule(df: DataFrame, rules: DataFrame, keys: Sequence[str], owner: str,
                  name: str = "owner") -> DataFrame:
    """Owner from the terms x payment rule table, default for combinations not listed."""
    side = rules.groupBy(*keys).agg(F.max(owner).alias("__owner"))
    out = equi(df, side, list(keys), "left")
    return out.withColumn(name, F.coalesce("__owner", F.lit(OWNER_DEFAULT))).drop("__owner")


def drop_flagged(df: DataFrame, exclusions: DataFrame, keys: Sequence[str], flag_col: str) -> DataFrame:
    """Rows whose combination carries a non-empty flag in the exclusion table are removed."""
    return anti(df, exclusions.filter(F.col(flag_col).isNotNull()), list(keys))


def receivables_by_order(ledger: DataFrame, keys: Sequence[str], first_dates: Sequence[str] = (),
                         last_dates: Sequence[str] = ()) -> DataFrame:
    """Amounts summed per order, with a presence flag per amount."""
    sums = ledger.groupBy(*keys).agg(
        *[zero_sum(money(a)).alias(a) for a in AMOUNTS],
        *[F.min(d).alias(d) for d in first_dates], *[F.max(d).alias(d) for d in last_dates])
    return sums.withColumns({"has_" + a.removesuffix("_amt"): flag(a) for a in AMOUNTS})


def with_payment_class(df: DataFrame, payment: str) -> DataFrame:
    return df.withColumn(payment, payment_class(payment))


def exclusive_orders(lines: DataFrame, keys: Sequence[str], item: str, items: Sequence) -> DataFrame:
    """Orders made of listed products only."""
    return all_members(lines, keys, item, items).filter("all_members").drop("all_members")


def override_terms(orders: DataFrame, exclusive: DataFrame, keys: Sequence[str], terms: str,
                   value: str) -> DataFrame:
    hit = exclusive.select(*keys).distinct().withColumn("__hit", F.lit(True))
    out = equi(orders, hit, list(keys), "left")
    return out.withColumn(terms, F.when(F.col("__hit"), F.lit(value)).otherwise(F.col(terms))).drop("__hit")


# ---- rolling due date ------------------------------------------------------------------

def rolling_due_date(orders: DataFrame, part: Sequence[str], date: str, terms_days: int = 30,
                     chunk: int = 2, name: str = "due_date", max_gap_days: int = 1) -> DataFrame:
    """Due date under "the next delivery pays the previous one".

    Order days of a customer with gaps of at most a day form a chain; a chain is cut into
    groups of ``chunk`` days. An order is due after ``terms_days``, but not later than the
    first day of the customer's next group, whichever chain that is in.

    Orders collapse to customer days first: the windows see calendar days only, and all of
    them share one shuffle. Orders get the day's result by an equi join.
    """
    part = list(part)
    due = rolling_days(orders, part, date, terms_days, chunk, max_gap_days, name)
    return equi(orders.withColumn("__day", F.to_date(date)), due, [*part, "__day"], "left",
                null_safe=True).drop("__day")


def rolling_days(orders: DataFrame, part: Sequence[str], date: str, terms_days: int, chunk: int,
                 max_gap_days: int, name: str) -> DataFrame:
    """The due date of each customer day (columns: part, ``__day``, name)."""
    days = orders.select(*part, F.to_date(date).alias("__day")).distinct()
    chained = islands(days, part, "__day", max_gap_days, "__island", "__n")
    starts = F.when((F.col("__n") - 1) % chunk == 0, F.col("__day"))
    # Backwards in time the days ahead are a growing frame, which is kept in one step per row.
    ahead = W.partitionBy(*part).orderBy(F.col("__day").desc()).rowsBetween(W.unboundedPreceding, -1)
    return chained.select(*part, "__day",
                          F.least(F.date_add("__day", terms_days), F.min(starts).over(ahead)).alias(name))


def due_dates(orders: DataFrame, part: Sequence[str], date: str, balance: str, terms: str,
              rolling_terms: str, due: str) -> DataFrame:
    """Rolling due date for open orders under one terms class; others keep their own.

    One row per order. The frame is used twice (for the customer days and for the orders),
    so a caller with a long plan behind it should hand in a written table.
    """
    candidate = (F.col(terms) == rolling_terms) & (F.col(balance) > 0)
    days = rolling_days(orders.filter(candidate), part, date, MONTH_DAYS, 2, 1, "__rolled")
    marked = orders.withColumn("__day", F.when(candidate, F.to_date(date)))
    out = equi(marked, days, [*part, "__day"], "left")
    return out.withColumn(due, F.coalesce("__rolled", F.col(due))).drop("__rolled", "__day")


# ---- owners ----------------------------------------------------------------------------

def assign_owner(orders: DataFrame, by_area: DataFrame, by_customer: DataFrame, by_staff: DataFrame,
                 fallback: str) -> DataFrame:
    """Person in charge: the staff member's manager for sales-owned orders (fallback when
    unknown); else the area's person, overridden per customer.

    ``orders``: owner, staff, staff_name, area, customer; the dimensions: key, name.
    """
    out = lookup(orders, by_staff, "staff", "key", "name", fallback, name="__manager")
    out = lookup(out, by_area, "area", "key", "name", name="__area")
    out = lookup(out, by_customer, "customer", "key", "name", name="__customer")
    manager = (F.when(F.col("owner") == OWNER_SALES, F.col("__manager"))
               .when(F.col("owner") == OWNER_DEFAULT, F.coalesce("__customer", "__area"))
               .otherwise(F.col("__area")))
    out = out.withColumn("manager", manager)
    in_charge = F.when(F.col("owner") == OWNER_SALES, F.col("staff_name")).otherwise(F.col("manager"))
    return out.withColumn("in_charge", in_charge).drop("__manager", "__area", "__customer")


def owner_class(sub_channel: str, payment: str, terms: str) -> Column:
    """Owner of a balance: cash channels to sales, institutions to theirs, the rest to service."""
    cash = F.col(payment) == "TM"
    sales = (F.col(sub_channel).isin(*CASH_CHANNELS) & cash) | (
        F.col(sub_channel).isin(*IMMEDIATE_CHANNELS) & (F.col(terms) == IMMEDIATE) & cash)
    return (F.when(sales, F.lit(OWNER_SALES))
            .when(F.col(sub_channel).isin(*INSTITUTION_CHANNELS), F.lit(OWNER_INSTITUTION))
            .otherwise(F.lit(OWNER_DEFAULT)))


# ---- balance ---------------------------------------------------------------------------

def last_delivery(deliveries: DataFrame, order_keys: Sequence[str], sequence: str, status: str,
                  updated: str) -> DataFrame:
    """Label and time of each order's last delivery step (the latest one among equal steps)."""
    last = deliveries.groupBy(*order_keys).agg(last_step(sequence, status, updated).alias("__last"))
    return last.select(*order_keys, *delivery_of("__last"))


def last_step(sequence: str | Column, status: str | Column, updated: str | Column) -> Column:
    """Aggregate: the last delivery step, for a frame that is grouped by order anyway."""
    return F.max(F.struct(col(sequence).alias("n"), col(updated).alias("at"), col(status).alias("status")))


def delivery_of(step: str) -> list[Column]:
    """Time and label of a step, null without one."""
    label = F.when(F.col(step).isNotNull(), delivery_status(f"{step}.status"))
    return [F.col(f"{step}.at").alias("delivery_time"), label.alias("delivery_status")]


def open_balance() -> Column:
    """What an order still owes."""
    return (F.col("opening_amt") + F.col("released_amt") - F.col("returned_amt")
            - F.col("confirmed_released_amt"))


def order_balance(by_order: DataFrame, delivery: DataFrame | None, order_keys: Sequence[str],
                  order_date: str, unit: str) -> DataFrame:
    """Open balance and delivery state per order; without ``delivery`` the orders carry its columns.

    A carrier's orders count as delivered unless something came back, and carry their own
    status; orders of the opening balance without a unit count as delivered on their day.
    """
    carrier = F.coalesce(F.col(unit) == CARRIER_UNIT, F.lit(False))
    old = F.col(unit).isNull() & (F.col(order_date) < F.lit(OPENING_BEFORE))
    on_order_day = F.col(order_date).cast("timestamp_ntz")
    both = by_order if delivery is None else facts(by_order, delivery, list(order_keys), "left")
    out = both.withColumns({
        "delivered_amt": F.when(carrier & (F.col("returned_amt") == 0), F.col("released_amt")).otherwise(F.col("delivered_amt")),
        "has_delivered": F.when(carrier & (F.col("has_returned") == 0), F.lit(1)).otherwise(F.col("has_delivered")),
        "delivery_status": F.when(carrier, F.lit(WITH_CARRIER)).when(old, F.lit(DELIVERED)).otherwise(F.col("delivery_status")),
        "delivery_time": F.when(carrier | old, on_order_day)
        .otherwise(F.coalesce("delivery_time", F.lit(NO_DATE).cast("timestamp_ntz"))),
        "balance": open_balance()})
    return out.withColumns({
        "is_open": flag("balance"),
        "undelivered": F.col("has_released") - F.col("has_delivered") - F.col("has_returned"),
        "undelivered_amt": F.col("released_amt") - F.col("delivered_amt") - F.col("returned_amt")})


# ---- overdue ---------------------------------------------------------------------------

@dataclass(frozen=True)
class ImmediateTerms:
    """Labels of the immediate-payment terms, by the days an undelivered order is given."""

    two_days: tuple[str, ...]
    one_day: tuple[str, ...]

    @property
    def all(self) -> tuple[str, ...]:
        return (*self.two_days, *self.one_day)


def collection_due(terms: str, status: str, delivered_at: str, ordered_on: str, due: str,
                   rules: ImmediateTerms) -> Column:
    """Day a balance falls due: the day after delivery under immediate terms; two or one day
    after the order while undelivered; the document's due date otherwise."""
    done = F.col(status) == DELIVERED
    return (F.when(done & F.col(terms).isin(*rules.all), F.date_add(F.to_date(delivered_at), 1))
            .when(~done & F.col(terms).isin(*rules.two_days), F.date_add(F.to_date(ordered_on), 2))
            .when(~done & F.col(terms).isin(*rules.one_day), F.date_add(F.to_date(ordered_on), 1))
            .otherwise(F.to_date(due)))


def overdue_rows(balances: DataFrame, as_of, rules: ImmediateTerms, exclude_staff: Sequence[str] = ()) -> DataFrame:
    """Open balances of the sales owners with the day they fall due (``due_on``) and ``due_state``.

    ``balances``: owner_class, balance, staff, terms, delivery_status, delivery_time,
    order_date, due_date.
    """
    open_ = balances.filter((F.col("owner_class") == OWNER_SALES) & (F.col("balance") > BALANCE_FLOOR))
    if exclude_staff:
        open_ = open_.filter(~F.col("staff").isin(*exclude_staff))
    due = collection_due("terms", "delivery_status", "delivery_time", "order_date", "due_date", rules)
    state = F.when(F.col("due_on") <= F.lit(as_date(as_of)), F.lit(DUE)).otherwise(F.lit(NOT_DUE))
    return open_.withColumn("due_on", due).withColumn("due_state", state)


def overdue_detail(balances: DataFrame, notes: DataFrame, staff: DataFrame, as_of, rules: ImmediateTerms,
                   customer: str, exclude_staff: Sequence[str] = ()) -> DataFrame:
    """The overdue rows one by one, with the customer's latest two visit notes and the names of
    the people in charge.

    ``notes``: customer, noted_at, note (a total order of a customer's notes); ``staff``: staff
    and the columns to show, one row per staff member.
    """
    rows = overdue_rows(balances, as_of, rules, exclude_staff)
    last = latest_two(notes, [customer], ["noted_at", "note"], "note")
    return equi(facts(rows, last, customer, "left"), one_per_key(staff, "staff"), "staff", "left")


def overdue_classes(balances: DataFrame, as_of, rules: ImmediateTerms, keys: Sequence[str],
                    exclude_staff: Sequence[str] = ()) -> DataFrame:
    """Open balances by due class; the input of ``overdue_rows``."""
    return (overdue_rows(balances, as_of, rules, exclude_staff).groupBy(*keys, "due_state")
            .agg(zero_sum(money("balance")).alias("balance"), F.count(F.lit(1)).alias("orders")))
