"""Sales reports: fact enrichment, raw lines to fact, programmes, run rate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.codes import payment_class
from tidemark.functions.dates import (NO_DATE, as_date, calendar, month_name3, month_start,
                                      parse_date, workdays)
from tidemark.functions.numbers import by_unit, money, zero_sum
from tidemark.operators.filters import blank
from tidemark.operators.joins import anti, equi, facts, lookup, membership, one_per_key
from tidemark.operators.quality import assert_unique, gated, no_nulls
from tidemark.operators.sets import union_by_name
from tidemark.sources.scratch import written
from tidemark.sources.upserts import window_replace
from tidemark.sources.writers import audited

# Sign of a document by its type; every other type is a return.
PLUS_TYPES = ("IN", "DM", "CS")
NEUTRAL_TYPES = ("NA",)
# Orders whose number starts with this text are credits.
CREDIT_PREFIX = "CO"


@dataclass(frozen=True)
class Lookup:
    """One dictionary column: ``name = dim[key -> value][on]``, default for unknown keys."""

    dim: DataFrame
    on: str
    key: str
    value: str
    name: str
    default: object = None


def enrich_sales(sales: DataFrame, lookups: Sequence[Lookup], document_date: str,
                 date_texts: Sequence[str] = (), fill_dates: Sequence[str] = (),
                 payment: str | None = None, as_of=None) -> DataFrame:
    """Dates parsed, missing dates filled, lookups applied, month and payment class derived."""
    out = sales.withColumns({c: parse_date(c) for c in date_texts})
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(NO_DATE)) for c in fill_dates})
    for item in lookups:
        out = lookup(out, item.dim, item.on, item.key, item.value, item.default, name=item.name)
    out = out.withColumn("month", month_start(document_date))
    if payment:
        out = out.withColumn(payment, payment_class(payment))
    return out if as_of is None else audited(out, as_of)


def refresh_sales(stored: DataFrame, enriched: DataFrame, date: str, first,
                  unique: Sequence[str] = ()) -> DataFrame:
    """The last days of the stored fact replaced; optionally only if the key is there and unique."""
    if unique:  # computed once; measured while it is written
        enriched = assert_unique(gated(enriched, "refresh", [no_nulls(unique)]), unique)
    return window_replace(stored, enriched, date, first)


def type_sign(doc_type: str | Column) -> Column:
    c = F.col(doc_type) if isinstance(doc_type, str) else doc_type
    return F.when(c.isin(*PLUS_TYPES), 1).when(c.isin(*NEUTRAL_TYPES), 0).otherwise(-1)


def sales_lines(headers: DataFrame, lines: DataFrame, lots: DataFrame, types: DataFrame,
                keys: Sequence[str] = ("branch_id", "order_nbr")) -> DataFrame:
    """Order lines with lots, signed quantity and signed amounts (free items count 0).

    ``headers``: keys, order_type …; ``lines``: keys, line_ref, line_qty, free_item,
    before_vat_price, before_vat_amount, vat_amount, after_vat_amount;
    ``lots``: keys, line_ref, lot, qty; ``types``: order_type, doc_type.
    A line delivered from several lots gives one row per lot. ``revenue`` is the lot's signed
    quantity at the line price; the line's own amounts are repeated on each of its lots.
    """
    keys = list(keys)
    out = facts(headers, lines, keys)
    out = facts(out, lots.withColumnRenamed("qty", "lot_qty"), [*keys, "line_ref"], "left")
    return signed_lines(equi(out, types, "order_type", "left"))


def signed_lines(rows: DataFrame) -> DataFrame:
    """Signs of ``sales_lines`` on rows that hold ``doc_type``, ``lot``, ``lot_qty`` and a line's columns."""
    sign = type_sign("doc_type")
    free = F.coalesce(F.col("free_item"), F.lit(False))
    charged = F.when(free, F.lit(0)).otherwise(sign)
    return (rows.withColumn("lot", F.coalesce("lot", F.lit("")))
            .withColumn("quantity", sign * F.coalesce("lot_qty", "line_qty"))
            .withColumn("revenue", F.when(free, F.lit(0)).otherwise(
                money("quantity") * money("before_vat_price")).cast("decimal(24,4)"))
            .withColumns({c: charged * money(c) for c in
                          ("before_vat_amount", "vat_amount", "after_vat_amount")})
            .drop("lot_qty", "line_qty"))


_FOLDS = {"sum": F.sum, "max": F.max, "any": F.bool_or}


def lines_by_lot(movements: DataFrame, keys: Sequence[str], line: Mapping[str, str], total: str = "line_qty") -> DataFrame:
    """Lines and their lots from one frame of movements, read once.

    ``movements``: keys, line_ref, lot, from_lot, qty and the columns of ``line``, which tells how each is
    put together over its line (``sum``, ``max`` or ``any``). A line has one row per lot of its
    movements from lots, with ``lot_qty``; a line without any has one row without a lot. Lines, not orders, are
    kept together: movements are dealt by line once, added up by lot there, and meet their line where they are.
    The last of ``keys`` is the order number.
    """
    key = [*keys, "line_ref"]
    # By order and line alone: a constant among the other keys would leave the grouping, not the partitioning.
    base = movements.repartition(keys[-1], "line_ref").groupBy(*key, "lot", "from_lot").agg(
        F.sum("qty").alias("__qty"), *[_FOLDS[how](c).alias(c) for c, how in line.items()])
    of_line = W.partitionBy(*key)
    out = base.withColumns({
        **{c: _FOLDS[how](c).over(of_line) for c, how in line.items()}, total: F.sum("__qty").over(of_line),
        "__lots": F.bool_or("from_lot").over(of_line), "__place": F.row_number().over(of_line.orderBy("lot"))})
    out = out.filter(F.col("from_lot") | (~F.col("__lots") & (F.col("__place") == 1)))
    return out.withColumns({"lot": F.when(F.col("from_lot"), F.col("lot")), "lot_qty": F.when(F.col("from_lot"), F.col("__qty"))}) \
        .drop("from_lot", "__lots", "__place", "__qty")


def with_books(headers: DataFrame, books: DataFrame, keys: Sequence[str], returned: str, columns: Sequence[str]) -> DataFrame:
    """The issue book of each order; where a column of it is blank, that of the order it returns.

    ``books``: keys, columns; the last of ``keys`` is the order number, ``returned`` names the header's
    column with the number of the returned order. A missing book stays missing: only a blank text is filled.
    """
    own, keys = list(columns), list(keys)
    side = one_per_key(books.select(*keys, *own).dropna(subset=keys), keys)
    out = equi(headers, side, keys, "left")
    back = side.withColumnsRenamed({keys[-1]: returned, **{c: f"__back_{c}" for c in own}})
    out = equi(out, back, [*keys[:-1], returned], "left")
    return out.withColumns({c: F.when(blank(c), F.col(f"__back_{c}")).otherwise(F.col(c)) for c in own}).drop(*[f"__back_{c}" for c in own])


def raw_to_fact(regular: DataFrame, replacement: DataFrame | None, returned: DataFrame,
                names: Sequence[tuple[str, str]] = (),
                order_keys: Sequence[str] = ("branch_id", "order_nbr")) -> DataFrame:
    """Regular and replacement lines united, blank names filled, returned orders removed.

    ``names`` lists (column, fallback): a blank value is taken from the fallback column.
    """
    out = regular if replacement is None else union_by_name([regular, replacement], distinct=True)
    out = out.withColumns({c: F.when(blank(c), F.col(f)).otherwise(F.col(c)) for c, f in names})
    return anti(out, returned, list(order_keys))


def programme_paid(orders: DataFrame, keys: Sequence[str], order_nbr: str, amount: str) -> DataFrame:
    """Paid amount per registration: credit orders count negative."""
    amt = money(amount)
    value = F.when(F.col(order_nbr).startswith(CREDIT_PREFIX), -amt).otherwise(amt)
    return orders.groupBy(*keys).agg(zero_sum(value).alias("paid_amount"))


def programme_progress(registrations: DataFrame, results: DataFrame, orders: DataFrame,
                       customer: str, programme: str, order_nbr: str, amount: str) -> DataFrame:
    """Registrations with their stored result and paid amount, all programmes in one job."""
    keys = [programme, customer]
    out = equi(registrations, results, keys, "left")
    out = equi(out, programme_paid(orders, keys, order_nbr, amount), keys, "left")
    return out.withColumn("paid_amount", F.coalesce("paid_amount", F.lit(0)))


def line_value(apply_type: str | Column = "A") -> Column:
    """Value of an order line in a programme: its amount, or its quantity in the base unit."""
    kind = F.lit(apply_type) if isinstance(apply_type, str) else apply_type
    amount = (money("qty") * money("price")).cast("decimal(24,4)")
    return F.when(kind == "A", amount).otherwise(by_unit("qty", "unit_rate", "unit_op").cast("decimal(24,4)"))


def accumulation_detail(lines: DataFrame, accumulated: DataFrame, discounts: DataFrame, order_keys: Sequence[str],
                        apply_type: str | Column = "A") -> DataFrame:
    """Programme detail: sale orders not yet accumulated, and return orders with minus sign.

    ``lines``: order keys, line_ref, kind (``sale`` or ``return``), qty, price, unit_rate,
    unit_op; ``discounts``: order keys, disc_id, disc_amount, line_list. A discount counts
    once, rounded, if its list names at least one of the kind's lines. Lines are read once,
    into one row per order, kind and line.
    """
    keys = list(order_keys)
    done = accumulated.select(*keys).distinct().withColumn("__done", F.lit(True))
    per_line = lines.groupBy(*keys, "kind", "line_ref").agg(F.sum(line_value(apply_type)).alias("__value"))
    counted = facts(per_line, done, keys, "left").filter((F.col("kind") == "return") | F.col("__done").isNull())
    staged = written(counted.drop("__done"), "programme-lines")
    sign = F.when(F.col("kind") == "return", -1).otherwise(1)
    values = staged.groupBy(*keys, "kind").agg(zero_sum("__value").alias("value"))
    hit = membership(staged.select(*keys, "kind", "line_ref"), discounts, keys, "line_ref", "line_list")
    once = hit.select(*keys, "kind", "disc_id", "disc_amount").distinct()
    off = once.groupBy(*keys, "kind").agg(zero_sum(F.round(money("disc_amount"), 0)).alias("discount"))
    out = facts(values, off, [*keys, "kind"], "left")
    return out.select(*keys, (F.col("value") * sign).cast("decimal(24,4)").alias("value"),
                      (F.coalesce("discount", F.lit(0)) * sign).alias("discount"), "kind")


def run_rate(sales: DataFrame, item_keys: Sequence[str], date: str, quantity: str, as_of) -> DataFrame:
    """Quantity per item and month, the running month projected to its full working days.

    ``projected``: quantity / elapsed working days * working days of the month, rounded,
    while days are left; the plain quantity for finished months.
    ``history``: the running month shows the mean of the year's earlier months (0 if none),
    any other month its own quantity. Last year's rows are tagged ``ACT LY``.
    """
    as_of = as_date(as_of)
    keys = list(item_keys)
    # Sales are read once: a row per item and month is staged, and serves the calendar too.
    monthly = written(sales.groupBy(*keys, month_start(date).alias("month"))
                      .agg(zero_sum(money(quantity)).alias("quantity")), "monthly")
    bounds = monthly.agg(F.min("month").alias("first"), F.last_day(F.max("month")).alias("last"))
    days = workdays(calendar(bounds, "first", "last"), as_of)
    running = F.lit(as_of.replace(day=1))
    year_start = F.lit(as_of.replace(month=1, day=1))
    earlier = (monthly.filter((F.col("month") >= year_start) & (F.col("month") < running))
               .groupBy(*keys).agg(F.sum("quantity").alias("__s"), F.count("quantity").alias("__n"))
               .select(*keys, F.round(F.col("__s").cast("double") / F.col("__n"), 0).alias("earlier_mean")))
    out = equi(equi(monthly, days, "month", "left"), earlier, keys, "left", null_safe=True)
    qty = F.col("quantity").cast("double")
    return out.select(
        *keys, "month", month_name3("month").alias("month_name"),
        F.when(F.year("month") < as_of.year, F.lit("ACT LY")).otherwise(F.lit("ACT TY")).alias("data_type"),
        qty.alias("quantity"),
        F.when(F.col("elapsed_days") < F.col("month_days"),
               F.round(F.try_divide(qty, F.col("elapsed_days")) * F.col("month_days"), 0))
        .otherwise(qty).alias("projected"),
        F.when(F.col("month") == running, F.coalesce("earlier_mean", F.lit(0.0)))
        .otherwise(qty).alias("history"))
