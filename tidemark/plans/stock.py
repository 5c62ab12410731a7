"""Stock: daily position, cover, lots, restatement, purchase shortfall, lot receipts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.codes import label, replace_values
from tidemark.functions.dates import as_date
from tidemark.functions.numbers import by_unit, money, round_half_even, zero_sum
from tidemark.operators.filters import not_starting_with
from tidemark.operators.joins import equi, lookup, one_per_key
from tidemark.operators.quality import Gate, gated
from tidemark.operators.sets import union_by_name
from tidemark.sources.scratch import written
from tidemark.sources.upserts import window_replace

# One stock measure per warehouse class; callers with other class codes pass their own map.
CLASS_MEASURES = {"HDD": "in_transit", "CN": "branch_stock", "HCM": "city", "CENTRAL": "central",
                  "PARTNER": "partner", "ECE": "online"}
IN_TRANSIT_CLASS = "HDD"
# Factory stock kinds.
FACTORY_MEASURES = {"TP": "factory_finished", "BT": "factory_semi", "HH": "factory_goods",
                    "PO": "factory_ordered", "NO": "factory_owed"}
FACTORY_BRANCH = "NM"
NO_BRANCH = "NA"
# Products with this prefix are left out; labels of units.
SKIPPED_PREFIX = "V"
UNIT_LABELS = {"Hộp": "HOP", "Cái": "CAI"}
# Selling days behind a three-month average.
AVERAGE_DAYS = 90 - 13
# Purchase lines without a request number.
NO_REQUEST = "KHONGCOYCRH"

FEED = ["warehouse", "product", "name", "unit", "lot", "expiry", "virtual", "quantity", "feed"]


def stock_feeds(on_hand: DataFrame, receipts: DataFrame, transfers: DataFrame) -> DataFrame:
    """Stock by lot, pending purchase receipts and transfers in one schema.

    ``on_hand``: warehouse, product, name, unit, lot, expiry, quantity, held, pending
    (virtual stock = held + pending); ``receipts``: … state, kind; ``transfers``: the
    warehouse is the destination.
    """
    none = F.lit(0).cast("double")
    a = (on_hand.filter(not_starting_with("product", SKIPPED_PREFIX))
         .withColumn("virtual", F.coalesce("held", none) + F.coalesce("pending", none))
         .withColumn("feed", F.lit("stock")))
    b = (receipts.filter((F.col("state") == "pending") & (F.col("kind") == "purchase"))
         .withColumn("virtual", none).withColumn("feed", F.lit("pending")))
    c = transfers.withColumn("virtual", none).withColumn("feed", F.lit("pending"))
    return union_by_name([a, b, c]).select(*FEED)


def feeds_of(rows: DataFrame, kinds: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """``stock_feeds`` for rows of one source, in one pass: ``kinds`` maps the values of
    ``movement`` to ``stock``, ``receipt`` or ``transfer``; other columns as there."""
    kind = label("movement", kinds)
    receipt = (kind == "receipt") & (F.col("state") == "pending") & (F.col("kind") == "purchase")
    feed = (F.when((kind == "stock") & not_starting_with("product", SKIPPED_PREFIX), "stock")
            .when(receipt | (kind == "transfer"), "pending"))
    held = F.coalesce("held", F.lit(0.0)) + F.coalesce("pending", F.lit(0.0))
    return (rows.withColumn("feed", feed).filter(F.col("feed").isNotNull())
            .withColumn("virtual", F.when(F.col("feed") == "stock", held).otherwise(F.lit(0.0)))
            .select(*FEED, *keep))


def stock_position(feeds: DataFrame, warehouses: DataFrame, destroyed: Mapping[str, Sequence] | None = None,
                   factory: DataFrame | None = None, sheet: DataFrame | None = None,
                   classes: Mapping[str, str] = CLASS_MEASURES, by: Sequence[str] = ()) -> DataFrame:
    """One row per (product, branch), one measure per warehouse class.

    ``warehouses``: warehouse, branch, wh_class, receive_days. Warehouses without a class are
    dropped; pending feeds count as in transit; ``destroyed`` maps a measure to the warehouses
    it shows apart as well. ``sheet`` (product, branch, quantity) is stock in transit that is
    kept by hand; it takes names and receiving days from the position. ``factory``
    (product, name, unit, kind, quantity) goes under a branch of its own. ``by`` names
    columns of the feeds (a day) that each have a position of their own.
    """
    known = warehouses.filter(F.col("wh_class").isNotNull())
    rows = equi(feeds, known, "warehouse", "inner")
    cls = F.when(F.col("feed") == "pending", F.lit(IN_TRANSIT_CLASS)).otherwise(F.col("wh_class"))
    rows = (rows.withColumn("wh_class", cls).withColumn("unit", replace_values("unit", UNIT_LABELS))
            .withColumn("branch", F.coalesce("branch", F.lit(NO_BRANCH))))
    qty = money("quantity")
    measures = [zero_sum(F.when(F.col("wh_class") == code, qty).otherwise(F.lit(0))).alias(name)
                for code, name in classes.items()]
    measures += [zero_sum(F.when(F.col("warehouse").isin(*wh), qty).otherwise(F.lit(0))).alias(name)
                 for name, wh in (destroyed or {}).items()]
    keys = [*by, "product", "name", "unit", "branch", "receive_days"]
    out = rows.groupBy(*keys).agg(zero_sum(money("virtual")).alias("virtual"), *measures)
    if sheet is not None:
        out = written(out, "position")
        transit = (sheet.filter(F.col("product").isNotNull()).withColumn("branch", F.coalesce("branch", F.lit(NO_BRANCH)))
                   .groupBy("product", "branch").agg(zero_sum(qty).alias(classes[IN_TRANSIT_CLASS])))
        transit = equi(transit, one_per_key(out.select("product", "name", "unit"), "product"), "product", "left")
        transit = equi(transit, one_per_key(out.select("branch", "receive_days"), "branch"), "branch", "left")
        numbers = [c for c in out.columns if c not in keys]
        both = union_by_name([out, transit]).fillna(0, subset=["receive_days", *numbers])
        out = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in numbers])
    parts = [out]
    if factory is not None:
        parts.append(factory.groupBy("product", "name", "unit", F.lit(FACTORY_BRANCH).alias("branch")).agg(*[
            zero_sum(F.when(F.col("kind") == code, qty).otherwise(F.lit(0))).alias(name)
            for code, name in FACTORY_MEASURES.items()]))
    merged = union_by_name(parts)
    numbers = [c for c in merged.columns if c not in ("product", "name", "unit", "branch", *by)]
    return merged.fillna(0, subset=numbers)


def checked_position(position: DataFrame, keys: Sequence[str] = ("product", "branch")) -> DataFrame:
    """The position written once, provided (product, branch) is unique: a product of two names, units or
    receiving days in a branch is counted while the rows are written."""
    keys = list(keys)
    rest = [c for c in position.columns if c not in keys]
    row = F.struct(*rest)
    rows = position.groupBy(*keys).agg(F.max(row).alias("__row"), F.count(F.lit(1)).alias("__copies"))
    once = Gate(f"repeated {keys}", F.count_if(F.col("__copies") > 1), lambda n: n == 0)
    return gated(rows.select(*keys, "__row.*", "__copies"), "position", [once]).drop("__copies")


def three_month_sales(sales: DataFrame, warehouses: DataFrame, date: str, as_of) -> DataFrame:
    """Quantity of the last three months and its daily average, per product and branch."""
    first = F.add_months(F.lit(as_date(as_of)), -3)
    recent = sales.filter(F.col(date) >= first)
    by_branch = lookup(recent, warehouses, "warehouse", "warehouse", "branch")
    total = zero_sum(money("quantity"))
    return (by_branch.groupBy("product", "branch").agg(total.alias("sold"))
            .withColumn("sold", F.col("sold").cast("double"))
            .withColumn("average", round_half_even(F.col("sold") / F.lit(AVERAGE_DAYS), 0)))


def stock_cover(position: DataFrame, sales: DataFrame, total_of: Sequence[str]) -> DataFrame:
    """Total stock and the days it lasts at the three-month average."""
    out = equi(position, sales, ["product", "branch"], "left")
    out = out.withColumns({"sold": F.coalesce("sold", F.lit(0.0)), "average": F.coalesce("average", F.lit(0.0))})
    total = sum((F.col(c).cast("double") for c in total_of[1:]), F.col(total_of[0]).cast("double"))
    return (out.withColumn("total_stock", total)
            .withColumn("cover_days", round_half_even(F.try_divide(F.col("total_stock"), F.col("average")), 0)))


def stock_by_lot(feeds: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Quantities per product, branch, lot and expiry."""
    rows = lookup(feeds, warehouses, "warehouse", "warehouse", "branch", NO_BRANCH)
    return (rows.groupBy("product", "name", "unit", "branch", "lot", "expiry")
            .agg(zero_sum(money("quantity")).alias("quantity"), zero_sum(money("virtual")).alias("virtual")))


def restated_day(as_of) -> dt.date:
    """The day a snapshot is restated for: the day before, and on Mondays two days back."""
    as_of = as_date(as_of)
    return as_of - dt.timedelta(days=2 if as_of.weekday() == 0 else 1)


def restated_position(stored: DataFrame, position: DataFrame, sales: DataFrame, as_of) -> DataFrame:
    """Stored daily positions with the restated day's rows replaced.

    ``stored``: the position's columns with sold, average and ``created_date``; ``position`` is
    the day's, unique by product and branch; products without sales have sold nothing.
    """
    day = restated_day(as_of)
    fresh = equi(position, sales, ["product", "branch"], "left")
    fresh = fresh.withColumns({"sold": F.coalesce("sold", F.lit(0.0)), "average": F.coalesce("average", F.lit(0.0)),
                               "created_date": F.lit(day)})
    return window_replace(stored, fresh.select(*stored.columns), "created_date", day, day)


def purchase_shortfall(ordered: DataFrame, awaiting: DataFrame, keys: Sequence[str], request: str) -> DataFrame:
    """Ordered minus received minus awaiting receipt, where something is left.

    ``ordered``: keys, ordered, received; ``awaiting``: keys, quantity.
    """
    none = {request: NO_REQUEST}
    def named(df):
        return df.withColumn(request, F.when(F.col(request) == "", F.lit(NO_REQUEST)).otherwise(F.col(request))) \
            .fillna(none)
    waiting = named(awaiting).groupBy(*keys).agg(zero_sum(money("quantity")).alias("awaiting"))
    out = equi(named(ordered), waiting, list(keys), "left")
    out = out.withColumn("awaiting", F.coalesce("awaiting", F.lit(0)))
    return (out.withColumn("shortfall", money("ordered") - money("received") - F.col("awaiting"))
            .filter("shortfall > 0"))


def lot_receipts(lots: DataFrame, documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Received lots: quantity in the base unit times the document's sign, positive only."""
    out = equi(lots, documents, list(keys), "inner")
    return (out.withColumn("received", by_unit("qty", "unit_rate", "unit_op") * F.col("sign"))
            .filter("received > 0"))
