"""Field activity: visit compliance, lead times, check-ins, routes, delivery state."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.codes import label
from tidemark.functions.dates import as_date, minutes_between, month_start, on_days
from tidemark.functions.numbers import percent
from tidemark.functions.text import none_if_blank
from tidemark.operators.joins import equi, groupwise_max, range_join, span_of

# Days before the end of a licence that count as expiring.
EXPIRING_DAYS = 30
# Types of check-ins and check-outs, and the prefix of delivery events.
VISIT_TYPE = "IO"
CHECK_OUT_TYPE = "OO"
DELIVERY_PREFIX = "DE"


def reporting_month(as_of) -> dt.date:
    """First day of the month shown: the previous month on the 1st."""
    as_of = as_date(as_of)
    shown = as_of - dt.timedelta(days=1) if as_of.day == 1 else as_of
    return shown.replace(day=1)


def visit_compliance(planned: DataFrame, visits: DataFrame, licences: DataFrame, as_of,
                     all_months: bool = False) -> DataFrame:
    """Per salesperson and month: planned and unvisited customers, licences, order ratio.

    ``planned``: staff, customer, visit_date (live route rows); ``visits``: staff, customer,
    visit_date, checkin_id, order_id; ``licences``: customer, licence_end. Counts missing on
    one side are 0.
    """
    as_of = as_date(as_of)
    keys = ["staff", "month"]
    if not all_months:
        first = reporting_month(as_of)
        last = (first + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(days=1)
        planned, visits = (d.filter(on_days("visit_date", first, last)) for d in (planned, visits))
    plan = planned.select("staff", "customer", month_start("visit_date").alias("month")).distinct()
    seen = visits.withColumn("month", month_start("visit_date"))
    per_customer = seen.groupBy(*keys, "customer").agg(F.count("checkin_id").alias("__checkins"))
    unvisited = (per_customer.filter("__checkins = 0").groupBy(*keys)
                 .agg(F.count(F.lit(1)).alias("unvisited")))
    end = F.to_date("licence_end")
    licensed = equi(plan, licences, "customer", "inner").select(
        *keys, "customer",
        F.when(end < F.lit(as_of), 1).otherwise(0).alias("__gone"),
        F.when((end > F.lit(as_of)) & (end <= F.lit(as_of + dt.timedelta(days=EXPIRING_DAYS))), 1)
        .otherwise(0).alias("__soon"))
    licence = (licensed.groupBy(*keys, "customer").agg(F.max("__gone").alias("__gone"), F.max("__soon").alias("__soon"))
               .groupBy(*keys).agg(F.sum("__gone").alias("expired"), F.sum("__soon").alias("expiring")))
    work = seen.groupBy(*keys).agg(F.count_distinct("order_id").alias("orders"),
                                   F.count_distinct("checkin_id").alias("checkins"))
    work = work.withColumn("order_ratio", percent("orders", "checkins"))
    out = plan.groupBy(*keys).agg(F.count(F.lit(1)).alias("planned"))
    for side in (unvisited, licence, work):
        out = equi(out, side, keys, "left")
    return out.fillna(0, ["unvisited", "expired", "expiring", "orders", "checkins", "order_ratio"])


def lead_times(df: DataFrame, steps: Mapping[str, tuple[str, str]],
               ordered: tuple[str, str] | None = None) -> DataFrame:
    """Minutes between fulfilment steps; rows with ``ordered`` times out of order are dropped."""
    out = df.withColumns({name: minutes_between(a, b) for name, (a, b) in steps.items()})
    return out if ordered is None else out.filter(minutes_between(*ordered) >= 0)


def checkin_trace(trace: DataFrame, keys: Sequence[str] = ("branch_id", "staff", "visit_nbr")) -> DataFrame:
    """Visits with the delivery events of the same visit number.

    ``trace``: keys, customer, type, time. Delivery events carry the order number after
    their type prefix.
    """
    visits = trace.filter(F.col("type") == VISIT_TYPE).withColumnRenamed("time", "checkin_time")
    events = (trace.filter(F.col("type").startswith(DELIVERY_PREFIX))
              .select(*keys, F.substring("type", len(DELIVERY_PREFIX) + 1, 18).alias("order_nbr"),
                      F.col("time").alias("delivery_time")))
    return equi(visits, events, list(keys), "left")


def check_rows(trace: DataFrame) -> DataFrame:
    """Check-ins and check-outs of a location trace, with ``check_type``; other events go."""
    return trace.filter(F.col("type").isin(VISIT_TYPE, CHECK_OUT_TYPE)).withColumn("check_type", F.col("type"))


def visit_notes(notes: DataFrame, labels: Mapping[str, str], image_prefix: str) -> DataFrame:
    """Visit notes with the label of their type and the full address of their image.

    ``notes``: type, image and anything else; a blank image stays null.
    """
    image = none_if_blank("image")
    return notes.withColumns({"type_label": label("type", labels, keep_unknown=True),
                              "image": F.concat(F.lit(image_prefix), image)})


def planned_routes(visits: DataFrame, staff_terms: DataFrame, validity: DataFrame) -> DataFrame:
    """Route visits within the staff assignment and the customer's validity interval.

    ``visits``: route, customer, freq, visit_date; ``staff_terms``: route, staff, from_date,
    to_date; ``validity``: route, customer, freq, start_date, end_date.
    """
    span = span_of(visits, "visit_date")
    out = range_join(visits, staff_terms, ["route"], "visit_date", "from_date", "to_date", span=span)
    out = range_join(out, validity, ["route", "customer", "freq"], "visit_date", "start_date", "end_date", span=span)
    return out.select("route", "customer", "freq", "visit_date", "staff").distinct()


def delivery_state(deliveries: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last delivery step with the last ship date, or the step's own time when none is known."""
    last = groupwise_max(deliveries, list(keys), "sequence")
    shipped = history.groupBy(*keys).agg(F.max("ship_date").alias("__shipped"))
    out = equi(last, shipped, list(keys), "left")
    return out.withColumn("ship_date", F.coalesce("__shipped", "created")).drop("__shipped").distinct()
