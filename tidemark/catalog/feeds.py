"""Feeds: payloads whose fields change, pages that come late, table functions, streams with deletes."""

import datetime as dt
import json
from pathlib import Path

from pyspark.sql import functions as F

from tidemark.catalog.base import dec, query, ymd, ymdhms
from tidemark.catalog.maintenance import FILES_PER_BATCH
from tidemark.functions import nested
from tidemark.operators.sets import union_by_name
from tidemark.sources import pages, readers
from tidemark.sources.scratch import run_folder
from tidemark.streaming import change_log


@query("payload_evolving", f"""
    SELECT event_id AS id, event_type AS kind, CASE WHEN ts >= DATE '2024-01-15' THEN round(value, 2) END AS price,
           CASE WHEN ts >= DATE '2024-01-15' THEN user_id END AS buyer_id,
           CASE WHEN ts >= DATE '2024-01-15' AND event_id % 3 = 0 THEN 'u' || user_id END AS buyer_name
    FROM events UNION ALL SELECT NULL, NULL, NULL, NULL, NULL FROM events WHERE event_id % 100 = 0""")
def payload_evolving(t):
    """Landed JSON lines: later files bring a price and a nested buyer, some lines are no JSON at all."""
    folder = run_folder(t.spark, "payloads")
    e = t.events
    early = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind")))
    name = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("u"), "user_id"))
    late = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.round("value", 2).alias("price"),
                              F.struct(F.col("user_id").alias("id"), name.alias("name")).alias("buyer")))
    turn = F.lit(dt.date(2024, 1, 15))
    e.filter(F.col("ts") < turn).select(early.alias("value")).write.text(f"{folder}/1")
    e.filter(F.col("ts") >= turn).select(late.alias("value")).write.text(f"{folder}/2")
    e.filter("event_id % 100 = 0").select(F.lit("no {json").alias("value")).write.text(f"{folder}/3")
    lines = union_by_name([readers.read_lines(t.spark, f"{folder}/{i}") for i in (1, 2, 3)])
    flat = nested.variant_columns(nested.with_variant(lines, "value").drop("value"), "payload")
    return flat.select("id", "kind", F.col("price").cast("double").alias("price"), "buyer_id", "buyer_name")


@query("payload_rows", f"""
    SELECT l_orderkey AS order_nbr, CAST(l_linenumber AS BIGINT) AS line, CAST({dec('l_quantity')} AS DOUBLE) AS qty,
           CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS note FROM lineitem WHERE l_orderkey % 10 = 0""")
def payload_rows(t):
    """Orders with an array of lines as payload: one row per line, an optional field of it by name."""
    line = F.struct(F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("qty"),
                    F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")).alias("note"))
    # A payload holds a line and its neighbour is another payload of the order, so no list grows with an order.
    raw = t.lineitem.filter("l_orderkey % 10 = 0").select(F.col("l_orderkey").alias("order_nbr"), F.to_json(F.struct(F.array(line).alias("lines"))).alias("value"))
    rows = nested.variant_rows(nested.with_variant(raw, "value").drop("value"), "payload", "$.lines")
    return nested.variant_fields(rows, "payload", {"line": ("$.line", "bigint"), "qty": ("$.qty", "double"), "note": ("$.note", "string")}) \
        .drop("payload")


PAGE_ROWS = 200


@query("paged_source", f"SELECT s_suppkey, s_name, CAST({dec('s_acctbal')} AS DOUBLE) AS s_acctbal FROM supplier")
def paged_source(t):
    """Pages landed by a service; every fourth one comes empty at first and is fetched again."""
    folder = run_folder(t.spark, "service")
    size = 7 if t.supplier.count() < 1000 else PAGE_ROWS
    numbered = t.supplier.select((F.floor(F.col("s_suppkey") / size) + 1).cast("int").alias("page"), "s_suppkey", "s_name", "s_acctbal")
    numbered.repartition("page").write.partitionBy("page").json(folder)
    total, root = t.supplier.count(), folder.removeprefix("file:")

    def fetch(page: int, attempt: int):
        if page % 4 == 0 and attempt == 0:
            return total, []
        lines = [json.loads(x) for f in sorted(Path(root, f"page={page}").glob("*.json")) for x in f.read_text().splitlines()]
        return total, [(r["s_suppkey"], r["s_name"], r["s_acctbal"]) for r in lines]

    return pages.read_pages(t.spark, fetch, "s_suppkey bigint, s_name string, s_acctbal double", size)


@query("report_function", f"""
    SELECT o_orderkey, {ymd('o_orderdate')} AS o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate >= DATE '1998-02-03' AND o_orderdate < DATE '1998-02-21' AND o_orderstatus = 'F'""")
def report_function(t):
    """A stored procedure with (from, to, status) as a table function."""
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    name = readers.report_function(t.spark, "order_report", rows, "o_orderdate", [("wanted", "STRING")],
                                   "o_orderstatus = order_report.wanted")
    out = t.spark.sql(f"SELECT o_orderkey, o_orderdate, o_totalprice FROM {name}(DATE '1998-02-03', DATE '1998-02-20', 'F')")
    return out.withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("sync_stream_deletes", f"""
    SELECT user_id, event_type, event_id, {ymdhms('ts')} AS ts, value FROM events
    WHERE event_id % 10 <> 3 OR ts >= DATE '2024-01-08'
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
        AND NOT (event_id % 10 = 3 AND ts >= DATE '2024-01-08')""")
def sync_stream_deletes(t):
    """Changes, each delivered twice, and delete notices as one stream of log rows."""
    columns, keys, order = ["event_id", "ts", "user_id", "event_type", "value"], ["user_id", "event_type"], ["ts", "event_id"]
    events = t.events.select(*columns)
    base = events.filter(F.col("ts") < F.lit(dt.date(2024, 1, 10))).filter("event_id % 10 <> 3")
    later = events.filter(F.col("ts") >= F.lit(dt.date(2024, 1, 8)))
    folder = run_folder(t.spark, "deletes")
    changes = later.filter("event_id % 10 <> 3").withColumn("dt", F.to_date("ts"))
    changes.unionByName(changes).write.partitionBy("dt").parquet(f"{folder}/changes")
    later.filter("event_id % 10 = 3").select(*keys, *order).write.parquet(f"{folder}/notices")
    streams = [change_log.read_changes(t.spark, f"{folder}/{name}", t.spark.read.parquet(f"{folder}/{name}").schema, FILES_PER_BATCH)
               for name in ("changes", "notices")]
    rows = change_log.with_deletes(streams[0].drop("dt"), streams[1], keys, order)
    rows = change_log.drop_repeats(rows, [*keys, "event_id"], "ts", "60 days")
    change_log.write_change_log(rows, f"{folder}/log", f"{folder}/checkpoint", keys, order).awaitTermination()
    return change_log.current_state(base, t.spark.read.parquet(f"{folder}/log"), keys, order)
