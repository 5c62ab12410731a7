"""Joins."""

from pyspark.sql import functions as F

from tidemark.catalog.base import dec, query, ymd
from tidemark.functions.dates import on_days
from tidemark.functions.numbers import money, zero_sum
from tidemark.functions.text import match_key
from tidemark.operators import joins as J
from tidemark.operators.aggregates import first_values
from tidemark.operators.windows import neighbour
from tidemark.plans.receivables import reversal_flags
from tidemark.sources.readers import literal_rows

REVENUE = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


def revenue():
    return money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))


def lines_of(t):
    """Order lines under the order's key name."""
    return t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")


@query("join_inner_star", f"""
    SELECT r_name, n_name, count(*) AS lines, CAST(sum({REVENUE}) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def join_inner_star(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    customers = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return (J.facts(lines_of(t), orders, "o_orderkey").groupBy("r_name", "n_name")
            .agg(F.count(F.lit(1)).alias("lines"), F.sum(revenue()).alias("revenue")))


@query("join_anti", """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (
        SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1997-04-01')""")
def join_anti(t):
    month = t.orders.filter(on_days("o_orderdate", "1997-03-01", "1997-03-31"))
    return J.anti(t.customer.withColumnRenamed("c_custkey", "o_custkey"), month, "o_custkey") \
        .select(F.col("o_custkey").alias("c_custkey"), "c_name")


@query("join_semi", """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
        SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1997-04-01')""")
def join_semi(t):
    month = t.orders.filter(on_days("o_orderdate", "1997-03-01", "1997-03-31"))
    return J.semi(t.customer.withColumnRenamed("c_custkey", "o_custkey"), month, "o_custkey") \
        .select(F.col("o_custkey").alias("c_custkey"), "c_name")


@query("join_theta_self", f"""
    SELECT o_orderkey, o_custkey, {ymd('o_orderdate')} AS o_orderdate,
           CAST(EXISTS (SELECT 1 FROM orders c WHERE c.o_orderstatus = 'F' AND c.o_custkey = o.o_custkey
                AND date_trunc('month', c.o_orderdate) = date_trunc('month', o.o_orderdate)
                AND c.o_orderdate = o.o_orderdate) AS BIGINT) AS same_day,
           CAST(EXISTS (SELECT 1 FROM orders c WHERE c.o_orderstatus = 'F' AND c.o_custkey = o.o_custkey
                AND date_trunc('month', c.o_orderdate) = date_trunc('month', o.o_orderdate)
                AND c.o_orderdate <> o.o_orderdate) AS BIGINT) AS other_day
    FROM orders o WHERE o_orderstatus = 'P'""")
def join_theta_self(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate"),
                        F.trunc("o_orderdate", "month").alias("invoice"))
    marked = reversal_flags(o.filter("o_orderstatus = 'P'"), o.filter("o_orderstatus = 'F'"),
                            ["o_custkey", "invoice"], "o_orderdate")
    return marked.select("o_orderkey", "o_custkey", "o_orderdate", "same_day", "other_day")


def _intervals(t):
    """Five-day validity intervals per event type, starting on three days of the month."""
    day = F.to_date("ts")
    return (t.events.filter(F.dayofmonth("ts").isin(1, 11, 21))
            .select("event_type", day.alias("start_day")).distinct()
            .filter("event_type <> 'error' or dayofmonth(start_day) = 1")
            .withColumn("end_day", F.date_add("start_day", 4)))


INTERVALS = """iv AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS start_day, CAST(ts AS DATE) + 4 AS end_day
    FROM events WHERE day(ts) IN (1, 11, 21) AND (event_type <> 'error' OR day(ts) = 1))"""


@query("join_range", f"""
    WITH {INTERVALS}
    SELECT event_id, e.event_type, {ymd('start_day')} AS start_day FROM events e JOIN iv
    ON e.event_type = iv.event_type AND CAST(e.ts AS DATE) BETWEEN start_day AND end_day""")
def join_range(t):
    out = J.range_join(t.events.select("event_id", "event_type", "ts"), _intervals(t), "event_type",
                       "ts", "start_day", "end_day", bucket_days=5)
    return out.select("event_id", "event_type", "start_day")


@query("join_range_nulling", f"""
    WITH {INTERVALS}
    SELECT event_id, e.event_type, {ymd('start_day')} AS start_day FROM events e LEFT JOIN iv
    ON e.event_type = iv.event_type AND CAST(e.ts AS DATE) BETWEEN start_day AND end_day""")
def join_range_nulling(t):
    out = J.range_join(t.events.select("event_id", "event_type", "ts"), _intervals(t), "event_type",
                       "ts", "start_day", "end_day", how="left", bucket_days=5)
    return out.select("event_id", "event_type", "start_day")


@query("join_groupwise_max", f"""
    SELECT event_id, user_id, event_type, {ymd('d')} AS d FROM (
        SELECT *, CAST(ts AS DATE) AS d,
               rank() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC) AS k FROM events)
    WHERE k = 1""")
def join_groupwise_max(t):
    e = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("d"))
    return J.groupwise_max(e, ["user_id", "event_type"], "d")


# Segment codes; one segment is left out on purpose.
SEGMENT_CODES = [("AUTOMOBILE", "AUT"), ("BUILDING", "BLD"), ("FURNITURE", "FUR"), ("HOUSEHOLD", "HOU")]


@query("join_lookup_default", f"""
    SELECT c_custkey, CASE c_mktsegment {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in SEGMENT_CODES)}
           ELSE 'OTHER' END AS code FROM customer""")
def join_lookup_default(t):
    codes = literal_rows(t.spark, SEGMENT_CODES, "segment string, code string")
    return J.lookup(t.customer, codes, "c_mktsegment", "segment", "code", "OTHER").select("c_custkey", "code")


@query("join_multi_alias", f"""
    SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS lines,
           CAST(sum({REVENUE}) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
    LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY ALL""")
def join_multi_alias(t):
    customers = J.alias_dimension(t.customer, t.nation, "c_nationkey", "n_nationkey", "customer_", ["n_name"])
    suppliers = J.alias_dimension(t.supplier, t.nation, "s_nationkey", "n_nationkey", "supplier_", ["n_name"])
    orders = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = J.facts(lines_of(t), orders, "o_orderkey").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return (lines.groupBy(F.col("customer_n_name").alias("customer_nation"),
                          F.col("supplier_n_name").alias("supplier_nation"))
            .agg(F.count(F.lit(1)).alias("lines"), F.sum(revenue()).alias("revenue")))


@query("join_key_transform", """
    WITH b AS (SELECT DISTINCT upper(p_brand) AS k, p_brand AS brand_name FROM part WHERE p_brand <> 'Brand#9')
    SELECT p_partkey, brand_name FROM part LEFT JOIN b ON upper(trim(p_brand)) = b.k""")
def join_key_transform(t):
    brands = (t.part.filter("p_brand <> 'Brand#9'").select("p_brand").distinct()
              .select(match_key(F.concat(F.lit("  "), F.lower("p_brand"), F.lit(" "))).alias("__k"),
                      F.col("p_brand").alias("brand_name")))
    parts = t.part.withColumn("__k", match_key("p_brand"))
    return J.equi(parts, brands, "__k", "left").select("p_partkey", "brand_name")


@query("join_list_membership", """
    WITH w AS (SELECT DISTINCT p_brand, string_split(p_name, ' ')[1] AS word FROM part),
         r AS (SELECT DISTINCT p_brand, p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
    SELECT w.p_brand, w.word, p_partkey FROM w JOIN r USING (p_brand, word)""")
def join_list_membership(t):
    """Parts of a brand that have one of the brand's first words anywhere in the list of words, their name."""
    words = t.part.select("p_brand", F.substring_index("p_name", " ", 1).alias("word")).distinct()
    return J.membership(words, t.part.select("p_brand", "p_partkey", "p_name"), "p_brand", "word", "p_name", sep=" ")


@query("join_conditional_left", """
    SELECT o_orderkey, o_custkey, c_name FROM orders
    LEFT JOIN customer ON c_custkey = o_custkey AND c_nationkey = o_custkey % 25 AND c_mktsegment = 'BUILDING'""")
def join_conditional_left(t):
    left = t.orders.select("o_orderkey", "o_custkey", (F.col("o_custkey") % 25).cast("int").alias("nation"))
    right = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"),
                              "c_name", "c_mktsegment")
    out = J.left_where(left, right, ["o_custkey", "nation"], F.col("c_mktsegment") == "BUILDING")
    return out.select("o_orderkey", "o_custkey", "c_name")


@query("join_checked_marker", """
    SELECT c_custkey, n_name, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'both' ELSE 'left_only' END AS "_merge"
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def join_checked_marker(t):
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = J.checked(t.customer, nations, "c_nationkey")
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return J.mark(customers, orders, "c_custkey").select("c_custkey", "n_name", "_merge")


@query("join_coalesce_lead", f"""
    SELECT o_orderkey, {ymd('next_date')} AS next_date, coalesce(status, o_orderstatus) AS status,
           {ymd('as_of')} AS as_of
    FROM (SELECT o_orderkey, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_date,
                 nullif(o_orderstatus, 'P') AS status, o_orderstatus, (SELECT max(o_orderdate) FROM orders) AS as_of
          FROM orders)""")
def join_coalesce_lead(t):
    o = t.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    copy = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    out = neighbour(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderdate"],
                    F.to_date("o_orderdate"), "next_", forward=True)
    out = J.fill_from(out, copy, "o_orderkey", ["status"])
    as_of = t.orders.agg(F.max("o_orderdate")).scalar()
    return out.select("o_orderkey", F.to_date("next_o_orderdate").alias("next_date"), "status",
                      F.to_date(as_of).alias("as_of"))
