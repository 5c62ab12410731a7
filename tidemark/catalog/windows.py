"""Latest rows, order-dependent columns, chains of days."""

from pyspark.sql import functions as F

from tidemark.catalog.base import dec, query, ymd, ymdhms
from tidemark.functions.numbers import money
from tidemark.operators import windows as Win
from tidemark.plans.receivables import rolling_due_date


@query("win_latest", f"""
    SELECT user_id, event_id, event_type, {ymdhms('ts')} AS ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def win_latest(t):
    return Win.latest(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"])


@query("win_latest_two", """
    SELECT user_id, CAST(max(event_id) FILTER (n = 1) AS BIGINT) AS event_id_1,
           CAST(max(event_id) FILTER (n = 2) AS BIGINT) AS event_id_2
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
    GROUP BY user_id""")
def win_latest_two(t):
    return Win.latest_two(t.events, ["user_id"], ["ts", "event_id"], "event_id")


@query("win_first_and_group_value", f"""
    SELECT event_type, user_id, event_id, {ymdhms('first_ts')} AS first_ts FROM (
        SELECT *, min(ts) OVER (PARTITION BY user_id) AS first_ts,
               row_number() OVER (PARTITION BY user_id, event_type ORDER BY value, event_id) AS n FROM events)
    WHERE n = 1""")
def win_first_and_group_value(t):
    e = Win.group_value(t.events, ["user_id"], F.min("ts"), "first_ts")
    return Win.earliest(e, ["user_id", "event_type"], ["value", "event_id"]) \
        .select("event_type", "user_id", "event_id", "first_ts")


@query("win_running", f"""
    SELECT o_orderkey, row_number() OVER w AS position,
           CAST(sum({dec('o_totalprice')}) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running,
           CAST(date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS BIGINT) AS gap_days
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def win_running(t):
    keys, order, bucket = ["o_custkey"], ["o_orderdate", "o_orderkey"], F.to_date("o_orderdate")
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", money("o_totalprice").alias("price"))
    out = Win.ordered(o, keys, order, bucket, sums={"position": F.lit(1), "running": "price"},
                      previous={"previous_date": "o_orderdate"})
    return out.select("o_orderkey", "position", "running",
                      F.datediff("o_orderdate", "previous_date").alias("gap_days"))


@query("win_islands", f"""
    WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
         g AS (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY o_custkey ORDER BY d) > 90 THEN 1 ELSE 0 END AS gap FROM d),
         i AS (SELECT *, sum(gap) OVER (PARTITION BY o_custkey ORDER BY d ROWS UNBOUNDED PRECEDING) AS island FROM g)
    SELECT o_custkey, CAST(island AS BIGINT) AS island, {ymd('min(d)')} AS first_day, {ymd('max(d)')} AS last_day,
           count(*) AS days FROM i GROUP BY o_custkey, island""")
def win_islands(t):
    days = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("d")).distinct()
    return (Win.islands(days, ["o_custkey"], "d", 90, position="n").groupBy("o_custkey", "island")
            .agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.max("n").alias("days")))


@query("win_rolling_due_date", f"""
    WITH o AS (SELECT o_orderkey, c_nationkey, CAST(o_orderdate AS DATE) AS d
               FROM orders JOIN customer ON o_custkey = c_custkey),
         d AS (SELECT DISTINCT c_nationkey, d FROM o),
         g AS (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY c_nationkey ORDER BY d) > 1 THEN 1 ELSE 0 END AS gap FROM d),
         i AS (SELECT *, sum(gap) OVER (PARTITION BY c_nationkey ORDER BY d) AS island FROM g),
         p AS (SELECT *, (row_number() OVER (PARTITION BY c_nationkey, island ORDER BY d) - 1) // 2 AS pair FROM i),
         f AS (SELECT c_nationkey, island, pair, min(d) AS first_day FROM p GROUP BY ALL),
         n AS (SELECT *, lead(first_day) OVER (PARTITION BY c_nationkey ORDER BY first_day) AS next_day FROM f)
    SELECT o.o_orderkey, CAST(o.c_nationkey AS BIGINT) AS c_nationkey,
           strftime(least(o.d + 30, coalesce(n.next_day, o.d + 30)), '%Y-%m-%d') AS due_date
    FROM o JOIN p ON o.c_nationkey = p.c_nationkey AND o.d = p.d
    JOIN n ON n.c_nationkey = p.c_nationkey AND n.island = p.island AND n.pair = p.pair""")
def win_rolling_due_date(t):
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")) \
        .select("o_orderkey", "c_nationkey", F.to_date("o_orderdate").alias("d"))
    return rolling_due_date(o, ["c_nationkey"], "d").select("o_orderkey", "c_nationkey", "due_date")
