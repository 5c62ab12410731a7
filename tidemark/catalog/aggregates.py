"""Aggregations."""

from pyspark.sql import functions as F

from tidemark.catalog.base import dec, query, ymd
from tidemark.functions.dates import month_key, month_start
from tidemark.functions.numbers import money, signed, zero_sum
from tidemark.operators import aggregates as A
from tidemark.operators.joins import equi, facts


@query("agg_signed_sum", f"""
    SELECT l_suppkey, CAST(sum(CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN -1 ELSE 0 END * {dec('l_extendedprice')})
           AS DOUBLE) AS net FROM lineitem GROUP BY l_suppkey""")
def agg_signed_sum(t):
    value = signed(money("l_extendedprice"), "l_returnflag", plus=("N",), minus=("R",))
    return t.lineitem.groupBy("l_suppkey").agg(zero_sum(value).alias("net"))


@query("agg_cond_pivot", f"""
    SELECT l_partkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN {dec('l_quantity')} ELSE 0 END) AS DOUBLE) AS returned,
           CAST(sum(CASE WHEN l_returnflag = 'N' THEN {dec('l_quantity')} ELSE 0 END) AS DOUBLE) AS sold,
           CAST(sum(CASE WHEN l_returnflag IN ('R', 'A') THEN {dec('l_quantity')} ELSE 0 END) AS DOUBLE) AS handled
    FROM lineitem GROUP BY l_partkey""")
def agg_cond_pivot(t):
    return A.cond_pivot(t.lineitem, ["l_partkey"], "l_returnflag",
                        {"R": "returned", "N": "sold", ("R", "A"): "handled"}, "l_quantity")


@query("agg_distinct_having", f"""
    SELECT o_custkey, {ymd("date_trunc('month', o_orderdate)")} AS month, count(DISTINCT o_orderkey) AS orders
    FROM orders GROUP BY o_custkey, date_trunc('month', o_orderdate)
    HAVING count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) = 0""")
def agg_distinct_having(t):
    per = t.orders.groupBy("o_custkey", month_start("o_orderdate").alias("month")).agg(
        F.count_distinct("o_orderkey").alias("orders"),
        F.count_distinct(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).alias("final"))
    return per.filter("final = 0").drop("final")


BRANDS = [f"Brand#{i}" for i in range(1, 16)]


@query("agg_all_members", f"""
    SELECT l_orderkey, CAST(bool_and(p_brand IN ({', '.join(repr(b) for b in BRANDS)})) AS BIGINT) AS all_members
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""")
def agg_all_members(t):
    lines = equi(t.lineitem.select("l_orderkey", F.col("l_partkey").alias("p_partkey")),
                 t.part.select("p_partkey", "p_brand"), "p_partkey")
    return A.all_members(lines, ["l_orderkey"], "p_brand", BRANDS)


@query("agg_two_level", f"""
    SELECT o_custkey, CAST(sum(v) AS DOUBLE) AS value, count(*) AS orders FROM (
        SELECT o_custkey, l_orderkey, round(sum({dec('l_extendedprice')}), 0) AS v
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) GROUP BY o_custkey""")
def agg_two_level(t):
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.round(zero_sum(money("l_extendedprice")), 0).alias("v"))
    return (facts(per_order, t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
            .groupBy("o_custkey").agg(F.sum("v").alias("value"), F.count(F.lit(1)).alias("orders")))


@query("agg_value_counts", """
    SELECT nullif(l_returnflag, 'A') AS flag, l_linestatus, count(*) AS counts FROM lineitem GROUP BY ALL""")
def agg_value_counts(t):
    holes = t.lineitem.select(F.nullif("l_returnflag", F.lit("A")).alias("flag"), "l_linestatus")
    return A.value_counts(holes, ["flag", "l_linestatus"])


@query("agg_distinct_values", "SELECT DISTINCT p_brand FROM part")
def agg_distinct_values(t):
    return A.distinct_values(t.part, "p_brand")


@query("agg_collect_top3", """
    WITH d AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
         r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS n FROM d)
    SELECT l_orderkey, CAST(max(l_partkey) FILTER (n = 1) AS BIGINT) AS part1,
           CAST(max(l_partkey) FILTER (n = 2) AS BIGINT) AS part2,
           CAST(max(l_partkey) FILTER (n = 3) AS BIGINT) AS part3, count(*) AS part_count FROM r GROUP BY l_orderkey""")
def agg_collect_top3(t):
    return A.first_values(t.lineitem, ["l_orderkey"], "l_partkey", 3, "part")


@query("agg_expr_keys", f"""
    SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, count(*) AS orders,
           CAST(sum({dec('o_totalprice')}) AS DOUBLE) / count(*) AS average,
           (SELECT max(o_totalprice) FROM orders) AS highest
    FROM orders GROUP BY 1, 2""")
def agg_expr_keys(t):
    out = t.orders.groupBy(month_key("o_orderdate").alias("month"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"),
        (zero_sum(money("o_totalprice")).cast("double") / F.count(F.lit(1))).alias("average"))
    return out.withColumn("highest", A.high_water(t.orders, "o_totalprice"))


@query("word_count", r"""
    SELECT word, count(*) AS occurrences FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""")
def word_count(t):
    return A.word_count(t.documents, "text")
