"""Filters, projections, sets, reshape, quality."""

from pyspark.sql import functions as F

from tidemark.catalog.base import dec, query, ymd
from tidemark.functions.dates import on_days
from tidemark.functions.nested import parse_json
from tidemark.functions.numbers import flag, money, zero_sum
from tidemark.functions.text import pieces
from tidemark.operators import filters, names, quality, reshape, sets
from tidemark.operators.aggregates import first_values
from tidemark.operators.joins import equi


@query("filter_eq_in_prefix", f"""
    SELECT o_orderkey, o_custkey, o_orderpriority, {ymd('o_orderdate')} AS o_orderdate
    FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
      AND o_orderpriority NOT IN ('2-HIGH') AND NOT starts_with(o_orderpriority, '3')
      AND o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1998-01-01'
      AND o_totalprice IS NOT NULL""")
def filter_eq_in_prefix(t):
    out = filters.where_equal(t.orders, o_orderstatus="F")
    out = filters.present(out, "o_totalprice").filter(filters.all_rules(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"),
        ~F.col("o_orderpriority").isin("2-HIGH"),
        filters.not_starting_with("o_orderpriority", "3"),
        on_days("o_orderdate", "1996-01-01", "1997-12-31")))
    return out.select("o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("o_orderdate"))


@query("filter_text_null_rules", """
    WITH p AS (SELECT p_partkey, nullif(p_brand, 'Brand#3') AS brand,
                      CASE WHEN p_type = 'ECONOMY' THEN '  ' ELSE p_type END AS kind,
                      nullif(p_size, 10) AS size, p_name FROM part)
    SELECT p_partkey, brand, kind, CAST(size AS BIGINT) AS size,
           CAST(trim(kind) = '' AS BIGINT) AS is_blank,
           CAST(brand IS DISTINCT FROM 'Brand#5' AS BIGINT) AS other_brand,
           CAST(p_name LIKE '%ring%' AS BIGINT) AS has_ring
    FROM p
    WHERE size IS NOT NULL AND (trim(kind) = '' OR (p_name LIKE '%ring%' AND brand IS DISTINCT FROM 'Brand#5')
                                OR (size > 30 AND kind IN ('STANDARD', 'PROMO')))""")
def filter_text_null_rules(t):
    p = t.part.select("p_partkey", F.nullif("p_brand", F.lit("Brand#3")).alias("brand"),
                      F.when(F.col("p_type") == "ECONOMY", "  ").otherwise(F.col("p_type")).alias("kind"),
                      F.nullif("p_size", F.lit(10)).alias("size"), "p_name")
    ring, other = F.col("p_name").contains("ring"), filters.differs_from("brand", "Brand#5")
    rules = filters.any_rule(filters.blank("kind"), filters.all_rules(ring, other),
                             filters.all_rules(F.col("size") > 30, F.col("kind").isin("STANDARD", "PROMO")))
    return filters.complete(p, ["size"]).filter(rules).select(
        "p_partkey", "brand", "kind", "size", filters.blank("kind").alias("is_blank"),
        other.alias("other_brand"), ring.alias("has_ring"))


@query("project_rename_tag", """
    SELECT p_partkey AS product, p_name AS product_name, p_retailprice AS price, p_brand AS brand,
           'part' AS datatype, CAST(1 AS BIGINT) AS batch FROM part""")
def project_rename_tag(t):
    out = names.without(t.part, "p_size", "p_type").select("p_partkey", "p_name", "p_retailprice", "p_brand")
    out = names.rename_all(out, ["product", "product_name", "price", "p_brand"])
    return names.tag(names.rename(out, {"p_brand": "brand"}), datatype="part", batch=1)


@query("names_clean", """
    SELECT CAST(r_regionkey AS BIGINT) AS makhuvuc, r_name AS "tenkhuvuc1",
           CAST(n_nationkey AS BIGINT) AS d_maduong, n_name AS d_diachi FROM nation JOIN region ON r_regionkey = n_regionkey""")
def names_clean(t):
    r = names.rename_all(t.region, ["Mã Khu/Vực", "Tên (Khu-Vực): 1."])
    n = names.rename(t.nation, {"n_nationkey": "Mã Đường", "n_name": "Địa*Chỉ", "n_regionkey": "Mã Khu/Vực"})
    r, n = names.load_names(r), names.load_names(n)
    n = names.prefix_names(n, "d_", keep=["makhuvuc"])
    return equi(r, n, "makhuvuc", "inner").select("makhuvuc", "tenkhuvuc1", "d_maduong", "d_diachi")


@query("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query("topk_order", f"""
    SELECT o_orderkey, o_custkey, o_totalprice, {ymd('o_orderdate')} AS o_orderdate
    FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def topk_order(t):
    return (t.orders.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey"))
            .select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"))
            .limit(100))


# ---- sets ------------------------------------------------------------------------------

@query("set_union_by_name", """
    SELECT c_custkey, c_name, c_acctbal, NULL AS c_mktsegment FROM customer WHERE c_acctbal < 5000
    UNION SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 2000
    UNION SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'""")
def set_union_by_name(t):
    a = t.customer.filter("c_acctbal < 5000").select("c_acctbal", "c_custkey", "c_name")
    b = t.customer.filter("c_acctbal > 2000").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    c = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_mktsegment", "c_custkey", "c_name", "c_acctbal")
    return sets.union_by_name([a, b, c], distinct=True)


@query("set_symdiff", """
    SELECT c_custkey, c_name, c_acctbal FROM customer
    WHERE (c_acctbal < 5000) <> (c_acctbal > 2000)""")
def set_symdiff(t):
    cols = ["c_custkey", "c_name", "c_acctbal"]
    return sets.symmetric_difference(t.customer.filter("c_acctbal < 5000").select(*cols),
                                     t.customer.filter("c_acctbal > 2000").select(*cols))


@query("set_keydiff", """
    SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'
    EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def set_keydiff(t):
    return sets.key_difference(t.orders.filter("o_orderstatus = 'F'"),
                               t.orders.filter("o_orderpriority = '1-URGENT'"), ["o_custkey"])


@query("dedup_first_none_last", """
    WITH e AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d,
        row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS f,
        row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS l,
        count(*) OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)) AS n FROM events)
    SELECT 'first' AS rule, event_id, user_id, event_type FROM e WHERE f = 1
    UNION ALL SELECT 'last', event_id, user_id, event_type FROM e WHERE l = 1
    UNION ALL SELECT 'none', event_id, user_id, event_type FROM e WHERE n = 1
    UNION ALL SELECT 'repeat', event_id, user_id, event_type FROM e WHERE f > 1
    UNION ALL SELECT 'copied', event_id, user_id, event_type FROM e WHERE n > 1""")
def dedup_first_none_last(t):
    e = t.events.select("event_id", "user_id", "event_type", "ts", F.to_date("ts").alias("d"))
    keys, order = ["user_id", "event_type", "d"], ["ts", "event_id"]
    found = {k: sets.dedup(e, keys, order, k) for k in ("first", "last", "none")}
    found["repeat"] = sets.mark_duplicates(e, keys, order).filter("duplicated")
    found["copied"] = sets.mark_duplicates(e, keys, keep="none").filter("duplicated")
    return sets.union_by_name([df.select(F.lit(rule).alias("rule"), "event_id", "user_id", "event_type")
                       for rule, df in found.items()])


# ---- reshape ---------------------------------------------------------------------------

@query("reshape_unpivot", """
    SELECT p_partkey, 'p_size' AS variable, CAST(p_size AS DOUBLE) AS value FROM part WHERE p_size <> 10
    UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part
    UNION ALL SELECT p_partkey, 'name_length', CAST(length(p_name) AS DOUBLE) FROM part""")
def reshape_unpivot(t):
    wide = t.part.select("p_partkey", F.nullif("p_size", F.lit(10)).alias("p_size"), "p_retailprice",
                         F.length("p_name").alias("name_length"))
    return reshape.melt(wide, ["p_partkey"], drop_nulls=True, value_type="double")


@query("reshape_json_struct", """
    SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k, count(*) AS events,
           CAST(max(event_id) AS BIGINT) AS last_event
    FROM events GROUP BY ALL""")
def reshape_json_struct(t):
    from tidemark.functions.nested import struct_fields
    e = t.events.select("event_id", "event_type", parse_json("props", "struct<k: bigint>").alias("props"))
    flat = struct_fields(e, "props", ["k"])
    return flat.groupBy("event_type", "props_k").agg(F.count(F.lit(1)).alias("events"),
                                                     F.max("event_id").alias("last_event"))


@query("reshape_list_rows", """
    SELECT conv_id, turn, piece, pieces[1] AS piece1, pieces[2] AS piece2
    FROM (SELECT conv_id, turn, pieces, unnest(pieces) AS piece
          FROM (SELECT conv_id, turn, string_split(regexp_replace(trim(text), ' *\\. *', '.', 'g'), '.') AS pieces FROM (SELECT conv_id, turn, translate(text, chr(9) || chr(10) || chr(13), '   ') AS text FROM conversations)))
    WHERE piece <> ''""")
def reshape_list_rows(t):
    """Texts as lists of their sentences."""
    lists = t.conversations.select("conv_id", "turn", F.translate("text", "\t\n\r", "   ").alias("text"))
    wide = reshape.list_to_columns(lists, pieces("text", "."), 2, "piece")
    return reshape.list_to_rows(wide, "text", "piece", ".").select("conv_id", "turn", "piece", "piece1", "piece2")


# ---- quality ---------------------------------------------------------------------------

@query("dq_unique_key", """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies
    FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def dq_unique_key(t):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_reconcile", """
    WITH a AS (SELECT o_orderstatus s, year(o_orderdate) y, count(*) n FROM orders GROUP BY ALL),
         b AS (SELECT o_orderstatus s, year(o_orderdate) y, count(*) n FROM orders
               WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') GROUP BY ALL)
    SELECT a.s AS o_orderstatus, a.y AS order_year, a.n AS rows_a, coalesce(b.n, 0) AS rows_b
    FROM a LEFT JOIN b USING (s, y) WHERE a.n <> coalesce(b.n, 0)""")
def dq_reconcile(t):
    a = t.orders.withColumn("order_year", F.year("o_orderdate"))
    b = a.filter("not (o_orderstatus = 'F' and o_orderpriority = '1-URGENT')")
    return quality.reconcile(a, b, ["o_orderstatus", "order_year"])


@query("agg_null_profile", """
    SELECT 'l_partkey' AS column_name, count(*) FILTER (nullif(l_partkey, 7) IS NULL) AS nulls FROM lineitem
    UNION ALL SELECT 'l_returnflag', count(*) FILTER (nullif(l_returnflag, 'R') IS NULL) FROM lineitem
    UNION ALL SELECT 'l_quantity', count(*) FILTER (l_quantity IS NULL) FROM lineitem""")
def agg_null_profile(t):
    holes = t.lineitem.select(F.nullif("l_partkey", F.lit(7)).alias("l_partkey"),
                              F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"), "l_quantity")
    return quality.null_profile(holes)


@query("dq_gates", f"""
    WITH k AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
    SELECT l_returnflag, count(*) AS lines, CAST(sum({dec('l_quantity')}) AS DOUBLE) AS quantity,
           CAST(count(DISTINCT l_orderkey) AS BIGINT) AS orders
    FROM lineitem SEMI JOIN k USING (l_orderkey, l_linenumber) GROUP BY ALL""")
def dq_gates(t):
    lines = quality.assert_not_empty(t.lineitem)
    quality.assert_unique(t.orders, ["o_orderkey"])
    twice = quality.split_duplicates(lines, ["l_orderkey", "l_linenumber"])
    return twice.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), zero_sum(money("l_quantity")).alias("quantity"),
        F.count_distinct("l_orderkey").alias("orders"))


@query("agg_sum_flags", f"""
    SELECT o_custkey, o_orderstatus, CAST(sum({dec('o_totalprice')}) AS DOUBLE) AS o_totalprice,
           {ymd('max(o_orderdate)')} AS o_orderdate, CAST(min(o_orderkey) AS BIGINT) AS o_orderkey,
           CAST(sum({dec('o_totalprice')}) > 300000 AS BIGINT) AS is_large
    FROM orders GROUP BY o_custkey, o_orderstatus""")
def agg_sum_flags(t):
    from tidemark.operators.aggregates import group_sum
    orders = t.orders.withColumn("o_orderdate", F.to_date("o_orderdate"))
    out = group_sum(orders, ["o_custkey", "o_orderstatus"], ["o_totalprice"], ["o_orderdate"], ["o_orderkey"])
    return out.withColumn("is_large", flag(F.col("o_totalprice") - 300000))


@query("dq_page_completeness", """
    SELECT conv_id, count(*) AS rows, max(turn) + 1 AS declared, CAST(count(*) = max(turn) + 1 AS BIGINT) AS complete
    FROM conversations WHERE NOT (role = 'assistant' AND turn % 5 = 3) GROUP BY conv_id""")
def dq_page_completeness(t):
    """Conversations as pages that number their turns; some rows were lost on the way."""
    left = t.conversations.filter("not (role = 'assistant' and turn % 5 = 3)")
    return quality.page_completeness(left.withColumn("declared", F.col("turn") + 1), ["conv_id"], "declared")
