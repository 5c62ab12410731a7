"""Reports on the given tables."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog.base import dec, query, ymd, ymdhms
from tidemark.functions import codes
from tidemark.functions.dates import month_key, month_start
from tidemark.functions.numbers import money, signed, zero_sum
from tidemark.functions.text import joined_key, pieces
from tidemark.operators import hierarchy as hierarchies
from tidemark.operators.filters import blank
from tidemark.operators.joins import alias_dimension, equi, facts
from tidemark.operators.quality import assert_unique
from tidemark.operators.sets import union_by_name
from tidemark.plans import activity, history, masters, sales, stock
from tidemark.plans import receivables as rec
from tidemark.sources import upserts, writers
from tidemark.sources.readers import literal_rows
from tidemark.sources.scratch import written

# ---- sales -----------------------------------------------------------------------------

# The label of unknown codes is the stored one.
SEGMENTS = [("AUTOMOBILE", "AUT"), ("BUILDING", "BLD"), ("FURNITURE", "FUR"), ("HOUSEHOLD", "HOU")]
PAY = {"F": "B", "O": "C", "P": "T"}


@query("sales_fact", f"""
    WITH s AS (SELECT *, CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN -1 ELSE 0 END AS sign,
                 CASE c_mktsegment {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in SEGMENTS)} ELSE 'Khác' END AS class
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
               JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
               LEFT JOIN part ON l_partkey = p_partkey)
    SELECT r_name AS region, {ymd("date_trunc('month', o_orderdate)")} AS month, class,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN 'TM' ELSE 'CK' END AS payment,
           count(*) AS lines, CAST(sum(sign * {dec('l_quantity')}) AS DOUBLE) AS quantity,
           CAST(sum(sign * {dec('l_extendedprice')}) AS DOUBLE) AS revenue,
           count(DISTINCT coalesce(p_brand, 'Khác')) AS groups,
           {ymd("min(CASE WHEN l_returnflag = 'A' THEN DATE '1900-01-01' ELSE l_shipdate END)")} AS first_delivery,
           '2001-08-02 00:00:00' AS inserted_at
    FROM s GROUP BY r_name, date_trunc('month', o_orderdate), class, payment""")
def sales_fact(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "r_name")
    orders = equi(t.orders, customers, "o_custkey", "inner")
    rows = facts(t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), orders, "o_orderkey").select(
        F.col("l_partkey").alias("product"), F.col("r_name").alias("region"), "c_mktsegment", "o_orderdate",
        F.when(F.col("l_returnflag") == "A", "").otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("delivered"),
        codes.label("o_orderstatus", PAY).alias("payment"),
        signed(money("l_quantity"), "l_returnflag", ("N",), ("R",)).alias("quantity"),
        signed(money("l_extendedprice"), "l_returnflag", ("N",), ("R",)).alias("revenue"))
    segments = literal_rows(t.spark, SEGMENTS, "segment string, code string")
    fact = sales.enrich_sales(
        rows, [sales.Lookup(segments, "c_mktsegment", "segment", "code", "class", "Khác"),
               sales.Lookup(t.part, "product", "p_partkey", "p_brand", "brand_group", "Khác")],
        "o_orderdate", date_texts=["delivered"], fill_dates=["delivered"], payment="payment", as_of="2001-08-02")
    return fact.groupBy("region", "month", "class", "payment", "inserted_at").agg(
        F.count(F.lit(1)).alias("lines"), zero_sum("quantity").alias("quantity"), zero_sum("revenue").alias("revenue"),
        F.count_distinct("brand_group").alias("groups"), F.min("delivered").alias("first_delivery"))


@query("sales_refresh", f"""
    WITH e AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice, CASE WHEN o_orderstatus IN ('F', 'O') THEN 'TM' ELSE 'CK' END AS payment,
                      coalesce(c_name, 'none') AS buyer
               FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_nationkey = o_custkey % 25)
    SELECT o_orderkey, {ymd('day')} AS day, CASE WHEN day >= DATE '2001-06-01' THEN o_totalprice ELSE 0 END AS price, payment, buyer
    FROM e WHERE day >= DATE '2001-06-01' OR o_orderkey % 2 = 0""")
def sales_refresh(t):
    """The last days of a stored fact replaced by the enriched orders, if their key is unique; the
    buyer is looked up by a key of two columns."""
    nation = (F.col("o_custkey") % 25).cast("int")
    orders = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("price"),
                             codes.label("o_orderstatus", PAY).alias("payment"),
                             joined_key("o_custkey", F.lit("|"), nation).alias("buyer_key"))
    buyers = t.customer.select(joined_key("c_custkey", F.lit("|"), "c_nationkey").alias("key"), "c_name")
    fact = sales.enrich_sales(orders, [sales.Lookup(buyers, "buyer_key", "key", "c_name", "buyer", "none")], "day", payment="payment") \
        .select("o_orderkey", "day", "price", "payment", "buyer")
    stored = fact.filter("o_orderkey % 2 = 0").withColumn("price", F.lit(0.0))
    first = dt.date(2001, 6, 1)
    return sales.refresh_sales(stored, fact.filter(F.col("day") >= F.lit(first)), "day", first, ["o_orderkey"])


# The people above a seller, by the customer's number: column, divisor.
PEOPLE = {"supervisor": 10, "area_manager": 7, "region_manager": 3, "seller": 50}


@query("sales_raw_to_fact", f"""
    WITH mv AS (SELECT *, CAST(l_suppkey AS VARCHAR) AS sup, {dec('l_extendedprice')} AS price, {dec('l_quantity')} AS q FROM lineitem),
         ln AS (SELECT l_orderkey, l_linenumber, CAST(sum(q) AS DOUBLE) AS qty, max(price) AS price, sum(price) AS amount,
                       bool_or(l_discount >= 0.1) AS free, max(l_partkey) AS part FROM mv GROUP BY ALL),
         lot AS (SELECT l_orderkey, l_linenumber, sup, CAST(sum(q) AS DOUBLE) AS qty FROM mv WHERE l_returnflag <> 'A' GROUP BY ALL),
         h AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE CASE o_orderpriority WHEN '2-HIGH' THEN 1 ELSE 0 END END AS sign,
                      c_name AS customer, c_mktsegment AS channel, n_name AS place, r_name AS company, o_custkey,
                      CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey - 1 END AS back
               FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
               LEFT JOIN region ON r_regionkey = o_custkey % 7
               WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')),
         dl AS (SELECT l_orderkey, max(l_shipdate)::DATE AS delivered, CASE WHEN max(l_suppkey) % 4 = 0 THEN ' ' ELSE 'S' || max(l_suppkey) END AS carrier,
                       'U' || min(l_suppkey) AS unit FROM lineitem GROUP BY ALL),
         bk AS (SELECT * FROM dl WHERE l_orderkey % 5 <> 0)
    SELECT o_orderkey AS order_nbr, CAST(ln.l_linenumber AS BIGINT) AS line_ref, coalesce(sup, '') AS lot,
           sign * coalesce(lot.qty, ln.qty) AS quantity,
           CAST(CASE WHEN free THEN 0 ELSE sign * CAST(coalesce(lot.qty, ln.qty) AS DECIMAL(18,2)) * price END AS DOUBLE) AS revenue,
           CAST(CASE WHEN free THEN 0 ELSE sign * amount END AS DOUBLE) AS before_vat_amount,
           p_name AS product, CASE WHEN p_size > 25 THEN p_brand ELSE p_name END AS product_short, customer, channel, place, company,
           CASE WHEN trim(bk.carrier) = '' THEN rb.carrier ELSE bk.carrier END AS carrier, bk.unit AS carrier_unit,
           {', '.join(f'{n}.s_name AS {n}' for n in PEOPLE)}, {ymd('dl.delivered')} AS delivered
    FROM ln JOIN h ON ln.l_orderkey = o_orderkey JOIN part ON p_partkey = part LEFT JOIN dl ON dl.l_orderkey = o_orderkey
    LEFT JOIN bk ON bk.l_orderkey = o_orderkey LEFT JOIN bk rb ON rb.l_orderkey = back
    {' '.join(f'LEFT JOIN supplier {n} ON {n}.s_suppkey = o_custkey % {m}' for n, m in PEOPLE.items())}
    LEFT JOIN lot ON lot.l_orderkey = ln.l_orderkey AND lot.l_linenumber = ln.l_linenumber""")
def sales_raw_to_fact(t):
    """Regular and replacement orders are one pass over the lines, told apart by their type; the books and
    deliveries of an order are one more, staged, since an order also looks up the book of the order it returns."""
    keys = ["branch_id", "order_nbr"]
    branch = F.lit("B1").alias("branch_id")
    replaced = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "2-HIGH")
    kind = F.when(replaced, "EX").otherwise(codes.label("o_orderstatus", {"F": "IN", "O": "CO", "P": "XX"}))
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("customer"), F.col("c_mktsegment").alias("channel"),
        F.col("n_name").alias("place"))
    headers = equi(t.orders, people, "o_custkey")
    headers = alias_dimension(headers.withColumn("company_id", F.col("o_custkey") % 7), t.region, "company_id", "r_regionkey", "company_", ["r_name"])
    for name, modulo in PEOPLE.items():
        headers = alias_dimension(headers.withColumn(name, F.col("o_custkey") % modulo), t.supplier, name, "s_suppkey", f"{name}_", ["s_name"])
    headers = headers.select(
        branch, F.col("o_orderkey").alias("order_nbr"), kind.alias("order_type"), "o_orderpriority", "customer", "channel", "place",
        F.col("company_r_name").alias("company"), *[F.col(f"{n}_s_name").alias(n) for n in PEOPLE],
        F.when(F.col("o_orderkey") % 2 == 1, F.col("o_orderkey") - 1).alias("return_nbr"))
    carrier = F.when(F.max("l_suppkey") % 4 == 0, " ").otherwise(F.concat(F.lit("S"), F.max("l_suppkey")))
    of_order = written(t.lineitem.groupBy(branch, F.col("l_orderkey").alias("order_nbr")).agg(
        F.to_date(F.max("l_shipdate")).alias("delivered"), carrier.alias("carrier"),
        F.concat(F.lit("U"), F.min("l_suppkey")).alias("carrier_unit")), "order-books")
    headers = facts(headers, of_order.select(*keys, "delivered"), keys, "left")
    headers = sales.with_books(headers, of_order.filter("order_nbr % 5 <> 0"), keys, "return_nbr", ["carrier", "carrier_unit"])
    amount = money("l_extendedprice")
    movements = t.lineitem.select(
        branch, F.col("l_orderkey").alias("order_nbr"), F.col("l_linenumber").alias("line_ref"), F.col("l_suppkey").cast("string").alias("lot"),
        (F.col("l_returnflag") != "A").alias("from_lot"), money("l_quantity").alias("qty"), (F.col("l_discount") >= 0.1).alias("free_item"),
        amount.alias("before_vat_price"), amount.alias("before_vat_amount"), F.col("l_partkey").alias("part"))
    lines = sales.lines_by_lot(movements, keys, {"free_item": "any", "before_vat_price": "max", "before_vat_amount": "sum", "part": "max"})
    lines = lines.withColumns({"after_vat_amount": F.col("before_vat_amount"), "vat_amount": F.lit(0)})
    parts = t.part.select(F.col("p_partkey").alias("part"), F.col("p_name").alias("product"),
                          F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("  ").alias("product_short"))
    types = literal_rows(t.spark, [("IN", "IN"), ("CO", "CM"), ("XX", "NA"), ("EX", "IN")], "order_type string, doc_type string")
    returned = (F.col("order_type") == "XX") & (F.col("o_orderpriority") == "1-URGENT")
    rows = facts(headers.filter(~returned), equi(lines, parts, "part", "inner"), keys)
    fact = sales.signed_lines(equi(rows, types, "order_type", "left"))
    fact = fact.withColumn("product_short", F.when(blank("product_short"), F.col("product")).otherwise(F.col("product_short")))
    return fact.select("order_nbr", "line_ref", "lot", F.col("quantity").cast("double").alias("quantity"), "revenue", "before_vat_amount",
                       "product", "product_short", "customer", "channel", "place", "company", "carrier", "carrier_unit", *PEOPLE, "delivered")


@query("run_rate", f"""
    WITH m AS (SELECT p_brand AS brand, date_trunc('month', l_shipdate)::DATE AS month, CAST(sum({dec('l_quantity')}) AS DOUBLE) AS q
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
         b AS (SELECT date_trunc('month', min(l_shipdate)) AS lo, last_day(max(l_shipdate)) AS hi FROM lineitem),
         d AS (SELECT unnest(generate_series(lo, CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS day FROM b),
         w AS (SELECT date_trunc('month', day)::DATE AS month, sum(CASE dayofweek(day) WHEN 0 THEN 0 WHEN 6 THEN 0.5 ELSE 1 END)::DOUBLE AS total,
                      sum(CASE WHEN day >= DATE '2001-05-17' THEN 0 ELSE CASE dayofweek(day) WHEN 0 THEN 0 WHEN 6 THEN 0.5 ELSE 1 END END)::DOUBLE AS done
               FROM d GROUP BY 1),
         e AS (SELECT brand, round(sum(q) / count(*), 0) AS mean FROM m WHERE year(month) = 2001 AND month(month) < 5 GROUP BY brand)
    SELECT m.brand, {ymd('m.month')} AS month, upper(strftime(m.month, '%b')) AS month_name,
           CASE WHEN year(m.month) < 2001 THEN 'ACT LY' ELSE 'ACT TY' END AS data_type, q AS quantity,
           CASE WHEN done < total THEN round(q / nullif(done, 0) * total, 0) ELSE q END AS projected,
           CASE WHEN m.month = DATE '2001-05-01' THEN coalesce(mean, 0) ELSE q END AS history
    FROM m JOIN w ON m.month = w.month LEFT JOIN e ON m.brand = e.brand""")
def run_rate(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")) \
        .select(F.col("p_brand").alias("brand"), "l_shipdate", "l_quantity")
    return sales.run_rate(rows, ["brand"], "l_shipdate", "l_quantity", "2001-05-17")


@query("programme_paid", f"""
    SELECT c_mktsegment AS programme, c_custkey AS customer, CAST(c_acctbal AS DOUBLE) AS reward,
           CAST(coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END * {dec('o_totalprice')}), 0) AS DOUBLE) AS paid_amount
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate >= DATE '1999-01-01' AND o_orderdate < DATE '1999-07-01'
    GROUP BY ALL""")
def programme_paid(t):
    reg = t.customer.select(F.col("c_mktsegment").alias("programme"), F.col("c_custkey").alias("customer"))
    results = t.customer.select(F.col("c_mktsegment").alias("programme"), F.col("c_custkey").alias("customer"),
                                F.col("c_acctbal").alias("reward"))
    half = t.orders.filter("o_orderdate >= '1999-01-01' and o_orderdate < '1999-07-01'").select(
        F.col("o_custkey").alias("customer"), "o_totalprice",
        F.concat(codes.label("o_orderstatus", {"P": "CO"}, "DH"), F.col("o_orderkey")).alias("order_nbr"))
    half = equi(half, reg, "customer", "inner")
    return sales.programme_progress(reg, results, half, "customer", "programme", "order_nbr", "o_totalprice")


@query("programme_progress", f"""
    WITH ln AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_extendedprice AS p, l_returnflag AS flag FROM lineitem),
         used AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW'),
         v AS (SELECT l_orderkey, 'sale' AS kind, sum({dec('q')} * {dec('p')}) AS value FROM ln
               WHERE flag <> 'R' AND l_orderkey NOT IN (SELECT o_orderkey FROM used) GROUP BY ALL
               UNION ALL SELECT l_orderkey, 'return', -sum({dec('q')} * {dec('p')}) FROM ln WHERE flag = 'R' GROUP BY ALL),
         dl AS (SELECT o_orderkey, {dec('o_totalprice / 100')} AS amount FROM orders),
         dd AS (SELECT DISTINCT l_orderkey, CASE WHEN flag = 'R' THEN 'return' ELSE 'sale' END AS kind FROM ln WHERE l_linenumber IN (1, 3))
    SELECT v.l_orderkey AS order_nbr, v.kind, CAST(value AS DOUBLE) AS value,
           CAST(CASE WHEN dd.l_orderkey IS NULL THEN 0 WHEN v.kind = 'sale' THEN round(amount, 0) ELSE -round(amount, 0) END AS DOUBLE) AS discount
    FROM v JOIN dl ON dl.o_orderkey = v.l_orderkey LEFT JOIN dd ON dd.l_orderkey = v.l_orderkey AND dd.kind = v.kind""")
def programme_progress(t):
    ln = t.lineitem.select(F.col("l_orderkey").alias("order_nbr"), F.col("l_linenumber").cast("string").alias("line_ref"),
                           F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
                           F.lit(1.0).alias("unit_rate"), F.lit("M").alias("unit_op"),
                           F.when(F.col("l_returnflag") == "R", "return").otherwise("sale").alias("kind"))
    used = t.orders.filter("o_orderpriority = '5-LOW'").select(F.col("o_orderkey").alias("order_nbr"))
    discounts = t.orders.select(F.col("o_orderkey").alias("order_nbr"), F.col("o_orderkey").alias("disc_id"),
                                (F.col("o_totalprice") / 100).alias("disc_amount"), F.lit("1, 3").alias("line_list"))
    return sales.accumulation_detail(ln, used, discounts, ["order_nbr"])


@query("programme_units", """
    WITH ln AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 'return' ELSE 'sale' END AS kind,
                       CAST(CASE WHEN p_type = 'PROMO' THEN l_quantity * p_size ELSE l_quantity / p_size END AS DECIMAL(24,4)) AS units
                FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT l_orderkey AS order_nbr, kind, CAST(sum(CASE WHEN kind = 'sale' THEN units ELSE -units END) AS DOUBLE) AS value
    FROM ln WHERE kind = 'return' OR l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW') GROUP BY ALL""")
def programme_units(t):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("unit_rate"),
                         F.when(F.col("p_type") == "PROMO", "M").otherwise("D").alias("unit_op"))
    ln = equi(t.lineitem, part, "l_partkey", "inner").select(
        F.col("l_orderkey").alias("order_nbr"), F.col("l_linenumber").cast("string").alias("line_ref"),
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"), "unit_rate", "unit_op",
        F.when(F.col("l_returnflag") == "R", "return").otherwise("sale").alias("kind"))
    used = t.orders.filter("o_orderpriority = '5-LOW'").select(F.col("o_orderkey").alias("order_nbr"))
    none = literal_rows(t.spark, [], "order_nbr bigint, disc_id bigint, disc_amount double, line_list string")
    return sales.accumulation_detail(ln, used, none, ["order_nbr"], apply_type="U").drop("discount")


# ---- receivables -----------------------------------------------------------------------

def _orders(t):
    return t.orders.select(
        F.col("o_orderkey").alias("order_nbr"), F.col("o_custkey").alias("cust_id"), F.col("o_orderstatus").alias("status"),
        F.to_date("o_orderdate").alias("order_date"), "o_totalprice", F.col("o_orderpriority").alias("priority"),
        F.trunc("o_orderdate", "month").alias("invoice"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "O1")
        .otherwise(F.concat(F.lit("T"), F.left("o_orderpriority", F.lit(1)))).alias("terms"),
        codes.label("o_orderstatus", PAY).alias("payment"),
        codes.label("o_orderpriority", {"5-LOW": codes.CARRIER_UNIT, "4-NOT SPECIFIED": None}, "PN").alias("unit"))


O = """o AS (SELECT o_orderkey, o_custkey, o_orderstatus AS st, CAST(o_orderdate AS DATE) AS d, o_totalprice AS amt, o_orderpriority AS pr,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'O1' ELSE 'T' || left(o_orderpriority, 1) END AS terms FROM orders),
    canc AS (SELECT o_orderkey FROM o a WHERE st <> 'P' AND EXISTS (SELECT 1 FROM o b WHERE b.st = 'P' AND b.o_custkey = a.o_custkey
        AND date_trunc('month', b.d) = date_trunc('month', a.d) AND b.d = a.d)),
    ret AS (SELECT o_orderkey FROM o a WHERE st <> 'P' AND EXISTS (SELECT 1 FROM o b WHERE b.st = 'P' AND b.o_custkey = a.o_custkey
        AND date_trunc('month', b.d) = date_trunc('month', a.d) AND b.d <> a.d))"""


def _flags(t):
    o = _orders(t).select("order_nbr", "cust_id", "status", "order_date", "invoice")
    return rec.reversal_flags(o.filter("status <> 'P'"), o.filter("status = 'P'"), ["cust_id", "invoice"], "order_date")


LEDGER_KEYS = ["order_nbr", "cust_id", "terms", "order_date", "due_date"]


def _ledger(t, carry=()):
    """The ledger, with ``carry`` of the order's own columns. Orders are read twice (the rows, and
    the days of their reversals), lines once."""
    o = _orders(t).withColumn("due_date", rec.terms_due("terms", "order_date", "order_date"))
    o = rec.reversal_flags(o, _orders(t).filter("status = 'P'"), ["cust_id", "invoice"], "order_date")
    o = o.withColumns({"cancelled": F.col("same_day") & (F.col("status") != "P"), "returned": F.col("other_day") & (F.col("status") != "P")})
    amount = money("l_extendedprice")

    def total(cond):
        return zero_sum(F.when(cond, amount).otherwise(F.lit(0)))

    flag, state = F.col("l_returnflag"), F.col("l_linestatus")
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("order_nbr")).agg(
        F.to_date(F.min("l_shipdate")).alias("first_ship"), F.to_date(F.max("l_shipdate")).alias("last_ship"),
        total(flag == "N").alias("n_amt"), total(flag == "R").alias("r_amt"),
        total((flag == "A") & (state == "F")).alias("af_amt"), total((flag == "A") & (state == "O")).alias("ao_amt"),
        rec.last_step("l_linenumber", codes.label("l_returnflag", {"N": "C", "R": "D"}, "A"), "l_shipdate").alias("__last"))
    wide = facts(o, lines, "order_nbr", "left").select("*", *rec.delivery_of("__last"))
    early, shipped, done = F.col("order_date") < F.lit(dt.date(1996, 1, 1)), F.col("last_ship").isNotNull(), F.col("status") == "F"
    total_price = F.col("o_totalprice")
    legs = {
        "opening_amt": (early, total_price, F.col("order_date")),
        "released_amt": (shipped & ~early & (F.col("status") != "P"), total_price, codes.later_of("order_date", "first_ship")),
        "delivered_amt": (shipped & done, total_price, F.col("last_ship")),
        "received_amt": (shipped & done, F.col("n_amt"), F.col("last_ship")),
        "returned_amt": (F.col("r_amt") > 0, F.col("r_amt"), F.col("last_ship")),
        "confirmed_amt": (shipped, F.col("af_amt"), F.col("last_ship")),
        "confirmed_released_amt": (shipped, F.col("ao_amt"), F.col("first_ship"))}
    counted = {name: (cond & rec.leg_counts(F.lit(name), "cancelled", "returned"), value, event)
               for name, (cond, value, event) in legs.items()}
    return rec.ledger_from_orders(wide, counted, [*LEDGER_KEYS, *carry])


def _leg(name, value, event, source, where, returned):
    zeros = ", ".join(f"{dec(value) if a == name else 'CAST(0 AS DECIMAL(18,2))'} AS {a}" for a in rec.AMOUNTS)
    cond = f"{where} AND o_orderkey NOT IN (SELECT o_orderkey FROM canc)"
    if returned:
        cond += " AND o_orderkey NOT IN (SELECT o_orderkey FROM ret)"
    return (f"SELECT o_orderkey AS order_nbr, o_custkey AS cust_id, terms, d AS order_date, "
            f"CASE WHEN terms = 'O1' THEN d + 30 ELSE d END AS due_date, CAST({event} AS DATE) AS event_date, {zeros} "
            f"FROM {source} WHERE {cond}")


_L = dec("l_extendedprice")
LEDGER = f"""{O},
    ln AS (SELECT l_orderkey, min(l_shipdate)::DATE AS fs, max(l_shipdate)::DATE AS ls,
        sum(CASE WHEN l_returnflag = 'N' THEN {_L} ELSE 0 END) AS n_amt, sum(CASE WHEN l_returnflag = 'R' THEN {_L} ELSE 0 END) AS r_amt,
        sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN {_L} ELSE 0 END) AS af_amt,
        sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN {_L} ELSE 0 END) AS ao_amt FROM lineitem GROUP BY l_orderkey),
    ol AS (SELECT * FROM o JOIN ln ON l_orderkey = o_orderkey),
    led AS (""" + " UNION ALL ".join([
    _leg("opening_amt", "amt", "d", "o", "d < DATE '1996-01-01'", False),
    _leg("released_amt", "amt", "greatest(d, fs)", "ol", "d >= DATE '1996-01-01' AND st <> 'P'", False),
    _leg("delivered_amt", "amt", "ls", "ol", "st = 'F'", True),
    _leg("received_amt", "n_amt", "ls", "ol", "st = 'F'", True),
    _leg("returned_amt", "r_amt", "ls", "ol", "r_amt > 0", False),
    _leg("confirmed_amt", "af_amt", "ls", "ol", "true", True),
    _leg("confirmed_released_amt", "ao_amt", "fs", "ol", "true", True)]) + ")"


@query("receivables_ledger", f"""
    WITH {LEDGER}
    SELECT order_nbr, cust_id, terms, {ymd('order_date')} AS order_date, {ymd('due_date')} AS due_date, {ymd('event_date')} AS event_date,
           {', '.join(f'CAST({a} AS DOUBLE) AS {a}' for a in rec.AMOUNTS)} FROM led""")
def receivables_ledger(t):
    return _ledger(t).drop("leg")


@query("receivables_legs", f"""
    WITH {O}, ids AS (SELECT o_orderkey AS order_nbr, o_orderkey - o_orderkey % 2 AS orig_nbr, d, st, amt FROM o),
    ln AS (SELECT l_orderkey, l_returnflag = 'N' AS received, max(l_shipdate)::DATE AS ls, sum({_L}) AS amt FROM lineitem
           WHERE l_returnflag = 'N' OR (l_returnflag = 'A' AND l_linestatus = 'F') GROUP BY ALL),
    legs AS (SELECT 'released_amt' AS leg, order_nbr, orig_nbr, d AS event_date, {dec('amt')} AS released_amt, 0 AS received_amt, 0 AS confirmed_amt
             FROM ids WHERE st <> 'P'
             UNION ALL SELECT CASE WHEN received THEN 'received_amt' ELSE 'confirmed_amt' END, order_nbr, orig_nbr, ls, 0,
                 CASE WHEN received THEN ln.amt ELSE 0 END, CASE WHEN received THEN 0 ELSE ln.amt END FROM ln JOIN ids ON l_orderkey = order_nbr)
    SELECT leg, order_nbr, orig_nbr, {ymd('event_date')} AS event_date, CAST(released_amt AS DOUBLE) AS released_amt,
           CAST(received_amt AS DOUBLE) AS received_amt, CAST(confirmed_amt AS DOUBLE) AS confirmed_amt
    FROM legs WHERE order_nbr NOT IN (SELECT o_orderkey FROM canc)
        AND NOT (leg = 'received_amt' AND order_nbr IN (SELECT o_orderkey FROM ret))
        AND NOT (leg = 'confirmed_amt' AND orig_nbr IN (SELECT o_orderkey FROM ret))""")
def receivables_legs(t):
    """The ledger from separate sources: a stored base of old releases, and confirmations that
    name the original order."""
    orig = (F.col("order_nbr") - F.col("order_nbr") % 2).alias("orig_nbr")
    o = _orders(t).filter("status <> 'P'").select("order_nbr", orig, "order_date", "o_totalprice")
    released = rec.ledger_leg(o, "released_amt", "o_totalprice", "order_date", ["order_nbr", "orig_nbr"])
    old = F.col("event_date") < F.lit(dt.date(1996, 1, 1))
    flag = F.col("l_returnflag")
    lines = t.lineitem.filter((flag == "N") | ((flag == "A") & (F.col("l_linestatus") == "F"))).groupBy(
        F.col("l_orderkey").alias("order_nbr"), (flag == "N").alias("received")).agg(
        F.max("l_shipdate").alias("last_ship"), zero_sum(money("l_extendedprice")).alias("amount")).select("*", orig)

    def booked(name, received):
        return rec.ledger_leg(lines.filter(F.col("received") == received), name, "amount", "last_ship", ["order_nbr", "orig_nbr"])

    legs = {"released_amt": released.filter(~old), "received_amt": booked("received_amt", True),
            "confirmed_amt": booked("confirmed_amt", False)}
    out = rec.receivables_ledger(legs, _flags(t), ["order_nbr"], ["orig_nbr"], {"released_amt": released.filter(old)})
    return out.select("leg", "order_nbr", "orig_nbr", "event_date", *legs)


@query("order_reversals", f"""
    WITH {O} SELECT 'cancelled' AS kind, o_orderkey AS order_nbr FROM canc UNION ALL SELECT 'returned', o_orderkey FROM ret""")
def order_reversals(t):
    kinds = F.array(F.when(F.col("same_day"), "cancelled"), F.when(F.col("other_day"), "returned"))
    return _flags(t).select(F.explode(kinds).alias("kind"), "order_nbr").filter("kind is not null")


RULES = [("O1", "TM", "MDS"), ("T2", "TM", "MDS"), ("T3", "CK", "INS"), ("T5", "TM", "INS")]
# Combinations left out of the report; only the flagged one counts.
EXCLUDED = [("T4", "CK", 1.0), ("T4", "TM", None)]


CARRIED = ["payment", "unit", "delivery_time", "delivery_status"]


def _by_order(t, more=()):
    carried = [*CARRIED, *more]
    by = rec.receivables_by_order(_ledger(t, carried), [*LEDGER_KEYS, *carried], last_dates=["event_date"])
    by = rec.with_payment_class(by, "payment")
    rules = literal_rows(t.spark, RULES, "terms string, payment string, owner string")
    by = rec.owner_by_rule(by, rules, ["terms", "payment"], "owner")
    by = by.withColumn("terms_type", rec.terms_type(F.lit("D"), F.substring("terms", 2, 1).cast("int")))
    excluded = literal_rows(t.spark, EXCLUDED, "terms string, payment string, no_count double")
    return rec.drop_flagged(by, excluded, ["terms", "payment"], "no_count")


BY_ORDER = f"""{LEDGER},
    byo AS (SELECT order_nbr, cust_id, terms, order_date, due_date, max(event_date) AS event_date,
        {', '.join(f'sum({a}) AS {a}' for a in rec.AMOUNTS)}, {', '.join(f"CAST(sum({a}) > 0 AS BIGINT) AS has_{a[:-4]}" for a in rec.AMOUNTS)}
        FROM led GROUP BY ALL),
    bo AS (SELECT byo.*, payment, CASE WHEN terms IN ('O1', 'T2') AND payment = 'TM' THEN 'MDS'
            WHEN (terms = 'T3' AND payment = 'CK') OR (terms = 'T5' AND payment = 'TM') THEN 'INS' ELSE 'CS' END AS owner,
            CASE WHEN terms IN ('O1', 'T2') THEN 'Thanh Toán Ngay' ELSE 'Cho nợ' END AS terms_type
        FROM byo JOIN (SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN 'TM' ELSE 'CK' END AS payment FROM orders)
            ON o_orderkey = order_nbr WHERE NOT (terms = 'T4' AND payment = 'CK'))"""


@query("receivables_by_order", f"""
    WITH {BY_ORDER}
    SELECT order_nbr, cust_id, terms, {ymd('order_date')} AS order_date, {ymd('due_date')} AS due_date, {ymd('event_date')} AS event_date,
           {', '.join(f'CAST({a} AS DOUBLE) AS {a}' for a in rec.AMOUNTS)}, {', '.join(f'has_{a[:-4]}' for a in rec.AMOUNTS)},
           payment, owner, terms_type, c_name AS cust_name, c_mktsegment AS channel, n_name AS place, r_name AS area,
           concat_ws(', ', c_name, n_name, r_name) AS address, pr AS priority, delivery_status AS last_step
    FROM bo JOIN (SELECT o_orderkey, pr FROM o) o ON o.o_orderkey = order_nbr LEFT JOIN customer ON c_custkey = cust_id LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN (
        SELECT l_orderkey, CASE l_returnflag WHEN 'N' THEN 'Đã giao hàng' WHEN 'R' THEN 'KH Không Nhận' ELSE 'Đã Xác Nhận' END AS delivery_status
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC,
            CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) = 1) ON l_orderkey = order_nbr""")
def receivables_by_order(t):
    """The balance per order with its customer, places, address, priority and last delivery step."""
    dims = [(t.customer, "cust_id", "c_custkey", "", ["c_name", "c_mktsegment", "c_nationkey"]),
            (t.nation, "c_nationkey", "n_nationkey", "", ["n_name", "n_regionkey"]),
            (t.region, "n_regionkey", "r_regionkey", "", ["r_name"])]
    out = masters.customer_master(_by_order(t, ["priority"]), dims, ["c_name", "n_name", "r_name"])
    return out.withColumnsRenamed({"c_name": "cust_name", "c_mktsegment": "channel", "n_name": "place", "r_name": "area",
                                   "delivery_status": "last_step"}).drop("unit", "delivery_time", "c_nationkey", "n_regionkey")


def _balance(t):
    return rec.order_balance(_by_order(t), None, ["order_nbr"], "order_date", "unit")


# Labels of delivery states.
BALANCE = f"""{BY_ORDER},
    ld AS (SELECT l_orderkey, l_shipdate AS delivered_at,
               CASE l_returnflag WHEN 'N' THEN 'Đã giao hàng' WHEN 'R' THEN 'KH Không Nhận' ELSE 'Đã Xác Nhận' END AS s
           FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC,
               CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) = 1),
    bl AS (SELECT bo.* REPLACE (CASE WHEN pr = '5-LOW' AND returned_amt = 0 THEN released_amt ELSE delivered_amt END AS delivered_amt,
               CASE WHEN pr = '5-LOW' AND has_returned = 0 THEN 1 ELSE has_delivered END AS has_delivered),
           CASE WHEN pr = '5-LOW' THEN 'Giao NVC' WHEN pr = '4-NOT SPECIFIED' THEN 'Đã giao hàng' ELSE ld.s END AS delivery_status,
           CASE WHEN pr IN ('5-LOW', '4-NOT SPECIFIED') THEN CAST(order_date AS TIMESTAMP)
                ELSE coalesce(delivered_at, TIMESTAMP '1900-01-01') END AS delivery_time,
           opening_amt + released_amt - returned_amt - confirmed_released_amt AS balance
        FROM bo JOIN o ON o.o_orderkey = order_nbr LEFT JOIN ld ON ld.l_orderkey = order_nbr)"""


@query("order_balance", f"""
    WITH {BALANCE}
    SELECT order_nbr, delivery_status, {ymdhms('delivery_time')} AS delivery_time, CAST(balance AS DOUBLE) AS balance,
           CAST(balance > 0 AS BIGINT) AS is_open, has_released - has_delivered - has_returned AS undelivered,
           CAST(released_amt - delivered_amt - returned_amt AS DOUBLE) AS undelivered_amt FROM bl""")
def order_balance(t):
    return _balance(t).select("order_nbr", "delivery_status", "delivery_time", "balance", "is_open", "undelivered", "undelivered_amt")


@query("receivables_due_dates", f"""
    WITH {BALANCE},
         cand AS (SELECT order_nbr, terms, n_nationkey AS branch, order_date AS d FROM bl JOIN customer ON c_custkey = cust_id
                  JOIN nation ON c_nationkey = n_nationkey WHERE terms = 'O1' AND balance > 0),
         dd AS (SELECT DISTINCT branch, d FROM cand),
         g AS (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY branch ORDER BY d) > 1 THEN 1 ELSE 0 END AS gap FROM dd),
         i AS (SELECT *, sum(gap) OVER (PARTITION BY branch ORDER BY d) AS island FROM g),
         p AS (SELECT *, (row_number() OVER (PARTITION BY branch, island ORDER BY d) - 1) // 2 AS pair FROM i),
         f AS (SELECT branch, island, pair, min(d) AS first_day FROM p GROUP BY ALL),
         n AS (SELECT *, lead(first_day) OVER (PARTITION BY branch ORDER BY first_day) AS nd FROM f),
         due AS (SELECT cand.order_nbr, least(cand.d + 30, coalesce(nd, cand.d + 30)) AS due_date
                 FROM cand JOIN p USING (branch, d) JOIN n USING (branch, island, pair))
    SELECT bl.order_nbr, strftime(coalesce(due.due_date, bl.due_date), '%Y-%m-%d') AS due_date
    FROM bl LEFT JOIN due ON due.order_nbr = bl.order_nbr""")
def receivables_due_dates(t):
    branch = t.customer.select(F.col("c_custkey").alias("cust_id"), F.col("c_nationkey").alias("branch"))
    rows = equi(_by_order(t).withColumn("balance", rec.open_balance()), branch, "cust_id", "left")
    rows = written(rows.select("order_nbr", "branch", "order_date", "balance", "terms", "due_date"), "balance")
    return rec.due_dates(rows, ["branch"], "order_date", "balance", "terms", "O1", "due_date") \
        .select("order_nbr", "due_date")


CHANNEL = {"BUILDING": "NT", "MACHINERY": "CHUOI", "HOUSEHOLD": "INS1"}
TERMS = rec.ImmediateTerms(two_days=("T2", "T3"), one_day=("O1",))


OVERDUE = f"""{BALANCE},
         c AS (SELECT bl.*, CASE c_mktsegment WHEN 'BUILDING' THEN 'NT' WHEN 'MACHINERY' THEN 'CHUOI' WHEN 'HOUSEHOLD' THEN 'INS1' ELSE 'X' END AS ch
               FROM bl JOIN customer ON c_custkey = cust_id WHERE c_nationkey <> 3),
         x AS (SELECT *, CASE WHEN delivery_status = 'Đã giao hàng' AND terms IN ('T2', 'T3', 'O1') THEN CAST(delivery_time AS DATE) + 1
                     WHEN delivery_status <> 'Đã giao hàng' AND terms IN ('T2', 'T3') THEN order_date + 2
                     WHEN delivery_status <> 'Đã giao hàng' AND terms = 'O1' THEN order_date + 1 ELSE due_date END AS due
               FROM c WHERE balance > 1000 AND ((ch = 'NT' AND payment = 'TM') OR (ch = 'CHUOI' AND terms_type = 'Thanh Toán Ngay' AND payment = 'TM')))"""


def _chased(t):
    side = t.customer.select(F.col("c_custkey").alias("cust_id"), F.col("c_nationkey").cast("string").alias("staff"),
                             codes.label("c_mktsegment", CHANNEL, "X").alias("channel"))
    rows = equi(_balance(t), side, "cust_id", "inner")
    return rows.withColumn("owner_class", rec.owner_class("channel", "payment", "terms_type"))


@query("overdue_detail", f"""
    WITH {OVERDUE},
         n AS (SELECT user_id, event_type || event_id AS note, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type || event_id DESC) AS k
               FROM events WHERE event_type IN ('view', 'click'))
    SELECT order_nbr, x.cust_id, {ymd('due')} AS due_on, CASE WHEN due <= DATE '2000-06-30' THEN 'Đã tới hạn' ELSE 'Chưa tới hạn' END AS due_state,
           CAST(balance AS DOUBLE) AS balance, a.note AS note_1, b.note AS note_2, n_name AS seller, r_name AS area
    FROM x LEFT JOIN n a ON a.user_id = x.cust_id AND a.k = 1 LEFT JOIN n b ON b.user_id = x.cust_id AND b.k = 2
    JOIN customer ON c_custkey = x.cust_id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def overdue_detail(t):
    notes = t.events.filter("event_type in ('view', 'click')").select(
        F.col("user_id").alias("cust_id"), F.col("ts").alias("noted_at"), F.concat("event_type", "event_id").alias("note"))
    staff = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("staff"), F.col("n_name").alias("seller"), F.col("r_name").alias("area"))
    out = rec.overdue_detail(_chased(t), notes, staff, "2000-06-30", TERMS, "cust_id", exclude_staff=["3"])
    return out.select("order_nbr", "cust_id", "due_on", "due_state", "balance", "note_1", "note_2", "seller", "area")


@query("overdue_classes", f"""
    WITH {OVERDUE}
    SELECT terms, delivery_status, CASE WHEN due <= DATE '2000-06-30' THEN 'Đã tới hạn' ELSE 'Chưa tới hạn' END AS due_state,
           CAST(sum(balance) AS DOUBLE) AS balance, count(*) AS orders FROM x GROUP BY 1, 2, 3""")
def overdue_classes(t):
    return rec.overdue_classes(_chased(t), "2000-06-30", TERMS, ["terms", "delivery_status"], exclude_staff=["3"])


@query("owner_assignment", f"""
    WITH {O}, x AS (SELECT o_orderkey, CASE WHEN terms IN ('O1', 'T2') THEN 'MDS' WHEN terms = 'T3' THEN 'INS' ELSE 'CS' END AS owner,
                           c_name, n_name, r_name, c_nationkey, c_mktsegment
                    FROM o JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
         m AS (SELECT *, CASE owner WHEN 'MDS' THEN CASE WHEN c_nationkey < 20 THEN n_name ELSE 'HEAD' END
                   WHEN 'CS' THEN CASE WHEN c_mktsegment = 'BUILDING' THEN 'OWN ' || c_name ELSE r_name END ELSE r_name END AS manager FROM x)
    SELECT o_orderkey AS order_nbr, owner, manager, CASE WHEN owner = 'MDS' THEN c_name ELSE manager END AS in_charge FROM m""")
def owner_assignment(t):
    o = _orders(t).select("order_nbr", "cust_id",
                          codes.label("terms", {"O1": "MDS", "T2": "MDS", "T3": "INS"}, "CS").alias("owner"))
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("staff_name"), F.col("c_nationkey").alias("staff"),
        F.col("n_regionkey").alias("area"))
    rows = equi(o, c, "cust_id", "inner").withColumn("customer", F.col("cust_id"))
    by_area = t.region.select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    by_staff = t.nation.filter("n_nationkey < 20").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    by_customer = t.customer.filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("key"), F.concat(F.lit("OWN "), "c_name").alias("name"))
    return rec.assign_owner(rows, by_area, by_customer, by_staff, "HEAD").select("order_nbr", "owner", "manager", "in_charge")


SPECIAL = [f"Brand#{i}" for i in range(1, 16)]


@query("terms_override", f"""
    WITH {O}, e AS (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
                    HAVING bool_and(p_brand IN ({', '.join(repr(b) for b in SPECIAL)})))
    SELECT o_orderkey AS order_nbr, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM e) THEN 'S30' ELSE terms END AS terms FROM o""")
def terms_override(t):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("order_nbr"), "p_brand")
    special = rec.exclusive_orders(lines, ["order_nbr"], "p_brand", SPECIAL)
    return rec.override_terms(_orders(t), special, ["order_nbr"], "terms", "S30").select("order_nbr", "terms")


# ---- stock -----------------------------------------------------------------------------

def _feeds(t):
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name"),
                      F.concat(F.when(F.col("p_brand") == "Brand#13", "V").otherwise("P"), "p_partkey").alias("product"),
                      F.when(F.col("p_size") > 25, "Hộp").otherwise("Cái").alias("unit"))
    flag = F.col("l_returnflag")
    rows = equi(t.lineitem, p, "l_partkey", "inner").select(
        F.col("l_suppkey").alias("warehouse"), "product", "name", "unit", F.col("l_linestatus").alias("lot"),
        month_start("l_shipdate").alias("expiry"), F.col("l_quantity").alias("quantity"),
        F.when(flag == "N", F.round(F.col("l_tax") * 100, 2)).alias("held"), F.when(flag == "N", F.lit(1.0)).alias("pending"),
        F.when(F.col("l_linestatus") == "O", "pending").otherwise("done").alias("state"),
        F.when(F.col("l_discount") < 0.05, "purchase").otherwise("other").alias("kind"),
        F.to_date("l_shipdate").alias("on_day"), flag.alias("movement"))
    return stock.feeds_of(rows, {"N": "stock", "R": "receipt", "A": "transfer"}, keep=["on_day"])


def _warehouses(t):
    key = F.col("s_nationkey")
    cls = F.when(key < 5, "CN").when(key < 10, "HCM").when(key < 14, "CENTRAL").when(key < 18, "PARTNER").when(key < 21, "ECE")
    return t.supplier.join(t.nation, key == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("warehouse"), F.nullif("n_name", F.lit("NATION_3")).alias("branch"), cls.alias("wh_class"),
        key.cast("double").alias("receive_days"))


FEEDS = f"""p AS (SELECT p_partkey, p_name AS name, CASE WHEN p_brand = 'Brand#13' THEN 'V' ELSE 'P' END || p_partkey AS product,
        CASE WHEN p_size > 25 THEN 'HOP' ELSE 'CAI' END AS unit FROM part),
    f AS (SELECT l_suppkey AS wh, product, name, unit, l_linestatus AS lot, date_trunc('month', l_shipdate)::DATE AS expiry, l_shipdate::DATE AS on_day, {dec('l_quantity')} AS q,
            CASE WHEN l_returnflag = 'N' THEN CAST(l_tax * 100 AS DECIMAL(18,2)) + 1 ELSE 0 END AS virt,
            CASE WHEN l_returnflag = 'N' THEN 'stock' ELSE 'pending' END AS feed
        FROM lineitem JOIN p ON l_partkey = p_partkey
        WHERE (l_returnflag = 'N' AND product NOT LIKE 'V%') OR (l_returnflag = 'R' AND l_linestatus = 'O' AND l_discount < 0.05) OR l_returnflag = 'A'),
    w AS (SELECT s_suppkey, coalesce(nullif(n_name, 'NATION_3'), 'NA') AS branch, n_nationkey AS k,
            CASE WHEN n_nationkey < 5 THEN 'CN' WHEN n_nationkey < 10 THEN 'HCM' WHEN n_nationkey < 14 THEN 'CENTRAL'
                 WHEN n_nationkey < 18 THEN 'PARTNER' WHEN n_nationkey < 21 THEN 'ECE' END AS cls
        FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
_IS = {"in_transit": "feed = 'pending'", **{n: f"feed = 'stock' AND cls = '{c}'" for c, n in stock.CLASS_MEASURES.items() if c != "HDD"}}
_FACT = {n: f"kind = '{c}'" for c, n in stock.FACTORY_MEASURES.items()}
POSITION = f"""{FEEDS},
    pos AS (SELECT product, name, unit, branch, CAST(k AS DOUBLE) AS receive_days, sum(virt) AS virtual,
            {', '.join(f"sum(CASE WHEN {c} THEN q ELSE 0 END) AS {n}" for n, c in _IS.items())},
            sum(CASE WHEN wh IN (7, 8) THEN q ELSE 0 END) AS destroyed_branch, sum(CASE WHEN wh = 9 THEN q ELSE 0 END) AS destroyed_city,
            {', '.join(f'0 AS {n}' for n in _FACT)}
        FROM f JOIN w ON wh = s_suppkey WHERE cls IS NOT NULL GROUP BY ALL
        UNION ALL SELECT product, name, unit, 'NM', 0, 0, {', '.join('0' for _ in _IS)}, 0, 0,
            {', '.join(f"sum(CASE WHEN {c} THEN {dec('p_size')} ELSE 0 END)" for c in _FACT.values())}
        FROM p JOIN (SELECT p_partkey, p_size, CASE p_type WHEN 'ECONOMY' THEN 'TP' WHEN 'PROMO' THEN 'BT' WHEN 'STANDARD' THEN 'PO' ELSE 'HH' END AS kind
                     FROM part) k USING (p_partkey) GROUP BY ALL)"""
NUMBERS = ["receive_days", "virtual", *_IS, "destroyed_branch", "destroyed_city", *_FACT]
DESTROYED = {"destroyed_branch": [7, 8], "destroyed_city": [9]}


def _position(t, sheet=None):
    factory = t.part.select(
        F.concat(F.when(F.col("p_brand") == "Brand#13", "V").otherwise("P"), "p_partkey").alias("product"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 25, "HOP").otherwise("CAI").alias("unit"), F.col("p_size").alias("quantity"),
        codes.label("p_type", {"ECONOMY": "TP", "PROMO": "BT", "STANDARD": "PO"}, "HH").alias("kind"))
    return stock.stock_position(_feeds(t), _warehouses(t), destroyed=DESTROYED, factory=factory, sheet=sheet)


@query("stock_position", f"""
    WITH {POSITION},
         sheet AS (SELECT product, coalesce(nullif(n_name, 'NATION_3'), 'NA') AS branch, sum({dec('p_size')}) AS q
                   FROM p JOIN part USING (p_partkey) JOIN nation ON n_nationkey = p_partkey % 25 WHERE p_size > 40 GROUP BY ALL),
         known AS (SELECT * FROM pos WHERE branch <> 'NM'),
         nm AS (SELECT product, max(name) AS name, max(unit) AS unit FROM known GROUP BY product),
         br AS (SELECT branch, max(receive_days) AS receive_days FROM known GROUP BY branch),
         allp AS (SELECT * FROM pos UNION ALL SELECT product, name, unit, branch, coalesce(receive_days, 0),
                      {', '.join('q' if n == 'in_transit' else '0' for n in NUMBERS[1:])}
                  FROM sheet LEFT JOIN nm USING (product) LEFT JOIN br USING (branch))
    SELECT product, name, unit, branch, CAST(receive_days AS DOUBLE) AS receive_days,
           {', '.join(f'CAST(sum({n}) AS DOUBLE) AS {n}' for n in NUMBERS[1:])} FROM allp GROUP BY product, name, unit, branch, receive_days""")
def stock_position(t):
    # The sheet of goods in transit: large parts, under the branch of their number.
    big = t.part.filter("p_size > 40").select(
        F.concat(F.when(F.col("p_brand") == "Brand#13", "V").otherwise("P"), "p_partkey").alias("product"),
        (F.col("p_partkey") % 25).alias("n_nationkey"), F.col("p_size").alias("quantity"))
    sheet = equi(big, t.nation.select(F.col("n_nationkey").cast("bigint"), F.nullif("n_name", F.lit("NATION_3")).alias("branch")),
                 "n_nationkey", "inner").drop("n_nationkey")
    # The position is staged for its sheet; of that only the keys are read to check it.
    position = assert_unique(_position(t, sheet), ["product", "branch"])
    return position.withColumns({n: F.col(n).cast("double") for n in NUMBERS})


def _three_months(t, as_of):
    sold = equi(t.lineitem.filter("l_returnflag = 'N'"), t.part.select(
        F.col("p_partkey").alias("l_partkey"), F.concat(F.when(F.col("p_brand") == "Brand#13", "V").otherwise("P"), "p_partkey").alias("product")),
        "l_partkey", "inner").select("product", F.col("l_suppkey").alias("warehouse"), F.col("l_quantity").alias("quantity"), "l_shipdate")
    wh = _warehouses(t).withColumn("branch", F.coalesce("branch", F.lit("NA")))
    return stock.three_month_sales(sold, wh, "l_shipdate", as_of)


@query("stock_cover", f"""
    WITH {POSITION},
         s AS (SELECT product, branch, CAST(sum({dec('l_quantity')}) AS DOUBLE) AS sold FROM lineitem JOIN p ON l_partkey = p_partkey
               JOIN w ON l_suppkey = s_suppkey WHERE l_returnflag = 'N' AND l_shipdate >= DATE '2001-03-01' GROUP BY ALL)
    SELECT pos.product, pos.branch, coalesce(sold, 0) AS sold, coalesce(round_even(sold / 77, 0), 0) AS average,
           CAST(branch_stock + city + central + partner + virtual + in_transit AS DOUBLE) AS total_stock,
           round_even(CAST(branch_stock + city + central + partner + virtual + in_transit AS DOUBLE) / nullif(round_even(sold / 77, 0), 0), 0) AS cover_days
    FROM pos LEFT JOIN s ON s.product = pos.product AND s.branch = pos.branch""")
def stock_cover(t):
    out = stock.stock_cover(_position(t), _three_months(t, "2001-06-01"),
                            ["branch_stock", "city", "central", "partner", "virtual", "in_transit"])
    return out.select("product", "branch", "sold", "average", "total_stock", "cover_days")


@query("stock_by_lot", f"""
    WITH {FEEDS}
    SELECT product, name, unit, coalesce(branch, 'NA') AS branch, lot, {ymd('expiry')} AS expiry,
           CAST(sum(q) AS DOUBLE) AS quantity, CAST(sum(virt) AS DOUBLE) AS virtual
    FROM f LEFT JOIN w ON wh = s_suppkey GROUP BY product, name, unit, branch, lot, expiry""".replace("product, name, unit, coalesce", "product, name, CASE unit WHEN 'HOP' THEN 'Hộp' ELSE 'Cái' END AS unit, coalesce"))
def stock_by_lot(t):
    return stock.stock_by_lot(_feeds(t), _warehouses(t))


@query("stock_restatement", f"""
    WITH {FEEDS},
         snap AS (SELECT f.*, created_date FROM f CROSS JOIN (VALUES (DATE '2001-05-25'), (DATE '2001-05-26')) v(created_date) WHERE on_day <= created_date),
         pos AS (SELECT created_date, product, name, unit, branch, sum(virt) AS virtual,
                 {', '.join(f"sum(CASE WHEN {c} THEN q ELSE 0 END) AS {n}" for n, c in _IS.items())}
             FROM snap JOIN w ON wh = s_suppkey WHERE cls IS NOT NULL GROUP BY ALL),
         s AS (SELECT product, branch, CAST(sum({dec('l_quantity')}) AS DOUBLE) AS sold FROM lineitem JOIN p ON l_partkey = p_partkey
               JOIN w ON l_suppkey = s_suppkey WHERE l_returnflag = 'N' AND l_shipdate >= DATE '2001-02-28' GROUP BY ALL)
    SELECT {ymd('created_date')} AS created_date, pos.product, pos.branch, CAST(virtual AS DOUBLE) AS virtual,
           {', '.join(f'CAST({n} AS DOUBLE) AS {n}' for n in _IS)},
           CASE WHEN created_date = DATE '2001-05-26' THEN coalesce(sold, 0) ELSE 0 END AS sold,
           CASE WHEN created_date = DATE '2001-05-26' THEN coalesce(round_even(sold / 77, 0), 0) ELSE 0 END AS average
    FROM pos LEFT JOIN s ON s.product = pos.product AND s.branch = pos.branch""")
def stock_restatement(t):
    """On a Monday: the position of two days back is made anew, with the sales known by then."""
    monday = "2001-05-28"
    day = stock.restated_day(monday)
    days = F.array(F.lit(day - dt.timedelta(days=1)), F.lit(day))
    dated = _feeds(t).withColumn("created_date", F.explode(days)).filter("on_day <= created_date")
    columns = ["created_date", "product", "branch", "virtual", *_IS, "sold", "average"]
    both = written(stock.stock_position(dated, _warehouses(t), by=["created_date"]), "positions")
    none = both.withColumns({"sold": F.lit(0.0), "average": F.lit(0.0)}).select(*columns)
    # What was stored for the day is stale: all of it is twice too much.
    stale = F.col("created_date") == F.lit(day)
    stored = none.withColumn("virtual", F.when(stale, F.col("virtual") * 2).otherwise(F.col("virtual")))
    fresh = both.filter(stale).drop("created_date")
    return stock.restated_position(stored, fresh, _three_months(t, monday), monday)


@query("purchase_shortfall", f"""
    WITH x AS (SELECT s_nationkey AS branch, CASE WHEN l_linestatus = 'O' AND l_linenumber < 3 THEN 'KHONGCOYCRH' ELSE 'R' || l_linenumber END AS request,
                      l_partkey AS product, {dec('l_quantity')} AS q, l_returnflag AS flag FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
    SELECT CAST(branch AS BIGINT) AS branch, request, product, CAST(sum(q) AS DOUBLE) AS ordered,
           CAST(sum(CASE WHEN flag = 'N' THEN q ELSE 0 END) AS DOUBLE) AS received, CAST(sum(CASE WHEN flag = 'R' THEN q ELSE 0 END) AS DOUBLE) AS awaiting,
           CAST(sum(CASE WHEN flag = 'A' THEN q ELSE 0 END) AS DOUBLE) AS shortfall
    FROM x GROUP BY branch, request, product HAVING sum(CASE WHEN flag = 'A' THEN q ELSE 0 END) > 0""")
def purchase_shortfall(t):
    none = (F.col("l_linestatus") == "O") & (F.col("l_linenumber") < 3)
    request = F.when(none & (F.col("l_linenumber") == 1), "").when(~none, F.concat(F.lit("R"), F.col("l_linenumber")))
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").alias("branch"), request.alias("request"), F.col("l_partkey").alias("product"),
        money("l_quantity").alias("quantity"), "l_returnflag")
    keys = ["branch", "request", "product"]
    named = rows.withColumn("request", F.coalesce(F.nullif("request", F.lit("")), F.lit(stock.NO_REQUEST)))
    ordered = named.groupBy(*keys).agg(
        F.sum("quantity").alias("ordered"),
        F.sum(F.when(F.col("l_returnflag") == "N", F.col("quantity")).otherwise(F.lit(0))).alias("received"))
    return stock.purchase_shortfall(ordered, rows.filter("l_returnflag = 'R'"), keys, "request")


@query("lot_receipts", f"""
    SELECT l_orderkey AS order_nbr, l_partkey AS product, count(*) AS lots,
           CAST(sum(CAST(CASE WHEN p_type = 'PROMO' THEN l_quantity * p_size ELSE l_quantity / p_size END AS DECIMAL(24,6))) AS DOUBLE) AS received
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY ALL""")
def lot_receipts(t):
    lots = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("order_nbr"), F.col("l_partkey").alias("product"), F.col("l_quantity").alias("qty"),
        F.col("p_size").alias("unit_rate"), F.when(F.col("p_type") == "PROMO", "M").otherwise("D").alias("unit_op"))
    docs = t.orders.select(F.col("o_orderkey").alias("order_nbr"), codes.label("o_orderstatus", {"F": 1, "O": -1}, 0).alias("sign"))
    return stock.lot_receipts(lots, docs, ["order_nbr"]).groupBy("order_nbr", "product").agg(
        F.count(F.lit(1)).alias("lots"), F.sum(F.col("received").cast("decimal(24,6)")).alias("received"))


# ---- history ---------------------------------------------------------------------------

@query("version_history", """
    SELECT o_orderkey, o_custkey, version_id FROM (
        SELECT o_orderkey, o_custkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version_id
        FROM orders) WHERE o_orderdate >= DATE '1998-01-01'""")
def version_history(t):
    cols, order, bucket = ["o_orderkey", "o_custkey", "o_orderdate"], ["o_orderdate", "o_orderkey"], F.to_date("o_orderdate")
    cut = F.lit(dt.date(1998, 1, 1))
    stored = history.versions(t.orders.select(*cols).filter(F.col("o_orderdate") < cut), None, ["o_custkey"], order, bucket)
    new = history.versions(t.orders.select(*cols).filter(F.col("o_orderdate") >= cut), stored, ["o_custkey"], order, bucket)
    return new.select("o_orderkey", "o_custkey", "version_id")


def _versions(t):
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus",
                        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
                        F.when(F.col("o_totalprice") > 400000, " ").otherwise(F.year("o_orderdate").cast("string")).alias("class"))
    return history.versions(o, None, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.to_date("o_orderdate"))


CHANGES = """v AS (SELECT o_custkey, row_number() OVER w AS version_id, o_orderstatus AS s0, nullif(o_orderpriority, '5-LOW') AS p0,
        CASE WHEN o_totalprice > 400000 THEN 'Unknow' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS c0, o_orderdate AS d0, o_orderkey
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
    l AS (SELECT *, lag(s0) OVER w AS s1, lag(p0) OVER w AS p1, lag(c0) OVER w AS c1 FROM v WINDOW w AS (PARTITION BY o_custkey ORDER BY version_id)),
    u AS (SELECT o_custkey, version_id, 'o_orderstatus' AS attribute, s1 AS old_value, s0 AS new_value FROM l
          UNION ALL SELECT o_custkey, version_id, 'priority', p1, p0 FROM l UNION ALL SELECT o_custkey, version_id, 'class', c1, c0 FROM l)"""


@query("attribute_changes", f"""
    WITH {CHANGES} SELECT * FROM u WHERE version_id > 1 AND old_value IS DISTINCT FROM new_value""")
def attribute_changes(t):
    return history.attribute_changes(_versions(t), ["o_custkey"], "version_id", ["o_orderstatus", "priority", "class"])


@query("attribute_changes_no_nulls", f"""
    WITH {CHANGES} SELECT * FROM u WHERE version_id > 1 AND old_value <> new_value""")
def attribute_changes_no_nulls(t):
    return history.attribute_changes(_versions(t), ["o_custkey"], "version_id", ["o_orderstatus", "priority", "class"],
                                     keep_nulls=False)


@query("snapshot_soft_delete", """
    WITH st AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'left' ELSE 'active' END AS status FROM customer
                WHERE c_mktsegment <> 'HOUSEHOLD'),
         cu AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOMES' ELSE c_mktsegment END AS c_mktsegment, 'active' AS status
                FROM customer WHERE c_acctbal > 1000)
    SELECT c_custkey, c_mktsegment, 'left' AS status FROM st WHERE c_custkey NOT IN (SELECT c_custkey FROM cu) AND status <> 'left'
    UNION ALL (SELECT * FROM cu EXCEPT SELECT * FROM st)""")
def snapshot_soft_delete(t):
    c = t.customer
    stored = c.filter("c_mktsegment <> 'HOUSEHOLD'").select(
        "c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") < 0, "left").otherwise("active").alias("status"), F.lit(1).alias("loaded"))
    # An older load of the same people, which the latest view must hide.
    older = stored.withColumns({"loaded": F.lit(0), "c_mktsegment": F.lit("OLD")})
    last = history.current_list(union_by_name([stored, older]), "c_custkey", ["loaded"]).drop("loaded")
    current = c.filter("c_acctbal > 1000").select(
        "c_custkey", codes.replace_values("c_mktsegment", {"BUILDING": "HOMES"}).alias("c_mktsegment"), F.lit("active").alias("status"))
    return history.snapshot_diff(last, current, "c_custkey", "status", "left")


# ---- activity --------------------------------------------------------------------------

@query("visit_compliance", f"""
    WITH e AS (SELECT event_id, user_id, user_id % 10 AS staff, value, event_type, date_trunc('month', ts)::DATE AS m FROM events),
         p AS (SELECT DISTINCT staff, m, user_id FROM e WHERE event_type = 'view'),
         v AS (SELECT staff, m, user_id, count(*) FILTER (event_type = 'click' AND value > 100) AS checks, count(*) FILTER (event_type = 'purchase') AS ords
               FROM e WHERE event_type IN ('click', 'purchase') GROUP BY ALL),
         lic AS (SELECT c_custkey, DATE '2024-01-01' + CAST(floor(c_acctbal / 100) AS INTEGER) AS fin FROM customer),
         n AS (SELECT staff, m, count(*) AS unvisited FROM v WHERE checks = 0 GROUP BY ALL),
         g AS (SELECT staff, m, count(*) FILTER (fin < DATE '2024-01-20') AS expired,
                      count(*) FILTER (fin > DATE '2024-01-20' AND fin <= DATE '2024-02-19') AS expiring FROM p JOIN lic ON c_custkey = user_id GROUP BY ALL),
         o AS (SELECT staff, m, CAST(sum(ords) AS BIGINT) AS orders, CAST(sum(checks) AS BIGINT) AS checkins FROM v GROUP BY ALL)
    SELECT p.staff, {ymd('p.m')} AS month, count(*) AS planned, any_value(coalesce(unvisited, 0)) AS unvisited,
           any_value(coalesce(expired, 0)) AS expired, any_value(coalesce(expiring, 0)) AS expiring, any_value(coalesce(orders, 0)) AS orders,
           any_value(coalesce(checkins, 0)) AS checkins, any_value(coalesce(round(100.0::DOUBLE * orders / nullif(checkins, 0), 0), 0)) AS order_ratio
    FROM p LEFT JOIN n USING (staff, m) LEFT JOIN g USING (staff, m) LEFT JOIN o USING (staff, m) GROUP BY p.staff, p.m""")
def visit_compliance(t):
    e = t.events.select("event_id", "event_type", "value", F.col("user_id").alias("customer"), (F.col("user_id") % 10).alias("staff"),
                        F.col("ts").alias("visit_date"))
    real = (F.col("event_type") == "click") & (F.col("value") > 100)
    visits = e.filter("event_type in ('click', 'purchase')").withColumns({
        "checkin_id": F.when(real, F.col("event_id")),
        "order_id": F.when(F.col("event_type") == "purchase", F.col("event_id"))})
    licences = t.customer.select(F.col("c_custkey").alias("customer"), F.date_add(
        F.lit(dt.date(2024, 1, 1)), F.floor(F.col("c_acctbal") / 100).cast("int")).alias("licence_end"))
    return activity.visit_compliance(e.filter("event_type = 'view'"), visits, licences, "2024-01-20")


@query("lead_times", """
    WITH s AS (SELECT l_orderkey, min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)
    SELECT o_orderkey, date_diff('minute', o_orderdate, a) AS to_ship, date_diff('minute', a, b) AS to_finish,
           date_diff('minute', o_orderdate, b) AS full_time FROM orders JOIN s ON l_orderkey = o_orderkey
    WHERE date_diff('minute', o_orderdate, a) >= 0""")
def lead_times(t):
    shipped = t.lineitem.filter("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    rows = equi(t.orders.select("o_orderkey", "o_orderdate"), shipped, "o_orderkey", "inner")
    steps = {"to_ship": ("o_orderdate", "a"), "to_finish": ("a", "b"), "full_time": ("o_orderdate", "b")}
    return activity.lead_times(rows, steps, ("o_orderdate", "a")).select("o_orderkey", *steps)


@query("checkin_trace", f"""
    WITH v AS (SELECT * FROM events WHERE event_type = 'click')
    SELECT v.user_id AS staff, {ymdhms('v.ts')} AS checkin_time, CAST(d.event_id AS VARCHAR) AS order_nbr, {ymdhms('d.ts')} AS delivery_time
    FROM v LEFT JOIN events d ON d.event_type = 'purchase' AND d.user_id = v.user_id AND CAST(d.ts AS DATE) = CAST(v.ts AS DATE)""")
def checkin_trace(t):
    e = t.events.select(F.lit("B1").alias("branch_id"), F.col("user_id").alias("staff"), F.to_date("ts").alias("visit_nbr"),
                        F.col("user_id").alias("customer"), F.col("ts").alias("time"), "event_id", "event_type")
    visits = e.filter("event_type = 'click'").withColumn("type", F.lit("IO"))
    events = e.filter("event_type = 'purchase'").withColumn("type", F.concat(F.lit("DE"), "event_id"))
    out = activity.checkin_trace(union_by_name([visits, events]).drop("event_id", "event_type"))
    return out.select("staff", "checkin_time", "order_nbr", "delivery_time")


@query("checkin_rows", f"""
    SELECT event_id, user_id AS staff, {ymdhms('ts')} AS time, CASE event_type WHEN 'click' THEN 'IO' ELSE 'OO' END AS check_type
    FROM events WHERE event_type IN ('click', 'view')""")
def checkin_rows(t):
    kind = codes.label("event_type", {"click": "IO", "view": "OO"}, "DE")
    trace = t.events.select("event_id", F.col("user_id").alias("staff"), F.col("ts").alias("time"), kind.alias("type"))
    return activity.check_rows(trace).drop("type")


@query("delivery_state", f"""
    WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, o_orderdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey
               QUALIFY l_linenumber = max(l_linenumber) OVER (PARTITION BY l_orderkey)),
         h AS (SELECT l_orderkey, max(l_shipdate) AS s FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL)
    SELECT l.l_orderkey AS order_nbr, CAST(l_linenumber AS BIGINT) AS sequence, l_returnflag AS status, {ymd('coalesce(s, o_orderdate)')} AS ship_date
    FROM l LEFT JOIN h ON h.l_orderkey = l.l_orderkey""")
def delivery_state(t):
    rows = t.lineitem.select(F.col("l_orderkey").alias("order_nbr"), F.col("l_linenumber").alias("sequence"),
                             F.col("l_returnflag").alias("status"), F.col("l_shipdate").alias("ship_date"))
    steps = rows.drop("ship_date").withColumn("created", F.lit(None).cast("timestamp_ntz"))
    state = activity.delivery_state(steps, rows.filter("status = 'N'"), ["order_nbr"])
    # Orders that never shipped show their own date.
    out = facts(state, t.orders.select(F.col("o_orderkey").alias("order_nbr"), "o_orderdate"), "order_nbr")
    return out.select("order_nbr", "sequence", "status", F.to_date(F.coalesce("ship_date", "o_orderdate")).alias("ship_date"))


@query("visit_notes", """
    SELECT event_id, CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'opened' ELSE event_type END AS type_label,
           CASE WHEN event_type <> 'error' THEN 'https://images.example.com/' || event_id || '.jpg' END AS image FROM events""")
def visit_notes(t):
    notes = t.events.select("event_id", F.col("event_type").alias("type"), F.when(
        F.col("event_type") == "error", " ").otherwise(F.concat(F.col("event_id").cast("string"), F.lit(".jpg"))).alias("image"))
    return activity.visit_notes(notes, {"view": "seen", "click": "opened"}, "https://images.example.com/").drop("type")


@query("planned_routes", f"""
    WITH v AS (SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type IN ('view', 'click')),
         s AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS a, CASE WHEN day(ts) = 1 THEN CAST(ts AS DATE) + 9 ELSE DATE '9999-12-31' END AS z
               FROM events WHERE day(ts) IN (1, 11)),
         c AS (SELECT user_id, event_type, min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS z FROM events WHERE event_type <> 'click' OR day(ts) > 5 GROUP BY ALL)
    SELECT DISTINCT v.event_type AS route, v.user_id AS customer, {ymd('d')} AS visit_date, {ymd('s.a')} AS staff
    FROM v JOIN s ON s.event_type = v.event_type AND d BETWEEN s.a AND s.z
    JOIN c ON c.event_type = v.event_type AND c.user_id = v.user_id AND d BETWEEN c.a AND c.z""")
def planned_routes(t):
    e = t.events.select(F.col("event_type").alias("route"), F.col("user_id").alias("customer"), F.to_date("ts").alias("day"))
    visits = e.filter("route in ('view', 'click')").select("route", "customer", F.lit(1).alias("freq"), F.col("day").alias("visit_date")).distinct()
    open_end = F.when(F.dayofmonth("day") == 1, F.date_add("day", 9)).otherwise(F.lit(dt.date(9999, 12, 31)))
    terms = e.filter(F.dayofmonth("day").isin(1, 11)).select("route", "day").distinct().select(
        "route", F.date_format("day", "yyyy-MM-dd").alias("staff"), F.col("day").alias("from_date"), open_end.alias("to_date"))
    validity = e.filter("route <> 'click' or dayofmonth(day) > 5").groupBy("route", "customer", F.lit(1).alias("freq")).agg(
        F.min("day").alias("start_date"), F.max("day").alias("end_date"))
    return activity.planned_routes(visits, terms, validity).drop("freq")


# ---- wide sheets, notes, discounts -----------------------------------------------------

@query("plan_unpivot", f"""
    SELECT o_orderpriority AS product, strftime(o_orderdate, '%Y-%m') AS month, {ymd('o_orderdate')} AS plan_date,
           count(*) AS quantity, 'plan ' || o_orderpriority AS stage
    FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority, o_orderdate""")
def plan_unpivot(t):
    days = [str(d) for d in range(1, 32)]

    def sheet(months):
        o = t.orders.filter(months).select(
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("product"),
            month_key("o_orderdate").alias("month"), F.dayofmonth("o_orderdate").alias("d"))
        counted = o.groupBy("product", "month", F.concat(F.lit("plan "), "product").alias("stage")).agg(*[
            F.count_if(F.col("d") == int(d)).alias(d) for d in days])
        # Empty days hold text, as filled-in sheets do.
        return counted.withColumns({d: F.when(F.col(d) > 0, F.format_number(d, 0)).otherwise("-") for d in days})

    until, since = F.col("o_orderdate") < F.lit(dt.date(1998, 1, 1)), F.col("o_orderdate") >= F.lit(dt.date(1998, 1, 1))
    out = masters.production_plan([sheet(until), sheet(since)], ["product"], days, "month", "product", ["stage"])
    return out.select("product", "month", "plan_date", "quantity", "stage")


SEGMENT_LIST = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGION_LIST = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("access_matrix", """
    WITH g AS (SELECT o_orderpriority AS report, c_mktsegment || '-' || r_name AS staff_group FROM orders JOIN customer ON o_custkey = c_custkey
               JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
               GROUP BY ALL HAVING count(*) FILTER (o_orderstatus = 'F') > count(*) FILTER (o_orderstatus = 'P')),
         s AS (SELECT c_custkey AS person, c_mktsegment || '-' || r_name AS staff_group FROM customer
               JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT report, person, staff_group FROM g JOIN s USING (staff_group)""")
def access_matrix(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    staff = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select(F.col("c_custkey").alias("person"), "c_mktsegment", "r_name")
    groups = [f"{s}-{r}" for s in SEGMENT_LIST for r in REGION_LIST]
    o = t.orders.join(staff, F.col("o_custkey") == F.col("person")).withColumn("g", F.concat_ws("-", "c_mktsegment", "r_name"))
    balance = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "P", -1).otherwise(0)
    wide = o.groupBy(F.col("o_orderpriority").alias("report")).agg(*[
        F.when(F.sum(F.when(F.col("g") == g, balance).otherwise(0)) > 0, "x").alias(g) for g in groups])
    return masters.access_matrix(wide, ["report"], staff, ["c_mktsegment", "r_name"], "person", "report")


NOTES = f"""w AS (SELECT user_id, date_trunc('month', ts)::DATE AS m, ((day(ts) - 1) // 7) + 1 AS week, max(event_type) AS note FROM events WHERE event_type IN ('view', 'signup') GROUP BY ALL),
    a AS (SELECT user_id, m + CAST((week - 1) * 7 AS INTEGER) AS note_date, note, 0 AS rank FROM w),
    b AS (SELECT user_id, CAST(ts AS DATE) AS note_date, 'P' || event_id AS note, 1 AS rank FROM events WHERE event_type = 'purchase'),
    c AS (SELECT user_id, CAST(ts AS DATE) AS note_date, 'E' || event_id AS note, 2 AS rank FROM events WHERE event_type = 'error' AND value > 5),
    n AS (SELECT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)
          QUALIFY row_number() OVER (PARTITION BY user_id, note_date ORDER BY rank DESC, note DESC) = 1)"""


WEEKS = range(1, 6)  # a month has days in five weeks of seven


def _notes(t):
    e = t.events
    week, month = F.floor((F.dayofmonth("ts") - 1) / 7) + 1, month_key("ts").alias("month")
    weekly = e.filter("event_type in ('view', 'signup')").groupBy("user_id", month).agg(*[
        F.max(F.when(week == i, F.concat(F.lit(" "), "event_type", F.lit("\t")))).alias(f"w{i}") for i in WEEKS])
    # The calendar sheet: first day of each week of a month, derived from the event days.
    calendar = e.select(month, F.concat(F.lit("w"), week.cast("string")).alias("week"),
                        F.date_add(F.trunc("ts", "month"), ((week - 1) * 7).cast("int")).alias("note_date")).distinct()

    def others(kind, letter, rank, cond):
        return e.filter((F.col("event_type") == kind) & cond).select(
            "user_id", F.to_date("ts").alias("note_date"), F.concat(F.lit(letter), "event_id").alias("note"), F.lit(rank).alias("rank"))

    return masters.consolidated_notes(
        weekly, ["user_id", "month"], [f"w{i}" for i in WEEKS], calendar,
        [others("purchase", "P", 1, F.lit(True)), others("error", "E", 2, F.col("value") > 5)],
        ["user_id", "note_date"], [F.coalesce("rank", F.lit(0)), "note"], ["note"], period=["month"])


@query("note_consolidation", f"WITH {NOTES} SELECT user_id, {ymd('note_date')} AS note_date, note FROM n")
def note_consolidation(t):
    return _notes(t).select("user_id", "note_date", "note")


@query("note_check", f"""
    WITH {NOTES} SELECT user_id, c_name AS name, {ymd('note_date')} AS note_date, note FROM n LEFT JOIN customer ON c_custkey = user_id
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY note_date DESC) = 1""")
def note_check(t):
    names = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    return masters.latest_notes(_notes(t), "user_id", "note_date", names).select("user_id", "name", "note_date", "note")


@query("discount_lines", """
    WITH d AS (SELECT DISTINCT l_orderkey, unnest([l_linenumber, l_linenumber + 1]) AS line_ref, l_returnflag || CAST(CAST(l_discount * 100 AS INTEGER) AS VARCHAR) AS promo,
                      'type ' || l_returnflag AS kind FROM lineitem),
         r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, line_ref ORDER BY promo) AS n FROM d)
    SELECT l_orderkey, CAST(line_ref AS VARCHAR) AS line_ref, max(promo) FILTER (n = 1) AS promo1, max(promo) FILTER (n = 2) AS promo2,
           max(promo) FILTER (n = 3) AS promo3, max(kind) FILTER (n = 1) AS kind1, max(kind) FILTER (n = 2) AS kind2, max(kind) FILTER (n = 3) AS kind3,
           count(*) AS promotions
    FROM r GROUP BY l_orderkey, line_ref""")
def discount_lines(t):
    rows = t.lineitem.select(
        "l_orderkey", F.concat(F.col("l_linenumber").cast("string"), F.lit(", "), F.col("l_linenumber") + 1, F.lit(",")).alias("lines"),
        F.concat("l_returnflag", F.round(F.col("l_discount") * 100, 0).cast("int").cast("string")).alias("promo"),
        F.concat(F.lit("type "), "l_returnflag").alias("kind"))
    return masters.discount_lines(rows, ["l_orderkey"], "lines", "promo", ["kind"])


# ---- masters ---------------------------------------------------------------------------

@query("customer_master", f"""
    SELECT c_custkey, n_name AS nation_n_name, r_name AS region_r_name, concat_ws(', ', c_name, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END, n_name, r_name) AS address,
           {ymd("least(DATE '2262-04-11', CASE WHEN c_acctbal < 0 THEN DATE '9999-12-31' ELSE DATE '2024-01-01' + CAST(floor(c_acctbal) AS INTEGER) END)")} AS licence_end
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def customer_master(t):
    end = F.when(F.col("c_acctbal") < 0, F.lit(dt.date(9999, 12, 31))).otherwise(
        F.date_add(F.lit(dt.date(2024, 1, 1)), F.floor("c_acctbal").cast("int")))
    c = t.customer.withColumns({"licence_end": end, "street": F.nullif("c_mktsegment", F.lit("MACHINERY"))})
    # The nation list twice: one row per key has to survive.
    nations = union_by_name([t.nation, t.nation])
    out = masters.customer_master(
        c, [(nations, "c_nationkey", "n_nationkey", "nation_", ["n_name", "n_regionkey"]),
            (t.region, "nation_n_regionkey", "r_regionkey", "region_", ["r_name"])],
        ["c_name", "street", "nation_n_name", "region_r_name"], "licence_end")
    return out.select("c_custkey", "nation_n_name", "region_r_name", "address", "licence_end")


@query("role_master", """
    SELECT c_name AS user_name, CAST(c_acctbal > 0 AS BIGINT) AS active,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'LOG' WHEN c_nationkey < 5 AND c_mktsegment <> 'FURNITURE' THEN 'MDS'
                WHEN c_mktsegment = 'BUILDING' THEN 'CS' WHEN c_nationkey BETWEEN 5 AND 9 THEN 'P.BH' WHEN c_nationkey < 5 THEN 'SD' ELSE 'X' END AS role
    FROM customer""")
def role_master(t):
    staff = t.customer.select(
        F.col("c_name").alias("user_name"), F.when(F.col("c_acctbal") > 0, "AC").otherwise("IN").alias("status"),
        codes.label("c_mktsegment", {"MACHINERY": "ALOG", "BUILDING": "CSR", "FURNITURE": None}, "none").alias("user_types"),
        F.when(F.col("c_nationkey") < 5, "SD").when(F.col("c_nationkey") < 10, "AM").otherwise("X").alias("position"))
    return masters.role_master(staff).select("user_name", "active", "role")


@query("hierarchy", """
    SELECT c_custkey AS staff, CASE WHEN n_nationkey NOT IN (2, 3, 12) THEN n_name ELSE CASE WHEN r_name <> 'ASIA' THEN r_name ELSE 'TOP' END END AS supervisor,
           CASE WHEN r_name <> 'ASIA' THEN r_name ELSE 'TOP' END AS manager
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def hierarchy(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    staff = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("staff"), F.concat(F.lit("N"), "n_nationkey").alias("sup_id"),
        F.concat(F.lit("R"), "r_regionkey").alias("asm_id"), F.lit("T").alias("rsm_id"))
    names = union_by_name([
        t.nation.filter("n_nationkey not in (2, 3, 12)").select(F.concat(F.lit("N"), "n_nationkey").alias("user_name"), F.col("n_name").alias("first_name")),
        t.region.filter("r_name <> 'ASIA'").select(F.concat(F.lit("R"), "r_regionkey").alias("user_name"), F.col("r_name").alias("first_name")),
        t.region.select(F.lit("T").alias("user_name"), F.lit("TOP").alias("first_name")).distinct()])
    out = masters.staff_hierarchy(union_by_name([staff, staff]), names, {"sup_id": "supervisor", "asm_id": "manager", "rsm_id": "director"},
                                  [("manager", "director"), ("supervisor", "manager")])
    return out.select("staff", "supervisor", "manager")


@query("reporting_lines", """
    WITH RECURSIVE e AS (
        SELECT 'S' || s_suppkey AS node, CASE WHEN s_suppkey >= 3 THEN 'S' || (s_suppkey // 3) ELSE 'N' || s_nationkey END AS parent FROM supplier
        UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation UNION ALL SELECT 'R' || r_regionkey, NULL FROM region),
    up AS (SELECT node, parent AS ancestor, 1 AS distance FROM e WHERE parent IS NOT NULL
           UNION ALL SELECT up.node, e.parent, distance + 1 FROM up JOIN e ON e.node = up.ancestor WHERE e.parent IS NOT NULL)
    SELECT e.node, count(ancestor) AS depth, coalesce(max_by(ancestor, distance), e.node) AS top,
           coalesce(string_agg(ancestor, '>' ORDER BY distance), '') AS line
    FROM e LEFT JOIN up ON up.node = e.node GROUP BY e.node""")
def reporting_lines(t):
    """Suppliers report to suppliers, those to a nation, a nation to a region: as many levels as there are."""
    named = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    above = F.when(F.col("s_suppkey") >= 3, F.concat(F.lit("S"), F.floor(F.col("s_suppkey") / 3).cast("string"))).otherwise(named("N", "s_nationkey"))
    edges = union_by_name([
        t.supplier.select(named("S", "s_suppkey").alias("node"), above.alias("parent")),
        t.nation.select(named("N", "n_nationkey").alias("node"), named("R", "n_regionkey").alias("parent")),
        t.region.select(named("R", "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent"))])
    out = hierarchies.reporting_lines(edges, "node", "parent")
    return out.select("node", "depth", "top", F.array_join("line", ">").alias("line"))


# ---- landed rows -----------------------------------------------------------------------

@query("weblog_parse", r"""
    WITH p AS (SELECT page_id, regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*$', '') AS path, url FROM pages)
    SELECT page_id, CASE WHEN len(string_split(path, '/')) > 1 THEN split_part(path, '/', 2) END AS level_1,
           CASE WHEN len(string_split(path, '/')) > 2 THEN split_part(path, '/', 3) END AS level_2,
           CASE WHEN len(string_split(path, '/')) > 3 THEN split_part(path, '/', 4) END AS level_3,
           'site' AS title_1, 'find' AS title_2, trim(regexp_replace(url, '[:|]', '-', 'g')) AS keyword FROM p""")
def weblog_parse(t):
    log = t.pages.select(
        "page_id", F.regexp_replace("url", r"^[a-z]+://[^/?#]*|[?#].*$", "").alias("pathname"),
        F.concat(F.lit("site | find: "), F.regexp_replace("url", "[:|]", "-")).alias("title_page"))
    return masters.web_log_levels(log).drop("pathname", "title_page")


@query("ticket_flatten", """
    SELECT event_id AS ticket_id, event_type AS ticket_subject, CAST(user_id AS VARCHAR) AS assignee_id, 'agent ' || user_id AS assignee_name,
           CAST(json_extract(props, '$.k') AS VARCHAR) AS channel, CASE WHEN value > 10 THEN CAST(event_id AS VARCHAR) END AS reason FROM events""")
def ticket_flatten(t):
    from tidemark.functions.nested import parse_json
    payload = F.to_json(F.struct(
        F.struct(F.col("user_id").alias("id"), F.concat(F.lit("agent "), "user_id").alias("name")).alias("assignee"),
        F.filter(F.array(F.struct(F.get_json_object("props", "$.k").alias("value")),
                         F.when(F.col("value") > 10, F.struct(F.col("event_id").cast("string").alias("value")))),
                 lambda x: x.isNotNull()).alias("custom_fields")))
    schema = "struct<assignee: struct<id: string, name: string>, custom_fields: array<struct<value: string>>>"
    tickets = t.events.select(F.col("event_id").alias("ticket_id"), F.col("event_type").alias("ticket_subject"),
                              parse_json(payload, schema).alias("x")).select("ticket_id", "ticket_subject", "x.*")
    return masters.ticket_rows(tickets, {"assignee": ["id", "name"]}, {"channel": 0, "reason": 1})


@query("contact_flatten", """
    SELECT user_id AS id, CAST(json_extract(props, '$.k') AS VARCHAR) AS phone_no, event_type AS channel, count(*) AS contacts
    FROM events GROUP BY ALL""")
def contact_flatten(t):
    fields = F.array(F.named_struct(F.lit("value"), F.get_json_object("props", "$.k")),
                     F.named_struct(F.lit("value"), F.col("event_type")))
    contacts = t.events.select(F.col("user_id").alias("id"), fields.alias("custom_fields"))
    flat = masters.ticket_rows(contacts, {}, {"phone_no": 0, "channel": 1, "missing": 2}).filter("missing is null")
    return flat.groupBy("id", "phone_no", "channel").agg(F.count(F.lit(1)).alias("contacts"))


@query("marketplace_items", """
    SELECT p_partkey AS shopid, CAST(p_partkey AS VARCHAR) AS item_id, p_brand AS sku, p_retailprice AS price,
           p_retailprice AS price_min, p_retailprice AS price_max, CAST(p_size AS DOUBLE) AS rating FROM part""")
def marketplace_items(t):
    scaled = F.round(F.col("p_retailprice") * masters.PRICE_SCALE).cast("bigint")
    items = t.part.select(
        F.col("p_partkey").alias("shopid"), F.concat(F.col("p_partkey").cast("string"), F.lit("::"), "p_brand", F.lit(":"), "p_partkey").alias("key"),
        scaled.alias("price"), scaled.alias("price_min"), scaled.alias("price_max"),
        F.struct(F.col("p_size").cast("double").alias("rating_star")).alias("item_rating"))
    return masters.marketplace_items(items)


@query("carrier_report", f"""
    SELECT CASE o_orderstatus WHEN 'F' THEN 'north' WHEN 'O' THEN 'south' ELSE 'centre' END AS site, CAST(o_orderkey AS VARCHAR) AS code,
           CASE WHEN o_orderstatus <> 'O' THEN {ymd('o_orderdate')} END AS sent_on FROM orders""")
def carrier_report(t):
    def site(status, sep):
        return t.orders.filter(F.col("o_orderstatus") == status).select(
            F.concat(F.col("o_orderkey").cast("string"), F.lit(sep), "o_orderpriority").alias("code"), F.to_date("o_orderdate").alias("sent_on"))
    out = masters.carrier_report([(site("F", "\t"), "north"), (site("O", "\t").drop("sent_on"), "south"), (site("P", "\t"), "centre")], "code")
    return out.select("site", "code", "sent_on")


@query("access_log", """
    SELECT event_id, event_type AS screen, CASE WHEN event_type <> 'error' THEN upper(event_type) END AS caption,
           trim(replace(replace(props, '{"k": ', ''), '}', '')) AS detail FROM events""")
def access_log(t):
    captions = t.events.filter("event_type <> 'error'").select(F.col("event_type").alias("screen"), F.upper("event_type").alias("caption"))
    log = t.events.select("event_id", F.col("event_type").alias("screen"),
                          masters.clean_error_text("props", ['{"k": ', "}"]).alias("detail"))
    return masters.access_log(log, captions)


@query("follower_list", """
    SELECT user_id, n_name AS province FROM (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup')
    LEFT JOIN customer ON c_custkey = user_id AND c_mktsegment <> 'BUILDING' LEFT JOIN nation ON n_nationkey = c_nationkey""")
def follower_list(t):
    followers = t.events.filter("event_type = 'signup'").select("user_id").distinct()
    places = t.customer.filter("c_mktsegment <> 'BUILDING'").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("province"))
    return masters.follower_list(followers, places, "user_id")


# ---- points ----------------------------------------------------------------------------
