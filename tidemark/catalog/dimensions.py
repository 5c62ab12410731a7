"""Reports whose rows meet many dimensions: the whole customer master, receivables by order, the ledger's seven legs."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog.base import dec, query, ymd
from tidemark.catalog.reports import BY_ORDER, O, _by_order, _flags
from tidemark.functions import codes
from tidemark.operators.joins import Dimension, star
from tidemark.operators.sets import union_by_name
from tidemark.plans import masters
from tidemark.plans import receivables as rec
from tidemark.sources.readers import literal_rows


def _codes(t, n, text):
    """Codes 0 to n - 2 with their texts; the last code is unknown."""
    return literal_rows(t.spark, [(k, f"{text} {k}") for k in range(n - 1)], "code int, text string")


def _known(c, n, text):
    return f"CASE WHEN {c} < {n - 1} THEN '{text} ' || {c} END"


SHOPS = {"AUTOMOBILE": "CHUOI", "BUILDING": "INS1", "FURNITURE": "NT"}
_SHOP = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SHOPS.items()) + " ELSE 'PK' END"


@query("customer_master_full", f"""
    WITH c AS (SELECT *, c_custkey % 5 AS branch, c_custkey % 5 AS country, c_nationkey AS state, c_custkey % 40 AS district,
                   CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 100 END AS ward, c_custkey % 4 AS territory, {_SHOP} AS shop FROM customer),
    links AS (SELECT c_custkey, c_custkey % 150 AS inv FROM customer WHERE c_custkey % 4 <> 0 UNION SELECT c_custkey, (c_custkey + 1) % 150 FROM customer),
    inv AS (SELECT c_custkey, s_suppkey AS invoice, s_name AS invoice_name, s_suppkey % 5 AS ic, s_nationkey AS ist, s_suppkey % 50 AS idi, (s_suppkey * 3) % 100 AS iw
            FROM links JOIN supplier ON inv = s_suppkey QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY s_suppkey) = 1)
    SELECT c.c_custkey AS custid, co.r_name AS company, cu.r_name AS country_name, st.n_name AS state_name, di.p_name AS district_name, wa.s_name AS ward_name,
           {_known('territory', 4, 'area')} AS territory_name, CASE shop WHEN 'CHUOI' THEN 'chain' WHEN 'INS1' THEN 'institution' ELSE '' END AS shop_name,
           coalesce({_known('(c.c_custkey % 6)', 6, 'terms')}, '') AS terms_name, {_known('(c.c_custkey % 3)', 3, 'pay')} AS payment_name,
           CASE WHEN (c.c_custkey % 3 + c.c_custkey % 7) % 2 = 0 THEN 'kind ' || (c.c_custkey % 3) || '/' || (c.c_custkey % 7) END AS hco_type_name,
           {_known('(c.c_custkey % 7)', 7, 'house')} AS hco_name, CASE c.c_custkey % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'closed' END AS approval,
           ic.r_name AS invoice_country_name, ist.n_name AS invoice_state_name, idi.p_name AS invoice_district_name, iw.s_name AS invoice_ward_name,
           loc.s_acctbal AS lat, {_known('(c.c_custkey % 3)', 3, 'tax')} AS tax_name, {_known('(c.c_custkey % 4)', 4, 'stock')} AS stock_name,
           ag.c_name AS agency_name, {_known('(c.c_custkey % 5)', 5, 'system')} AS system_name, CASE WHEN c.c_mktsegment <> 'MACHINERY' THEN lower(c.c_mktsegment) END AS channel_name,
           invoice, invoice_name,
           concat_ws(', ', c.c_name, CASE WHEN ward IS NOT NULL THEN coalesce(wa.s_name, CAST(ward AS VARCHAR)) END, coalesce(di.p_name, CAST(district AS VARCHAR)),
                     coalesce(st.n_name, CAST(state AS VARCHAR)), coalesce(cu.r_name, CAST(country AS VARCHAR))) AS address,
           concat_ws(', ', invoice_name, CASE WHEN inv.iw IS NOT NULL THEN coalesce(iw.s_name, CAST(inv.iw AS VARCHAR)) END,
                     coalesce(ist.n_name, CAST(inv.ist AS VARCHAR)), coalesce(ic.r_name, CAST(inv.ic AS VARCHAR))) AS invoice_address,
           CASE c.c_custkey % 3 WHEN 0 THEN 'Active' WHEN 1 THEN 'Inactive' ELSE 'Pending' END AS state_label,
           CASE WHEN shop IN ('CHUOI', 'INS1') OR c.c_custkey = 42 THEN 'G' ELSE 'No-G' END AS group_flag
    FROM c JOIN region co ON co.r_regionkey = branch LEFT JOIN inv ON inv.c_custkey = c.c_custkey LEFT JOIN region cu ON cu.r_regionkey = country
    LEFT JOIN nation st ON st.n_nationkey = state AND st.n_regionkey = country LEFT JOIN part di ON di.p_partkey = district AND di.p_size % 4 = territory
    LEFT JOIN supplier wa ON wa.s_suppkey = ward AND wa.s_nationkey = state AND wa.s_suppkey % 40 = district
    LEFT JOIN region ic ON ic.r_regionkey = inv.ic LEFT JOIN nation ist ON ist.n_nationkey = inv.ist AND ist.n_regionkey = inv.ic
    LEFT JOIN part idi ON idi.p_partkey = inv.idi LEFT JOIN supplier iw ON iw.s_suppkey = inv.iw AND iw.s_nationkey = inv.ist
    LEFT JOIN supplier loc ON loc.s_suppkey * 2 = c.c_custkey AND (loc.s_suppkey * 2) % 5 = branch LEFT JOIN customer ag ON ag.c_custkey = c.c_custkey // 10""")
def customer_master_full(t):
    """Every lookup of the master: 22 dimensions by one to three keys, some chained, some twice under other names."""
    key = F.col("c_custkey")
    part_of = lambda n: (key % n).cast("int")
    customers = t.customer.select(
        key.alias("custid"), "c_name", F.col("c_mktsegment").alias("channel"), part_of(5).alias("branch"), part_of(5).alias("country"),
        F.col("c_nationkey").alias("state"), part_of(40).alias("district"), F.when(key % 11 != 0, part_of(100)).alias("ward"),
        part_of(4).alias("territory"), codes.label("c_mktsegment", SHOPS, "PK").alias("shop"), part_of(6).alias("terms"), part_of(3).alias("pay"),
        part_of(3).alias("hco_type"), part_of(7).alias("hco"), codes.label(part_of(3).cast("string"), {"0": "A", "1": "I"}, "H").alias("status"),
        part_of(3).alias("tax"), part_of(4).alias("stock"), F.floor(key / 10).alias("agency"), part_of(5).alias("system"))
    invoices = t.supplier.select(
        F.col("s_suppkey").alias("invoice"), F.col("s_name").alias("invoice_name"), (F.col("s_suppkey") % 5).cast("int").alias("inv_country"),
        F.col("s_nationkey").alias("inv_state"), (F.col("s_suppkey") % 50).alias("inv_district"), (F.col("s_suppkey") * 3 % 100).alias("inv_ward"))
    links = union_by_name([
        t.customer.select(key.alias("custid"), (key % 150).alias("invoice"), F.when(key % 4 != 0, 1).otherwise(0).alias("active")),
        t.customer.select(key.alias("custid"), ((key + 1) % 150).alias("invoice"), F.lit(1).alias("active"))])
    spark = t.spark
    code = lambda c, n, said, name, **more: Dimension(_codes(t, n, said), {c: "code"}, {"text": name}, **more)
    kinds = literal_rows(spark, [(a, b, f"kind {a}/{b}") for a in range(3) for b in range(7) if (a + b) % 2 == 0], "a int, b int, text string")
    flows = literal_rows(spark, [("A", "AR20400", "approved"), ("I", "AR20400", "closed"), ("H", "OTHER", "held")], "status string, flow string, text string")
    shops = literal_rows(spark, [("CHUOI", "chain"), ("INS1", "institution")], "code string, text string")
    channels = literal_rows(spark, [(s, s.lower()) for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")], "code string, text string")
    wards = t.supplier.withColumn("district", (F.col("s_suppkey") % 40).cast("int"))
    places = t.supplier.select((F.col("s_suppkey") * 2).alias("custid"), (F.col("s_suppkey") * 2 % 5).cast("int").alias("branch"), "s_acctbal")
    dimensions = [
        Dimension(t.region, {"branch": "r_regionkey"}, {"r_name": "company"}, inner=True),
        Dimension(t.region, {"country": "r_regionkey"}, {"r_name": "country_name"}),
        Dimension(t.nation, {"state": "n_nationkey", "country": "n_regionkey"}, {"n_name": "state_name"}),
        Dimension(t.part.withColumn("territory", F.col("p_size") % 4), {"district": "p_partkey", "territory": "territory"}, {"p_name": "district_name"}),
        Dimension(wards, {"ward": "s_suppkey", "state": "s_nationkey", "district": "district"}, {"s_name": "ward_name"}),
        code("territory", 4, "area", "territory_name"),
        Dimension(shops, {"shop": "code"}, {"text": "shop_name"}, defaults={"shop_name": ""}),
        code("terms", 6, "terms", "terms_name", defaults={"terms_name": ""}),
        code("pay", 3, "pay", "payment_name"),
        Dimension(kinds, {"hco_type": "a", "hco": "b"}, {"text": "hco_type_name"}),
        code("hco", 7, "house", "hco_name"),
        Dimension(flows, {"status": "status"}, {"text": "approval"}, where="flow = 'AR20400'"),
        Dimension(t.region, {"inv_country": "r_regionkey"}, {"r_name": "invoice_country_name"}),
        Dimension(t.nation, {"inv_state": "n_nationkey", "inv_country": "n_regionkey"}, {"n_name": "invoice_state_name"}),
        Dimension(t.part, {"inv_district": "p_partkey"}, {"p_name": "invoice_district_name"}),
        Dimension(t.supplier, {"inv_ward": "s_suppkey", "inv_state": "s_nationkey"}, {"s_name": "invoice_ward_name"}),
        Dimension(places, {"custid": "custid", "branch": "branch"}, {"s_acctbal": "lat"}),
        code("tax", 3, "tax", "tax_name"), code("stock", 4, "stock", "stock_name"),
        Dimension(t.customer, {"agency": "c_custkey"}, {"c_name": "agency_name"}),
        code("system", 5, "system", "system_name"), Dimension(channels, {"channel": "code"}, {"text": "channel_name"})]
    out = masters.full_customer_master(
        customers, links, invoices, dimensions, "custid", "invoice",
        {"c_name": None, "ward_name": "ward", "district_name": "district", "state_name": "state", "country_name": "country"},
        {"invoice_name": None, "invoice_ward_name": "inv_ward", "invoice_state_name": "inv_state", "invoice_country_name": "inv_country"},
        ["invoice_name", "inv_country", "inv_state", "inv_district", "inv_ward"], "shop", "status", [42])
    return out.select("custid", *[n for d in dimensions for n in d.columns.values()], "invoice", "invoice_name", "address",
                      "invoice_address", "state_label", "group_flag")


TERMS = [("O1", "D", 1, "at once"), ("T2", "D", 2, "two days"), ("T3", "M", 1, None), ("T5", "D", 30, "thirty days")]


@query("receivables_order_star", f"""
    WITH {BY_ORDER},
    x AS (SELECT bo.*, cust_id % 5 AS branch, order_nbr % 9 AS staff, order_nbr % 4 AS territory, CASE WHEN cust_id % 20 = 0 THEN 7 ELSE (cust_id % 40) % 3 END AS part_state FROM bo),
    team AS (SELECT s_suppkey, s_suppkey % 5 AS branch, s_nationkey % 10 AS sup, s_nationkey % 7 AS asm, s_nationkey % 3 AS rsm FROM supplier)
    SELECT order_nbr, {', '.join(f'CAST({a} AS DOUBLE) AS {a}' for a in rec.AMOUNTS)}, payment, owner, co.r_name AS company, us.s_name AS staff_name,
           CASE WHEN us.s_nationkey < 5 THEN 'LOG' WHEN us.s_nationkey < 15 THEN 'MDS' ELSE 'CS' END AS position, cu.c_name AS cust_name, cu.c_mktsegment AS channel,
           ci.c_name AS invoice_name, 'area ' || territory AS territory_name, st.n_name AS state_name, di.p_name AS district_name, wa.s_name AS ward_name,
           {_known('(order_nbr % 4)', 4, 'carrier')} AS carrier, su.s_name AS supervisor, am.s_name AS area_manager, rm.s_name AS region_manager,
           CASE terms WHEN 'O1' THEN 'at once' WHEN 'T2' THEN 'two days' WHEN 'T5' THEN 'thirty days' ELSE terms END AS terms_name,
           CASE WHEN terms IN ('O1', 'T2') THEN 'Thanh Toán Ngay' ELSE 'Cho nợ' END AS due_class
    FROM x JOIN region co ON co.r_regionkey = branch JOIN supplier us ON us.s_suppkey = staff JOIN customer cu ON cu.c_custkey = cust_id
    LEFT JOIN customer ci ON ci.c_custkey = cust_id + 1 JOIN nation st ON st.n_nationkey = cu.c_nationkey
    JOIN part di ON di.p_partkey = cust_id % 40 AND di.p_partkey % 3 = part_state
    LEFT JOIN supplier wa ON wa.s_suppkey = cust_id % 100 AND wa.s_nationkey = cu.c_nationkey AND wa.s_suppkey % 40 = cust_id % 40
    LEFT JOIN team ON team.s_suppkey = staff AND team.branch = x.branch LEFT JOIN supplier su ON su.s_suppkey = sup LEFT JOIN supplier am ON am.s_suppkey = asm
    LEFT JOIN supplier rm ON rm.s_suppkey = rsm""")
def receivables_order_star(t):
    """The balance per order with its fifteen dimensions, in the order in which one needs the other."""
    key, cust = F.col("order_nbr"), F.col("cust_id")
    rows = _by_order(t).withColumns({
        "branch": (cust % 5).cast("int"), "staff": key % 9, "territory": (key % 4).cast("int"), "district": cust % 40, "ward": cust % 100,
        "district_state": F.when(cust % 20 == 0, 7).otherwise(cust % 40 % 3), "unit_code": (key % 4).cast("int"), "invoice_cust": cust + 1})
    people = t.supplier.withColumn("position", F.when(F.col("s_nationkey") < 5, "LOG").when(F.col("s_nationkey") < 15, "MDS").otherwise("CS"))
    team = t.supplier.select("s_suppkey", (F.col("s_suppkey") % 5).cast("int").alias("branch"), *[
        (F.col("s_nationkey") % n).alias(c) for c, n in (("sup", 10), ("asm", 7), ("rsm", 3))])
    terms = literal_rows(t.spark, TERMS, "terms string, due_type string, due_days int, text string")
    areas = literal_rows(t.spark, [(k, f"area {k}") for k in range(4)], "code int, text string")
    out = star(rows, [
        Dimension(t.region, {"branch": "r_regionkey"}, {"r_name": "company"}, inner=True),
        Dimension(people, {"staff": "s_suppkey"}, {"s_name": "staff_name", "position": "position"}, inner=True),
        Dimension(t.customer, {"cust_id": "c_custkey"}, {"c_name": "cust_name", "c_mktsegment": "channel", "c_nationkey": "state"}, inner=True),
        Dimension(t.customer, {"invoice_cust": "c_custkey"}, {"c_name": "invoice_name"}),
        Dimension(areas, {"territory": "code"}, {"text": "territory_name"}, inner=True),
        Dimension(t.nation, {"state": "n_nationkey"}, {"n_name": "state_name"}, inner=True),
        Dimension(t.part.withColumn("p_state", F.col("p_partkey") % 3), {"district": "p_partkey", "district_state": "p_state"}, {"p_name": "district_name"}, inner=True),
        Dimension(t.supplier.withColumn("district", F.col("s_suppkey") % 40), {"ward": "s_suppkey", "state": "s_nationkey", "district": "district"}, {"s_name": "ward_name"}),
        Dimension(_codes(t, 4, "carrier"), {"unit_code": "code"}, {"text": "carrier"}),
        Dimension(team, {"staff": "s_suppkey", "branch": "branch"}, {"sup": "sup", "asm": "asm", "rsm": "rsm"}),
        Dimension(t.supplier, {"sup": "s_suppkey"}, {"s_name": "supervisor"}), Dimension(t.supplier, {"asm": "s_suppkey"}, {"s_name": "area_manager"}),
        Dimension(t.supplier, {"rsm": "s_suppkey"}, {"s_name": "region_manager"}),
        Dimension(terms, {"terms": "terms"}, {"due_type": "due_type", "due_days": "due_days"}), Dimension(terms, {"terms": "terms"}, {"text": "terms_name"})])
    return out.select("order_nbr", *rec.AMOUNTS, "payment", "owner", "company", "staff_name", "position", "cust_name", "channel", "invoice_name",
                      "territory_name", "state_name", "district_name", "ward_name", "carrier", "supervisor", "area_manager", "region_manager",
                      F.coalesce("terms_name", "terms").alias("terms_name"), rec.terms_type("due_type", "due_days").alias("due_class"))


AS_OF, OPENING = "2001-03-15", "1996-01-01"
TYPES = {"1-URGENT": "IN", "2-HIGH": "CO", "3-MEDIUM": "DI", "4-NOT SPECIFIED": "OO", "5-LOW": "CR"}
_ZEROS = {a: f"CAST(0 AS DECIMAL(18,2)) AS {a}" for a in rec.AMOUNTS}


def _event(name, value, event, source, delivery="''", reason="''", staff="NULL", unit="''"):
    amounts = ", ".join(f"CAST({value} AS DECIMAL(18,2)) AS {a}" if a == name else z for a, z in _ZEROS.items())
    return (f"SELECT '{name}' AS leg, order_nbr, om_order, {staff} AS staff, {unit} AS unit, terms, due_date, {delivery} AS delivery_time, "
            f"{reason} AS reason, CAST({event} AS DATE) AS event_date, {amounts} FROM {source}")


@query("receivables_seven_legs", f"""
    WITH {O}, k AS (SELECT o_orderkey AS order_nbr, o_orderkey - o_orderkey % 2 AS om_order, 'B' || o_orderkey % 3 AS branch, d, amt, o.terms, st,
             CASE pr {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in TYPES.items())} END AS typ, o_orderkey % 500 AS ab FROM o),
    bat AS (SELECT DISTINCT branch, ab, ab % 17 <> 0 AS ar, CASE WHEN ab % 13 = 0 THEN 'V' WHEN ab % 2 = 0 THEN 'C' ELSE 'B' END AS bs FROM k),
    bl AS (SELECT k.*, CASE WHEN terms = 'O1' THEN d + 30 ELSE d + 7 END AS due_date FROM k WHERE order_nbr % 23 <> 0 AND ab % 17 <> 0),
    dn AS (SELECT * FROM bl WHERE st <> 'P' AND typ <> 'CR'),
    dl AS (SELECT l_orderkey, min(l_shipdate) AS made, max(l_shipdate) + to_minutes(CAST(l_orderkey % 300 AS INTEGER)) AS upd FROM lineitem GROUP BY l_orderkey
           HAVING bool_or(l_returnflag = 'N')),
    de AS (SELECT *, date_diff('minute', made, upd) AS mi FROM dn JOIN dl ON l_orderkey = order_nbr
           WHERE order_nbr % 19 <> 0 AND order_nbr % 7 <> 0 AND order_nbr % 11 <> 0),
    cf AS (SELECT de.*, l.l_shipdate AS at_day, {dec('l.l_extendedprice')} AS got, CASE WHEN l.l_linenumber <= 4 THEN 'reason ' || l.l_linenumber ELSE '' END AS why
           FROM de JOIN lineitem l ON l.l_orderkey = order_nbr AND l.l_returnflag = 'A'),
    aj AS (SELECT dn.*, l_shipdate AS at_day, l_shipdate + INTERVAL 3 DAY AS paid, {dec('l_extendedprice')} AS adj, own.bs AS bs,
                  CASE WHEN order_nbr % 7 <> 0 THEN 'S' || order_nbr % 10 ELSE 'A' || order_nbr % 6 END AS who, CASE WHEN order_nbr % 7 <> 0 THEN 'U' || order_nbr % 4 ELSE '' END AS un
           FROM dn JOIN lineitem ON l_orderkey = order_nbr AND l_returnflag = 'R' AND l_tax <> 0 JOIN bat own ON own.branch = dn.branch AND own.ab = (order_nbr + 1) % 500 AND own.ar
           WHERE order_nbr % 19 <> 0 AND (order_nbr + 3) % 23 <> 0 AND EXISTS (SELECT 1 FROM orders x WHERE x.o_orderkey = order_nbr + 3)),
    ev AS ({_event('opening_amt', 'amt', 'd', f"bl WHERE d < DATE '{OPENING}'")}
        UNION ALL {_event('released_amt', 'amt', 'd', f"bl WHERE d >= DATE '{OPENING}' AND typ <> 'CR'")}
        UNION ALL {_event('delivered_amt', 'amt', 'upd', 'de', "(mi // 60) || ':' || lpad(CAST(mi % 60 AS VARCHAR), 2, '0')", staff="'S' || order_nbr % 10", unit="'U' || order_nbr % 4")}
        UNION ALL {_event('received_amt', 'got', 'at_day', 'cf', reason='why', staff="'S' || order_nbr % 10", unit="'U' || order_nbr % 4")}
        UNION ALL {_event('returned_amt', 'amt', 'd', "bl WHERE st <> 'P' AND typ = 'CR'")}
        UNION ALL {_event('confirmed_amt', 'adj', 'at_day', "aj WHERE bs <> 'V'", staff='who', unit='un')}
        UNION ALL {_event('confirmed_released_amt', 'adj', 'paid', "aj WHERE bs = 'C'", staff='who', unit='un')})
    SELECT leg, order_nbr, om_order, staff, unit, terms, {ymd('due_date')} AS due_date, delivery_time, reason, {ymd('event_date')} AS event_date,
           {', '.join(f'CAST({a} AS DOUBLE) AS {a}' for a in rec.AMOUNTS)}
    FROM ev WHERE event_date <= DATE '{AS_OF}' AND order_nbr NOT IN (SELECT o_orderkey FROM canc)
        AND NOT (leg IN ('delivered_amt', 'received_amt') AND order_nbr IN (SELECT o_orderkey FROM ret))
        AND NOT (leg IN ('confirmed_amt', 'confirmed_released_amt') AND om_order IN (SELECT o_orderkey FROM ret))""")
def receivables_seven_legs(t):
    """Seven legs from nine tables; each is its stored base and the rows of the last seven days. The base is
    made of the same tables here, so both are taken from joins that are staged once."""
    s = rec.ledger_rows(_ledger_sources(t), stage=True)
    first = dt.date.fromisoformat(AS_OF) - dt.timedelta(days=6)
    stored = {name: leg.filter(F.col("event_date") < F.lit(first)) for name, leg in rec.ledger_legs(s, OPENING).items()}
    out = rec.receivables_ledger(rec.ledger_legs(s, OPENING, AS_OF), _flags(t).select("order_nbr", "same_day", "other_day"),
                                 ["order_nbr"], ["om_order"], stored)
    return out.select("leg", "order_nbr", "om_order", "staff", "unit", "terms", "due_date", "delivery_time", "reason", "event_date", *rec.AMOUNTS)


def _ledger_sources(t):
    """The nine tables of the ledger, derived from orders and their lines."""
    def keyed(c):
        return {"branch": F.concat(F.lit("B"), (c % 3).cast("string")), "ar_batch": c % 500, "ar_ref": F.concat(F.lit("R"), c.cast("string")),
                "invoice": F.concat(F.lit("I"), c.cast("string")), "note": F.concat(F.lit("N"), (c % 50).cast("string"))}

    key, text = F.col("o_orderkey"), lambda p, c: F.concat(F.lit(p), c.cast("string"))
    o = t.orders.withColumns({**keyed(key), "order_nbr": key, "om_order": key - key % 2, "cust_id": F.col("o_custkey"), "order_date": F.to_date("o_orderdate"),
                              "order_type": codes.label("o_orderpriority", TYPES), "status": F.when(F.col("o_orderstatus") != "P", "C").otherwise("N"),
                              "payment": F.col("o_orderstatus")})
    terms = F.when(F.col("o_orderpriority") == "1-URGENT", "O1").otherwise(F.concat(F.lit("T"), F.left("o_orderpriority", F.lit(1))))
    line = F.col("l_orderkey")
    ln = t.lineitem.withColumns(keyed(line))
    return rec.LedgerSources(
        orders=o.select("branch", "order_nbr", "om_order", "cust_id", "order_date", "order_type", "status", "payment", "ar_batch", "ar_ref"),
        documents=o.filter("order_nbr % 23 <> 0").select("branch", "ar_batch", "ar_ref", "invoice", "note", terms.alias("terms"), F.col("order_date").alias("doc_date"),
                                                         F.date_add("order_date", 7).alias("doc_due"), F.col("o_totalprice").alias("amount")),
        batches=o.select("branch", "ar_batch").distinct().withColumns({
            "module": F.when(F.col("ar_batch") % 17 == 0, "GL").otherwise("AR"),
            "batch_status": F.when(F.col("ar_batch") % 13 == 0, "V").when(F.col("ar_batch") % 2 == 0, "C").otherwise("B")}),
        allocations=o.filter("order_nbr % 19 <> 0").select("branch", "order_nbr", "ar_batch", text("A", key % 6).alias("alloc_staff")),
        books=o.filter("order_nbr % 7 <> 0").select("branch", "order_nbr", text("S", key % 10).alias("staff"), text("U", key % 4).alias("unit"),
                                                    F.when(key % 11 != 0, "C").otherwise("N").alias("book_status")),
        deliveries=ln.groupBy("branch", line.alias("order_nbr")).agg(
            F.min("l_shipdate").alias("created"), F.max("l_shipdate").alias("last"), F.bool_or(F.col("l_returnflag") == "N").alias("came")).select(
            "branch", "order_nbr", "created", (F.col("last") + F.make_dt_interval(mins=(F.col("order_nbr") % 300).cast("int"))).alias("updated"),
            F.when(F.col("came"), "C").otherwise("D").alias("status")),
        confirmations=ln.filter("l_returnflag = 'A'").select("invoice", "note", "branch", "ar_batch", "ar_ref", F.col("l_shipdate").alias("created"),
                                                             F.col("l_extendedprice").alias("received"), F.col("l_linenumber").alias("reason_code")),
        reasons=literal_rows(t.spark, [(n, f"reason {n}") for n in range(1, 5)], "reason_code int, reason string"),
        adjustments=ln.filter("l_returnflag = 'R'").select(
            "branch", ((line + 1) % 500).alias("own_batch"), "ar_batch", "ar_ref", ((line + 3) % 500).alias("paid_batch"), text("R", line + 3).alias("paid_ref"),
            F.col("l_shipdate").alias("created"), (F.col("l_shipdate") + F.expr("interval 3 day")).alias("paid_date"),
            F.col("l_extendedprice").alias("amount"), F.when(F.col("l_tax") == 0, "X").otherwise(" ").alias("reversal")))
