"""Scalar functions applied to whole tables."""

from pyspark.sql import functions as F

from tidemark.catalog.base import dec, query, ymd
from tidemark.functions import codes, dates, numbers, text
from tidemark.operators.windows import neighbour

MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
MONTH_CASE = "CASE month({c}) " + " ".join(f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(MONTHS)) + " END"


@query("fn_text", r"""
    SELECT p_partkey, concat(p_brand, coalesce(nullif(p_type, 'PROMO'), ''), p_size) AS soft_key,
           p_brand || nullif(p_type, 'PROMO') || p_size AS strict_key,
           substr(p_name, 2, 3) AS middle, left(p_name, 4) AS head, right(p_name, 3) AS tail,
           upper(p_brand) AS brand_key, replace(p_name, ' ', '') AS squeezed,
           split_part(p_name, ' ', 1) AS word_1, nullif(split_part(p_name, ' ', 3), '') AS word_3,
           CAST(contains(p_name, 'widget') AS BIGINT) AS is_widget,
           translate(p_brand, '#a', '  ') AS scrubbed
    FROM part""")
def fn_text(t):
    kind = F.nullif("p_type", F.lit("PROMO"))
    return t.part.select(
        "p_partkey", text.joined_key("p_brand", kind, "p_size").alias("soft_key"),
        text.strict_key("p_brand", kind, "p_size").alias("strict_key"),
        F.substring("p_name", 2, 3).alias("middle"), F.left("p_name", F.lit(4)).alias("head"),
        F.right("p_name", F.lit(3)).alias("tail"),
        text.match_key(text.squash(F.concat(F.lit(" \t"), "p_brand", F.lit(" \n")))).alias("brand_key"),
        F.replace("p_name", F.lit(" "), F.lit("")).alias("squeezed"),
        text.token("p_name", " ", 0).alias("word_1"), text.token("p_name", " ", 2).alias("word_3"),
        F.col("p_name").contains("widget").alias("is_widget"),
        text.scrub("p_brand", "#a").alias("scrubbed"))


@query("fn_date", f"""
    SELECT o_orderkey, {ymd('o_orderdate + INTERVAL 30 DAY')} AS plus_30, {ymd('o_orderdate - INTERVAL 7 DAY')} AS minus_7,
           {ymd('o_orderdate - INTERVAL 3 MONTH')} AS three_months_ago,
           {ymd("date_trunc('month', o_orderdate)")} AS month_first, {ymd('last_day(o_orderdate)')} AS month_last,
           year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, dayofweek(o_orderdate) + 1 AS dow,
           {MONTH_CASE.format(c='o_orderdate')} AS month_name,
           CASE dayofweek(o_orderdate) WHEN 0 THEN 0.0::DOUBLE WHEN 6 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight,
           strftime(o_orderdate, '%y%m%d') AS key_day, strftime(o_orderdate, '%H%M%S') AS key_time,
           concat(month(o_orderdate), year(o_orderdate)) AS my
    FROM orders""")
def fn_date(t):
    c = "o_orderdate"
    return t.orders.select(
        "o_orderkey", F.date_add(c, 30).alias("plus_30"), F.date_sub(c, 7).alias("minus_7"),
        F.add_months(c, -3).alias("three_months_ago"), dates.month_start(c).alias("month_first"),
        dates.month_end(c).alias("month_last"), F.year(c).alias("y"), F.month(c).alias("m"),
        F.dayofmonth(c).alias("d"), F.dayofweek(c).alias("dow"), dates.month_name3(c).alias("month_name"),
        dates.workday_weight(c).alias("weight"), dates.key_day(c).alias("key_day"),
        dates.key_time(c).alias("key_time"), dates.month_label(c).alias("my"))


def _gaps(t):
    return neighbour(t.events.select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"], ["ts"],
                     F.to_date("ts"))


GAPS = "SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events"


@query("fn_datediff_minute", f"""
    SELECT event_id, date_diff('minute', prev, ts) AS minutes FROM ({GAPS})""")
def fn_datediff_minute(t):
    return _gaps(t).select("event_id", dates.minutes_between("previous_ts", "ts").alias("minutes"))


@query("fn_duration_text", f"""
    SELECT event_id, concat(m // 60, ':', lpad(CAST(m % 60 AS VARCHAR), 2, '0')) AS duration
    FROM (SELECT event_id, date_diff('minute', prev, ts) AS m FROM ({GAPS}) WHERE prev IS NOT NULL)""")
def fn_duration_text(t):
    return _gaps(t).filter("previous_ts is not null").select(
        "event_id", dates.duration_text(dates.minutes_between("previous_ts", "ts")).alias("duration"))


@query("fn_numeric_clean", f"""
    SELECT l_orderkey, l_partkey, CAST(sum({dec('l_extendedprice')}) AS DOUBLE) AS amount,
           CAST(sum(CASE WHEN l_returnflag = 'A' THEN 0 ELSE CAST(l_quantity AS BIGINT) END) AS BIGINT) AS pieces,
           count(*) FILTER (l_returnflag = 'A') AS unreadable
    FROM lineitem GROUP BY l_orderkey, l_partkey""")
def fn_numeric_clean(t):
    typed = t.lineitem.select(
        "l_orderkey", "l_partkey", F.concat(F.lit(" "), F.format_number("l_extendedprice", 2), F.lit(" ")).alias("a"),
        F.when(F.col("l_returnflag") == "A", "x").otherwise(F.format_number("l_quantity", 0)).alias("q"))
    clean = typed.select("l_orderkey", "l_partkey", numbers.to_number("a", "decimal(18,2)").alias("a"),
                         numbers.to_number("q", "bigint").alias("q"))
    return clean.groupBy("l_orderkey", "l_partkey").agg(
        F.sum("a").alias("amount"), numbers.zero_sum("q").alias("pieces"),
        F.count_if(F.col("q").isNull()).alias("unreadable"))


@query("fn_workday_calendar", f"""
    WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, last_day(max(o_orderdate)) AS hi FROM orders),
         d AS (SELECT unnest(generate_series(lo, CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS day FROM b),
         w AS (SELECT day, CASE dayofweek(day) WHEN 0 THEN 0 WHEN 6 THEN 0.5 ELSE 1 END AS w FROM d)
    SELECT {ymd("date_trunc('month', day)")} AS month, CAST(sum(w) AS DOUBLE) AS month_days,
           CAST(sum(CASE WHEN day < DATE '1999-06-17' THEN w ELSE 0 END) AS DOUBLE) AS elapsed_days
    FROM w GROUP BY date_trunc('month', day)""")
def fn_workday_calendar(t):
    bounds = t.orders.agg(F.trunc(F.min("o_orderdate"), "month").alias("lo"),
                          F.last_day(F.max("o_orderdate")).alias("hi"))
    return dates.workdays(dates.calendar(bounds, "lo", "hi"), "1999-06-17")


STATUS = {"F": "Đã giao hàng", "P": "KH Không Nhận"}


@query("fn_case_coalesce", f"""
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'part' ELSE 'other' END AS label,
           CASE o_orderpriority WHEN '1-URGENT' THEN '1-HIGH' ELSE o_orderpriority END AS replaced,
           coalesce(nullif(o_orderpriority, '5-LOW'), nullif(o_orderstatus, 'O'), '') AS known,
           {ymd("greatest(o_orderdate, TIMESTAMP '1998-01-01')")} AS later,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN 'TM' ELSE 'CK' END AS payment,
           CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 'LOG' WHEN o_orderstatus = 'F' THEN 'MDS'
                WHEN o_orderpriority LIKE '%LOW%' THEN 'CS' WHEN o_orderstatus = 'P' THEN 'P.BH' ELSE o_orderstatus END AS role,
           CASE o_orderstatus WHEN 'F' THEN 'Đã giao hàng' WHEN 'P' THEN 'KH Không Nhận' ELSE 'Chưa Xác Nhận' END AS delivery,
           CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS BIGINT) AS rushed
    FROM orders""")
def fn_case_coalesce(t):
    status = F.col("o_orderstatus")
    types = F.when(F.col("o_orderpriority").contains("URGENT"), "xLOG") \
        .when(F.col("o_orderpriority").contains("LOW"), "CSx").otherwise("none")
    position = codes.replace_values(status, {"F": "SD", "P": "AM"})
    return t.orders.select(
        "o_orderkey", codes.label(status, {"F": "done", "P": "part"}, "other").alias("label"),
        codes.replace_values("o_orderpriority", {"1-URGENT": "1-HIGH"}).alias("replaced"),
        codes.first_known(F.nullif("o_orderpriority", F.lit("5-LOW")), F.nullif(status, F.lit("O"))).alias("known"),
        codes.later_of("o_orderdate", F.lit("1998-01-01").cast("timestamp_ntz")).cast("date").alias("later"),
        codes.payment_class(codes.label(status, {"F": "B", "O": "C"}, "T")).alias("payment"),
        codes.staff_role(types, position).alias("role"),
        codes.delivery_status(codes.label(status, {"F": "C", "P": "D"}, "x")).alias("delivery"),
        codes.any_of("o_orderpriority", ["1-URGENT", "2-HIGH"]).alias("rushed"))


@query("fn_address", """
    SELECT c_custkey, concat_ws(', ', c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, n_name, r_name) AS address
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def fn_address(t):
    c = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    ward = F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", text.address("c_name", ward, F.concat(F.lit(" "), "n_name"), "r_name").alias("address"))


@query("fn_parse_dates", f"""
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN {ymd('o_orderdate')} END AS parsed,
           CASE WHEN o_orderstatus <> 'P' THEN {ymd('o_orderdate')} ELSE '1900-01-01' END AS filled,
           {ymd("least(o_orderdate, TIMESTAMP '1999-12-31')")} AS clamped,
           CASE WHEN day(o_orderdate) + 3 <= day(last_day(o_orderdate))
                THEN strftime(o_orderdate + INTERVAL 3 DAY, '%Y-%m-%d') END AS from_parts
    FROM orders""")
def fn_parse_dates(t):
    import datetime as dt
    shown = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss"))
    return t.orders.select(
        "o_orderkey", dates.parse_date(shown).alias("parsed"), dates.parse_date_or_sentinel(shown).alias("filled"),
        dates.clamp_date(F.to_date("o_orderdate"), dt.date(1999, 12, 31)).alias("clamped"),
        dates.date_from_parts(dates.month_key("o_orderdate"), F.dayofmonth("o_orderdate") + 3).alias("from_parts"))


@query("fn_math", """
    SELECT p_partkey, p_retailprice / nullif(p_size % 5, 0) AS ratio,
           CAST(floor((p_size * 100 * 2 + 40) / 80) AS DOUBLE) AS share,
           CAST((p_size + 1) // 2 AS DOUBLE) AS half_up,
           CAST(CASE WHEN p_size % 2 = 0 THEN p_size // 2 WHEN (p_size // 2) % 2 = 0 THEN p_size // 2
                ELSE p_size // 2 + 1 END AS DOUBLE) AS half_even,
           CAST(p_size > 25 AS BIGINT) AS is_big,
           CASE WHEN p_type = 'PROMO' THEN p_retailprice * p_size ELSE p_retailprice / p_size END AS base_units
    FROM part""")
def fn_math(t):
    op = F.when(F.col("p_type") == "PROMO", "M").otherwise("D")
    half = F.col("p_size") / 2
    return t.part.select(
        "p_partkey", numbers.ratio("p_retailprice", F.col("p_size") % 5).alias("ratio"),
        numbers.percent("p_size", F.lit(40)).alias("share"),
        numbers.round_half_up(half).alias("half_up"), numbers.round_half_even(half).alias("half_even"),
        numbers.flag(F.col("p_size") - 25).alias("is_big"),
        numbers.by_unit("p_retailprice", "p_size", op).alias("base_units"))


@query("fn_url", r"""
    SELECT page_id, nullif(split_part(regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*$', ''), '/', 2), '') AS level_1,
           nullif(split_part(regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*$', ''), '/', 3), '') AS level_2,
           nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page
    FROM pages""")
def fn_url(t):
    return t.pages.select("page_id", text.url_path_level("url", 1).alias("level_1"),
                          text.url_path_level("url", 2).alias("level_2"), text.url_parameter("url", "page").alias("page"))
