"""Table maintenance, mirrors, streams, sources and sinks.

The copies to be maintained are derived from ``orders`` by rules on its own columns: rows
missing, rows with a stale price, and surplus rows the source does not have.
"""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog.base import dec, query, ymd, ymdhms
from tidemark.functions.numbers import money, zero_sum
from tidemark.operators.aggregates import word_count
from tidemark.operators.sets import union_by_name
from tidemark.plans.masters import LoadSpec, load_landed
from tidemark.sources import mirror, readers, upserts, writers
from tidemark.sources.scratch import run_folder
from tidemark.streaming import change_log

COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
SRC = "src AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders)"
TGT = """tgt AS (SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate
    FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')
    UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW')"""
SHOW = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, {ymd('o_orderdate')} AS o_orderdate"


def source_of(t):
    return t.orders.select(*COLS)


def target_of(t):
    o = t.orders
    price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    known = (o.filter("not (o_orderpriority = '1-URGENT' and o_orderstatus = 'P')")
             .withColumn("o_totalprice", price).select(*COLS))
    surplus = (o.filter("o_orderstatus = 'F' and o_orderpriority = '5-LOW'")
               .withColumn("o_orderkey", -F.col("o_orderkey") - 1).select(*COLS))
    return known.unionByName(surplus)


def shown(df):
    return df.withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("upsert", f"""
    WITH {SRC}, {TGT}, ch AS (SELECT * FROM src WHERE o_orderstatus IN ('O', 'P') AND o_totalprice > 100000)
    SELECT {SHOW} FROM ch UNION ALL SELECT {SHOW} FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ch)""")
def upsert(t):
    changes = source_of(t).filter("o_orderstatus in ('O', 'P') and o_totalprice > 100000")
    # Each change arrives twice, first with an older price: the later one counts.
    twice = union_by_name([changes.withColumn("__seq", F.lit(2)),
                   changes.withColumns({"__seq": F.lit(1), "o_totalprice": F.lit(0.0)})])
    return shown(upserts.upsert(target_of(t), twice, ["o_orderkey"], ["__seq"]))


@query("merge_partial_update", f"""
    WITH {SRC}, {TGT}
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
           coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
           coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice,
           CASE WHEN t.o_orderkey IS NOT NULL THEN '2020-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS inserted_at
    FROM tgt t FULL JOIN src s ON t.o_orderkey = s.o_orderkey""")
def merge_partial_update(t):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    target = writers.audited(target_of(t).select(*columns), "2020-01-01")
    source = writers.audited(source_of(t).select(*columns), "2024-02-01")
    return upserts.merge(target, source, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query("update_from_staging", f"""
    WITH {SRC}, {TGT}
    SELECT t.o_orderkey, coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice
    FROM tgt t LEFT JOIN (SELECT * FROM src WHERE o_orderstatus = 'O') s ON t.o_orderkey = s.o_orderkey""")
def update_from_staging(t):
    staged = source_of(t).filter("o_orderstatus = 'O'")
    return upserts.update_from(target_of(t), staged, ["o_orderkey"], ["o_totalprice"]) \
        .select("o_orderkey", "o_totalprice")


@query("window_replace", f"""
    WITH {SRC}, {TGT}
    SELECT 'open' AS kind, {SHOW} FROM tgt WHERE o_orderdate < DATE '2000-01-01'
    UNION ALL SELECT 'open', {SHOW} FROM src WHERE o_orderdate >= DATE '2000-01-01'
    UNION ALL SELECT 'range', {SHOW} FROM tgt WHERE o_orderdate < DATE '1999-04-01' OR o_orderdate >= DATE '1999-07-01'
    UNION ALL SELECT 'range', {SHOW} FROM src WHERE o_orderdate >= DATE '1999-04-01' AND o_orderdate < DATE '1999-07-01'""")
def window_replace(t):
    s = source_of(t)
    recent = readers.report_source(s, "o_orderdate", "2000-01-01", None)
    quarter = readers.report_source(s, "o_orderdate", "1999-04-01", "1999-06-30")
    a = upserts.window_replace(target_of(t), recent, "o_orderdate", "2000-01-01")
    b = upserts.window_replace(target_of(t), quarter, "o_orderdate", "1999-04-01", "1999-06-30")
    return shown(union_by_name([a.withColumn("kind", F.lit("open")), b.withColumn("kind", F.lit("range"))]))


@query("month_replace", f"""
    WITH {SRC}, {TGT}
    SELECT {SHOW}, concat(month(o_orderdate), year(o_orderdate)) AS my FROM (
        SELECT * FROM src WHERE year(o_orderdate) = 1999 AND month(o_orderdate) IN (1, 11)
        UNION ALL SELECT * FROM tgt WHERE NOT (year(o_orderdate) = 1999 AND month(o_orderdate) IN (1, 11)))""")
def month_replace(t):
    from tidemark.functions.dates import month_label
    extract = source_of(t).filter("year(o_orderdate) = 1999 and month(o_orderdate) in (1, 11)")
    out = upserts.month_replace(target_of(t), extract, "o_orderdate")
    return shown(out.withColumn("my", month_label("o_orderdate")))


@query("key_replace", f"""
    WITH {SRC}, tgt AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice,
             CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate FROM orders),
         ch AS (SELECT * FROM src WHERE o_totalprice > 450000)
    SELECT {SHOW} FROM ch UNION ALL SELECT {SHOW} FROM tgt
    WHERE NOT (CAST(o_orderdate AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM ch)
               AND o_orderkey IN (SELECT o_orderkey FROM ch))""")
def key_replace(t):
    s = source_of(t)
    moved = F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate") + F.expr("interval 1 day")) \
        .otherwise(F.col("o_orderdate"))
    target = s.withColumns({"o_totalprice": F.col("o_totalprice") + 1, "o_orderdate": moved})
    return shown(upserts.key_date_replace(target, s.filter("o_totalprice > 450000"), ["o_orderkey"], "o_orderdate"))


@query("hwm_copy", f"""
    SELECT event_id, user_id, {ymdhms('ts')} AS ts FROM events""")
def hwm_copy(t):
    e = t.events.select("event_id", "user_id", "ts")
    stored = e.filter(F.col("ts") < F.lit(dt.date(2024, 1, 16)))
    return upserts.copy_new(stored, e, "ts")


@query("daily_income", f"""
    SELECT o_orderkey, {ymd('o_orderdate')} AS o_orderdate,
           CAST(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE 0 END AS BIGINT) AS amount FROM orders""")
def daily_income(t):
    """Stored amounts are 0; the day's list brings them as text with thousands commas."""
    stored = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), F.lit(0).cast("bigint").alias("amount"))
    sheet = t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("Order"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("Date"),
        F.concat(F.format_number(F.floor("o_totalprice"), 0), F.lit(" ")).alias("Amount"))
    spec = LoadSpec(rename={"order": "o_orderkey", "date": "o_orderdate"}, dates={"o_orderdate": "dd/MM/yyyy"},
                    numbers={"amount": "bigint"}, required=["amount"])
    return upserts.upsert(stored, load_landed(sheet, spec), ["o_orderkey"])


# ---- mirrors ---------------------------------------------------------------------------

AS_OF = "2001-06-15"
UPDATED = "CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 40 DAY ELSE o_orderdate + INTERVAL 1 DAY END"


@query("sync_table", f"""
    WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, {UPDATED} AS updated FROM orders),
         {TGT}, ch AS (SELECT * FROM s WHERE updated >= DATE '{AS_OF}' AND o_orderdate >= DATE '1998-01-01'),
         a AS (SELECT * EXCLUDE (updated) FROM ch
               UNION ALL SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ch)),
         b AS (SELECT * EXCLUDE (updated) FROM ch
               UNION ALL SELECT * FROM tgt WHERE o_orderdate < DATE '{AS_OF}' AND o_orderkey NOT IN (SELECT o_orderkey FROM ch)),
         c AS (SELECT * EXCLUDE (updated) FROM s WHERE o_orderdate >= DATE '{AS_OF}' - 180
               UNION ALL SELECT * FROM a WHERE o_orderdate < DATE '{AS_OF}' - 180)
    SELECT 'repair' AS kind, {SHOW} FROM a WHERE o_orderdate < DATE '{AS_OF}' - 45
        OR o_orderkey IN (SELECT o_orderkey FROM s WHERE o_orderdate >= DATE '{AS_OF}' - 45)
    UNION ALL SELECT 'same_day', {SHOW} FROM b
    UNION ALL SELECT 'reload', {SHOW} FROM c""")
def sync_table(t):
    updated = F.expr("case when o_orderpriority = '1-URGENT' then o_orderdate + interval 40 day "
                     "else o_orderdate + interval 1 day end")
    s = t.orders.withColumn("updated", updated).select(*COLS, "updated")
    args = (s, target_of(t), ["o_orderkey"], "o_orderdate", "updated", AS_OF)
    runs = {"repair": mirror.sync_table(*args, lookback_days=45, floor="1998-01-01"),
            "same_day": mirror.sync_table(*args, lookback_days=None, floor="1998-01-01", same_day=True),
            "reload": mirror.sync_table(*args, lookback_days=45, floor="1998-01-01", reload_days=180,
                                        reconcile_by=["o_orderstatus"])}
    return shown(union_by_name([df.withColumn("kind", F.lit(kind)) for kind, df in runs.items()]))


# One mirror of each kind of rule: (name, repair days, reload days, same day, status at the source).
MIRROR_KINDS = [("ar_doc", 45, 180, False, None), ("delivery_history_done", 45, 90, False, "F"), ("sales_order", 15, 90, False, None),
                ("order_errors", None, 90, True, None), ("carrier_keys", None, 90, False, None)]


def _mirror_sql(name, repair, reload_, same_day, status):
    only = f"WHERE o_orderstatus = '{status}'" if status else ""
    target = "tgt"
    if name == "carrier_keys":
        target = "(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate FROM orders)"
    day, kept = f"DATE '{AS_OF}'", ["o_orderkey NOT IN (SELECT o_orderkey FROM ch)"]
    if same_day:
        kept.append(f"o_orderdate < {day}")
    if repair is not None:
        kept.append(f"(o_orderdate < {day} - {repair} OR o_orderkey IN (SELECT o_orderkey FROM so WHERE o_orderdate >= {day} - {repair}))")
    return f"""(WITH so AS (SELECT * FROM s {only}), ch AS (SELECT * EXCLUDE (updated) FROM so WHERE updated >= {day}),
        st AS (SELECT * FROM ch UNION ALL SELECT * FROM (SELECT * FROM {target} {only}) WHERE {' AND '.join(kept)}),
        df AS (SELECT (SELECT count(*) FROM st WHERE o_orderdate >= {day} - {reload_}) <> (SELECT count(*) FROM so WHERE o_orderdate >= {day} - {reload_}) AS differs)
        SELECT '{name}' AS kind, {SHOW} FROM st, df WHERE o_orderdate < {day} - {reload_} OR NOT differs
        UNION ALL SELECT '{name}', {SHOW} FROM so, df WHERE o_orderdate >= {day} - {reload_} AND differs)"""


@query("sync_mirrors", f"""
    WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, {UPDATED} AS updated FROM orders), {TGT}
    """ + " UNION ALL ".join(f"SELECT * FROM {_mirror_sql(*k)}" for k in MIRROR_KINDS))
def sync_mirrors(t):
    """Mirrors by name: most find other counts than the source and reload, the last one reconciles."""
    updated = F.expr("case when o_orderpriority = '1-URGENT' then o_orderdate + interval 40 day "
                     "else o_orderdate + interval 1 day end")
    keys = {k: F.col("o_orderkey") for k in ("ordernbr", "refnbr", "batnbr")} | {k: F.lit("B1") for k in ("branchid", "shiptime")}

    def named(df, status):
        done = F.when(F.col("o_orderstatus") == "F", "C").otherwise(F.col("o_orderstatus"))
        df = df.withColumns({**keys, "status": done, "created": F.col("o_orderdate")})
        return df.filter(F.col("o_orderstatus") == status) if status else df

    source = t.orders.withColumn("updated", updated).select(*COLS, "updated")
    runs = []
    for name, _, _, _, status in MIRROR_KINDS:
        target = source_of(t).withColumn("o_totalprice", F.col("o_totalprice") + 1) if name == "carrier_keys" else target_of(t)
        state = mirror.sync_mirror(name, named(source, None), named(target, status), "created", "updated", AS_OF)
        runs.append(state.select(F.lit(name).alias("kind"), *COLS))
    return shown(union_by_name(runs))


@query("sync_lookback", f"""
    SELECT 'working' AS run, event_id, CASE WHEN ts < DATE '2024-01-20' THEN 0.0 ELSE value END AS value FROM events
    UNION ALL SELECT 'night', event_id, CASE WHEN ts < DATE '2024-01-10' THEN 0.0 ELSE value END FROM events""")
def sync_lookback(t):
    e = t.events.select("event_id", "ts", "value")
    stale, runs = e.withColumn("value", F.lit(0.0)), []
    for run, hour in (("working", 10), ("night", 23)):
        start = mirror.lookback_start(dt.datetime(2024, 1, 20, hour, 30), days=10)
        fresh = readers.report_source(e, "ts", start, None)
        runs.append(upserts.window_replace(stale, fresh, "ts", start).withColumn("run", F.lit(run)))
    return union_by_name(runs).select("run", "event_id", "value")


@query("sync_full_refresh", f"SELECT {SHOW} FROM orders")
def sync_full_refresh(t):
    folder = run_folder(t.spark, "refresh")
    writers.append(target_of(t), folder)
    writers.replace_all(mirror.full_refresh(source_of(t), COLS), folder)
    return shown(t.spark.read.parquet(folder))


FILES_PER_BATCH = 8  # bounds a micro-batch, whatever has landed


@query("sync_stream_upsert", f"""
    SELECT user_id, event_type, event_id, {ymdhms('ts')} AS ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def sync_stream_upsert(t):
    columns, keys, order = ["event_id", "ts", "user_id", "event_type", "value"], ["user_id", "event_type"], ["ts", "event_id"]
    events = t.events.select(*columns)
    base = events.filter(F.col("ts") < F.lit(dt.date(2024, 1, 10)))
    changes = events.filter(F.col("ts") >= F.lit(dt.date(2024, 1, 8)))
    folder = run_folder(t.spark, "stream")
    changes.withColumn("dt", F.to_date("ts")).write.partitionBy("dt").parquet(f"{folder}/landed")
    landed = t.spark.read.parquet(f"{folder}/landed")
    stream = change_log.read_changes(t.spark, f"{folder}/landed", landed.schema, FILES_PER_BATCH).drop("dt")
    change_log.write_change_log(stream, f"{folder}/log", f"{folder}/checkpoint", keys, order).awaitTermination()
    log = t.spark.read.parquet(f"{folder}/log")
    return change_log.current_state(base, log, keys, order)


# ---- sources and sinks -----------------------------------------------------------------

@query("load_modes", f"""
    WITH {SRC}
    SELECT 'append' AS kind, o_orderstatus, 2 * count(*) AS orders, CAST(2 * sum({dec('o_totalprice')}) AS DOUBLE) AS total FROM src GROUP BY ALL
    UNION ALL SELECT 'replace', o_orderstatus, count(*), CAST(sum({dec('o_totalprice')}) AS DOUBLE) FROM src
        WHERE o_orderstatus <> 'F' GROUP BY ALL
    UNION ALL SELECT 'partition', o_orderstatus, count(*),
        CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE {dec('o_totalprice')} END) AS DOUBLE) FROM src GROUP BY ALL""")
def load_modes(t):
    folder, orders = run_folder(t.spark, "loads"), source_of(t)
    writers.load(orders, f"{folder}/append", 1)
    writers.load(orders, f"{folder}/append", 2)
    writers.gated_load(orders, f"{folder}/replace", 1, ["o_orderkey"])
    writers.load(orders.filter("o_orderstatus <> 'F'"), f"{folder}/replace", 3)
    writers.load(orders, f"{folder}/partition", 1, ["o_orderstatus"])
    writers.replace_partitions(orders.filter("o_orderstatus = 'O'").withColumn("o_totalprice", F.lit(0.0)),
                               f"{folder}/partition", ["o_orderstatus"])
    return union_by_name([t.spark.read.parquet(f"{folder}/{kind}").groupBy(F.lit(kind).alias("kind"), "o_orderstatus")
                  .agg(F.count(F.lit(1)).alias("orders"), zero_sum(money("o_totalprice")).alias("total"))
                  for kind in ("append", "replace", "partition")])


@query("snapshot_append", f"""
    WITH {SRC}
    SELECT {ymd('o_orderdate')} AS dt, count(*) AS orders, '2001-07-02 08:00:00' AS inserted_at
    FROM src WHERE o_orderdate >= DATE '2001-07-01' AND o_orderdate < DATE '2001-07-03' GROUP BY ALL""")
def snapshot_append(t):
    folder = run_folder(t.spark, "snapshots")
    for on in ("2001-07-01", "2001-07-02", "2001-07-02"):  # the second day runs twice
        day = readers.day_extract(source_of(t), "o_orderdate", on)
        writers.replace_partitions(writers.audited(day, "2001-07-02 08:00:00"), folder, ["dt"])
    return t.spark.read.parquet(folder).groupBy("dt", "inserted_at").agg(F.count(F.lit(1)).alias("orders"))


FORMATS = f"""
    SELECT 'csv' AS format, count(*) AS n, CAST(sum({dec('o_totalprice')}) AS DOUBLE) AS total,
           min(lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS first_code, {ymd('max(o_orderdate)')} AS last_day FROM orders
    UNION ALL SELECT 'linked', count(*), CAST(sum({dec('o_totalprice')}) AS DOUBLE),
           min(lpad(CAST(o_custkey AS VARCHAR), 9, '0')), {ymd('max(o_orderdate)')} FROM orders"""


STATUSES = ("F", "O", "P")


@query("source_formats", FORMATS + f"""
    UNION ALL SELECT 'json', count(*), CAST(sum({dec('p_retailprice')}) AS DOUBLE), min(p_brand), NULL FROM part
    UNION ALL SELECT 'lines', count(*), CAST(sum(length(p_name)) AS DOUBLE), min(p_name), NULL FROM part
    UNION ALL SELECT 'header', count(*), CAST(sum(n_nationkey) AS DOUBLE), min(n_name), NULL FROM nation
    UNION ALL SELECT 'sql', count(*), CAST(sum({dec('s_acctbal')}) AS DOUBLE), min(s_name), NULL FROM supplier""")
def source_formats(t):
    spark, folder = t.spark, run_folder(t.spark, "formats")
    schema = "code string, o_totalprice double, o_orderdate date"
    text_rows = t.orders.select(F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("code"), "o_totalprice",
                                F.date_format("o_orderdate", "dd/MM/yyyy").alias("o_orderdate"), "o_orderstatus")
    for s in STATUSES:
        writers.export_csv(text_rows.filter(F.col("o_orderstatus") == s).drop("o_orderstatus"), f"{folder}/csv_{s}")
    writers.export_csv(text_rows.drop("o_orderstatus"), f"{folder}/csv")
    links = readers.literal_rows(spark, [(f"{folder}/csv_{s}",) for s in STATUSES], "path string")

    def orders_row(df, name):
        return df.agg(F.lit(name).alias("format"), F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("total"),
                      F.min("code").alias("first_code"), F.max("o_orderdate").alias("last_day"))

    out = [orders_row(readers.read_csv(spark, f"{folder}/csv", schema), "csv"),
           orders_row(readers.read_linked_csvs(spark, links, "path", schema), "linked")]

    t.part.select(F.array(F.struct("p_brand", "p_retailprice")).alias("data")).write.json(f"{folder}/json")
    parts = readers.read_payload(spark, f"{folder}/json", "data array<struct<p_brand: string, p_retailprice: double>>", "data")
    out.append(parts.agg(F.lit("json").alias("format"), F.count(F.lit(1)).alias("n"),
                         F.sum(money("p_retailprice")).alias("total"), F.min("p_brand").alias("first_code")))

    t.part.select("p_name").write.text(f"{folder}/lines")
    out.append(readers.read_lines(spark, f"{folder}/lines").agg(
        F.lit("lines").alias("format"), F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("total"),
        F.min("value").alias("first_code")))

    t.nation.write.option("header", "true").csv(f"{folder}/header")
    raw = readers.read_csv(spark, f"{folder}/header", "a string, b string, c string", header=False)
    promoted = readers.promote_header(raw, F.col("a") == "n_nationkey")  # one header per written file
    out.append(promoted.agg(F.lit("header").alias("format"), F.count(F.lit(1)).alias("n"),
                            F.sum(F.col("n_nationkey").cast("double")).alias("total"), F.min("n_name").alias("first_code")))

    out.append(readers.read_sql(spark, "select 'sql' as format, count(*) as n, sum(cast(s_acctbal as decimal(18,2))) as total, "
                                       "min(s_name) as first_code from {supplier}", supplier=t.supplier))
    out = [df.withColumn("total", F.col("total").cast("double")) for df in out]
    return union_by_name(out).select("format", "n", "total", "first_code", "last_day")


@query("export_formats", """
    SELECT 'csv' AS format, p_partkey, p_name, p_size::BIGINT AS p_size FROM part
    UNION ALL SELECT 'json', p_partkey, p_name, NULL FROM part
    UNION ALL SELECT 'parquet', p_partkey, p_name, p_size FROM part""")
def export_formats(t):
    spark, folder = t.spark, run_folder(t.spark, "exports")
    part = t.part.select("p_partkey", "p_name", "p_size")
    schema = "p_partkey bigint, p_name string, p_size int"
    writers.export_csv(part, f"{folder}/csv")
    writers.export_json(part, f"{folder}/json", ["p_partkey", "p_name"])
    writers.append(part, f"{folder}/parquet")
    back = {"csv": readers.read_csv(spark, f"{folder}/csv", schema),
            "json": spark.read.schema(schema).json(f"{folder}/json"),
            "parquet": readers.read_snapshot(spark, f"{folder}/parquet")}
    return union_by_name([df.select(F.lit(name).alias("format"), *part.columns) for name, df in back.items()])


@query("landed_loads", f"""
    SELECT lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS customer, o_orderstatus AS status, {ymd('o_orderdate')} AS ordered_on,
           CAST({dec('o_totalprice')} AS DOUBLE) AS amount, CASE WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE o_orderpriority END AS priority,
           o_totalprice > 200000 AND o_orderstatus = 'F' AS is_large_done, '2001-08-02 00:00:00' AS inserted_at
    FROM orders WHERE o_orderstatus <> 'P'""".replace("o_totalprice > 200000 AND o_orderstatus = 'F' AS",
                                                      "CAST(o_totalprice > 200000 AND o_orderstatus = 'F' AS BIGINT) AS"))
def landed_loads(t):
    folder = run_folder(t.spark, "landed")
    sheet = t.orders.select(
        F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("MaKH"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit(" "), "o_orderstatus", F.lit("  "))).alias("Status"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("OrderedOn"),
        F.format_number("o_totalprice", 2).alias("Amount"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("Priority"))
    sheet.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false") \
        .option("ignoreTrailingWhiteSpace", "false").csv(folder)
    raw = readers.read_csv(t.spark, folder, "MaKH string, Status string, OrderedOn string, Amount string, Priority string")
    spec = LoadSpec(rename={"makh": "customer", "orderedon": "ordered_on"}, dates={"ordered_on": "dd/MM/yyyy"},
                    numbers={"amount": "decimal(18,2)"}, texts=["status"], blanks={"priority": "none"},
                    required=["status"],
                    derived={"is_large_done": (F.col("amount") > 200000) & (F.col("status") == "F")},
                    keep=["customer", "status", "ordered_on", "amount", "priority", "is_large_done"])
    return load_landed(raw, spec, "2001-08-02")


@query("text_lines_count", r"""
    SELECT word, count(*) AS occurrences FROM (
        SELECT unnest(string_split(line, ' ')) AS word
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM conversations)) GROUP BY word""")
def text_lines_count(t):
    folder = run_folder(t.spark, "lines")
    t.conversations.select("text").write.text(folder)
    return word_count(readers.read_lines(t.spark, folder), "value")


@query("order_list_refresh", f"""
    WITH {SRC}, {TGT}, days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM tgt WHERE o_orderstatus = 'O' AND o_totalprice > 490000
                               UNION SELECT DATE '2001-07-20'),
         f AS (SELECT * FROM src WHERE CAST(o_orderdate AS DATE) IN (SELECT d FROM days))
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM f
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM f)""")
def order_list_refresh(t):
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    open_ = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 490000)
    return upserts.refresh_open(target_of(t).select(*columns), source_of(t).select(*columns), ["o_orderkey"],
                                "o_orderdate", open_, "2001-07-20", ["o_orderstatus", "o_totalprice"]).drop("o_orderdate")
