"""Stored tables kept in step by rewriting only the partitions that a load touches."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog.base import query, ymd
from tidemark.catalog.maintenance import AS_OF, COLS, SHOW, SRC, TGT, UPDATED, shown, source_of, target_of
from tidemark.operators.quality import no_nulls, not_empty
from tidemark.operators.sets import union_by_name
from tidemark.sources.partitioned import PartitionedTable
from tidemark.sources.scratch import run_folder


def _table(t, rows, name, unit="month"):
    return PartitionedTable.create(rows, run_folder(t.spark, name), "o_orderdate", unit)


def _dated(t, condition):
    return source_of(t).filter(condition)


CHANGES = "o_orderstatus IN ('O', 'P') AND o_orderdate >= DATE '1998-01-10' AND o_orderdate < DATE '1998-03-05'"
EXTRACT = "year(o_orderdate) = 1997 AND month(o_orderdate) IN (1, 11)"
KEYED = "o_totalprice > 300000 AND year(o_orderdate) = 1996 AND month(o_orderdate) = 7"
MERGED = "o_orderdate >= DATE '2000-02-01' AND o_orderdate < DATE '2000-02-11'"


@query("touched_partitions", f"""
    WITH {SRC}, {TGT}, ch AS (SELECT * FROM src WHERE {CHANGES}),
    a AS (SELECT * FROM ch UNION ALL SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ch)),
    b AS (SELECT * FROM a WHERE o_orderdate < DATE '1999-04-01' OR o_orderdate >= DATE '1999-05-16'
          UNION ALL SELECT * FROM src WHERE o_orderdate >= DATE '1999-04-01' AND o_orderdate < DATE '1999-05-16'),
    c AS (SELECT * FROM b WHERE NOT ({EXTRACT}) UNION ALL SELECT * FROM src WHERE {EXTRACT}),
    k AS (SELECT * FROM src WHERE {KEYED}),
    d AS (SELECT * FROM c WHERE NOT (CAST(o_orderdate AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM k)
                                     AND o_orderkey IN (SELECT o_orderkey FROM k)) UNION ALL SELECT * FROM k),
    m AS (SELECT * FROM src WHERE {MERGED}),
    e AS (SELECT d.o_orderkey, d.o_custkey, d.o_orderstatus, coalesce(m.o_totalprice, d.o_totalprice) AS o_totalprice, d.o_orderdate
          FROM d LEFT JOIN m ON m.o_orderkey = d.o_orderkey
          UNION ALL SELECT * FROM m WHERE o_orderkey NOT IN (SELECT o_orderkey FROM d)),
    u AS (SELECT * FROM src WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1995-03-01' AND o_orderdate < DATE '1995-04-01')
    SELECT e.o_orderkey, e.o_custkey, e.o_orderstatus, CASE WHEN u.o_orderkey IS NULL THEN e.o_totalprice ELSE 0 END AS o_totalprice,
           {ymd('e.o_orderdate')} AS o_orderdate FROM e LEFT JOIN u ON u.o_orderkey = e.o_orderkey""")
def touched_partitions(t):
    """A stored copy taken through every kind of load; each rewrites the months that it touches."""
    table = _table(t, target_of(t), "touched-table")
    table.upsert(_dated(t, CHANGES), ["o_orderkey"], gates=[not_empty(), no_nulls(["o_orderkey"])])
    quarter = _dated(t, "o_orderdate >= DATE '1999-04-01' AND o_orderdate < DATE '1999-05-16'")
    table.replace_window(quarter, "1999-04-01", "1999-05-15")
    table.replace_months(_dated(t, EXTRACT))
    table.replace_keys(_dated(t, KEYED), ["o_orderkey"])
    table.merge(_dated(t, MERGED), ["o_orderkey"], ["o_totalprice"])
    staged = _dated(t, "o_orderstatus = 'F' AND o_orderdate >= DATE '1995-03-01' AND o_orderdate < DATE '1995-04-01'")
    table.update_from(staged.withColumn("o_totalprice", F.lit(0.0)), ["o_orderkey"], ["o_totalprice"])
    return shown(table.read())


@query("touched_sync", f"""
    WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, {UPDATED} AS updated FROM orders), {TGT},
         ch AS (SELECT * FROM s WHERE updated >= DATE '{AS_OF}' AND o_orderdate >= DATE '1998-01-01'),
         a AS (SELECT * EXCLUDE (updated) FROM ch UNION ALL SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ch))
    SELECT 'sync' AS kind, {SHOW} FROM a WHERE o_orderdate < DATE '{AS_OF}' - 45
        OR o_orderkey IN (SELECT o_orderkey FROM s WHERE o_orderdate >= DATE '{AS_OF}' - 45)
    UNION ALL SELECT 'append', {SHOW} FROM tgt WHERE o_orderdate <= (SELECT max(o_orderdate) FROM tgt WHERE o_orderdate < DATE '2001-03-10')
    UNION ALL SELECT 'append', {SHOW} FROM s WHERE o_orderdate > (SELECT max(o_orderdate) FROM tgt WHERE o_orderdate < DATE '2001-03-10')""")
def touched_sync(t):
    """A mirror run and a copy of new rows on stored months."""
    updated = F.expr("case when o_orderpriority = '1-URGENT' then o_orderdate + interval 40 day else o_orderdate + interval 1 day end")
    source = t.orders.withColumn("updated", updated).select(*COLS, "updated")
    mirrored = _table(t, target_of(t), "synced-table")
    mirrored.sync(source, ["o_orderkey"], "updated", AS_OF, lookback_days=45, floor="1998-01-01")
    grown = _table(t, target_of(t).filter(F.col("o_orderdate") < F.lit(dt.date(2001, 3, 10))), "grown-table")
    grown.append_new(source)
    return shown(union_by_name([df.read().withColumn("kind", F.lit(kind)) for kind, df in (("sync", mirrored), ("append", grown))]))


RECENT = "2001-05-01"


@query("reconcile_fingerprints", f"""
    WITH {SRC}, old AS (SELECT o_orderkey, o_custkey, o_orderstatus,
             CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate FROM src)
    SELECT 'state' AS kind, {SHOW} FROM old WHERE o_orderdate < DATE '{RECENT}'
    UNION ALL SELECT 'state', {SHOW} FROM src WHERE o_orderdate >= DATE '{RECENT}'
    UNION ALL SELECT DISTINCT 'day', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), {ymd('o_orderdate')}
    FROM src WHERE o_orderkey % 50 = 0 AND o_orderdate >= DATE '{RECENT}'""")
def reconcile_fingerprints(t):
    """Equal row counts, changed values: the differing days are found and only their differing rows reloaded."""
    stale = F.when(F.col("o_orderkey") % 50 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    table = _table(t, source_of(t).withColumn("o_totalprice", stale), "reconciled-table")
    leaves = table.reconcile(source_of(t), ["o_orderkey"], RECENT)
    days = leaves.select(F.col("day").alias("o_orderdate")).distinct().withColumn("kind", F.lit("day"))
    return union_by_name([shown(table.read()).withColumn("kind", F.lit("state")), days])
