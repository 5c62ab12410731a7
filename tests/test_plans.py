"""Plans: what the optimizer makes of the operators (every query's plan is checked in test_oracle)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.oracle import executed_nodes, executed_plans, plan
from tidemark.catalog import registered
from tidemark.functions.dates import on_days
from tidemark.operators import windows as W
from tidemark.operators.joins import facts
from tidemark.plans import sales

SMALL = "/root/testdata/sf0.001"


def test_latest_limits_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SMALL}/events.parquet")
    text = plan(W.latest(df, ["user_id"], ["ts", "event_id"]))
    assert text.count("WindowGroupLimit") >= 2
    assert text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet")
    text = plan(df.filter(on_days("o_orderdate", "1997-01-01", "1997-01-31")).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_lookup_tables_do_not_move_the_fact(spark):
    """The flagship shuffles lines once for the order join and then only partial aggregates."""
    text = plan(registered["sales_fact"].run(spark, SMALL))
    assert text.count("SortMergeJoin") == 1 and "c_mktsegment" not in "".join(
        line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_facts_are_never_broadcast(spark):
    a, b = spark.range(10).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
    assert "SortMergeJoin" in plan(facts(a, b, "k"))


def test_hot_key_is_spread_over_buckets(spark):
    df = spark.range(100).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    text = plan(W.numbered(df, ["k"], ["t"], "n", F.floor(F.col("t") / 10)))
    assert "partial_sum" in text


def scans(text: str, table: str) -> int:
    return sum(f"/{table}.parquet" in line and "Scan parquet" in line for line in text.splitlines())


@pytest.mark.parametrize("name", ["receivables_ledger", "receivables_by_order", "order_balance", "overdue_classes"])
def test_receivables_read_their_facts_once(spark, name):
    text = plan(registered[name].run(spark, SMALL))
    assert scans(text, "lineitem") <= 1 and scans(text, "orders") <= 2


@pytest.mark.parametrize("name, lines, exchanges", [
    ("stock_by_lot", 1, 4), ("stock_position", 1, 12), ("stock_cover", 2, 6), ("run_rate", 1, 4), ("programme_progress", 1, 8),
    ("sales_raw_to_fact", 2, 9), ("discount_lines", 1, 2)])
def test_lines_are_read_once(spark, name, lines, exchanges):
    """Counted over all jobs of a query as they ended, the staging writes included."""
    plans = executed_plans(spark, lambda: registered[name].run(spark, SMALL).write.format("noop").mode("overwrite").save())
    assert 1 <= executed_nodes(plans, "Scan parquet", "lineitem.parquet") <= lines
    assert executed_nodes(plans, "Exchange") <= exchanges


@pytest.mark.parametrize("name", ["upsert", "discount_lines", "receivables_by_order"])
def test_tasks_have_small_shares(spark, name):
    """A task's memory follows its bytes of a shuffle or file, which must not grow with the tables."""
    text = plan(registered[name].run(spark, SMALL))
    assert ", 400), " in text  # partitions enough to be put together from
    shares = [spark.conf.get(f"spark.sql.{k}") for k in ("adaptive.advisoryPartitionSizeInBytes", "files.maxPartitionBytes")]
    assert all(int(x.removesuffix("m")) <= 16 for x in shares)


def test_movements_are_dealt_once(spark):
    """By line, for their lots and for their line, with a constant among the keys as well."""
    df = spark.read.parquet(f"{SMALL}/lineitem.parquet").select(
        F.lit("B1").alias("branch"), "l_orderkey", F.col("l_linenumber").alias("line_ref"), F.col("l_suppkey").alias("lot"),
        (F.col("l_returnflag") != "A").alias("from_lot"), F.col("l_quantity").cast("decimal(18,2)").alias("qty"))
    assert plan(sales.lines_by_lot(df, ["branch", "l_orderkey"], {})).count("Exchange hashpartitioning") == 1


def test_receivables_broadcast_dimensions_only(spark):
    text = plan(registered["receivables_by_order"].run(spark, SMALL))
    assert text.count("SortMergeJoin") == 2  # reversals and lines


def test_seven_legs_are_joined_once(spark):
    """The stored base and the recent rows come from the same joins: deliveries, confirmations and adjustments
    read the lines once each."""
    plans = executed_plans(spark, lambda: registered["receivables_seven_legs"].run(spark, SMALL).write.format("noop").mode("overwrite").save())
    assert 1 <= executed_nodes(plans, "Scan parquet", "lineitem.parquet") <= 3


@pytest.mark.parametrize("name", ["win_running", "version_history", "attribute_changes", "join_coalesce_lead"])
def test_ordered_columns_are_dealt_by_days(spark, name):
    """A hot key is spread over the calendar: rows are dealt by key and day, not by key or key and year."""
    dealt = [line for line in plan(registered[name].run(spark, SMALL)).splitlines() if "hashpartitioning" in line]
    assert any("bucket" in line for line in dealt) and not any("year(" in line for line in dealt)


def test_contract():
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(queries) and contract.FLAGSHIP in queries
    assert len(queries) >= 120


def test_entry(spark):
    assert contract.entry(spark).count() > 0
