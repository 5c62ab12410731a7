"""Payloads whose fields change, paged sources, table functions, delete notices, recursion, raw lines."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tests.oracle import plan
from tidemark.functions import nested
from tidemark.operators import hierarchy
from tidemark.operators.quality import QualityError
from tidemark.plans import sales
from tidemark.sources import pages, readers
from tidemark.sources.scratch import run_folder
from tidemark.streaming import change_log


# ---- payloads --------------------------------------------------------------------------

def test_fields_of_later_files_appear(spark, frame):
    early = frame("k int, t string", (1, '{"id": 1, "name": "a"}'), (2, '{"id": 2}'))
    flat = nested.variant_columns(nested.with_variant(early, "t").drop("t"), "payload")
    assert flat.columns == ["k", "id", "name"]
    late = early.unionByName(frame("k int, t string", (3, '{"id": 3, "new": {"x": 1.5, "y": "z"}}'), (4, "broken {"), (5, None)))
    flat = nested.variant_columns(nested.with_variant(late, "t").drop("t"), "payload")
    got = {r.k: r.asDict() for r in flat.collect()}
    assert set(flat.columns) == {"k", "id", "name", "new_x", "new_y"}
    assert float(got[3]["new_x"]) == 1.5 and got[3]["new_y"] == "z" and got[1]["new_x"] is None and got[4]["id"] is None
    with pytest.raises(ValueError):
        nested.variant_columns(nested.with_variant(late, "t").drop("t").withColumnRenamed("k", "id"), "payload")


def test_fields_that_do_not_fit_are_null(frame):
    df = nested.with_variant(frame("t string", ('{"a": 5, "l": [{"v": 1}, {"v": "x"}]}',), ('{"a": "five"}',)), "t").drop("t")
    assert sorted(str(r.a) for r in nested.variant_fields(df, "payload", {"a": ("$.a", "int")}).collect()) == ["5", "None"]
    rows = nested.variant_fields(nested.variant_rows(df, "payload", "$.l"), "payload", {"v": ("$.v", "int")})
    assert sorted(str(r.v) for r in rows.collect()) == ["1", "None"]
    assert nested.variant_columns(df.where("false"), "payload").columns == []


# ---- pages -----------------------------------------------------------------------------

def service(total, size, fails):
    """Pages of numbers; ``fails`` maps a page to how many attempts come short."""
    def fetch(page, attempt):
        rows = [(n, f"row {n}") for n in range((page - 1) * size, min(page * size, total))]
        return total, rows[:-1] if attempt < fails.get(page, 0) else rows
    return fetch


@pytest.mark.parametrize("total, fails", [(23, {}), (23, {2: 1, 5: 1}), (20, {1: 2, 4: 1}), (1, {1: 1})])
def test_missing_pages_are_fetched_again(spark, total, fails):
    got = pages.read_pages(spark, service(total, 5, fails), "n int, text string", 5)
    assert sorted(r.n for r in got.collect()) == list(range(total))


def test_a_page_that_stays_short_is_named(spark):
    with pytest.raises(QualityError, match=r"\[2\]"):
        pages.read_pages(spark, service(23, 5, {2: 9}), "n int, text string", 5)
    assert pages.read_pages(spark, service(0, 5, {}), "n int, text string", 5).count() == 0


def test_every_page_is_a_partition(spark):
    source = pages._source(service(23, 5, {}), "n int, text string", [1, 2, 3, 4, 5], 0)
    spark.dataSource.register(source)
    assert spark.read.format("tidemark_pages").load().select(F.spark_partition_id().alias("p")).distinct().count() == 5


# ---- table functions -------------------------------------------------------------------

def test_arguments_of_a_table_function_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    readers.report_function(spark, "by_days", orders, "o_orderdate", [("least", "DOUBLE")], "o_totalprice >= by_days.least")
    df = spark.sql("SELECT o_orderkey FROM by_days(DATE '1997-01-01', DATE '1997-01-31', 1000.0)")
    text = plan(df)
    pushed = text.split("PushedFilters: [")[1]  # the line is cut after some filters
    assert "IsNotNull(o_totalprice)" in pushed and "GreaterThanOrEqual(o_orderdate,1997-01-01" in pushed
    assert "o_orderstatus" not in pushed.split("ReadSchema")[1]  # columns nobody asks for are not read
    first, last = dt.datetime(1997, 1, 1), dt.datetime(1997, 2, 1)
    want = orders.filter((F.col("o_orderdate") >= F.lit(first)) & (F.col("o_orderdate") < F.lit(last)) & (F.col("o_totalprice") >= 1000))
    assert sorted(r[0] for r in df.collect()) == sorted(r.o_orderkey for r in want.collect()) != []


# ---- delete notices --------------------------------------------------------------------

AT = dt.datetime(2024, 1, 1)
LOG = "k int, v string, u timestamp_ntz"


def hours(n):
    return AT + dt.timedelta(hours=n)


def test_stream_with_deletes_equals_the_batch(spark, frame):
    changes = [(i % 7, f"v{i}", hours(i)) for i in range(40)]
    notices = [(3, hours(39)), (4, hours(5)), (6, hours(41)), (50, hours(1))]
    base = frame(LOG, *[(k, "base", hours(-1)) for k in range(10)])
    folder = run_folder(spark, "deletes")
    frame(LOG, *changes, *changes[:5]).write.parquet(f"{folder}/changes")
    frame("k int, u timestamp_ntz", *notices).write.parquet(f"{folder}/notices")
    want = change_log.with_deletes(frame(LOG, *changes), frame("k int, u timestamp_ntz", *notices), ["k"], ["u"])
    batch = sorted(tuple(r) for r in change_log.current_state(base, want.withColumn("batch_id", F.lit(0)), ["k"], ["u"]).collect())
    assert {r[0] for r in batch} == {0, 1, 2, 4, 5, 7, 8, 9}

    def run():
        a = change_log.read_changes(spark, f"{folder}/changes", spark.read.parquet(f"{folder}/changes").schema, 1)
        b = change_log.read_changes(spark, f"{folder}/notices", spark.read.parquet(f"{folder}/notices").schema, 1)
        rows = change_log.drop_repeats(change_log.with_deletes(a, b, ["k"], ["u"]), ["k"], "u", "30 days")
        change_log.write_change_log(rows, f"{folder}/log", f"{folder}/checkpoint", ["k"], ["u"]).awaitTermination()
        return spark.read.parquet(f"{folder}/log")

    log = run()
    assert sorted(tuple(r) for r in change_log.current_state(base, log, ["k"], ["u"]).collect()) == batch
    # A later change revives a deleted key; earlier rows delivered again change nothing.
    frame(LOG, (3, "again", hours(60)), *changes[:5]).write.mode("append").parquet(f"{folder}/changes")
    after = {r.k: r.v for r in change_log.current_state(base, run(), ["k"], ["u"]).collect()}
    assert after == {**{r[0]: r[1] for r in batch}, 3: "again"}
    change_log.compact(base, log, ["k"], ["u"], f"{folder}/compacted")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{folder}/compacted").collect()) == batch


# ---- lines of command ------------------------------------------------------------------

def test_ten_levels_and_a_cycle(frame):
    chain = [(f"n{i:02}", f"n{i - 1:02}" if i else None) for i in range(11)]
    cycle = [("a", "b"), ("b", "c"), ("c", "a"), ("into", "c"), ("self", "self")]
    got = {r.who: r for r in hierarchy.reporting_lines(frame("who string, boss string", *chain, *cycle), "who", "boss").collect()}
    assert got["n10"].line == [f"n{i:02}" for i in range(9, -1, -1)] and got["n10"].depth == 10 and got["n10"].top == "n00"
    assert got["n00"].line == [] and got["n00"].top == "n00" and not got["n00"].in_cycle
    assert got["a"].line == ["b", "c"] and got["a"].in_cycle and got["a"].top is None
    assert got["into"].line == ["c", "a", "b"] and got["into"].in_cycle
    assert got["self"].line == [] and got["self"].in_cycle
    assert len(got) == 16


def test_a_boss_outside_the_list_and_too_many_levels(spark, frame):
    got = {r.who: r for r in hierarchy.reporting_lines(frame("who string, boss string", ("x", "outside"), (None, "x"), ("y", "x")), "who", "boss").collect()}
    assert got["y"].line == ["x", "outside"] and got["y"].top == "outside" and set(got) == {"x", "y"}
    deep = spark.range(30).select(F.col("id").alias("who"), (F.col("id") - 1).alias("boss"))
    assert hierarchy.ancestors(deep, "who", "boss").count() == 30 * 31 // 2
    with pytest.raises(Exception, match="(?i)recursion"):
        hierarchy.ancestors(deep, "who", "boss", most=5).count()


# ---- raw lines -------------------------------------------------------------------------

def test_lines_by_lot_against_plain(frame):
    data = [(o, n, f"l{l}", bool((o + n + l) % 3), float(q), q % 2 == 0, 10.0 * q)
            for o, n, l, q in itertools.product((1, 2), (1, 2, 3), (0, 1), (1, 2))] + [(9, 1, None, False, 4.0, False, 1.0), (9, 2, None, True, 5.0, True, 2.0)]
    df = frame("o int, line_ref int, lot string, from_lot boolean, qty double, free boolean, amount double", *data)
    got = sorted((r.o, r.line_ref, str(r.lot), str(r.lot_qty), r.line_qty, r.free, r.amount)
                 for r in sales.lines_by_lot(df, ["o"], {"free": "any", "amount": "max"}).collect())
    want = []
    for key in {(r[0], r[1]) for r in data}:
        rows = [r for r in data if (r[0], r[1]) == key]
        line = (sum(r[4] for r in rows), any(r[5] for r in rows), max(r[6] for r in rows))
        lots = {}
        for r in rows:
            if r[3]:
                lots[r[2]] = lots.get(r[2], 0.0) + r[4]
        want += [(*key, str(lot), str(q), *line) for lot, q in lots.items()] or [(*key, "None", "None", *line)]
    assert got == sorted(want)


def test_books_of_returns_fill_blank_texts_only(frame):
    headers = frame("b string, o int, back int", ("x", 1, None), ("x", 2, 1), ("x", 3, 1), ("x", 4, 9), ("x", 5, 1))
    books = frame("b string, o int, who string", ("x", 1, "one"), ("x", 2, " "), ("x", 3, "three"), ("x", 4, ""), ("x", None, "lost"))
    got = {r.o: r.who for r in sales.with_books(headers, books, ["b", "o"], "back", ["who"]).collect()}
    assert got == {1: "one", 2: "one", 3: "three", 4: None, 5: None}
