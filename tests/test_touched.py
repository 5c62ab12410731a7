"""Partitioned tables: what a load reads and rewrites, gates, replays; fingerprints."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.oracle import plan
from tidemark.operators import fingerprints
from tidemark.operators.quality import Gate, QualityError, declared_rows, gated, no_nulls, not_empty
from tidemark.sources import upserts
from tidemark.sources.partitioned import PartitionedTable
from tidemark.sources.scratch import run_folder

SCHEMA = "k int, v string, d timestamp_ntz"


def day(n):
    return dt.datetime(2024, 1, 1, 7) + dt.timedelta(days=n)


ROWS = [(i, f"v{i}", day(i // 3)) for i in range(30)] + [(99, "undated", None)]


@pytest.fixture
def table(spark, frame):
    return PartitionedTable.create(frame(SCHEMA, *ROWS), run_folder(spark, "t"), "d")


def files(table):
    """The data files of each partition."""
    found = {}
    for f in table.read(with_part=True).select("part", F.input_file_name().alias("f")).distinct().collect():
        found.setdefault(f.part, set()).add(f.f)
    return found


def state(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def replaced(table, load):
    """Run a load; the partitions it names are those whose files changed, and a replay changes no row."""
    before = files(table)
    named = load()
    after = files(table)
    changed = {p for p in {*before, *after} if before.get(p) != after.get(p)}
    assert changed <= set(named)
    rows = state(table)
    load()
    assert state(table) == rows
    return sorted(named)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_create_and_read(table, frame):
    assert len(table.stored()) == 11 and "none" in table.stored()
    assert state(table) == plain(frame(SCHEMA, *ROWS))
    text = plan(table.read(["2024-01-02"]))
    assert "PartitionFilters: [" in text and "part#" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_upsert_touches_the_days_of_changes_and_of_their_stored_rows(table, frame):
    changes = frame(SCHEMA, (4, "new", day(1)), (5, "moved", day(7)), (200, "fresh", day(40)), (99, "dated now", day(2)))
    want = plain(upserts.upsert(frame(SCHEMA, *ROWS), changes, ["k"]))
    days = replaced(table, lambda: table.upsert(changes, ["k"]))
    assert state(table) == want
    assert days == ["2024-01-02", "2024-01-03", "2024-01-08", "2024-02-10", "none"]
    assert "none" not in table.stored()  # its only row moved away


def test_upsert_of_repeated_keys_takes_the_last(table, frame):
    changes = frame(SCHEMA + ", seq int", (4, "a", day(1), 1), (4, "b", day(1), 2))
    assert table.upsert(changes, ["k"], ["seq"], fixed_dates=True) == ["2024-01-02"]
    assert [r.v for r in table.read(["2024-01-02"]).filter("k = 4").collect()] == ["b"]


def test_merge_keeps_the_stored_day(table, frame):
    changes = frame(SCHEMA, (4, "new", day(9)), (300, "fresh", day(12)))
    assert replaced(table, lambda: table.merge(changes, ["k"], ["v"])) in (["2024-01-02", "2024-01-13"],)
    assert (4, "new", day(1)) in state(table) and (300, "fresh", day(12)) in state(table)
    with pytest.raises(ValueError):
        table.merge(changes, ["k"], ["v", "d"])


def test_update_from(table, frame):
    staged = frame("k int, v string", (4, "x"), (7, None), (400, "unknown"))
    assert table.update_from(staged, ["k"], ["v"]) == ["2024-01-02", "2024-01-03"]
    rows = dict((r[0], r[1]) for r in state(table))
    assert rows[4] == "x" and rows[7] == "v7" and 400 not in rows


@pytest.mark.parametrize("unit", ["day", "month"])
def test_window_replace_empties_days(spark, frame, unit):
    table = PartitionedTable.create(frame(SCHEMA, *ROWS), run_folder(spark, "t"), "d", unit)
    extract = frame(SCHEMA, (500, "x", day(3)), (501, "y", day(4)))
    want = plain(upserts.window_replace(frame(SCHEMA, *ROWS), extract, "d", day(2).date(), day(5).date()))
    days = replaced(table, lambda: table.replace_window(extract, day(2).date(), day(5).date()))
    assert state(table) == want
    if unit == "day":
        assert days[0] == "2024-01-03" and "2024-01-03" not in table.stored() and "2024-01-06" not in table.stored()
    open_end = frame(SCHEMA, (600, "z", day(8)))
    table.replace_window(open_end, day(8).date())
    assert [r[0] for r in state(table) if r[2] and r[2] >= day(8)] == [600]


def test_months_and_keys(spark, frame):
    rows = [(i, "v", day(i)) for i in range(0, 90, 5)]
    table = PartitionedTable.create(frame(SCHEMA, *rows), run_folder(spark, "t"), "d")
    extract = frame(SCHEMA, (1000, "x", day(35)))
    want = plain(upserts.month_replace(frame(SCHEMA, *rows), extract, "d"))
    days = replaced(table, lambda: table.replace_months(extract))
    assert state(table) == want and all(d.startswith("2024-02") for d in days)
    keyed = frame(SCHEMA, (0, "y", day(0)), (1000, "y", day(0)))
    assert replaced(table, lambda: table.replace_keys(keyed, ["k"])) == ["2024-01-01"]


def test_new_rows_are_appended(table, frame):
    source = frame(SCHEMA, *ROWS, (700, "n", day(9) + dt.timedelta(hours=1)), (701, "n", day(15)))
    assert replaced(table, lambda: table.append_new(source)) in (["2024-01-10", "2024-01-16"], [])
    assert {r[0] for r in state(table)} == {*range(30), 99, 700, 701}


def test_failing_gates_leave_the_table_alone(table, frame):
    before, kept = files(table), state(table)
    changes = frame(SCHEMA, (None, "x", day(1)), (4, "new", day(1)))
    for gate in (no_nulls(["k"]), declared_rows(1000), Gate("too many", F.count(F.lit(1)), lambda n: n < 2)):
        with pytest.raises(QualityError):
            table.upsert(changes, ["k"], gates=[gate])
    with pytest.raises(QualityError):  # rows outside the named partitions
        table.put(frame(SCHEMA, (1, "x", day(1))), ["2024-01-05"])
    assert files(table) == before and state(table) == kept


def test_gates_measure_the_staging_write(spark, frame):
    df = frame("k int", (1,), (2,))
    assert gated(df, "g", [not_empty(), declared_rows(2), no_nulls(["k"])]).count() == 2
    for rows, gate in ((df.limit(0), not_empty()), (df.filter("k > 5"), not_empty()), (df, declared_rows(3))):
        with pytest.raises(QualityError):
            gated(rows, "g", [gate])


def test_an_empty_table(spark, frame):
    table = PartitionedTable(spark, run_folder(spark, "t"), frame(SCHEMA, ROWS[0]).schema, "d")
    assert table.stored() == [] and table.read().count() == 0
    table.upsert(frame(SCHEMA, *ROWS), ["k"])
    assert state(table) == plain(frame(SCHEMA, *ROWS))
    assert table.upsert(frame(SCHEMA, *ROWS).limit(0), ["k"]) == []


def test_sync_against_the_whole_table(spark, frame):
    from tidemark.sources import mirror
    schema = SCHEMA + ", u timestamp_ntz"
    source = frame(schema, *[(i, "new" if i % 4 == 0 else "v", day(i), day(60) if i % 4 == 0 else day(i)) for i in range(60) if i % 7])
    target = [(i, "v", day(i)) for i in range(55)]
    table = PartitionedTable.create(frame(SCHEMA, *target), run_folder(spark, "t"), "d")
    want = plain(mirror.sync_table(source, frame(SCHEMA, *target), ["k"], "d", "u", day(60).date(), lookback_days=15))
    replaced(table, lambda: table.sync(source, ["k"], "u", day(60).date(), lookback_days=15))
    assert state(table) == want


# ---- fingerprints ----------------------------------------------------------------------

def test_reconciliation_reloads_the_differing_days_only(table, frame):
    changed = [(k, "changed" if k in (4, 20) else v, d) for k, v, d in ROWS]  # as many rows as before
    source = frame(SCHEMA, *changed)
    before = files(table)
    leaves = table.reconcile(source, ["k"], "2024-01-01", buckets=4)
    assert {str(r.day) for r in leaves.collect()} == {"2024-01-02", "2024-01-07"}
    after = files(table)
    assert {p for p in before if before[p] != after[p]} == {"2024-01-02", "2024-01-07"}
    assert state(table) == plain(source)
    assert table.reconcile(source, ["k"], "2024-01-01").count() == 0
    assert files(table) == after


def test_reconciliation_of_lost_and_surplus_rows(table, frame):
    source = frame(SCHEMA, *[r for r in ROWS if r[0] not in (3, 4, 5)], (800, "late", day(20)), (10, "v10", day(3)))  # 10 twice
    table.reconcile(source, ["k"], "2024-01-01")
    assert state(table) == plain(source)
    early = frame(SCHEMA, *[(k, "other", d) for k, v, d in ROWS])
    table.reconcile(early, ["k"], day(8).date())
    assert {r[0] for r in state(table) if r[1] == "other"} == {24, 25, 26, 27, 28, 29}


def test_fingerprints_depend_on_values_nulls_and_copies_only(frame):
    def same(a, b, schema="x string, y string"):
        one, two = frame(schema, *a), frame(schema, *b)
        return fingerprints.unequal(one, two, {"g": F.lit(1)}).isEmpty()

    rows = [("a", "b"), ("c", None), (None, "c"), ("", None)]
    shuffled = rows[:]
    random.Random(2).shuffle(shuffled)
    assert same(rows, shuffled)
    assert not same([("a", None)], [(None, "a")])
    assert not same([("a", "")], [("a", None)])
    assert not same([("a", "b")] * 2, [("a", "b")] * 4)
    assert not same([("a", "b"), ("c", "d")], [("a", "d"), ("c", "b")])
    assert same([(0.0,), (float("nan"),)], [(-0.0,), (float("nan"),)], "x double")


def test_differing_leaves_without_dates(frame):
    a = frame("k int, d date, v int", (1, None, 1), (2, dt.date(2024, 1, 1), 1))
    b = frame("k int, d date, v int", (1, None, 2), (2, dt.date(2024, 1, 1), 1))
    got = fingerprints.differing(a, b, "d", ["k"], 8).collect()
    assert [(r.day, r.rows_a, r.rows_b) for r in got] == [(None, 1, 1)]
