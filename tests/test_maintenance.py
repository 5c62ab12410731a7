"""Table states: idempotence, edges of the windows, hard deletes, streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import QualityError
from tidemark.sources import mirror, readers, upserts, writers
from tidemark.sources.scratch import run_folder, shared_folder, written
from tidemark.streaming import change_log

AS_OF = dt.date(2024, 3, 10)


def at(day, hour=0):
    return dt.datetime.combine(AS_OF + dt.timedelta(days=day), dt.time(hour))


SCHEMA = "pk int, v string, created timestamp_ntz, updated timestamp_ntz"


@pytest.fixture
def source(frame):
    return frame(SCHEMA, (1, "old", at(-100), at(-100)), (2, "edge", at(-45), at(-45)), (3, "new value", at(-50), at(0, 9)),
                 (4, "today", at(0), at(0, 8)), (5, "inside", at(-10), at(-10)))


@pytest.fixture
def target(frame):
    return frame(SCHEMA, (1, "old", at(-100), at(-100)), (2, "edge", at(-45), at(-45)), (3, "stale", at(-50), at(-50)),
                 (6, "lost outside", at(-46), at(-46)), (7, "lost at the edge", at(-45), at(-45)), (8, "lost today", at(0), at(0)),
                 (9, "no date", None, None))


def ids(df):
    return sorted(r.pk for r in df.collect())


def test_sync_table(source, target, rows):
    def run(copy, **kw):
        return mirror.sync_table(source, copy, ["pk"], "created", "updated", AS_OF, **kw)

    state = run(target)
    # 5 was never copied and did not change today: only the reload brings it.
    assert ids(state) == [1, 2, 3, 4, 6, 9]
    assert {r.pk: r.v for r in state.collect()}[3] == "new value"
    assert rows(run(state)) == rows(state)
    assert ids(run(target, lookback_days=None)) == [1, 2, 3, 4, 6, 7, 8, 9]
    assert ids(run(target, lookback_days=None, same_day=True)) == [1, 2, 3, 4, 6, 7, 9]
    reloaded = run(target, reload_days=45, reconcile_by=["v"])
    assert ids(reloaded) == [1, 2, 3, 4, 5, 6, 9]
    window = F.col("created") >= F.lit(AS_OF - dt.timedelta(days=45))
    assert rows(reloaded.filter(window)) == rows(source.filter(window))
    assert rows(run(reloaded, reload_days=45, reconcile_by=["v"])) == rows(reloaded)
    assert ids(run(target, reload_days=45, force=True)) == [1, 2, 3, 4, 5, 6, 9]
    assert ids(run(target, lookback_days=None, floor=AS_OF)) == [1, 2, 3, 4, 6, 7, 8, 9]


def test_mirror_rules(frame):
    assert len(mirror.MIRRORS) == 19
    s = frame("branchid string, module string, batnbr int, created timestamp_ntz, updated timestamp_ntz",
              ("b", "AR", 1, at(0), at(0)), ("b", "GL", 2, at(0), at(0)))
    out = mirror.sync_mirror("batch", s, s.limit(0), "created", "updated", AS_OF)
    assert [r.batnbr for r in out.collect()] == [1]
    with pytest.raises(KeyError):
        mirror.sync_mirror("unknown", s, s, "created", "updated", AS_OF)


def test_lookback():
    assert mirror.lookback_start(dt.datetime(2024, 3, 10, 9)) == dt.date(2024, 3, 10)
    assert mirror.lookback_start(dt.datetime(2024, 3, 10, 23)) == dt.date(2024, 1, 25)


def test_upsert_is_idempotent(frame, rows):
    target = frame("k int, v double", (1, 1.0), (2, 2.0))
    changes = frame("k int, v double, seq int", (2, 5.0, 1), (2, float("nan"), 2), (3, 3.0, 1))
    once = upserts.upsert(target, changes, ["k"], ["seq"])
    assert rows(once) == [(1, 1.0), (2, None), (3, 3.0)]
    assert rows(upserts.upsert(once, changes, ["k"], ["seq"])) == rows(once)


def test_merge_keeps_columns_outside_the_list(frame, rows):
    target = frame("k int, v string, first string", (1, "a", "t0"), (2, "b", "t0"))
    source = frame("k int, v string, first string", (2, None, "t1"), (3, "c", "t1"))
    once = upserts.merge(target, source, ["k"], ["v"])
    assert rows(once) == [(1, "a", "t0"), (2, None, "t0"), (3, "c", "t1")]
    assert rows(upserts.merge(once, source, ["k"], ["v"])) == rows(once)


def test_update_from(frame, rows):
    t, s = frame("k int, v string", (1, "a"), (2, "b")), frame("k int, v string", (1, None), (2, "z"))
    assert rows(upserts.update_from(t, s, ["k"], ["v"])) == [(1, "a"), (2, "z")]


def test_window_and_month_replace(frame, rows):
    t = frame("d date, v int", (dt.date(2024, 1, 31), 1), (dt.date(2024, 2, 1), 2), (dt.date(2024, 2, 29), 3), (dt.date(2024, 3, 1), 4), (None, 5))
    s = frame("d date, v int", (dt.date(2024, 2, 10), 20))
    once = upserts.window_replace(t, s, "d", "2024-02-01", "2024-02-29")
    assert sorted(r.v for r in once.collect()) == [1, 4, 5, 20]
    assert rows(upserts.window_replace(once, s, "d", "2024-02-01", "2024-02-29")) == rows(once)
    assert sorted(r.v for r in upserts.window_replace(t, s, "d", "2024-02-01").collect()) == [1, 5, 20]
    assert sorted(r.v for r in upserts.month_replace(t, s, "d").collect()) == [1, 4, 5, 20]
    # Month and year run together are ambiguous; the replace is not.
    t2 = frame("d date, v int", (dt.date(2023, 1, 1), 1), (dt.date(2023, 11, 1), 11))
    s2 = frame("d date, v int", (dt.date(2023, 11, 5), 99))
    assert sorted(r.v for r in upserts.month_replace(t2, s2, "d").collect()) == [1, 99]


def test_key_date_replace_conditions_are_independent(frame):
    t = frame("k int, d date, v int", (1, dt.date(2024, 1, 1), 1), (1, dt.date(2024, 1, 2), 2), (1, dt.date(2024, 1, 3), 3), (2, dt.date(2024, 1, 1), 4))
    s = frame("k int, d date, v int", (1, dt.date(2024, 1, 1), 10), (3, dt.date(2024, 1, 2), 30))
    # Key 1 on the 2nd goes too: both its day and its key are touched.
    assert sorted(r.v for r in upserts.key_date_replace(t, s, ["k"], "d").collect()) == [3, 4, 10, 30]


def test_high_water_mark(frame):
    e = frame("id int, t int", (1, 1), (2, 2), (3, 3))
    assert upserts.copy_new(e.filter("t <= 2"), e, "t").count() == 3
    assert upserts.copy_new(e.limit(0), e, "t").count() == 3


def test_refresh_open(frame, rows):
    t = frame("k int, st string, d date", (1, "open", dt.date(2024, 1, 1)), (2, "done", dt.date(2024, 1, 2)))
    s = frame("k int, st string, d date", (1, "done", dt.date(2024, 1, 1)), (2, "x", dt.date(2024, 1, 2)), (3, "open", AS_OF))
    out = upserts.refresh_open(t, s, ["k"], "d", F.col("st") == "open", AS_OF, ["st"])
    assert [(r.k, r.st) for r in out.orderBy("k").collect()] == [(1, "done"), (2, "done"), (3, "open")]


def test_latest_version(frame, rows):
    h = frame("k int, v string, t int", (1, "a", 1), (1, "b", 2))
    assert rows(upserts.latest_version(h, ["k"], ["t"])) == [(1, "b", 2)]


# ---- sources and sinks -----------------------------------------------------------------

def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "select 1", user="u")
    assert plain == {"url": "jdbc:x", "fetchsize": "10000", "query": "select 1", "user": "u"}
    split = readers.jdbc_options("jdbc:x", "select 1", partition=("id", 0, 100, 4))
    assert split["dbtable"] == "(select 1) src" and split["numPartitions"] == "4" and "query" not in split


def test_load_options(spark, frame):
    folder = run_folder(spark, "t") + "/x"
    df = frame("`Mã KH` int, `Tên.1` string", (1, "a"))
    writers.load(df, folder, 1)
    with pytest.raises(Exception, match="(?i)already exists"):
        writers.load(df, folder, 1)
    writers.load(df, folder, 2)
    assert spark.read.parquet(folder).columns == ["makh", "ten1"] and spark.read.parquet(folder).count() == 2
    writers.load(df, folder, 3)
    assert spark.read.parquet(folder).count() == 1
    with pytest.raises(ValueError):
        writers.load(df, folder, 4)
    with pytest.raises(QualityError):
        writers.replace_all(df.limit(0), folder)
    assert spark.read.parquet(folder).count() == 1
    with pytest.raises(QualityError):
        writers.gated_load(df.union(df), folder, 2, ["Mã KH"])


def test_csv_keeps_zeros_and_days_first(spark, tmp_path):
    (tmp_path / "a.csv").write_text("code,on,n\n001,31/12/2023,5\n002,,\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("code,on,n\n003,01/02/2024,7\n", encoding="utf-8")
    schema = "code string, on date, n int"
    a = readers.read_csv(spark, str(tmp_path / "a.csv"), schema)
    assert [tuple(r) for r in a.orderBy("code").collect()] == [("001", dt.date(2023, 12, 31), 5), ("002", None, None)]
    links = readers.literal_rows(spark, [(str(tmp_path / "a.csv"),), (str(tmp_path / "b.csv"),)], "path string")
    both = readers.read_linked_csvs(spark, links, "path", schema)
    assert sorted(r.code for r in both.collect()) == ["001", "002", "003"]
    (tmp_path / "c.csv").write_text("code,extra\n004,x\n", encoding="utf-8")
    links = readers.literal_rows(spark, [(str(tmp_path / "a.csv"),), (str(tmp_path / "c.csv"),)], "path string")
    mixed = readers.read_linked_csvs(spark, links, "path", {str(tmp_path / "a.csv"): schema, str(tmp_path / "c.csv"): "code string, extra string"})
    assert {r.code: r.extra for r in mixed.collect()} == {"001": None, "002": None, "004": "x"}
    with pytest.raises(ValueError):
        readers.read_linked_csvs(spark, links.limit(0), "path", schema)


def test_promote_header(frame, rows):
    raw = frame("a string, b string", ("code", "name"), ("1", "x"), (None, "y"))
    out = readers.promote_header(raw, F.col("a") == "code")
    assert out.columns == ["code", "name"] and rows(out) == [("1", "x"), (None, "y")]
    with pytest.raises(ValueError):
        readers.promote_header(raw, F.col("a") == "zzz")
    # Every file brings its header, and equal data rows stay.
    files = frame("a string, b string", ("code", "name"), ("1", "x"), ("1", "x"), ("code", "name"))
    assert rows(readers.promote_header(files, F.col("a") == "code")) == [("1", "x"), ("1", "x")]
    with pytest.raises(ValueError):
        readers.promote_header(files.union(frame("a string, b string", ("code", "other"))), F.col("a") == "code")


def test_payload(spark, tmp_path):
    (tmp_path / "p1.json").write_text('{"data": [{"id": 1}, {"id": 2}], "total": 3}')
    (tmp_path / "p2.json").write_text('{\n"data": [\n{"id": 3}], "total": 3}')
    out = readers.read_payload(spark, str(tmp_path), "data array<struct<id: int>>, total int", "data", whole_files=True)
    assert sorted(r.id for r in out.collect()) == [1, 2, 3]


def test_literal_rows_have_a_known_size(spark):
    df = readers.literal_rows(spark, [("a", None), ("b", 2)], "k string, v int")
    assert "LocalTableScan" in df._jdf.queryExecution().toString()
    assert sorted(df.collect()) == [("a", None), ("b", 2)]
    assert readers.literal_rows(spark, [], "k string").count() == 0


def test_scratch(spark, frame):
    folder = run_folder(spark, "x")
    assert folder != run_folder(spark, "x") and "/x-" in folder
    assert shared_folder(spark) in folder
    assert written(frame("a int", (1,), (2,)), "w").count() == 2


def test_sql_source(spark, frame, rows):
    assert rows(readers.read_sql(spark, "select a + 1 as b from {t}", t=frame("a int", (1,)))) == [(2,)]


# ---- stream ----------------------------------------------------------------------------

def test_stream_equals_batch(spark, frame, rows):
    folder = run_folder(spark, "stream")
    schema = "k int, v string, updated timestamp_ntz, id int"
    base = frame(schema, (1, "base", at(-3), 1), (9, "only base", at(-3), 2))
    files = [[(1, "second", at(-1), 4), (2, "a", at(-2), 3)],
             [(1, "late", at(-2), 5), (2, "b", at(-1), 6), (2, "c", at(0), 7)],   # late row, two of a key in one file
             [(1, "second", at(-1), 4), (3, "n", at(0), 8)]]                       # delivered again
    for i, data in enumerate(files):
        frame(schema, *data, parts=1).write.parquet(f"{folder}/in/f={i}")
    keys, order = ["k"], ["updated", "id"]
    stream = change_log.read_changes(spark, f"{folder}/in", f"{schema}, f int", files_per_batch=1).drop("f")
    change_log.write_change_log(stream, f"{folder}/log", f"{folder}/cp", keys, order).awaitTermination()
    log = spark.read.parquet(f"{folder}/log")
    assert log.select("batch_id").distinct().count() == 3
    state = change_log.current_state(base, log, keys, order)
    changes = spark.read.schema(base.schema).parquet(f"{folder}/in").select("k", "v", "updated", "id")
    batch = upserts.upsert(base, changes, keys, order)
    assert rows(state.select("k", "v")) == rows(batch.select("k", "v")) == [(1, "second"), (2, "c"), (3, "n"), (9, "only base")]
    # Nothing new: a second start adds no batch, and compaction keeps the state.
    stream = change_log.read_changes(spark, f"{folder}/in", f"{schema}, f int", files_per_batch=1).drop("f")
    change_log.write_change_log(stream, f"{folder}/log", f"{folder}/cp", keys, order).awaitTermination()
    assert spark.read.parquet(f"{folder}/log").count() == log.count()
    change_log.compact(base, log, keys, order, f"{folder}/base")
    assert rows(spark.read.parquet(f"{folder}/base")) == rows(state)


def test_repeated_deliveries_are_dropped(spark, frame):
    folder = run_folder(spark, "repeats")
    schema = "k int, updated timestamp_ntz"
    for i, data in enumerate([[(1, at(0)), (1, at(0)), (2, at(0))], [(1, at(0)), (1, at(0, 1))]]):
        frame(schema, *data, parts=1).write.parquet(f"{folder}/in/f={i}")
    stream = change_log.read_changes(spark, f"{folder}/in", "k int, updated timestamp_ntz, f int", 1).drop("f")
    once = change_log.drop_repeats(stream, ["k"], "updated")
    (once.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
     .trigger(availableNow=True).start().awaitTermination())
    out = spark.read.parquet(f"{folder}/out")
    assert sorted(tuple(r) for r in out.collect()) == [(1, at(0)), (1, at(0, 1)), (2, at(0))]
