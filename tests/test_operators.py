"""Relational verbs on frames with nulls, ties and copies."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.oracle import plan
from tidemark.operators import aggregates as A
from tidemark.operators import filters, joins as J, names, quality, reshape, sets, windows as W


def d(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


# ---- names and filters -----------------------------------------------------------------

def test_names_must_stay_unique(frame):
    df = frame("a int, b int", (1, 2))
    with pytest.raises(ValueError):
        names.rename_all(df, ["x", "x"])
    with pytest.raises(ValueError):
        names.rename(df, {"a": "b"})
    with pytest.raises(ValueError):
        names.without(df, "zz")
    assert names.prefix_names(df, "p_", keep=["a"]).columns == ["a", "p_b"]


def test_null_passes_element_comparisons(frame, rows):
    df = frame("c string", ("V1",), ("A1",), (None,))
    assert rows(df.filter(filters.not_starting_with("c", "V"))) == [("A1",), (None,)]
    assert rows(df.filter(filters.differs_from("c", "A1"))) == [("V1",), (None,)]
    assert rows(df.filter(~filters.starts_with("c", "V"))) == [("A1",)]


def test_filters(frame, rows):
    df = frame("a int, b string", (1, "x"), (1, " "), (2, "x"), (None, None))
    assert rows(filters.where_equal(df, a=1, b="x")) == [(1, "x")]
    assert rows(filters.missing(df, "a")) == [(None, None)]
    assert filters.present(df, "a").count() == 3 and filters.complete(df, ["a", "b"]).count() == 3
    assert rows(df.filter(filters.blank("b"))) == [(1, " ")]
    assert df.filter(filters.changed("a", F.lit(1))).count() == 2


# ---- joins -----------------------------------------------------------------------------

def test_null_keys(frame, rows):
    left, right = frame("k string, l int", ("a", 1), (None, 2)), frame("k string, r int", ("a", 10), (None, 20))
    assert rows(J.equi(left, right, "k")) == [("a", 1, 10), (None, 2, None)]
    assert rows(J.equi(left, right, "k", null_safe=True)) == [("a", 1, 10), (None, 2, 20)]
    assert rows(J.anti(left, right, "k")) == [(None, 2)]
    assert rows(J.anti(left, right, "k", null_safe=True)) == []
    assert rows(J.semi(left, right, "k")) == [("a", 1)]


def test_lookup_last_key_wins(frame, rows):
    df = frame("c string", ("a",), ("b",), (None,))
    dim = frame("code string, label string, n int", ("a", "z", 1), ("a", "m", 2))
    assert rows(J.lookup(df, dim, "c", "code", "label", "?", order="n")) == [("a", "m"), ("b", "?"), (None, "?")]
    assert rows(J.lookup(df, dim, "c", "code", "label")) == [("a", "z"), ("b", None), (None, None)]


def test_checked_join(frame):
    df, dim = frame("k int", (1,)), frame("k int, v int", (1, 1), (1, 2))
    with pytest.raises(quality.QualityError):
        J.checked(df, dim, "k")
    assert J.checked(df, dim.limit(1), "k").count() == 1


def test_mark(frame, rows):
    assert rows(J.mark(frame("k int", (1,), (2,)), frame("k int", (1,), (1,)), "k")) == [(1, "both"), (2, "left_only")]


def test_groupwise_max_keeps_ties(frame, rows):
    df = frame("k string, t int, v int", ("a", 1, 1), ("a", 2, 2), ("a", 2, 3), (None, 5, 4), (None, 4, 5), ("n", None, 6))
    assert rows(J.groupwise_max(df, "k", "t")) == [("a", 2, 2), ("a", 2, 3), (None, 5, 4)]


def test_range_join_against_brute_force(frame, rows):
    rng = random.Random(3)
    points = [(i, "hot" if rng.random() < .6 else "cold", d(rng.randrange(120))) for i in range(300)]
    spans = [(j, rng.choice(["hot", "cold"]), d(s := rng.randrange(110)), d(s + rng.randrange(20)) if j % 3 else dt.date(9999, 12, 31))
             for j in range(20)]
    left, right = frame("i int, k string, p date", *points), frame("j int, k string, a date, z date", *spans)
    want = sorted((i, j) for i, k, p in points for j, kk, a, z in spans if k == kk and a <= p <= z)
    for width in (1, 7, 400):
        assert rows(J.range_join(left, right, "k", "p", "a", "z", bucket_days=width).select("i", "j")) == \
            sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    got = J.range_join(left, right, "k", "p", "a", "z", how="left", bucket_days=7).select("i", "j").collect()
    matched = {i for i, _ in want}
    assert sorted(tuple(r) for r in got if r.j is not None) == want
    assert sorted(r.i for r in got if r.j is None) == sorted(i for i, _, _ in points if i not in matched)


def test_long_intervals_are_not_copied(spark, frame):
    spans = frame("j int, a date, z date", *[(j, d(j), d(j + length)) for j, length in enumerate([0, 5, 29, 30, 400, 480, 9000, 200000])])
    rows = J.on_levels(spans, "a", "z", 30).groupBy("j").agg(F.count("*").alias("n"), F.max("__size").alias("size")).orderBy("j").collect()
    assert all(r.n <= 2 for r in rows)
    assert [r["size"] for r in rows] == [30, 30, 30, 480, 480, 7680, 122880, 1966080]


def test_a_hot_key_is_spread_over_buckets_and_levels(spark, frame):
    """A third of the points share a key and meet an open interval; the join's keys hold bucket and level."""
    points = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                      F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 3650).cast("int")).alias("p"), "id")
    spans = frame("k string, a date, z date", ("hot", dt.date(2000, 1, 1), dt.date(9999, 12, 31)), ("hot", dt.date(2001, 1, 1), dt.date(2001, 1, 3)))
    got = J.range_join(points, spans, "k", "p", "a", "z")
    assert got.count() == 1000 + 1
    text = plan(J.range_join(points.hint("merge"), spans, "k", "p", "a", "z"))
    keys = next(line for line in text.splitlines() if "hashpartitioning" in line and "__point_bucket" in line)
    assert "k#" in keys and "__point_size" in keys


def test_membership(frame, rows):
    left = frame("o int, item string", (1, "a"), (1, "b"), (2, "a"), (1, "z"))
    lists = frame("o int, l string, v int", (1, "a, b,a", 7), (2, "", 8))
    assert rows(J.membership(left, lists, "o", "item", "l")) == [(1, "a", 7), (1, "b", 7)]


def test_fill_from(frame, rows):
    df, other = frame("k int, v string", (1, None), (2, "x"), (3, None)), frame("k int, v string", (1, "n"), (2, "y"))
    assert rows(J.fill_from(df, other, "k", ["v"])) == [(1, "n"), (2, "x"), (3, None)]


# ---- aggregates ------------------------------------------------------------------------

def test_sum_of_nulls_is_zero_and_null_keys_stay(frame, rows):
    df = frame("k string, v double, t int", ("a", None, 1), ("a", None, 2), (None, 1.1, 3), (None, 2.2, 1))
    out = A.group_sum(df, ["k"], ["v"], ["t"])
    assert [(k, float(v), t) for k, v, t in rows(out)] == [("a", 0.0, 2), (None, 3.3, 3)]
    assert rows(A.aggregate(df, ["k"], {"v": "sum", "t": "nunique"})) == [("a", 0.0, 2), (None, pytest.approx(3.3), 2)]


def test_money_sums_do_not_depend_on_order(frame):
    values = [(0.1 * i,) for i in range(1, 200)]
    totals = {A.group_sum(frame("v double", *v, parts=p), [], ["v"]).first()[0]
              for p, v in ((1, values), (5, values[::-1]), (7, sorted(values, key=str)))}
    assert len(totals) == 1


def test_cond_pivot_and_counts(frame, rows):
    df = frame("k int, c string, q double", (1, "A", 2.0), (1, "B", 3.0), (1, None, 4.0), (2, "C", 5.0))
    out = A.cond_pivot(df, ["k"], "c", {"A": "a", ("B", "C"): "bc"}, "q")
    assert [(k, float(a), float(b)) for k, a, b in rows(out)] == [(1, 2.0, 3.0), (2, 0.0, 5.0)]
    assert rows(A.value_counts(df, ["c"])) == [("A", 1), ("B", 1), ("C", 1), (None, 1)]
    assert rows(quality.null_profile(df)) == [("c", 1), ("k", 0), ("q", 0)]


def test_first_values(frame, rows):
    df = frame("k int, v string", (1, "c"), (1, "a"), (1, "a"), (1, "b"), (1, "d"), (2, "z"), (3, None))
    assert rows(A.first_values(df, ["k"], "v", 3)) == [(1, "a", "b", "c", 4), (2, "z", None, None, 1)]


def test_all_members_counts_copies_once(frame, rows):
    df = frame("o int, i string", (1, "x"), (1, "x"), (1, "y"), (2, "x"), (2, "n"), (3, None))
    assert rows(A.all_members(df, ["o"], "i", ["x", "y"])) == [(1, True), (2, False), (3, False)]


# ---- windows ---------------------------------------------------------------------------

def test_latest_ignores_input_order(frame, rows):
    data = [("a", 1, 1), ("a", 3, 2), ("a", 3, 9), ("b", None, 4), (None, 2, 5)]
    for seed, parts in itertools.product(range(3), (1, 4)):
        random.Random(seed).shuffle(data)
        df = frame("k string, t int, id int", *data, parts=parts)
        assert rows(W.latest(df, ["k"], ["t", "id"])) == [("a", 3, 9), ("b", None, 4), (None, 2, 5)]
    assert rows(W.latest_two(df, ["k"], ["t", "id"], "id")) == [("a", 9, 2), ("b", 4, None), (None, 5, None)]


def test_ordered_equals_plain_windows_on_a_hot_key(spark, frame):
    rng = random.Random(5)
    data = [(("hot" if rng.random() < .7 else rng.choice(["a", "b", None])), rng.randrange(400), i, rng.randrange(100))
            for i in range(500)]
    df = frame("k string, t int, id int, v int", *data, parts=6)
    got = {r.id: r for r in W.ordered(df, ["k"], ["t", "id"], F.floor(F.col("t") / 50), sums={"n": F.lit(1), "s": "v"},
                                      previous={"pt": "t", "pv": "v"}, following={"nt": "t"}).collect()}
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    assert len(got) == len(data)
    for group in groups.values():
        total = 0
        group.sort(key=lambda r: (r[1], r[2]))
        for n, (k, t, i, v) in enumerate(group):
            total += v
            r = got[i]
            before, after = group[n - 1] if n else None, group[n + 1] if n + 1 < len(group) else None
            assert (r.k, r.n, r.s) == (k, n + 1, total)
            assert (r.pt, r.pv) == ((before[1], before[3]) if before else (None, None))
            assert r.nt == (after[1] if after else None)


def test_islands(frame, rows):
    df = frame("k int, d date", *[(1, d(n)) for n in (0, 1, 2, 3, 7, 8, 40)], (2, d(0)))
    out = rows(W.islands(df, ["k"], "d", 1, position="n"))
    assert [(k, i, n) for k, _, i, n in out] == [(1, 0, 1), (1, 0, 2), (1, 0, 3), (1, 0, 4), (1, 1, 1), (1, 1, 2), (1, 2, 1), (2, 0, 1)]


# ---- sets ------------------------------------------------------------------------------

def test_union_and_differences(frame, rows):
    a, b = frame("x int, y string", (1, "a"), (2, "b"), (2, "b")), frame("y string, x int, z int", ("a", 1, None), ("c", 3, 9))
    assert rows(sets.union_by_name([a, b], distinct=True)) == [(1, "a", None), (2, "b", None), (3, "c", 9)]
    # Copies inside one input vanish too.
    assert rows(sets.symmetric_difference(a, b.drop("z"))) == [(3, "c")]
    assert rows(sets.key_difference(a, b, ["x"])) == [(2,)]


def test_dedup(frame, rows):
    df = frame("k string, t int, id int", ("a", 1, 1), ("a", 2, 2), (None, 1, 3), (None, 2, 4), ("c", 1, 5))
    assert [r[2] for r in rows(sets.dedup(df, ["k"], ["t", "id"], "first"))] == [1, 5, 3]
    assert [r[2] for r in rows(sets.dedup(df, ["k"], ["t", "id"], "last"))] == [2, 5, 4]
    assert rows(sets.dedup(df, ["k"], keep="none")) == [("c", 1, 5)]
    assert {r.id: r.duplicated for r in sets.mark_duplicates(df, ["k"], ["t", "id"]).collect()} == \
        {1: False, 2: True, 3: False, 4: True, 5: False}
    assert {r.id for r in sets.mark_duplicates(df, ["k"], ["t", "id"], "last").filter("duplicated").collect()} == {1, 3}
    assert {r.id for r in sets.mark_duplicates(df, ["k"], keep="none").filter("duplicated").collect()} == {1, 2, 3, 4}
    for f in (sets.dedup, sets.mark_duplicates):
        with pytest.raises(ValueError):
            f(df, ["k"], ["t"], "some")


def test_reshape(frame, rows):
    df = frame("id int, a int, b int", (1, 5, None))
    assert rows(reshape.melt(df, ["id"])) == [(1, "a", "5"), (1, "b", None)]
    assert rows(reshape.melt(df, ["id"], drop_nulls=True, value_type="int")) == [(1, "a", 5)]
    lists = frame("id int, l string", (1, "x"), (2, "a,b, c,d"), (3, ""), (4, None))
    assert rows(reshape.list_to_rows(lists, "l", "p")) == [(1, "x"), (2, "a"), (2, "b"), (2, "c"), (2, "d")]
    assert rows(reshape.map_labels(frame("w string", ("w1",), ("w9",)), frame("w string, d int", ("w1", 1)), "w")) == [("w1", 1), ("w9", None)]


def test_quality(frame, rows):
    df = frame("k int, s string", (1, "C"), (1, "C"), (2, "H"))
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert quality.split_duplicates(df, ["k"]).count() == 2
    with pytest.raises(quality.QualityError):
        quality.assert_unique(df, ["k"])
    with pytest.raises(quality.QualityError):
        quality.assert_not_empty(df.filter("k = 9"))
    assert quality.is_complete(df, 3) and not quality.is_complete(df, 4)
    assert rows(quality.reconcile(df, df.filter("k = 2"), ["s"])) == [("C", 2, 0)]
    assert rows(quality.reconcile(df, df, ["s"])) == []
    assert quality.table_definition(df) == "k BIGINT NULL,\ns VARCHAR(100) NULL,"
