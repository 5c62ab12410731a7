"""Reports on small frames: the cases the given tables cannot show."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import QualityError
from tidemark.plans import activity, history, masters, receivables as rec, sales, stock


def d(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


# ---- receivables -----------------------------------------------------------------------

def brute_due(days, terms=30, chunk=2, gap=1):
    """Rolling due dates of one customer's order days, written as plain loops."""
    days = sorted(set(days))
    chains = []
    for x in days:
        if chains and (x - chains[-1][-1]).days <= gap:
            chains[-1].append(x)
        else:
            chains.append([x])
    groups = [c[i:i + chunk] for c in chains for i in range(0, len(c), chunk)]
    due = {}
    for i, g in enumerate(groups):
        for x in g:
            own = x + dt.timedelta(days=terms)
            due[x] = min(own, groups[i + 1][0]) if i + 1 < len(groups) else own
    return due


def test_rolling_due_date_worked_example(frame):
    orders = frame("o int, c int, d date", *[(i, 1, d(n)) for i, n in enumerate((0, 0, 1, 2, 3, 7, 8, 40))], (99, 2, d(5)))
    got = {r.o: r.due_date for r in rec.rolling_due_date(orders, ["c"], "d").collect()}
    assert got == {0: d(2), 1: d(2), 2: d(2), 3: d(7), 4: d(7), 5: d(37), 6: d(38), 7: d(70), 99: d(35)}


def test_rolling_due_date_against_brute_force(frame):
    rng = random.Random(11)
    orders = [(i, "hot" if i % 3 else f"c{i % 7}", d(rng.randrange(200))) for i in range(300)]
    got = {r.o: r.due_date for r in rec.rolling_due_date(frame("o int, c string, d date", *orders, parts=5), ["c"], "d").collect()}
    for c in {o[1] for o in orders}:
        due = brute_due([x for _, k, x in orders if k == c])
        assert all(got[i] == due[x] for i, k, x in orders if k == c)


def test_due_dates_only_for_open_orders_of_the_class(frame):
    o = frame("o int, c int, d date, bal double, terms string, due date",
              (1, 1, d(0), 5.0, "R", d(99)), (2, 1, d(2), 0.0, "R", d(99)), (3, 1, d(4), 5.0, "X", d(99)), (4, 1, d(10), 5.0, "R", d(99)))
    out = {r.o: r.due for r in rec.due_dates(o, ["c"], "d", "bal", "terms", "R", "due").collect()}
    assert out == {1: d(10), 2: d(99), 3: d(99), 4: d(40)}


def test_reversals_without_pairs(frame):
    originals = frame("o int, inv string, d date", (1, "a", d(0)), (2, "a", d(1)), (3, "b", d(0)), (4, None, d(0)), (5, "z", d(0)))
    credits = frame("o int, inv string, d date", (11, "a", d(0)), (12, "b", d(5)), (13, None, d(0)), (14, "b", d(5)))
    flags = {r.o: (r.same_day, r.other_day) for r in rec.reversal_flags(originals, credits, ["inv"], "d").collect()}
    assert flags == {1: (True, False), 2: (False, True), 3: (False, True), 4: (False, False), 5: (False, False)}
    cancelled, returned = rec.cancelled_and_returned(credits, originals, ["inv"], "d")
    assert [r.o for r in cancelled.collect()] == [1] and sorted(r.o for r in returned.collect()) == [2, 3]


def test_ledger_from_separate_legs(frame):
    orders = frame("o int, inv int, amt double, d date", *[(i, 100 + i, 10.0 * i, d(i)) for i in range(1, 5)])
    flags = frame("o int, same_day boolean, other_day boolean", (1, True, False), (2, False, True), (3, False, False))
    cols = ["o", "inv"]
    legs = {a: rec.ledger_leg(orders, a, "amt", "d", cols) for a in rec.AMOUNTS}
    stored = {"opening_amt": rec.ledger_leg(orders.filter("o = 4").withColumn("o", F.lit(40)), "opening_amt", "amt", "d", cols)}
    out = rec.receivables_ledger(legs, flags, ["o"], stored=stored)
    kept = {}
    for r in out.collect():
        kept.setdefault(r.o, set()).add(r.leg)
    assert 1 not in kept and kept[3] == kept[4] == set(rec.AMOUNTS) and kept[40] == {"opening_amt"}
    assert kept[2] == {"opening_amt", "released_amt", "returned_amt"}
    # Confirmations follow the invoice order: order 2's key matches nothing there, invoice 2 would.
    moved = {a: leg.withColumn("inv", F.when(F.col("o") == 3, 2).otherwise(F.col("inv"))) for a, leg in legs.items()}
    by_invoice = rec.receivables_ledger(moved, flags, ["o"], ["inv"])
    legs_of = lambda o: {r.leg for r in by_invoice.filter(F.col("o") == o).collect()}
    assert legs_of(3) == {"opening_amt", "released_amt", "delivered_amt", "received_amt", "returned_amt"}
    assert legs_of(2) == {"opening_amt", "released_amt", "returned_amt", "confirmed_amt", "confirmed_released_amt"}
    with pytest.raises(ValueError):
        rec.ledger_leg(orders, "other", "amt", "d", cols)


def test_exclusion_flag_empty_or_filled(frame):
    df = frame("k string, v int", ("a", 1), ("b", 2))
    empty, filled = frame("k string, f double", ("a", None), ("b", None)), frame("k string, f double", ("a", 1.0), ("b", None))
    assert rec.drop_flagged(df, empty, ["k"], "f").count() == 2
    assert [r.k for r in rec.drop_flagged(df, filled, ["k"], "f").collect()] == ["b"]


def test_exclusive_orders(frame):
    lines = frame("o int, i string", (1, "x"), (1, "x"), (2, "x"), (2, "n"), (3, "n"))
    assert [r.o for r in rec.exclusive_orders(lines, ["o"], "i", ["x", "y"]).collect()] == [1]


def test_last_delivery_one_row(frame):
    steps = frame("o int, seq int, st string, at timestamp_ntz", (1, 1, "H", dt.datetime(2024, 1, 1)),
                  (1, 2, "C", dt.datetime(2024, 1, 2)), (1, 2, "D", dt.datetime(2024, 1, 3)), (2, 1, "q", None))
    got = {r.o: (r.delivery_status, r.delivery_time) for r in rec.last_delivery(steps, ["o"], "seq", "st", "at").collect()}
    assert got == {1: ("KH Không Nhận", dt.datetime(2024, 1, 3)), 2: ("Chưa Xác Nhận", None)}


def test_zero_account(frame):
    leg, adj = frame("o int, amt double", (1, 5.0), (2, 6.0)), frame("o int, acc string", (1, "711"), (2, "112"))
    assert {r.o: r.amt for r in rec.zero_account(leg, adj, ["o"], "acc", "amt").collect()} == {1: 0.0, 2: 6.0}


# ---- sales and stock -------------------------------------------------------------------

def test_replacement_rows_and_blank_names(frame):
    schema = "branch_id string, order_nbr int, name string, long_name string"
    regular, repl = frame(schema, ("b", 1, " ", "L"), ("b", 2, "n", "L")), frame(schema, ("b", 2, "n", "L"), ("b", 3, None, "L"))
    out = sales.raw_to_fact(regular, repl, frame("branch_id string, order_nbr int", ("x", 1), ("b", 2)), [("name", "long_name")])
    assert {r.order_nbr: r.name for r in out.collect()} == {1: "L", 3: None}


def test_sales_lines_sign_and_free_items(spark, frame):
    head = frame("branch_id string, order_nbr int, order_type string", ("b", 1, "A"), ("b", 2, "B"), ("b", 3, "C"))
    lines = frame("branch_id string, order_nbr int, line_ref string, line_qty double, free_item boolean, before_vat_price double, "
                  "before_vat_amount double, vat_amount double, after_vat_amount double",
                  *[("b", o, "1", 4.0, f, 2.0, 8.0, 0.8, 8.8) for o, f in ((1, False), (2, None), (3, True))])
    lots = frame("branch_id string, order_nbr int, line_ref string, lot string, qty double", ("b", 1, "1", "L1", 1.0), ("b", 1, "1", "L2", 3.0))
    types = frame("order_type string, doc_type string", ("A", "IN"), ("B", "CM"), ("C", "NA"))
    got = sorted((r.order_nbr, r.lot, r.quantity, float(r.revenue), float(r.after_vat_amount))
                 for r in sales.sales_lines(head, lines, lots, types).collect())
    assert got == [(1, "L1", 1.0, 2.0, 8.8), (1, "L2", 3.0, 6.0, 8.8), (2, "", -4.0, -8.0, -8.8), (3, "", 0.0, 0.0, 0.0)]


def test_enrich_and_refresh(frame):
    s = frame("id int, item string, on_text string, doc date, pay string", (1, "a", "05/02/2024", d(40), "B"), (2, "z", "?", d(0), "T"))
    dim = frame("k string, v string", ("a", "X"))
    out = sales.enrich_sales(s, [sales.Lookup(dim, "item", "k", "v", "grp", "other")], "doc", ["on_text"], ["on_text"], "pay", "2024-03-01")
    got = {r.id: (r.on_text, r.grp, r.month, r.pay) for r in out.collect()}
    assert got == {1: (dt.date(2024, 2, 5), "X", dt.date(2024, 2, 1), "TM"), 2: (dt.date(1900, 1, 1), "other", dt.date(2024, 1, 1), "CK")}
    assert sorted(r.id for r in sales.refresh_sales(out, out.filter("id = 1"), "doc", d(10), ["id"]).collect()) == [1, 2]
    with pytest.raises(QualityError):
        sales.refresh_sales(out, out.union(out), "doc", d(10), ["id"])


def test_accumulation_discount_counts_once(frame):
    data = [(1, "1", 2.0, 5.0, 4.0, "D"), (1, "2", 3.0, 5.0, 4.0, "M"), (2, "1", 1.0, 1.0, 1.0, "M")]
    lines = frame("kind string, o int, line_ref string, qty double, price double, unit_rate double, unit_op string",
                  *[("sale", *r) for r in data], *[("return", *r) for r in data if r[0] == 1])
    disc = frame("o int, disc_id int, disc_amount double, line_list string", (1, 7, 10.4, "1,2"), (1, 8, 2.5, "9"))
    done = lines.filter("o = 2").select("o")
    out = sales.accumulation_detail(lines, done, disc, ["o"])
    assert sorted((r.o, r.kind, float(r.value), float(r.discount)) for r in out.collect()) == [(1, "return", -25.0, -10.0), (1, "sale", 25.0, 10.0)]
    units = sales.accumulation_detail(lines, done, disc, ["o"], "Q")
    assert {(r.o, r.kind): float(r.value) for r in units.collect()} == {(1, "sale"): 12.5, (1, "return"): -12.5}


def test_stock_rules(frame):
    on_hand = frame("warehouse string, product string, name string, unit string, lot string, expiry date, quantity double, held double, pending double",
                    ("w1", "P1", "n", "Hộp", "l", d(1), 5.0, 1.0, None), ("w1", "V9", "n", "Hộp", "l", d(1), 5.0, 0.0, 0.0),
                    ("w9", "P1", "n", "Hộp", "l", d(1), 7.0, 0.0, 0.0), ("w1", None, "n", "Cái", "l", d(1), 2.0, 0.0, 0.0))
    receipts = frame("warehouse string, product string, name string, unit string, lot string, expiry date, quantity double, state string, kind string",
                     ("w1", "P1", "n", "HOP", "l", d(1), 3.0, "pending", "purchase"), ("w1", "P1", "n", "HOP", "l", d(1), 9.0, "done", "purchase"))
    transfers = frame("warehouse string, product string, name string, unit string, lot string, quantity double", ("w2", "P1", "n", "HOP", "l", 4.0))
    wh = frame("warehouse string, branch string, wh_class string, receive_days double", ("w1", "b1", "CN", 2.0), ("w2", None, "HCM", 3.0), ("w9", "b1", None, 1.0))
    feeds = stock.stock_feeds(on_hand, receipts, transfers)
    assert feeds.count() == 5
    pos = stock.checked_position(stock.stock_position(feeds, wh, destroyed={"destroyed": ["w2"]}))
    got = {(r["product"], r.branch): (float(r.branch_stock), float(r.in_transit), float(r.city), float(r.virtual), float(r.destroyed), r.unit) for r in pos.collect()}
    assert got == {("P1", "b1"): (5.0, 3.0, 0.0, 1.0, 0.0, "HOP"), ("P1", "NA"): (0.0, 4.0, 0.0, 0.0, 4.0, "HOP"),
                   (None, "b1"): (2.0, 0.0, 0.0, 0.0, 0.0, "CAI")}
    with pytest.raises(QualityError):
        stock.checked_position(pos.union(pos))
    sheet = frame("product string, branch string, quantity int", ("P1", "b1", 10), ("P1", "b1", 1), ("P9", None, 5), (None, "b1", 7))
    more = stock.stock_position(feeds, wh, destroyed={"one": ["w2"], "two": ["w1"]}, sheet=sheet)
    seen = {(r["product"], r.branch): (r.name, float(r.in_transit), float(r.one), float(r.two)) for r in more.collect()}
    assert seen[("P1", "b1")][1] == 14.0 and seen[("P9", "NA")][:2] == (None, 5.0) and len(seen) == 4


def test_restated_day():
    # Friday, Saturday, Sunday, Monday, Tuesday
    got = [stock.restated_day(f"2024-03-{x:02}").day for x in (8, 9, 10, 11, 12)]
    assert got == [7, 8, 9, 9, 11]


def test_notes_of_two_months(frame):
    weekly = frame("user int, month string, w1 string, w2 string", (1, "2024-01", "a", None), (1, "2024-02", "b", "c"))
    calendar = frame("month string, week string, note_date date", ("2024-01", "w1", dt.date(2024, 1, 1)),
                     ("2024-02", "w1", dt.date(2024, 2, 1)), ("2024-02", "w2", dt.date(2024, 2, 8)))
    out = masters.consolidated_notes(weekly, ["user", "month"], ["w1", "w2"], calendar, [], ["user", "note_date"], ["note"],
                                     ["note"], period=["month"])
    assert {(r.note_date, r.note) for r in out.collect()} == {(dt.date(2024, 1, 1), "a"), (dt.date(2024, 2, 1), "b"), (dt.date(2024, 2, 8), "c")}


def test_access_sheet_without_a_group(frame):
    staff = frame("p int, s string, r string", (1, "A", "X"), (2, "A", "Y"))
    wide = frame("report string, `A-X` string", ("r1", "x"))
    with pytest.raises(ValueError, match="A-Y"):
        masters.access_matrix(wide, ["report"], staff, ["s", "r"], "p", "report")


def test_shortfall_without_request(frame):
    ordered = frame("r string, p int, ordered double, received double", ("", 1, 10.0, 2.0), (None, 2, 5.0, 5.0), ("R", 3, 1.0, 0.0))
    awaiting = frame("r string, p int, quantity double", (None, 1, 3.0), ("R", 3, 1.0))
    out = stock.purchase_shortfall(ordered, awaiting, ["r", "p"], "r").collect()
    assert [(x.r, x.p, x.shortfall) for x in out] == [("KHONGCOYCRH", 1, Decimal("5.00"))]


# ---- history ---------------------------------------------------------------------------

def test_versions_continue(frame):
    stored = frame("c int, version_id bigint", (1, 1), (1, 2))
    new = frame("c int, t int", (1, 5), (1, 9), (2, 1))
    out = history.versions(new, stored, ["c"], ["t"], F.floor(F.col("t") / 6))
    assert sorted((r.c, r.t, r.version_id) for r in out.collect()) == [(1, 5, 3), (1, 9, 4), (2, 1, 1)]


def test_attribute_changes_and_nulls(frame):
    h = frame("c int, version_id bigint, a string, b string", (1, 1, None, "x"), (1, 2, "v", "x"), (1, 3, None, "y"), (1, 4, " ", "y"), (2, 1, "q", "q"))
    def log(**kw):
        return sorted((r.version_id, r.attribute, r.old_value, r.new_value) for r in history.attribute_changes(h, ["c"], "version_id", ["a", "b"], **kw)
                      .fillna("<null>").collect())
    assert log() == [(2, "a", "<null>", "v"), (3, "a", "v", "<null>"), (3, "b", "x", "y"), (4, "a", "<null>", "Unknow")]
    assert log(keep_nulls=False) == [(3, "b", "x", "y")]
    assert log(bucket=F.col("version_id")) == log()
    assert history.attribute_rows(h, ["c"], "version_id", ["a", "b"]).count() == 8


def test_soft_delete_happens_once(frame, rows):
    stored = frame("p string, st string, g int", ("a", "on", 1), ("b", "on", 1), ("c", "left", 1), ("e", "on", 1))
    current = frame("p string, st string, g int", ("a", "on", 1), ("d", "on", 2), ("e", "on", 5), (None, "on", 9))
    added = history.snapshot_diff(stored, current, "p", "st", "left")
    assert rows(added) == [("b", "left", 1), ("d", "on", 2), ("e", "on", 5)]
    now = stored.join(added, "p", "left_anti").unionByName(added)
    assert rows(history.snapshot_diff(now, current, "p", "st", "left")) == []
    back = frame("p string, st string, g int", ("c", "on", 1))
    assert ("c", "on", 1) in rows(history.snapshot_diff(now, back, "p", "st", "left"))
    assert rows(history.list_changes(stored, stored)) == []


# ---- activity and masters --------------------------------------------------------------

def test_reporting_month():
    assert activity.reporting_month("2024-03-01") == dt.date(2024, 2, 1)
    assert activity.reporting_month("2024-03-02") == dt.date(2024, 3, 1)


def test_visit_compliance_licence_edges(frame):
    planned = frame("staff int, customer int, visit_date date", (1, 1, d(3)), (1, 1, d(4)), (1, 2, d(3)), (1, 3, d(3)), (1, 4, d(3)), (2, 9, d(-20)))
    visits = frame("staff int, customer int, visit_date date, checkin_id int, order_id int", (1, 1, d(3), 5, 7), (1, 1, d(4), 6, None), (1, 2, d(4), None, None))
    lic = frame("customer int, licence_end date", (1, d(19)), (2, d(20)), (3, d(21)), (4, d(50)))
    r = [x.asDict() for x in activity.visit_compliance(planned, visits, lic, d(20)).collect()]
    assert r == [{"staff": 1, "month": d(0), "planned": 4, "unvisited": 1, "expired": 1, "expiring": 2, "orders": 1, "checkins": 2, "order_ratio": 50.0}]
    both = activity.visit_compliance(planned, visits, lic, d(20), all_months=True)
    assert both.filter("staff = 2").first().asDict()["order_ratio"] == 0


def test_lead_times_drop_wrong_order(frame):
    t = dt.datetime(2024, 1, 1, 10)
    df = frame("a timestamp_ntz, b timestamp_ntz", (t, t + dt.timedelta(seconds=61)), (t, t - dt.timedelta(minutes=1)), (t, None))
    out = activity.lead_times(df, {"m": ("a", "b")}, ("a", "b"))
    assert [r.m for r in out.collect()] == [1]


def test_hierarchy_fallbacks(frame):
    staff = frame("staff int, sup_id string, asm_id string", (1, "s", "m"), (2, "?", "m"), (2, "?", "m"))
    names_ = frame("user_name string, first_name string", ("s", "Sup"), ("m", "Man"), ("m", "Man"))
    out = masters.staff_hierarchy(staff, names_, {"sup_id": "sup", "asm_id": "asm"}, [("sup", "asm")])
    assert {r.staff: (r.sup, r.asm) for r in out.collect()} == {1: ("Sup", "Man"), 2: ("Man", "Man")}


def test_discount_lines(frame):
    df = frame("o int, l string, p string, t string", (1, "1,2", "B", "tb"), (1, "1", "A", "ta"), (1, "1", "A", "ta"), (1, "1", "C", "tc"), (1, "1", "D", "td"), (1, "", "E", "te"))
    got = {r.line_ref: tuple(r)[2:] for r in masters.discount_lines(df, ["o"], "l", "p", ["t"]).collect()}
    assert got == {"1": ("A", "B", "C", "ta", "tb", "tc", 4), "2": ("B", None, None, "tb", None, None, 1)}


def test_weblog(frame):
    df = frame("pathname string, title_page string", ("/a/b", "x | y: z"), ("/", "only"), (None, None))
    got = [tuple(r) for r in masters.web_log_levels(df).select("level_1", "level_2", "level_3", "title_1", "title_2", "keyword").collect()]
    assert sorted(got, key=str) == sorted([("a", "b", None, "x", "y", "z"), ("", None, None, "only", None, None), (None,) * 6], key=str)
