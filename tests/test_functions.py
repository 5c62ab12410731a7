"""Column helpers, one case per semantic trap."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import codes, dates, nested, numbers, text


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first().asDict()


def ts(v):
    return F.lit(v).cast("timestamp_ntz")


def test_minutes_count_crossed_boundaries(spark):
    r = one(spark, a=dates.minutes_between(ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:01")),
            b=dates.minutes_between(ts("2024-01-01 00:01:01"), ts("2024-01-01 00:00:59")),
            c=dates.minutes_between(ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:59")))
    assert r == {"a": 1, "b": -1, "c": 0}


def test_rounding_modes(spark):
    r = one(spark, **{f"up{i}": numbers.round_half_up(F.lit(v)) for i, v in enumerate((0.5, 1.5, 2.5))},
            **{f"even{i}": numbers.round_half_even(F.lit(v)) for i, v in enumerate((0.5, 1.5, 2.5))})
    assert [r[f"up{i}"] for i in range(3)] == [1, 2, 3]
    assert [r[f"even{i}"] for i in range(3)] == [0, 2, 2]


@pytest.mark.parametrize("given, expected", [("1,234", 1234.0), (" 12 ", 12.0), ("x", None), (None, None), ("-3.5", -3.5)])
def test_numbers_from_text(spark, given, expected):
    assert one(spark, v=numbers.to_number(F.lit(given).cast("string")))["v"] == expected


def test_division_and_flags(spark):
    r = one(spark, a=numbers.ratio(F.lit(1), F.lit(0)), b=numbers.percent(F.lit(1), F.lit(8)),
            c=numbers.flag(F.lit(None).cast("double")), d=numbers.flag(F.lit(2)), e=numbers.flag(F.lit(0)),
            f=numbers.by_unit(F.lit(6), F.lit(2), F.lit("M")), g=numbers.by_unit(F.lit(6), F.lit(2), F.lit("D")))
    assert r == {"a": None, "b": 13.0, "c": 0, "d": 1, "e": 0, "f": 12.0, "g": 3.0}


def test_signed(spark):
    def s(code):
        return numbers.signed(F.lit(5), F.lit(code), ("IN",), ("CM",))
    assert one(spark, a=s("IN"), b=s("CM"), c=s("NA")) == {"a": 5, "b": -5, "c": 0}


def test_pieces_and_tokens(spark):
    r = one(spark, a=text.pieces(F.lit(" a , b,c ")), b=text.token(F.lit("x|y"), "|", 1), c=text.token(F.lit("x|y"), "|", 5),
            d=text.joined_key(F.lit("a"), F.lit(None), F.lit(1)), e=text.strict_key(F.lit("a"), F.lit(None)),
            f=text.squash(F.lit(" \t q r\n")), g=text.match_key(F.lit(" ab ")))
    assert r == {"a": ["a", "b", "c"], "b": "y", "c": None, "d": "a1", "e": None, "f": "q r", "g": "AB"}


def test_address_separators(spark):
    assert one(spark, v=text.address(F.lit("1 Street"), F.lit("  "), F.lit(None), F.lit(" Town ")))["v"] == "1 Street, Town"


def test_names():
    assert text.plain_name("Đơn vị (giá): 1.000 *x*") == "Donvigia1000x"


def test_urls(spark):
    url = F.lit("https://a.example.com/x/y/?page=2&q=")
    r = one(spark, a=text.url_path_level(url, 1), b=text.url_path_level(url, 2), c=text.url_path_level(url, 3),
            d=text.url_parameter(url, "page"), e=text.url_parameter(url, "q"), f=text.url_path_level(F.lit("/p/q"), 2))
    assert r == {"a": "x", "b": "y", "c": None, "d": "2", "e": None, "f": "q"}


def test_dates(spark):
    r = one(spark, a=dates.parse_date(F.lit("31/12/2023 10:00")), b=dates.parse_date(F.lit("2023")),
            c=dates.parse_date_or_sentinel(F.lit("")), d=dates.clamp_date(F.lit(dt.date(9999, 1, 1))),
            e=dates.date_from_parts(F.lit("2023-02"), F.lit(29)), f=dates.date_from_parts(F.lit("2024-02"), F.lit("29")),
            g=dates.duration_text(F.lit(605)), h=dates.month_label(F.lit(dt.date(2023, 1, 5))),
            i=dates.month_key(F.lit(dt.date(2023, 1, 5))), j=dates.month_name3(F.lit(dt.date(2023, 9, 5))),
            k=F.add_months(F.lit(dt.date(2023, 5, 31)), -3))
    assert r == {"a": dt.date(2023, 12, 31), "b": None, "c": dt.date(1900, 1, 1), "d": dt.date(2262, 4, 11), "e": None,
                 "f": dt.date(2024, 2, 29), "g": "10:05", "h": "12023", "i": "2023-01", "j": "SEP", "k": dt.date(2023, 2, 28)}


def test_workdays(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 32)], "day date")
    r = dates.workdays(days, "2024-01-08").first()
    # January 2024: 23 week days, 4 Saturdays, 4 Sundays; 1-7: five week days and a Saturday.
    assert (r.month_days, r.elapsed_days) == (25.0, 5.5)


def test_codes(spark):
    types, pos = F.lit("X,LOG"), F.lit("SD")
    r = one(spark, a=codes.staff_role(types, pos), b=codes.staff_role(F.lit("S"), pos), c=codes.staff_role(F.lit("CS"), F.lit("Q")),
            d=codes.staff_role(F.lit("S"), F.lit("AM")), e=codes.staff_role(F.lit(None).cast("string"), pos),
            f=codes.payment_class(F.lit("B")), g=codes.payment_class(F.lit(None).cast("string")),
            h=codes.delivery_status(F.lit("R")), i=codes.delivery_status(F.lit("?")),
            j=codes.first_known(F.lit(None).cast("string"), F.lit("w3")), k=codes.label(F.lit("z"), {}, "d"),
            l=codes.any_of(F.lit(None).cast("string"), ["a"]))
    assert r == {"a": "LOG", "b": "MDS", "c": "CS", "d": "P.BH", "e": "SD", "f": "TM", "g": "CK", "h": "Từ Chối Giao Hàng",
                 "i": "Chưa Xác Nhận", "j": "w3", "k": "d", "l": False}


def test_nested(spark):
    df = spark.range(1).select(nested.parse_json(F.lit('{"a": {"x": 1}, "l": [{"value": "v"}]}'),
                                                 "struct<a: struct<x: int>, l: array<struct<value: string>>>").alias("j")).select("j.*")
    out = nested.struct_fields(df, "a", ["x"]).select("a_x", nested.at("l", 0, "value").alias("v"), nested.at("l", 3, "value").alias("w"))
    assert tuple(out.first()) == (1, "v", None)
