import datetime as dt
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catalog_signals.functions import casts
from catalog_signals.functions.casts import (
    as_timestamp,
    clean_text,
    elapsed_days,
    is_true,
    parse_money,
    safe_bigint,
    safe_timestamp,
    strict_bigint,
    years_before,
)
from catalog_signals.functions.text import percent_text, share_pct
from catalog_signals.operators.ranking import active_revenue
from catalog_signals.sources.scans import scan_subscriptions


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("7", 7), (" 7 ", 7), ("+7", 7), ("-7", -7), ("07", 7), ("\t7\n", 7), ("1.5", None),
        ("0x1F", None), ("1_000", None), ("5d", None), ("n/a", None), ("", None), ("-", None),
        (None, None), ("1,000", None), ("1e3", None), ("9223372036854775807", 2**63 - 1),
        ("9223372036854775808", None),
    ],
)
def test_tolerant_integer(spark, text, number):
    df = column(spark, [text], "string")
    assert values(df, safe_bigint(df, "x")) == [number]


def test_tolerant_integer_of_numbers(spark):
    df = column(spark, [1.0, 1.5, float("nan"), float("inf"), None], "double")
    assert values(df, safe_bigint(df, "x")) == [1, None, None, None, None]
    df = column(spark, [3, None], "int")
    assert values(df, safe_bigint(df, "x")) == [3, None]


def test_strict_integer_fails_on_bad_text(spark):
    with pytest.raises(PySparkException):
        column(spark, ["5d"], "string").select(strict_bigint("x")).collect()


MONEY = {
    "$1,200.50": 1200.5, "($1,200.50)": -1200.5, "(5)": -5.0, "-(5)": -5.0, "-5": -5.0, "(-5)": -5.0,
    " 12 ": 12.0, "\t12\n": 12.0, "$ 12": 12.0, "( 12 )": -12.0, "nan": None, "inf": None,
    "None": None, "1e3": 1000.0, "1_000": None, "5d": None, "5f": None, "0x1p3": None, "": None,
    "()": None, "(": None, "1.": 1.0, ".5": 0.5, ".": None, "1.2.3": None, "n/a": None, None: None,
    " 7 ": 7.0, "(5": 5.0, "(5)$": -5.0,
}


def test_money_text(spark):
    df = column(spark, list(MONEY), "string")
    assert values(df, parse_money(df, "x")) == list(MONEY.values())


def test_money_numbers(spark):
    df = column(spark, [1.5, -2.0, float("nan"), float("inf"), None], "double")
    assert values(df, parse_money(df, "x")) == [1.5, -2.0, None, None, None]


def test_clean_text_strips_what_python_strips(spark):
    texts = [" a ", "\ta\n", " a ", "\x1fa\x1c", "a b", ""]
    df = column(spark, texts, "string")
    assert values(df, clean_text(F.col("x"))) == [t.strip() for t in texts]


def test_tolerant_timestamp(spark):
    moment = dt.datetime(2020, 5, 1, 13)
    df = column(spark, ["2020-05-01 13:00:00", "2020-05-01", "soon", "", None], "string")
    assert values(df, safe_timestamp(df, "x")) == [moment, dt.datetime(2020, 5, 1), None, None, None]
    df = column(spark, [dt.date(2020, 5, 1), None], "date")
    assert values(df, safe_timestamp(df, "x")) == [dt.datetime(2020, 5, 1), None]


def test_truth_is_boolean_or_one(spark):
    df = column(spark, [True, False, None], "boolean")
    assert values(df, is_true(df, "x")) == [True, False, False]
    df = column(spark, [1, 0, 2, None], "int")
    assert values(df, is_true(df, "x")) == [True, False, False, False]
    df = column(spark, ["1", "true"], "string")
    assert values(df, is_true(df, "x")) == [False, False]


def test_cutoff_keeps_the_time_of_day(spark):
    one = spark.range(1)
    assert values(one, years_before("2024-02-29 13:00:00", 2)) == [dt.datetime(2022, 2, 28, 13)]
    assert values(one, years_before(dt.datetime(2023, 3, 1, 8, 30), 2)) == [
        dt.datetime(2021, 3, 1, 8, 30)
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_elapsed_days_are_whole_24_hours(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        pairs = [
            ("2020-01-01 23:00:00", "2020-01-02 01:00:00", 0),
            ("2020-01-01 23:00:00", "2020-01-02 23:00:00", 1),
            ("2020-03-07 12:00:00", "2020-03-09 12:00:00", 2),
            ("2019-01-01 00:00:00", "2020-01-01 00:00:00", 365),
        ]
        for start, end, days in pairs:
            got = values(spark.range(1), elapsed_days(as_timestamp(start), as_timestamp(end)))
            assert got == [days]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(1, 800), (3, 800), (1, 3), (0, 5), (5, 0), (-1, 8)], "n int, t int")
    assert values(df, share_pct(F.col("n"), F.col("t"))) == [0.12, 0.38, 33.33, 0.0, None, -12.5]


def test_percent_text_equals_python_formatting(spark):
    pairs = [(s, t) for t in range(1, 120) for s in range(t + 1)]
    df = spark.createDataFrame(pairs, "s bigint, t bigint")
    got = [r[0] for r in df.select(F.expr(percent_text("s / t"))).collect()]
    assert got == [f"{s / t:.0%}" for s, t in pairs]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_dates_mean_the_same_in_every_session_zone(spark, zone):
    texts = [
        "2024-06-01", "2024-06-01 10:20:30", "06/01/2024", "6/1/2024", "20240601", "Jun 1 2024", "June 1, 2024", "1 Jun 2024",
        "2024-06-01T10:00:00+02:00", "2024-06-01T08:00:00Z", "soon", "13/45/2024", "Foo 1 2024", "", None,
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [str(r[0]) for r in df.select(safe_timestamp(df, "t")).collect()]
        moments = spark.sql("SELECT timestamp_micros(1717228800000000) AS t")
        moment = str(moments.select(safe_timestamp(moments, "t")).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    day = "2024-06-01 00:00:00"
    eight = "2024-06-01 08:00:00"
    assert got == [day, "2024-06-01 10:20:30", day, day, day, day, day, day, eight, eight, *["None"] * 5]
    assert moment == eight


def test_amounts_out_of_range_are_null_and_never_fail(spark):
    texts = ["1e22", "1e400", "$99999999999999999999999", "$5"]
    df = spark.createDataFrame([(t, "A", "1", True, None, i) for i, t in enumerate(texts)],
                               "annualRecurringServices string, clientID string, serviceID string, active boolean, "
                               "dateCancelled timestamp_ntz, subscriptionID int")
    assert [r[0] for r in df.select(parse_money(df, "annualRecurringServices")).collect()] == [1e22, None, 1e23, 5.0]
    subs = scan_subscriptions(df)
    assert [float(r.revenue) for r in active_revenue(subs).collect()] == [5.0]
    without = scan_subscriptions(df.drop("annualRecurringServices"))
    assert [r.revenue for r in active_revenue(without).collect()] == [None]


def test_integral_decimal_texts_are_ids(spark):
    df = spark.createDataFrame([(t,) for t in ("7.0", " 7.", "7.5", ".0", "7.00 ")], "t string")
    assert [r[0] for r in df.select(safe_bigint(df, "t")).collect()] == [7, 7, None, None, 7]


def _date_of(text):
    """The formats one after the other, each by an expression of its own, as a brute-force model."""
    months = "jan feb mar apr may jun jul aug sep oct nov dec".split()
    text = text.strip()
    if re.search(r":\d{2}(\.\d+)?\s*(Z|[+-]\d{2}:\d{2})$", text):
        return dt.datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(dt.timezone.utc).replace(tzinfo=None)
    patterns = [
        (r"(\d{4})-(\d{1,2})-(\d{1,2})", "ymd"), (r"(\d{1,2})/(\d{1,2})/(\d{4})", "mdy"), (r"(\d{4})(\d{2})(\d{2})$", "ymd"),
        (r"([A-Za-z]{3})[a-z]*\.? (\d{1,2}),? (\d{4})", "mdy"), (r"(\d{1,2}) ([A-Za-z]{3})[a-z]*\.? (\d{4})", "dmy"),
    ]
    for pattern, order in patterns:
        found = re.match(pattern + r"(?:[ T](\d{1,2}):(\d{2})(?::(\d{2}))?)?$", text)
        if found:
            parts = dict(zip(order, found.groups()))
            if not parts["m"].isdigit():
                if parts["m"].lower() not in months:
                    return None
                parts["m"] = months.index(parts["m"].lower()) + 1
            try:
                return dt.datetime(*[int(parts[k]) for k in "ymd"], *[int(t or 0) for t in found.groups()[3:]])
            except ValueError:
                return None
    return None


def test_every_format_with_and_without_a_time(spark):
    days = [
        "2024-02-29", "2023-02-29", "2024-6-1", "02/29/2024", "2/9/2024", "13/1/2024", "20240229", "20241301", "00000000",
        "Feb 29, 2024", "February 9 2024", "Sept. 9, 2024", "Foo 9, 2024", "29 Feb 2024", "9 febr. 2024", "31 Apr 2024", "MAR 3, 2024",
        "soon", "", "12:30:00", "1 Jun 24", "2024", "2024 6 1", "/", "a/b/2024", "abcdefgh", "99999999",
    ]
    times = ["", " 10:20:30", " 7:05"]
    texts = [f" {d}{t}\t" for d in days for t in times if not (len(d) == 8 and d.isdigit() and t)]
    texts += ["2024-06-01T10:00:00+02:00", "2024-06-01T10:00:00.500-05:00", "2024-06-01 10:00:00Z"]
    texts.remove(" 2024\t")  # a year alone is the year's first day here, and nothing to the model
    df = column(spark, texts, "string")
    for text, got in zip(texts, values(df, safe_timestamp(df, "x"))):
        assert got == _date_of(text), text


ODD_DATES = [
    "2024-06-01", "2024-02-30", " 2024-06-01", "2024-06-1 ", "2024-6-1", "06/01/2024", "6/1/2024", "06/1 /2024", "13/45/2024",
    "20240601", "2024061 ", " 2024061", "+2024061", "00000601", "20241301", "+024-06-01", "0000-01-01", "2024-0a-01", "2024-06-01\n",
    "24:0-06-01", "12:30:00Z", "١٢/٠١/٢٠٢٤", "01/02/2024 10:00", "Jun 1, 2024", "soon", "", None,
]
ODD_MONEY = [
    "$1,200.50", " 12.5 ", "$ 12", "12 $", "1 2", ".5", "5.", ".", "1.2.3", "($45)", "-3", "+3", "1e3", "1d", "NaN", "Infinity",
    "9" * 300, "9" * 301, "9" * 400, "12\n", "\xa012", "$", ",", "", "١٢", None,
]


def test_plain_texts_read_as_all_others_do(spark):
    dates = spark.createDataFrame([(t,) for t in ODD_DATES], "t string")
    slow = casts._computed_once(casts.clean_text(F.col("t")), casts._read_date)
    for r in dates.select("t", casts.safe_timestamp(dates, "t").cast("string").alias("fast"), slow.cast("string").alias("slow")).collect():
        assert r.fast == r.slow, r.t
    money = spark.createDataFrame([(t,) for t in ODD_MONEY], "t string")
    slow = casts._computed_once(F.translate(casts.clean_text(F.col("t")), ",$", ""), casts._read_money)
    for r in money.select("t", casts.parse_money(money, "t").alias("fast"), slow.alias("slow")).collect():
        assert r.fast == r.slow, r.t
    ids = spark.createDataFrame([(t,) for t in ("7", "7.0", " 7. ", "7.5", "1e3", ".0", "x.0", "", None)], "t string")
    whole = F.regexp_replace("t", r"(?<=\d)\.0*(?=\s*$)", "").try_cast("bigint")
    for r in ids.select("t", casts.safe_bigint(ids, "t").alias("fast"), whole.alias("slow")).collect():
        assert r.fast == r.slow, r.t


def test_plain_texts_take_no_lambda(spark, monkeypatch):
    """Seconds: lambdas are interpreted value by value; the usual texts are read by compiled code."""
    monkeypatch.setattr(casts, "_read_date", lambda _: F.raise_error(F.lit("lambda")).cast("timestamp_ntz"))
    monkeypatch.setattr(casts, "_read_money", lambda _: F.raise_error(F.lit("lambda")).cast("double"))
    df = spark.createDataFrame([("2024-06-01", "$1,200.50"), ("06/01/2024", " 7 "), ("20240601", "3")], "d string, m string")
    found = df.select(casts.safe_timestamp(df, "d"), casts.parse_money(df, "m")).collect()
    assert [tuple(r) for r in found] == [(dt.datetime(2024, 6, 1), m) for m in (1200.5, 7.0, 3.0)]
