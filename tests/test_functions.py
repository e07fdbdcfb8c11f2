"""Column builders against written-out cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rentscope.functions import dates, money, numbers, text


def column(spark, build, cases):
    """Apply ``build`` to all inputs at once and compare in order."""
    rows = [(i, given) for i, (given, _) in enumerate(cases)]
    frame = spark.createDataFrame(rows, "i int, x string")
    got = [r.y for r in frame.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == [wanted for _, wanted in cases]


def test_money_token(spark):
    column(spark, money.money_token, [
        ("28.000", 28000), ("28,000", 28000), ("2.8萬", 28000), ("2萬8", 28000), ("2万5", 25000),
        ("1,234,567", 1234567), ("28k", 28000), ("2.5K", 2500), ("28千", 28000), ("1500.9", 1500),
        (" 8 500 ", 8500), ("2萬8000", 8020000), ("abc", None), ("", None), (".", None),
        ("1.2.3", None), ("1,2.5", None), ("1f", None), ("２８０００", 28000), (None, None),
        ("99999999999999999999999", None), ("0.0005萬", 5), ("千", None),
    ])


def test_post_prices(spark):
    column(spark, money.post_prices, [
        ("每月租金：28.000", [28000]),
        ("租金2.8萬", [28000]),
        ("月租 12,500元/月 或 15000", [12500, 15000]),
        ("電話 0912345678 樓層 1234567", []),
        ("押金 25k, 2千, 1999, 300001", [2000, 25000]),
        ("8k元", []),
        ("2萬8000", [8000]),
        ("1,234,5678", [5678]),
        ("價格： 3500", [3500]),
        ("租金　２８０００", [28000]),
        (" ".join(str(2000 + i) for i in range(15)), [2000 + i for i in range(10)]),
        ("", []),
        (None, None),
    ])


def test_post_areas(spark):
    column(spark, money.post_areas, [
        ("10坪 套房", [10.0]), ("10坪的房", []), ("12.5 PING, 8p", [8.0, 12.5]),
        ("0.5坪 201坪 200坪", [200.0]), ("3 pings", []), ("十坪", []),
    ])


def test_page_numbers(spark):
    column(spark, money.page_prices, [
        ("NT$ 1,200 元/月 30 45 50", [50, 1200]), ("12345678", [78, 123456]),
        ("300001 300000", [300000]), ("５００元", [500]),
    ])
    column(spark, money.page_percents, [
        ("5% 12.5 % 0% 100% 101%", [5.0, 12.5, 100.0]), ("%", []),
    ])


def test_merge_prices(spark):
    rows = spark.createDataFrame([([5, 3], 4), ([5, 3], None), (None, 7)], "a array<int>, m int")
    got = rows.select(money.merge_prices(F.col("a"), F.col("m")).alias("p")).collect()
    assert [r.p for r in got] == [[3, 4, 5], [3, 5], [7]]


def test_tags(spark):
    column(spark, text.keyword_tags, [
        ("大安 App 套房 行情", ["comparable", "reasonable", "studio", "tool", "大安"]),
        ("hello", []),
        ("出租金額", ["landlord", "pricing"]),
        (None, []),
    ])
    column(spark, text.name_tags, [("萬里到中正 中正", ["中正", "萬里"]), ("", [])])
    column(spark, text.pain_tags, [("廣告 詐騙", ["ads", "trust"]), ("", [])])
    patterns = {"b": "X[0-9]", "a": "word|ÄPFEL"}
    column(spark, lambda c: text.category_tags(c, patterns), [
        ("x1 äpfel", ["a", "b"]), ("WORD", ["a"]), ("x", []),
    ])


def test_asks_price(spark):
    column(spark, text.asks_price, [
        ("大安區這樣的租金合理嗎？", True), ("大安區出租，月租28000", False),
        ("租金?", True), ("合理嗎", False), ("房租多少", True),
    ])


def test_snippet(spark):
    column(spark, lambda c: text.snippet(c, 5), [
        ("  a \n\t b　c ", "a b c"), ("abcdef", "abcd…"), ("", ""), ("abcde", "abcde"),
    ])


def test_price_snippet(spark):
    early, late = "x" * 10 + "租金 5000", "y" * 300 + "費用" + "z" * 900
    column(spark, text.price_snippet, [
        (early, early), (late, "y" * 120 + "費用" + "z" * 578), ("q" * 800, "q" * 700),
    ])


def test_masks(spark):
    column(spark, text.mask_post, [
        ("0912-345-678", "[PHONE_REDACTED]"),
        ("tel 02-27001234.", "tel [PHONE_REDACTED]."),
        ("12345678", "[PHONE_REDACTED]"),
        ("1234567", "1234567"),
        ("1234567890123", "1234567890123"),
        ("a.b+c@mail.example.tw!", "[EMAIL_REDACTED]!"),
        ("Line id: abc_12 ok", "Line id: [LINE_ID_REDACTED] ok"),
        ("LINE帳號：user.name", "LINE帳號：[LINE_ID_REDACTED]"),
        ("line abc", "line abc"),
    ])
    column(spark, text.mask_review, [
        ("x@y.io 0912345678 12345678", "[EMAIL_REDACTED] [PHONE_REDACTED] 12345678"),
    ])


def test_post_body(spark):
    column(spark, text.post_body, [
        ("\n a\n\n\n\nb -- c", "a\n\nb"), ("body\n※ 發信站: here", "body"), ("a--b--c", "a"),
    ])


def test_urls(spark):
    column(spark, text.thread_id, [
        ("https://x/bbs/b/M.1.A.html/", "M.1.A"), ("https://x/bbs/b/M.html.2", "M.2"),
    ])
    column(spark, text.url_host, [
        ("https://u@a.b:8/c?d", "u@a.b:8"), ("a.b/c", ""), ("//h/p", "h"),
    ])


def test_numbers(spark):
    column(spark, numbers.to_number, [
        ("1,234.5元", 1234.5), ("-3", -3.0), (".5", 0.5), ("nan", None), ("", None),
        ("約１２", 12.0), (None, None),
    ])
    column(spark, lambda c: numbers.half_even(c.cast("double")), [
        ("0.5", 0), ("1.5", 2), ("2.5", 2), ("14798.5", 14798), ("-0.5", 0),
    ])
    column(spark, lambda c: numbers.confidence(c.cast("int")), [
        ("1", 0.35), ("10", 0.5), ("100", 0.95),
    ])
    column(spark, numbers.blank_missing, [("N/A", None), ("", None), ("x", "x"), ("na", "na")])


def test_roc_date(spark):
    column(spark, dates.roc_date, [
        ("1150427", dt.date(2026, 4, 27)), ("1150427.0", dt.date(2026, 4, 27)),
        ("0990101", dt.date(2010, 1, 1)), ("990101", None), ("1150231", None), ("115/4/7", None),
        ("11504270", dt.date(2026, 4, 27)), (None, None),
    ])


def test_forum_timestamp(spark):
    column(spark, dates.forum_timestamp, [
        ("Wed Jul 26 21:06:35 2017", dt.datetime(2017, 7, 26, 21, 6, 35)),
        (" Wed Jul  6 01:06:35 2017 ", dt.datetime(2017, 7, 6, 1, 6, 35)),
        ("2024/07/05 08:05", dt.datetime(2024, 7, 5, 8, 5)),
        ("2024-07-05 08:05:09", dt.datetime(2024, 7, 5, 8, 5, 9)),
        ("7/26", None), ("Xxx Jul 26 21:06:35 2017", None), ("Wed Feb 30 21:06:35 2017", None),
        ("", None), (None, None),
    ])


def test_review_date(spark):
    column(spark, dates.review_date, [
        ("2024-06-14T23:00:00-07:00", dt.date(2024, 6, 14)), ("2024-06-14", dt.date(2024, 6, 14)),
        ("2024-06-14T23:00:00Z", dt.date(2024, 6, 14)), ("2024-06-14abc", None),
        ("2024-13-14", None), ("", None),
    ])


@pytest.mark.parametrize("zone", ["UTC", "Asia/Taipei", "America/New_York"])
def test_utc_date_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        column(spark, dates.utc_date, [
            ("1718323200", dt.date(2024, 6, 14)), ("1718409599", dt.date(2024, 6, 14)),
            ("-1", dt.date(1969, 12, 31)),
        ])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_cutoffs():
    assert dates.cutoff() is None
    day = dt.date(2026, 6, 14)
    assert dates.timeframe("today 24-m", day) == "2024-06-14 2026-06-14"
    assert dates.timeframe("today 12-m", day) == "2025-06-14 2026-06-14"
    assert dates.timeframe("today 5-y", day) == "2021-06-15 2026-06-14"
    assert dates.timeframe("2024-01-01 2024-02-01") == "2024-01-01 2024-02-01"


def test_json_guard(spark):
    column(spark, text.strip_json_guard, [(")]}'\n{}", "{}"), ("{}", "{}")])


def test_cutoff_columns(spark):
    row = spark.range(1).select(
        dates.cutoff("2024-01-02", 5).alias("day"),
        F.expr("current_timestamp()").alias("now"),
        dates.cutoff(days=730).alias("back"),
    ).first()
    assert row.day == dt.datetime(2024, 1, 2) and row.now - row.back == dt.timedelta(days=730)
    as_of = dt.datetime(2026, 3, 1, 12, 30)
    assert spark.range(1).select(dates.cutoff(days=1, as_of=as_of)).first()[0] == dt.datetime(2026, 2, 28, 12, 30)
