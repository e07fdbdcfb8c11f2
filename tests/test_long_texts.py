"""Searches over long texts: short cuts read less of a text and find the same."""

import random

from pyspark.sql import functions as F

from rentscope import vocab
from rentscope.functions import money, text
from rentscope.operators import signals
from rentscope.sources import html_pages

D, S = vocab.DIGIT, vocab.SPACE
PLAIN_PHONE = (
    rf"(?<!{D})(?:09{D}{{2}}[-{S}]?{D}{{3}}[-{S}]?{D}{{3}}|{D}{{2,4}}[-{S}]?{D}{{6,8}})(?!{D})"
)
PIECES = [
    *"0123456789０９.,:：;x?kKpPing_é", " ", "  ", "\n", "　", "\xa0", "12", "2.8", "28.000", "12,500", "9000",
    "30000", "k", "k ", "ping", "Ping ", "p)", "pıng", "坪", "千", "萬", "万", "租金", "每月租金：", "開價", "月租", "大安",
    "板橋", "公寓", "多少", "some words here, and ", "happen", " " * 9, ",.:" * 4, "\U0001f3e0", "é" * 8,
]


def drawn(spark, n, pieces):
    draw = random.Random(7)
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 24))) for _ in range(n)]
    return spark.createDataFrame([(t,) for t in texts], "x string")


def differing(df, a, b):
    return df.filter(~a.eqNullSafe(b)).count()


def test_gist_has_every_tag_amount_and_area(spark):
    df = drawn(spark, 6000, PIECES).withColumn("short", text.gist(F.col("x"))).localCheckpoint()
    whole, short = F.col("x"), F.col("short")
    assert df.filter(F.size(money.post_prices(whole)) > 0).count() > 500
    assert df.filter(F.size(money.post_areas(whole)) > 0).count() > 500
    assert differing(df, money.post_prices(short), money.post_prices(whole)) == 0
    assert differing(df, money.post_areas(short), money.post_areas(whole)) == 0
    assert differing(df, text.keyword_tags(whole, short=short), text.keyword_tags(whole)) == 0
    assert differing(df, text.name_tags(whole, short=short), text.name_tags(whole)) == 0
    assert differing(df, text.asks_price(whole, short=short), text.asks_price(whole)) == 0


def test_words_that_a_gist_may_lack_are_looked_for_in_the_whole(spark):
    long = "words in Latin script and more of them: les prix, Paris " * 50
    df = spark.createDataFrame([(long + "大安", None), (None, None)], "content string, title string")
    df = df.withColumns({c: F.lit("") for c in ("board", "author", "date", "url")})
    found = signals.to_signals(df, {"pricing": "prix|PRIX|租", "place": "rue"}, ["Paris", "大安"], "more")
    first = found.filter(F.size("keywords") > 0).first()
    assert first.keywords == ["Paris", "pricing", "大安"] and first.districts == ["Paris", "大安"]
    assert first.contains_pricing_question


def test_little_of_a_latin_text_is_searched_for_amounts(spark, value):
    long = "many words, and none of them is an amount; " * 2000
    assert len(value(text.gist, long + "月租 12,500 約 8 ping" + long)) < 60
    df = spark.createDataFrame([(long,)], "content string").withColumns(
        {c: F.lit("") for c in ("board", "title", "author", "date", "url")}
    )
    plan = signals.to_signals(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all(_all" not in plan and plan.count("{6})") == 1
    assert value(text.gist, " " * 300_000 + "　" * 300_000 + "8坪").endswith("8坪")


def test_snippet_of_white_space_and_words(spark):
    def plain(column, length):
        line = text.collapse(column)
        cut = F.concat(F.substring(line, 1, length - 1), F.lit("…"))
        return F.when(F.length(line) <= length, line).otherwise(cut)

    df = drawn(spark, 3000, [" ", "\n", " " * 20, "　", "ab", "租", "\U0001f3e0"])
    for length in (1, 5, 8, 200):
        assert differing(df, text.snippet(F.col("x"), length), plain(F.col("x"), length)) == 0
    spaced = spark.createDataFrame([(" " * 900 + "ab" + " " * 900 + "c",), (" " * 900 + "d" * 300,)], "x string")
    assert [r[0] for r in spaced.select(text.snippet(F.col("x"))).collect()] == ["ab c", "d" * 199 + "…"]


def test_phone_pattern_begins_with_a_digit_and_finds_the_same(spark):
    assert vocab.PHONE.startswith(vocab.DIGIT)
    df = drawn(spark, 8000, ["0", "9", "09", "０", "９", "12", "345", "1234567", "-", " ", "　", "a", "０９"])
    new = F.regexp_replace("x", vocab.PHONE, "<$0>")
    assert differing(df, new, F.regexp_replace("x", PLAIN_PHONE, "<$0>")) == 0
    assert df.filter(new.contains("<")).count() > 1000


def test_post_bodies_with_and_without_blank_runs(spark):
    page = '<div id="main-content">a\n\n\n\nb 0912-345-678\n\nc</div>'
    df = spark.createDataFrame([(1, page), (2, '<div id="main-content"><p>x</b>y</p>z'), (3, None)], "i int, html string")
    assert [r.content for r in html_pages.posts(df).orderBy("i").collect()] == [
        "a\n\nb [PHONE_REDACTED]\n\nc", "x\ny\nz", "",
    ]
