"""Reviews, price pages, search interest and the report."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rentscope import schemas
from rentscope.operators import benchmarks, evidence, interest, reviews
from rentscope.operators import signals as signal_ops
from rentscope.plans import jobs
from rentscope.sources import documents, feeds


def entry(rating, title="t", content="c", updated="2024-06-14T23:00:00-07:00", **more):
    made = {
        "title": {"label": title}, "content": {"label": content}, "updated": {"label": updated},
        "id": {"label": "1"}, "link": {"attributes": {"href": "https://a"}}, **more,
    }
    if rating is not None:
        made["im:rating"] = {"label": rating}
    return made


def feed(entries):
    return json.dumps({"feed": {"entry": entries}}, ensure_ascii=False)


def review_pages(spark):
    pages = [
        feed([entry(None, "the app"), entry("5", "租金太貴", "mail a@b.co 0912-345-678"), entry("x", "客服")]),
        feed(entry("2", "廣告 假", updated="2020-01-01")),
        feed(entry("1", "廣告", updated="broken")),
        json.dumps({"feed": {}}),
        feed([{"im:rating": {"label": "3"}, "updated": {"label": "2024-07-01"}}]),
    ]
    return spark.createDataFrame(
        [(p, "App", "7", "tw") for p in pages], "payload string, app_name string, app_id string, country string"
    )


def test_review_entries(spark):
    rows = feeds.review_entries(review_pages(spark)).collect()
    assert len(rows) == 5
    bare = next(r for r in rows if r.rating == 3)
    assert (bare.title, bare.content, bare.review_id, bare.source_url) == ("", "", "", "")
    assert next(r for r in rows if r.title == "客服").rating is None


def test_review_job(spark, tmp_path):
    found, summary = jobs.review_signals(review_pages(spark), dt.date(2024, 6, 1), str(tmp_path))
    rows = {r.title: r for r in found.collect()}
    assert set(rows) == {"租金太貴", "客服", ""}
    assert rows["租金太貴"].content_redacted == "mail [EMAIL_REDACTED] [PHONE_REDACTED]"
    assert rows["租金太貴"].pain_keywords == ["pricing"]
    row = summary.first()
    assert row.reviews_collected == 3 and row.average_rating == 4.0
    assert row.app_count == 1 and [tuple(x) for x in reviews.apps(found).collect()] == [(1, "App", 3)]
    assert spark.read.json(f"{tmp_path}/json/apps").count() == 1
    assert [tuple(x) for x in row.top_pain_keywords] == [("contact", 1), ("pricing", 1)]
    stored = spark.read.schema(schemas.REVIEWS).json(f"{tmp_path}/json/reviews")
    assert stored.count() == 3 and stored.filter("rating is null").count() == 1
    empty = reviews.summary(found.limit(0), dt.date(2024, 6, 1)).first()
    assert empty.reviews_collected == 0 and empty.average_rating is None


SOURCES = [
    ("Alpha", "cat", "https://a.example/p", "Basic", 400, "2026-06-14", "n", True),
    (None, None, "https://b.example/q", None, None, None, None, None),
    ("MyBrand Pro", "cat", "https://c.example", "Pro", 4990, None, None, True),
    ("Off", "cat", "https://a.example/p", "Basic", 1, None, None, False),
    ("Gone", "cat", "https://gone.example", None, 1500, None, "seen", True),
    ("Stopped", "cat", "https://d.example", None, None, None, "old", True),
]
PAGES = [
    ("https://a.example/p", 1, "<title>old</title>9999", None, None),
    ("https://a.example/p", 2, "<title>new</title><p>方案 NT$1,200/月 抽成 5%</p>", None, None),
    ("https://b.example/q", 1, "fee 85 and 120000", None, None),
    ("https://c.example", 1, None, "robots_blocked", None),
    ("https://d.example", 1, None, "fetch_failed", "timed out"),
    ("https://unasked.example", 1, "1234", None, None),
]


def price_inputs(spark):
    pages = "source_url string, version int, html string, crawl_status string, crawl_error string"
    return spark.createDataFrame(SOURCES, schemas.PRICE_SOURCES), spark.createDataFrame(PAGES, pages)


def test_price_records(spark, tmp_path):
    found, summary = jobs.price_benchmarks(*price_inputs(spark), ["version"], str(tmp_path))
    rows = {r["product"]: r for r in found.collect()}
    assert set(rows) == {"Alpha", "b.example", "MyBrand Pro", "Gone", "Stopped"}
    alpha = rows["Alpha"]
    assert alpha.page_title == "new" and alpha.crawl_status == "crawled"
    assert alpha.extracted_price_values_ntd == [400, 1200] and alpha.extracted_percent_values == [5.0]
    assert alpha.pricing_text_snippet == "new 方案 NT$1,200/月 抽成 5%"
    assert rows["b.example"].category == "competitor_or_analogous_product"
    assert rows["b.example"].extracted_price_values_ntd == [85, 120000]
    blocked = rows["MyBrand Pro"]
    assert blocked.pricing_text_snippet == (
        "Manual verified benchmark: Pro = NT$4,990 (checked N/A)."
    )
    assert blocked.notes == " robots.txt blocked automated fetch; manual price retained."
    assert rows["Gone"].crawl_status == "manual_only" and rows["Gone"].notes == "seen"
    assert rows["Gone"].pricing_text_snippet.startswith("Manual verified benchmark: Gone = NT$1,500")
    assert rows["Stopped"].notes == "old Crawl failed: timed out"
    assert rows["Stopped"].pricing_text_snippet == ""
    row = summary.first()
    assert row.pages_checked == 5 and row.verified_price_count == 3
    verified = spark.read.json(f"{tmp_path}/json/verified_prices").collect()
    assert sorted((r.price_ntd, r.records) for r in verified) == [(400, 1), (1500, 1), (4990, 1)]
    assert row.price_values_observed_ntd == [85, 400, 1200, 1500, 4990, 120000]
    assert row.percent_values_observed == [5.0] and row.product_count == 5
    assert row.benchmark_count == 3
    assert spark.read.json(f"{tmp_path}/json/benchmarks").count() == 3


def test_feeds_of_any_shape(spark):
    payloads = [
        '{"feed":{"entry":[{"im:rating":{"label":"5"},"author":1,"im:version":{"x":2}},{"title":null},3,{"im:rating":null}]}}',
        '{"feed":{"entry":{"im:rating":{"label":" 4 "},"title":{"label":7},"author":2,"updated":{"label":"x"}}}}',
        '{"feed":{}}', '{"feed":{"entry":null}}', '{"feed":{"entry":[]}}',
        '{"feed":{"entry":"text"}}', "[1]", '{"feed":', "", None,
    ]
    pages = spark.createDataFrame(list(enumerate(payloads)), "page int, payload string")
    found = {r.page: r for r in feeds.review_entries(pages).collect()}
    assert set(found) == {0, 1} and (found[0].rating, found[1].rating, found[1].title) == (5, 4, "7")
    rejects = {r.page: r.reason for r in feeds.review_rejects(pages).collect()}
    assert rejects == {
        5: "entry is neither record nor list", 6: "no feed", 7: "not JSON", 8: "not JSON", 9: "no payload",
    }
    unknown = {r.field: r.entries for r in feeds.unknown_fields(pages).collect()}
    assert unknown == {"author": 2, "im:version": 1}
    guard = ")]}'\n"
    trends = [
        guard + '{"default":{"timelineData":[{"time":"86400","hasData":true,"value":[7]},{"time":"0","hasData":true,"value":[]}]}}',
        guard + '{"default":{}}', guard + '{"default', None, '{"default":{"timelineData":[]}}',
    ]
    table = spark.createDataFrame(list(enumerate(trends)), "page int, payload string")
    assert [(r.page, str(r.week), r.interest) for r in feeds.interest_points(table).collect()] == [(0, "1970-01-02", 7)]
    assert {r.page: r.reason for r in feeds.interest_rejects(table).collect()} == {1: "no timeline", 2: "not JSON", 3: "no payload"}


def test_price_report(spark):
    found = benchmarks.records(*price_inputs(spark), ["version"]).cache()
    row = benchmarks.report_summary(found, "mybrand").first()
    assert row.pages_checked == 4 and row.median_monthly_like_price_ntd == 950
    assert row.candidate_price_values_ntd == [85, 400, 1200, 1500, 120000]
    bare = found.withColumn("manual_verified_price_ntd", F.lit(None).cast("int"))
    assert benchmarks.report_summary(bare, "mybrand").first().median_monthly_like_price_ntd == 800
    found.unpersist()


def test_price_summaries_of_many_records(spark):
    """The same columns and whole tables beyond ten thousand records."""
    sources, pages = price_inputs(spark)
    few = benchmarks.records(sources, pages, ["version"])
    many = few.crossJoin(spark.range(3000)).drop("id")
    assert benchmarks.summary(many).columns == benchmarks.summary(few).columns
    row = benchmarks.report_summary(many, "mybrand").first()
    assert row.pages_checked == 12_000 and row.product_count == 12_000
    assert benchmarks.products(many).count() == 15_000
    assert benchmarks.verified_benchmarks(many).count() == 9_000


def payload(points):
    return ")]}'\n" + json.dumps({"default": {"timelineData": points}})


def test_interest(spark, tmp_path):
    week = 7 * 86400
    points = [
        {"time": "1718323200", "hasData": True, "value": [50]},
        {"time": str(1718323200 + week), "hasData": True, "value": [80, 1]},
        {"time": str(1718323200 + 2 * week), "hasData": False, "value": [9]},
        {"time": str(1718323200 + 3 * week), "hasData": True, "value": []},
    ]
    df = spark.createDataFrame(
        [("a", payload(points)), ("b", payload(points[:1])), ("none", payload([]))],
        "keyword string, payload string",
    )
    series, summary = jobs.search_interest(df, ["a", "b", "none"], "2024-01-01 2024-12-31", "TW", str(tmp_path))
    assert sorted((r.keyword, r.week, r.interest) for r in series.collect()) == [
        ("a", dt.date(2024, 6, 14), 50), ("a", dt.date(2024, 6, 21), 80), ("b", dt.date(2024, 6, 14), 50),
    ]
    row = summary.first()
    assert row.top_keyword_by_mean_interest == "a" and row.available
    assert [tuple(x) for x in row.keyword_stats] == [("a", 65.0, 80, 80.0, 2), ("b", 50.0, 50, 50.0, 1)]
    assert row.note == "Partial Google Trends failures: none: empty timeline"
    nothing = interest.combine(spark, [], "today 12-m", "TW")
    empty = interest.summary(nothing, "2024-01-01 2024-12-31", "TW").first()
    assert empty.available is False and empty.top_keyword_by_mean_interest is None


def test_report(spark, tmp_path):
    path = str(tmp_path / "report")
    records = benchmarks.records(*price_inputs(spark), ["version"])
    signals = spark.createDataFrame(
        [("t", "b", "大安", "a", "d", None, "u", "s", True, ["pricing"], ["大安"], [9000], [])], schemas.SIGNALS
    )
    jobs.evidence_report(
        spark, "mybrand", signals, price_records=records, output=path,
        sources={"forum_summary": "signals.json"},
    )
    report = spark.read.json(path).first()
    assert report.private_interviews_used is False
    assert report.forum_summary.threads_analyzed == 1
    assert report.forum_summary.source_file == "signals.json"
    assert report.search_trends_summary.available is False
    assert report.competitor_pricing_summary.median_monthly_like_price_ntd == 950
    rows = evidence.listing(spark.read.json(path), "forum_summary.top_keywords").collect()
    assert [(r.position, r.key, r["count"]) for r in rows] == [(0, "pricing", 1)]
    nothing = jobs.evidence_report(spark, "mybrand").first()
    assert nothing.forum_summary.threads_analyzed == 0
    assert nothing.competitor_pricing_summary.available is False
    own = records.filter("product = 'MyBrand Pro'")
    only_own = jobs.evidence_report(spark, "mybrand", price_records=own).first()
    assert only_own.competitor_pricing_summary.available is True
    assert only_own.competitor_pricing_summary.pages_checked == 0


def test_documents(spark, tmp_path):
    assert documents.read_json(spark, str(tmp_path / "no"), schemas.APPS).isEmpty()
    apps = tmp_path / "apps.json"
    apps.write_text(json.dumps([{"app_name": "A", "app_id": "1", "country": "tw"}] * 2), encoding="utf-8")
    read = documents.read_json(spark, str(apps), schemas.APPS)
    assert read.count() == 2
    named = documents.with_source_file(read, str(tmp_path)).first()
    assert named.source_file == "apps.json"
    with pytest.raises(FileNotFoundError):
        documents.read_signals(spark, str(tmp_path / "no"), schemas.SIGNALS)
    rows = documents.read_signals(spark, str(apps), schemas.APPS, str(tmp_path / "no"))
    assert {r.origin for r in rows.collect()} == {"default"}
    assert signal_ops.report_summary(
        documents.read_json(spark, str(tmp_path / "no"), schemas.SIGNALS)
    ).first().threads_analyzed == 0
