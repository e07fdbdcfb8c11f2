"""Table schemas."""

from __future__ import annotations

RAW_RENT_COLUMNS = [
    "DISTRICT", "BUITYPE", "FAREA", "TPRICE", "UPRICE", "SDATE", "CASE_T", "CASE_F",
    "RENT_TYPE", "RENT_PERIOD", "ELEVATOR",
]

TRANSACTIONS = (
    "district string, building_type string, area_ping double, rent_ntd bigint, "
    "rent_per_ping double, transaction_date date, floor int, building_age_years int, "
    "source string, ingested_at timestamp"
)
METRICS = (
    "district string, building_type string, sample_size bigint, median_rent_per_ping double, "
    "p25_rent_per_ping double, p75_rent_per_ping double, median_rent_ntd double, "
    "updated_at timestamp"
)
RECOMMENDATIONS = (
    "district string, building_type string, area_ping double, recommended_rent_low bigint, "
    "recommended_rent_mid bigint, recommended_rent_high bigint, confidence_score double, "
    "updated_at timestamp"
)
CLUSTERS = (
    "cluster_id int, segment_label string, centroid_area_ping double, "
    "centroid_rent_per_ping double, sample_size bigint, updated_at timestamp"
)
TRANSACTIONS_SUMMARY = (
    "total_transactions bigint, districts array<string>, latest_ingested_at timestamp"
)
ARTICLES = (
    "board string, title string, author string, date string, url string, content string"
)
SIGNALS = (
    "thread_id string, board string, title string, author string, date string, "
    "posted_at timestamp, url string, short_snippet string, contains_pricing_question boolean, "
    "keywords array<string>, districts array<string>, extracted_prices_ntd array<bigint>, "
    "extracted_areas_ping array<double>"
)
APPS = "app_name string, app_id string, country string"
REVIEWS = (
    "app_name string, app_id string, country string, review_id string, title string, "
    "rating int, updated string, content_redacted string, pain_keywords array<string>, "
    "source_url string, collected_at string"
)
INTEREST = (
    "week date, keyword string, interest int, source string, timeframe string, geo string, "
    "collected_at string"
)
PRICE_SOURCES = (
    "product string, category string, source_url string, pricing_plan_name string, "
    "manual_verified_price_ntd int, checked_date string, notes string, enabled boolean"
)
PRICE_RECORDS = (
    "product string, category string, source_url string, checked_at string, "
    "pricing_plan_name string, manual_verified_price_ntd int, page_title string, "
    "extracted_price_values_ntd array<int>, extracted_percent_values array<double>, "
    "pricing_text_snippet string, notes string, crawl_status string"
)

REVIEW_ENTRIES = (
    "array<struct<`im:rating`:struct<label:string>, title:struct<label:string>, "
    "content:struct<label:string>, updated:struct<label:string>, id:struct<label:string>, "
    "link:struct<attributes:struct<href:string>>>>"
)
TREND_PAYLOAD = (
    "`default` struct<timelineData:array<struct<time:string, hasData:boolean, value:array<int>>>>"
)

COUNTS = "array<struct<key:string, count:bigint>>"
