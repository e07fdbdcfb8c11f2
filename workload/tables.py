"""The driver's tables in the shapes the engine works on.

Each shape is one portable SELECT, run by Spark here and repeated as a subquery by
the comparison SQL, so both sides start from the same rows. Feed pages and trend
payloads are JSON text and are built by Spark only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope import vocab
from rentscope.session import spread

# Each of the driver's files holds a single row group, which one core would read alone.
LARGE = {"lineitem", "documents", "pages", "conversations"}
BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TRANSACTIONS = """
select concat(cast(l_orderkey as string), '-', cast(l_partkey as string), '-',
              cast(l_suppkey as string), '-', cast(l_linenumber as string)) as row_key,
       n_name as district, p_type as building_type, l_quantity as area_ping,
       cast(floor(l_extendedprice) as bigint) as rent_ntd,
       l_extendedprice / l_quantity as rent_per_ping,
       cast(l_shipdate as date) as transaction_date
from {lineitem}
join {part} on l_partkey = p_partkey
join {supplier} on l_suppkey = s_suppkey
join {nation} on s_nationkey = n_nationkey
"""

RAW_RENT = """
select l_orderkey as order_key, l_linenumber as line_number,
       case when l_linenumber = 4 and l_returnflag = 'R' then null else n_name end as DISTRICT,
       p_type as BUITYPE,
       concat(cast(cast(l_quantity as bigint) as string), ' 坪') as FAREA,
       concat(cast(cast(floor(l_extendedprice / 10000) as bigint) as string), '.',
              lpad(cast(cast(floor(l_extendedprice / 100) as bigint) % 100 as string), 2, '0'))
           as TPRICE,
       case when l_returnflag = 'A' then null when l_returnflag = 'N' then 'NA'
            when l_extendedprice / l_quantity >= 1000 then
              concat(cast(cast(floor(l_extendedprice / l_quantity / 1000) as bigint) as string), ',',
                     lpad(cast(cast(floor(l_extendedprice / l_quantity) as bigint) % 1000 as string),
                          3, '0'))
            else cast(cast(floor(l_extendedprice / l_quantity) as bigint) as string) end as UPRICE,
       concat(lpad(cast(year(l_shipdate) - 1911 as string), 3, '0'),
              lpad(cast(case when l_linenumber = 7 then 13 else month(l_shipdate) end as string), 2, '0'),
              case when l_linenumber = 5 and l_returnflag = 'N' then ''
                   else lpad(cast(day(l_shipdate) as string), 2, '0') end,
              case when l_linenumber = 6 then '.0' else '' end) as SDATE,
       case when l_linestatus = 'O' then '租賃房屋' else '買賣' end as CASE_T,
       case when l_linenumber in (1, 2) then '整棟(戶)出租' end as RENT_TYPE,
       case when l_linenumber = 3 then 'N/A' else '一年' end as RENT_PERIOD,
       case when l_suppkey % 2 = 0 then '有' else '無' end as ELEVATOR
from {lineitem}
join {part} on l_partkey = p_partkey
join {supplier} on l_suppkey = s_suppkey
join {nation} on s_nationkey = n_nationkey
"""

REQUESTS = """
select o_orderkey as request_id, n_name as district,
       case o_orderpriority when '1-URGENT' then 'ECONOMY' when '2-HIGH' then 'SMALL'
            when '3-MEDIUM' then 'LARGE' when '4-NOT SPECIFIED' then 'PROMO' else 'CASTLE' end
           as building_type,
       cast(o_orderkey % 41 as double) - 1.5 as area_ping
from {orders}
join {customer} on o_custkey = c_custkey
join {nation} on c_nationkey = n_nationkey
"""

_NAMES = " ".join(f"when {i} then '{name}'" for i, name in enumerate(vocab.DISTRICTS))

ARTICLES = f"""
select doc_id, source as board,
       case doc_id % 6
         when 0 then concat('每月租金：', cast(10 + doc_id % 20 as string), '.',
                            lpad(cast(doc_id % 1000 as string), 3, '0'), '，',
                            cast(5 + doc_id % 30 as string), '坪 ')
         when 1 then concat(case doc_id % 35 {_NAMES} end, '區整層住家 租金',
                            cast(8000 + n_chars % 20000 as string), '元，',
                            cast(5 + doc_id % 30 as string), '.5 ping 請問行情合理嗎')
         when 2 then concat(case (doc_id + 11) % 35 {_NAMES} end, '公寓出租 ',
                            cast(5 + doc_id % 25 as string), 'k 近捷運，開價 12,',
                            lpad(cast(doc_id % 1000 as string), 3, '0'))
         when 3 then concat('電梯大樓 月租', cast(1 + doc_id % 3 as string), '.',
                            cast(doc_id % 10 as string), '萬 或 2萬', cast(doc_id % 10 as string))
         when 4 then concat('台北 ', cast(6 + doc_id % 20 as string), '千 附近行情多少？房租網站')
         else 'notes' end as title,
       concat('author', cast(doc_id % 97 as string)) as author,
       case doc_id % 4
         when 0 then concat('Wed Jul ', lpad(cast(1 + doc_id % 28 as string), 2, ' '),
                            ' 21:06:35 ', cast(2016 + doc_id % 9 as string))
         when 1 then concat(cast(2016 + doc_id % 9 as string), '/07/',
                            lpad(cast(1 + doc_id % 28 as string), 2, '0'), ' 08:05')
         when 2 then concat(cast(2016 + doc_id % 9 as string), '-07-',
                            lpad(cast(1 + doc_id % 28 as string), 2, '0'), ' 10:11:12')
         else '7/26' end as date,
       concat('https://forum.example/bbs/', source, '/M.', cast(doc_id % 700 as string), '.A.html')
           as url,
       text as content
from {{documents}}
"""

REVIEWS = """
select conv_id, turn, concat('App ', cast(conv_id % 3 as string)) as app_name,
       cast(100 + conv_id % 3 as string) as app_id, 'tw' as country,
       concat(cast(conv_id as string), '-', cast(turn as string)) as review_id,
       case conv_id % 6 when 0 then '租金太貴' when 1 then '廣告很多 詐騙' when 2 then '搜尋 地圖'
            when 3 then '資訊過期' when 4 then '客服不回覆 0912-345-678' else 'ok' end as title,
       case when turn % 7 = 6 then 'n/a' else cast(1 + turn % 5 as string) end as rating_text,
       case when conv_id % 10 = 9 then 'yesterday' else
         concat('2024-', lpad(cast(1 + conv_id % 12 as string), 2, '0'), '-',
                lpad(cast(1 + turn % 28 as string), 2, '0'), 'T23:00:00-07:00') end as updated,
       concat('https://apps.example/', cast(conv_id as string)) as source_url,
       role, concat(text, case when turn % 3 = 0 then ' me.user@mail.example 0911 222 333' else '' end)
           as content
from {conversations}
"""

PRICE_SOURCES = """
select case when page_id % 7 = 0 then null when page_id % 7 = 1 then 'RentPilot Pro'
            else concat('Product ', cast(page_id % 50 as string)) end as product,
       case when page_id % 3 = 0 then null else 'listing_platform' end as category,
       case when page_id % 5 = 4 then concat(url, '/gone') else url end as source_url,
       concat('Plan ', cast(page_id % 4 as string)) as pricing_plan_name,
       cast(case when page_id % 3 = 0 then 990 + page_id % 900 end as int)
           as manual_verified_price_ntd,
       case when page_id % 2 = 0 then '2026-06-14' end as checked_date,
       case when page_id % 9 = 0 then null else concat('note ', cast(page_id as string)) end as notes,
       case page_id % 4 when 3 then false when 2 then null else true end as enabled
from {pages}
"""

PRICE_PAGES = """
select page_id, url as source_url,
       replace(html, '</article>', concat('<p>方案 A<br>NT$1,', lpad(cast(page_id % 1000 as string), 3, '0'),
               ' 元 / 月 &amp; 抽成 ', cast(1 + page_id % 30 as string), '.5%</p></article>')) as html,
       case when page_id % 11 = 10 then 'fetch_failed' when page_id % 13 = 12 then 'robots_blocked'
            end as crawl_status,
       case when page_id % 11 = 10 then 'timed out' end as crawl_error
from {pages}
"""


def shape(sql: str) -> str:
    """The SELECT over the bare table names, for the comparison SQL."""
    return sql.format(**{name: name for name in BASE})


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(scan) if name in LARGE else scan


def table(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The SELECT over the driver's tables."""
    frames = {name: base(spark, sf_dir, name) for name in BASE if "{" + name + "}" in sql}
    return spark.sql(sql, **frames)


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed page per turn; odd conversations hold their entry without a list, and
    entries of the system describe the app and have no rating."""
    rows = table(spark, sf_dir, REVIEWS)

    def labelled(value):
        return F.struct(value.alias("label"))

    entry = F.struct(
        F.when(F.col("role") != "system", labelled(F.col("rating_text"))).alias("im:rating"),
        labelled(F.col("title")).alias("title"),
        labelled(F.col("content")).alias("content"),
        labelled(F.col("updated")).alias("updated"),
        labelled(F.col("review_id")).alias("id"),
        F.struct(F.struct(F.col("source_url").alias("href")).alias("attributes")).alias("link"),
    )

    def page(inner):
        return F.to_json(F.struct(F.struct(inner.alias("entry")).alias("feed")))

    payload = F.when(F.col("conv_id") % 2 == 0, page(F.array(entry))).otherwise(page(entry))
    return rows.select("app_id", payload.alias("payload"))


def apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The apps the reviews are about; the country is left to its default."""
    unset = F.lit(None).cast("string").alias("country")
    return table(spark, sf_dir, REVIEWS).select("app_name", "app_id", unset).distinct()


def trend_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One guarded payload per event type and week; its interest is the week's events."""
    week = F.to_date(F.date_trunc("week", "ts"))
    weekly = (
        base(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("keyword"), week.alias("week"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    point = F.struct(
        (F.datediff("week", F.lit("1970-01-01")).cast("bigint") * 86400).cast("string").alias("time"),
        (F.col("n") % 10 != 3).alias("hasData"),
        F.when(F.col("n") % 10 != 7, F.array((F.col("n") % 101).cast("int")))
        .otherwise(F.array().cast("array<int>"))
        .alias("value"),
    )
    document = F.struct(F.struct(F.array(point).alias("timelineData")).alias("default"))
    guarded = F.concat(F.lit(vocab.JSON_GUARD + "\n"), F.to_json(document))
    return weekly.select("keyword", guarded.alias("payload"))
