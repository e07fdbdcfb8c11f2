"""Comparison SQL (DuckDB) for the registered queries, over the same table shapes."""

from __future__ import annotations

from rentscope import vocab
from workload import tables
from workload.queries import BUILDING_TYPES, CHECKED_AT, EVENT_TYPES, FIRST_DAY, GEO, SINCE, TIMEFRAME
from workload.queries import FORUM_URL, OWN_NAME

SPACE = r"[\s\x0b\x85\p{Z}]"
SPACES = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def with_(*parts: tuple[str, str], final: str) -> str:
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in parts) + "\n" + final


def text_list(values: str, mark: str = ",") -> str:
    return f"array_to_string(list_transform({values}, lambda v: cast(v as varchar)), '{mark}')"


def hundredths(values: str) -> str:
    return text_list(f"list_transform({values}, lambda h: cast(round(h * 100) as bigint))")


# --- cleaning -------------------------------------------------------------------

RAW = ("raw", tables.shape(tables.RAW_RENT))
RENTAL = (
    "rental",
    """select * replace (nullif(UPRICE, 'NA') as UPRICE, nullif(RENT_PERIOD, 'N/A') as RENT_PERIOD)
       from raw
       where CASE_T like '%租%' or RENT_TYPE like '%租%' or RENT_PERIOD like '%租%'""",
)


def number(column: str) -> str:
    return (
        f"try_cast(regexp_extract(replace({column}, ',', ''), '([-+]?[0-9]*\\.?[0-9]+)', 1) as double)"
    )


CLEAN = (
    "clean",
    f"""
    select * from (
      select district, building_type, area_ping, rent_total_ntd,
             coalesce(unit, case when area_ping > 0 then rent_total_ntd / area_ping end)
                 as rent_per_ping_ntd,
             transaction_date, has_elevator, rent_type, rent_period,
             '{vocab.RENT_SOURCE}' as source
      from (
        select DISTRICT as district, BUITYPE as building_type, {number('FAREA')} as area_ping,
               {number('UPRICE')} as unit,
               cast(round_even(coalesce({number('UPRICE')} * {number('FAREA')},
                                        {number('TPRICE')} * 10000), 0) as bigint) as rent_total_ntd,
               case when regexp_full_match(split_part(SDATE, '.', 1), '[0-9]{{7,}}') then
                 cast(try_strptime(
                   concat(cast(cast(substr(SDATE, 1, 3) as int) + 1911 as varchar), substr(SDATE, 4, 4)),
                   '%Y%m%d') as date) end as transaction_date,
               ELEVATOR as has_elevator, RENT_TYPE as rent_type, RENT_PERIOD as rent_period
        from rental))
    where district is not null and transaction_date is not null
      and area_ping > 0 and area_ping < 300 and rent_total_ntd > 3000 and rent_total_ntd < 1000000
      and rent_per_ping_ntd > 100 and rent_per_ping_ntd < 10000""",
)

SUMMARY = """
select district, count(rent_total_ntd) as sample_size,
       round_even(median(cast(rent_total_ntd as double)), 2) as median_rent_total_ntd,
       round_even(avg(rent_total_ntd), 2) as avg_rent_total_ntd,
       round_even(quantile_cont(cast(rent_total_ntd as double), 0.25), 2) as p25_rent_total_ntd,
       round_even(quantile_cont(cast(rent_total_ntd as double), 0.75), 2) as p75_rent_total_ntd,
       round_even(median(area_ping), 2) as median_area_ping,
       round_even(median(rent_per_ping_ntd), 2) as median_rent_per_ping_ntd,
       round_even(avg(rent_per_ping_ntd), 2) as avg_rent_per_ping_ntd
from clean group by district"""

# --- metrics --------------------------------------------------------------------

TX = ("tx", tables.shape(tables.TRANSACTIONS))
GOOD = (
    "good",
    """select * from tx where area_ping > 0 and area_ping < 300 and rent_ntd > 3000
       and rent_ntd < 1000000 and rent_per_ping > 100 and rent_per_ping < 10000""",
)
METRICS = (
    "metrics",
    """select district, building_type, count(rent_per_ping) as sample_size,
              median(rent_per_ping) as median_rent_per_ping,
              quantile_cont(rent_per_ping, 0.25) as p25_rent_per_ping,
              quantile_cont(rent_per_ping, 0.75) as p75_rent_per_ping,
              median(cast(rent_ntd as double)) as median_rent_ntd
       from good group by district, building_type""",
)
METRIC_ROWS = """
select district, building_type, sample_size, round(median_rent_per_ping, 6) as median_rent_per_ping,
       round(p25_rent_per_ping, 6) as p25_rent_per_ping,
       round(p75_rent_per_ping, 6) as p75_rent_per_ping, round(median_rent_ntd, 6) as median_rent_ntd
from metrics"""


def band(unit: str, area: str) -> str:
    return f"cast(round_even({unit} * {area}, 0) as bigint)"


CONFIDENCE = "least(0.95::double, greatest(0.35::double, sample_size / 20.0::double))"


def recommended(area: float) -> str:
    return f"""
select district, building_type, cast({area} as double) as area_ping,
       {band('p25_rent_per_ping', str(area) + '::double')} as recommended_rent_low,
       {band('median_rent_per_ping', str(area) + '::double')} as recommended_rent_mid,
       {band('p75_rent_per_ping', str(area) + '::double')} as recommended_rent_high,
       round({CONFIDENCE}, 6) as confidence_score
from metrics"""


def half_even_cents(value: str) -> str:
    """Two digits of a value of six, halves to the even neighbour, in whole numbers."""
    return (
        f"(select (q + case when r > 5000 or (r = 5000 and q % 2 = 1) then 1 else 0 end) / 100.0::double "
        f"from (select cast(round({value} * 1000000) as bigint) // 10000 as q, "
        f"cast(round({value} * 1000000) as bigint) % 10000 as r))"
    )


QUOTES = (
    "quotes",
    f"""
    select q.*, {CONFIDENCE} as confidence_score,
           {band('p25_rent_per_ping', 'area_ping')} as low,
           {band('median_rent_per_ping', 'area_ping')} as mid,
           {band('p75_rent_per_ping', 'area_ping')} as high
    from (
      select r.*, m.* exclude (district, building_type),
             case when not (r.area_ping > 0) then 'invalid_area'
                  when m.sample_size is null then 'not_found' else 'ok' end as status
      from ({tables.shape(tables.REQUESTS)}) r
      left join ({METRIC_ROWS}) m on r.district = m.district and r.building_type = m.building_type) q""",
)


def if_ok(expression: str, name: str) -> str:
    return f"case when status = 'ok' then {expression} end as {name}"


# --- segments ---------------------------------------------------------------------

def distance(z: str, c: int) -> str:
    return f"(({z}.z0 - c{c}_0) * ({z}.z0 - c{c}_0) + ({z}.z1 - c{c}_1) * ({z}.z1 - c{c}_1))"


def nearest() -> str:
    d = [distance("p", c) for c in range(4)]
    return (
        f"case when {d[0]} <= {d[1]} and {d[0]} <= {d[2]} and {d[0]} <= {d[3]} then 0 "
        f"when {d[1]} <= {d[2]} and {d[1]} <= {d[3]} then 1 when {d[2]} <= {d[3]} then 2 else 3 end"
    )


def kmeans(rounds: int = 10) -> list[tuple[str, str]]:
    """Scaled points, ten rounds with the early stop, and the last centroids ``last``."""
    parts = [
        (
            "scale",
            """select avg(area_ping) as m0, stddev_samp(area_ping) as s0,
                      avg(rent_per_ping) as m1, stddev_samp(rent_per_ping) as s1 from good""",
        ),
        (
            "p",
            """select district, row_key, (area_ping - m0) / s0 as z0, (rent_per_ping - m1) / s1 as z1
               from good, scale""",
        ),
        (
            "start",
            """select row_number() over (order by md5(row_key), z0, z1) - 1 as i, z0, z1 from p
               order by md5(row_key), z0, z1 limit 4""",
        ),
        (
            "k0",
            "select "
            + ", ".join(f"max(z{a}) filter (where i = {c}) as c{c}_{a}" for c in range(4) for a in (0, 1))
            + ", false as done from start",
        ),
    ]
    cells = [f"c{c}_{a}" for c in range(4) for a in (0, 1)]
    for r in range(rounds):
        means = ", ".join(
            f"coalesce(avg(z{a}) filter (where k = {c}), any_value(c{c}_{a})) as n{c}_{a}"
            for c in range(4) for a in (0, 1)
        )
        parts.append(
            (
                f"u{r}",
                f"select {means} from (select p.z0, p.z1, k{r}.*, {nearest()} as k from p, k{r})",
            )
        )
        still = " and ".join(
            f"abs({c} - n{c[1:]}) <= 1e-4 + 1e-5 * abs(n{c[1:]})" for c in cells
        )
        parts.append(
            (
                f"k{r + 1}",
                "select "
                + ", ".join(f"case when done then {c} else n{c[1:]} end as {c}" for c in cells)
                + f", done or ({still}) as done from k{r}, u{r}",
            )
        )
    parts.append(("last", f"select * from k{rounds}"))
    parts.append(
        ("assigned", f"select p.district, p.row_key, {nearest()} as cluster_id from p, last")
    )
    return parts


SEGMENTS = (
    "segments",
    " union all ".join(
        f"""select {c} as cluster_id, c{c}_0 * s0 + m0 as centroid_area_ping,
                   c{c}_1 * s1 + m1 as centroid_rent_per_ping,
                   (select count(*) from assigned where cluster_id = {c}) as sample_size
            from last, scale"""
        for c in range(4)
    ),
)

# --- posts --------------------------------------------------------------------------

ARTICLES = ("articles", tables.shape(tables.ARTICLES))
POSTS = (
    "posts",
    r"""select *, concat(title, chr(10), content) as t,
               try_strptime(trim(regexp_replace(date, '\s+', ' ', 'g')),
                 ['%a %b %d %H:%M:%S %Y', '%Y/%m/%d %H:%M', '%Y-%m-%d %H:%M:%S']) as posted_at
        from articles""",
)


def tags(column: str, patterns: dict[str, str]) -> str:
    cells = ", ".join(
        f"case when regexp_matches({column}, {quoted('(?i)' + pattern)}) then '{name}' end"
        for name, pattern in patterns.items()
    )
    return f"[{cells}]"


def names(column: str, words: list[str]) -> str:
    cells = ", ".join(f"case when contains({column}, '{w}') then '{w}' end" for w in words)
    return f"list_filter([{cells}], lambda n: n is not null)"


def keywords(column: str, patterns: dict[str, str], words: list[str]) -> str:
    both = f"list_concat({tags(column, patterns)}, {names(column, words)})"
    return f"list_sort(list_distinct(list_filter({both}, lambda w: w is not null)))"


def asks(column: str, pricing: str, words: str, marks: str) -> str:
    return (
        f"(regexp_matches({column}, '(?i){pricing}') and "
        f"(regexp_matches({column}, '{marks}') or regexp_matches({column}, '(?i){words}')))"
    )


AMOUNT = r"[0-9,.]+(?:\.[0-9]{3})?|[0-9]+(?:\.[0-9]+)?[万萬](?:[0-9]+)?"
WAN = r"([0-9]+(?:\.[0-9]+)?)[万萬]([0-9]+)?"
WORD_END = r"(?:[^\pL\pN_]|$)"


def money_token(t: str) -> str:
    return f"""case
      when regexp_matches({t}, '{WAN}') then
        round_even(try_cast(regexp_extract({t}, '{WAN}', 1) as double) * 10000
          + coalesce(try_cast(nullif(regexp_extract({t}, '{WAN}', 2), '') as double), 0) * 1000, 0)
      when regexp_full_match({t}, '[0-9]+\\.[0-9]{{3}}') then try_cast(replace({t}, '.', '') as double)
      when contains({t}, ',') then
        case when regexp_full_match(replace({t}, ',', ''), '[0-9]+')
             then try_cast(replace({t}, ',', '') as double) end
      when regexp_full_match({t}, '[0-9]+\\.?[0-9]*|\\.[0-9]+') then trunc(try_cast({t} as double)) end"""


def post_prices(t: str) -> str:
    """Look-around is spelled out: every character that is no digit is doubled, so a
    match may use up one copy as its border and leave the other to the next."""
    doubled = f"regexp_replace({t}, '([^0-9])', '\\1\\1', 'g')"
    found = [
        f"list_transform(regexp_extract_all({t}, '每月租金(?:[：:]|{SPACE})*({AMOUNT})', 1), "
        f"lambda x: {money_token('x')})",
        f"list_transform(regexp_extract_all({t}, "
        f"'(?:租金|房租|月租|價格|價錢|開價)(?:[：:]|{SPACE})*({AMOUNT})', 1), lambda x: {money_token('x')})",
        f"list_transform(regexp_extract_all({doubled}, "
        "'(?:^|[^0-9])([0-9]{1,2}\\.\\.[0-9]{3})(?:[^0-9]|$)', 1), "
        "lambda x: cast(replace(x, '.', '') as double))",
        f"list_transform(regexp_extract_all({doubled}, "
        "'(?:^|[^0-9])([0-9]{1,3}(?:,,[0-9]{3})+)(?:[^0-9]|$)', 1), "
        "lambda x: cast(replace(x, ',', '') as double))",
        f"list_transform(list_filter(regexp_extract_all({t}, '[0-9]+'), "
        "lambda x: length(x) between 4 and 6), lambda x: cast(x as double))",
        f"list_transform(regexp_extract_all({t}, '([0-9]+(?:\\.[0-9]+)?){SPACE}*[kK]{WORD_END}', 1), "
        "lambda x: round_even(cast(x as double) * 1000, 0))",
        f"list_transform(regexp_extract_all({t}, '([0-9]+(?:\\.[0-9]+)?){SPACE}*千', 1), "
        "lambda x: round_even(cast(x as double) * 1000, 0))",
        f"list_transform(regexp_extract_all({t}, '{WAN}'), lambda x: {money_token('x')})",
    ]
    every = f"flatten([{', '.join(found)}])"
    kept = f"list_filter({every}, lambda v: v between 2000 and 300000)"
    return f"list_transform(list_sort(list_distinct({kept}))[1:10], lambda v: cast(v as bigint))"


def post_areas(t: str) -> str:
    found = (
        f"list_transform(regexp_extract_all({t}, "
        f"'(?i)([0-9]+(?:\\.[0-9]+)?){SPACE}*(?:坪|ping|p){WORD_END}', 1), lambda x: cast(x as double))"
    )
    return f"list_sort(list_distinct(list_filter({found}, lambda a: a between 1 and 200)))[1:10]"


def one_line(t: str) -> str:
    return f"trim(regexp_replace({t}, '{SPACES}', ' ', 'g'))"


def snippet(t: str) -> str:
    line = one_line(t)
    return f"case when length({line}) <= 200 then {line} else concat(substr({line}, 1, 199), '…') end"


def marked(t: str) -> str:
    """Every run of digits between two marks, which stand for its borders."""
    return f"regexp_replace({t}, '([0-9]+)', concat(chr(1), '\\1', chr(2)), 'g')"


GAP = r"(?:\x02[-\s\x0b\x85\p{Z}]\x01)?"
MOBILE = rf"\x0109[0-9]{{2}}{GAP}[0-9]{{3}}{GAP}[0-9]{{3}}\x02"
PHONE = rf"{MOBILE}|\x01[0-9]{{2,4}}{GAP}[0-9]{{6,8}}\x02"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
LINE_ID = rf"(?i)(line{SPACE}*(?:id|帳號)?{SPACE}*[:：]?{SPACE}*)[A-Za-z0-9_.-]{{4,}}"


def without_phone(t: str, pattern: str) -> str:
    masked = f"regexp_replace({marked(t)}, '{pattern}', '[PHONE_REDACTED]', 'g')"
    return f"replace(replace({masked}, chr(1), ''), chr(2), '')"


def mask_post(t: str) -> str:
    mail = f"regexp_replace({without_phone(t, PHONE)}, '{EMAIL}', '[EMAIL_REDACTED]', 'g')"
    return f"regexp_replace({mail}, '{LINE_ID}', '\\1[LINE_ID_REDACTED]', 'g')"


def mask_review(t: str) -> str:
    return without_phone(f"regexp_replace({t}, '{EMAIL}', '[EMAIL_REDACTED]', 'g')", MOBILE)


SIGNALS = (
    "signals",
    f"""select doc_id, board, title, date, posted_at,
               regexp_extract(url, '/([^/]*)\\.html$', 1) as thread_id,
               {snippet('content')} as short_snippet,
               {asks('t', vocab.KEYWORDS['pricing'], vocab.QUESTION_WORDS, vocab.QUESTION_MARKS)}
                   as contains_pricing_question,
               {keywords('t', vocab.KEYWORDS, vocab.DISTRICTS)} as keywords,
               {names('t', vocab.DISTRICTS)} as districts,
               {post_prices('t')} as prices, {post_areas('t')} as areas
        from posts""",
)
STAMP = "strftime(posted_at, '%Y-%m-%dT%H:%M:%S')"
SIGNAL_ROWS = f"""
select doc_id, thread_id, board, title, {STAMP} as posted_at, short_snippet,
       contains_pricing_question, {text_list('keywords')} as keywords,
       {text_list('districts')} as districts, {text_list('prices')} as prices,
       {hundredths('areas')} as areas
from """
RECENT = f"coalesce(posted_at >= timestamp '{SINCE}', false)"
NEWEST = (
    "newest",
    f"""select * from (
          select *, row_number() over (partition by board order by posted_at desc nulls last, url) as n
          from (select *, row_number() over (partition by board, url
                    order by posted_at desc nulls last, title desc, content desc) as copy from posts)
          where copy = 1 and {RECENT})
        where n <= 10""",
)


def top_list(values: str, k: int | None, kind: str = "") -> str:
    """``key:count`` of the most frequent list elements, ties by first occurrence."""
    limit = "" if k is None else f"limit {k}"
    return f"""(select string_agg(concat(key, ':', cast(n as varchar)), ',' order by n desc, first, place)
      from (select key, count(*) as n, min(doc_id) as first, min_by(place, doc_id) as place
            from (select doc_id, unnest({values}) as key, generate_subscripts({values}, 1) as place
                  from signals) group by key order by n desc, first, place {limit}))"""


PRICES = "(select unnest(prices) as v from signals)"
FORUM = f"""
select count(*) as threads_analyzed,
       round_even(count(*) filter (where contains_pricing_question) / count(*), 3)
           as pricing_question_ratio,
       {top_list('keywords', 10)} as top_keywords, {top_list('districts', 10)} as top_districts,
       (select cast(trunc(median(cast(v as double))) as bigint) from {PRICES})
           as median_extracted_rent_ntd,
       (select count(*) from {PRICES}) as rent_mentions_observed
from signals"""
TOP_KINDS = " union all ".join(
    f"""select '{kind}' as kind, doc_id, unnest({values}) as key, generate_subscripts({values}, 1) as place
        from signals"""
    for kind, values in (("keyword", "keywords"), ("district", "districts"), ("board", "[board]"))
)

# --- reviews ------------------------------------------------------------------------

REVIEW_ROWS = (
    "reviews",
    f"""select app_name, app_id, country, review_id, title, try_cast(rating_text as int) as rating,
               updated, {mask_review('content')} as content_redacted,
               list_sort(list_filter({tags("concat(title, chr(10), content)", vocab.PAIN_POINTS)},
                                     lambda p: p is not null)) as pain_keywords,
               source_url, '{CHECKED_AT}' as collected_at
        from ({tables.shape(tables.REVIEWS)})
        where role <> 'system' and updated <> 'yesterday'
          and cast(substr(updated, 1, 10) as date) >= date '{FIRST_DAY}'""",
)
PAIN_TOP = """(select string_agg(concat(key, ':', cast(n as varchar)), ',' order by n desc, key)
   from (select key, count(*) as n from (select unnest(pain_keywords) as key from reviews)
         group by key order by n desc, key limit 10))"""
REVIEW_SUMMARY = f"""
select 'Apple App Store public RSS customer reviews' as source, '{FIRST_DAY}' as since_date,
       count(*) as reviews_collected,
       (select string_agg(concat(app_name, ':', cast(n as varchar)), ',' order by n desc, app_name)
        from (select app_name, count(*) as n from reviews group by app_name)) as apps_reviewed,
       round_even(avg(rating), 2) as average_rating, {PAIN_TOP} as top_pain_keywords
from reviews"""

# --- pages and prices -----------------------------------------------------------------


def visible(html: str) -> str:
    """Text of the driver's pages, whose scripts and styles are closed where they should be."""
    bare = html
    for name in ("script", "style", "noscript"):
        bare = f"regexp_replace({bare}, '(?is)<{name}\\b[^>]*>.*?</{name}>', '<x>', 'g')"
    bare = f"regexp_replace({bare}, '(?s)<!--.*?-->|<[!/]?[A-Za-z][^>]*>', ' ', 'g')"
    return one_line(unescaped(bare))


ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "#x27": "'", "#39": "'", "nbsp": " ", "copy": "©",
    "middot": "·", "amp": "&",
}


def unescaped(t: str) -> str:
    """Entities as signs; the semicolon may be missing where a title was cut off."""
    for entity, sign in ENTITIES.items():
        t = f"regexp_replace({t}, '&{entity}(?:;|\\b)', {quoted(sign)}, 'g')"
    return t


def page_title(html: str) -> str:
    return f"trim({unescaped(f'''regexp_extract({html}, '(?is)<title>(.*?)</title>', 1)''')})"


def page_prices(t: str) -> str:
    found = (
        f"list_transform(regexp_extract_all({t}, '[0-9]{{1,3}}(?:,[0-9]{{3}})+|[0-9]{{2,6}}'), "
        "lambda x: try_cast(replace(x, ',', '') as int))"
    )
    return f"list_sort(list_distinct(list_filter({found}, lambda v: v between 50 and 300000)))[1:30]"


def page_percents(t: str) -> str:
    found = (
        f"list_transform(regexp_extract_all({t}, '([0-9]+(?:\\.[0-9]+)?){SPACE}*%', 1), "
        "lambda x: cast(x as double))"
    )
    return f"list_sort(list_distinct(list_filter({found}, lambda v: v > 0 and v <= 100)))[1:20]"


def price_snippet(t: str) -> str:
    places = ", ".join(f"nullif(strpos({t}, '{a}'), 0)" for a in vocab.SNIPPET_ANCHORS)
    return f"substr({t}, greatest(1, coalesce(least({places}), 1) - 120), 700)"


PAGES = ("read", f"select *, {visible('html')} as page_text, {page_title('html')} as page_title "
                 f"from ({tables.shape(tables.PRICE_PAGES)})")
RECORDS = (
    "records",
    f"""
    select coalesce(nullif(product, ''), regexp_extract(s.source_url, '^[a-z]+://([^/?#]*)', 1)) as product,
           coalesce(category, 'competitor_or_analogous_product') as category, s.source_url,
           '{CHECKED_AT}' as checked_at, pricing_plan_name, manual_verified_price_ntd,
           case when status = 'crawled' then page_title end as page_title,
           list_sort(list_distinct(list_concat(
             case when status = 'crawled' then {page_prices('page_text')} else cast([] as int[]) end,
             case when manual_verified_price_ntd is not null then [manual_verified_price_ntd]
                  else cast([] as int[]) end))) as prices,
           case when status = 'crawled' then {page_percents('page_text')} else cast([] as double[]) end
               as percents,
           case when status = 'crawled' then {price_snippet('page_text')}
                when manual_verified_price_ntd is not null then
                  concat('Manual verified benchmark: ', pricing_plan_name, ' = NT$',
                         format('{{:,}}', manual_verified_price_ntd), ' (checked ',
                         coalesce(checked_date, 'N/A'), ').')
                else '' end as pricing_text_snippet,
           case status
             when 'robots_blocked' then concat(coalesce(notes, ''),
                  ' robots.txt blocked automated fetch; manual price retained.')
             when 'fetch_failed' then concat(coalesce(notes, ''), ' Crawl failed: ', crawl_error)
             else notes end as notes,
           coalesce(status, 'manual_only') as crawl_status
    from ({tables.shape(tables.PRICE_SOURCES)}) s
    left join (select *, coalesce(crawl_status, 'crawled') as status from read) p
           on s.source_url = p.source_url
    where coalesce(enabled, true)""",
)


def smallest(values: str, n: int, source: str = "records") -> str:
    return f"(select list_sort(list(distinct v))[1:{n}] from (select unnest({values}) as v from {source}))"


OTHERS = ("others", f"select * from records where not contains(lower(product), '{OWN_NAME}')")
MEDIAN_PRICE = """(select cast(trunc(coalesce(
     (select median(cast(manual_verified_price_ntd as double)) from others),
     (select median(cast(v as double)) from (select unnest(prices) as v from others)
      where v between 50 and 5000))) as bigint))"""
PRICE_REPORT = f"""
select count(*) as pages_checked, cast(count(product) as int) as products,
       cast(count(manual_verified_price_ntd) as int) as benchmarks,
       {text_list(smallest('prices', 50, 'others'))} as candidates, {MEDIAN_PRICE} as median_price
from others"""

# --- interest --------------------------------------------------------------------------

INTEREST = (
    "series",
    f"""select strftime(week, '%Y-%m-%d') as week, keyword, cast(n % 101 as int) as interest,
               'Google Trends public widget API' as source, '{TIMEFRAME}' as timeframe,
               '{GEO}' as geo, '{CHECKED_AT}' as collected_at
        from (select event_type as keyword, date_trunc('week', ts) as week, count(*) as n
              from events group by 1, 2)
        where n % 10 <> 3 and n % 10 <> 7""",
)
STATS = (
    "stats",
    """select keyword, round_even(avg(interest), 2) as mean_interest,
              max(interest) as max_interest, cast(arg_max(interest, week) as double) as latest_interest,
              count(interest) as weeks_observed, avg(interest) as raw_mean
       from series group by keyword""",
)

# --- the comparison SQL ---------------------------------------------------------------

TRANSACTION_DAY = "strftime(transaction_date, '%Y-%m-%d') as transaction_date"
POST_TEXT = "concat(title, chr(10), content)"

ORACLES = {
    "rental_rows": with_(RAW, RENTAL, final="""
        select order_key, line_number, DISTRICT, CASE_T, RENT_TYPE, RENT_PERIOD from rental"""),
    "clean_rent": with_(RAW, RENTAL, CLEAN, final=f"""
        select * replace (strftime(transaction_date, '%Y-%m-%d') as transaction_date) from clean"""),
    "ingest_rows": with_(RAW, RENTAL, CLEAN, final=f"""
        select district, building_type, area_ping, rent_total_ntd as rent_ntd,
               rent_per_ping_ntd as rent_per_ping, {TRANSACTION_DAY}, source from clean"""),
    "district_summary": with_(RAW, RENTAL, CLEAN, final=SUMMARY),
    "rent_csv_files": with_(RAW, RENTAL, CLEAN, final=SUMMARY),
    "normalised_transactions": with_(TX, final=f"""
        select district, building_type, area_ping, rent_ntd,
               case when rent_ntd % 2 = 0 then rent_per_ping else rent_ntd / area_ping end
                   as rent_per_ping,
               {TRANSACTION_DAY}, cast(null as int) as floor, cast(null as int) as building_age_years,
               '{vocab.RENT_SOURCE}' as source from tx"""),
    "plausible_transactions": with_(TX, GOOD, final=f"""
        select row_key, district, building_type, area_ping, rent_ntd,
               rent_per_ping, {TRANSACTION_DAY} from good"""),
    "district_metrics": with_(TX, GOOD, METRICS, final=METRIC_ROWS),
    "narrowed_metrics": with_(TX, GOOD, METRICS, final=METRIC_ROWS),
    "overall_quantiles": with_(TX, final="""
        select round(quantile_cont(area_ping, 0.25), 6) as p25_area_ping,
               round(median(cast(rent_ntd as double)), 6) as median_rent_ntd,
               round(quantile_cont(rent_per_ping, 0.99), 6) as p99_rent_per_ping,
               count(*) as sample_size from tx"""),
    "recommendations": with_(TX, GOOD, METRICS, final=recommended(10.0)),
    "recommendations_filtered": with_(
        TX, GOOD, METRICS, final=recommended(12.5) + " where district = 'NATION_3'"),
    "batch_quotes": with_(TX, GOOD, METRICS, QUOTES, final=f"""
        select request_id, district, building_type, area_ping, status,
               {if_ok('low', 'recommended_rent_low')}, {if_ok('mid', 'recommended_rent_mid')},
               {if_ok('high', 'recommended_rent_high')},
               {if_ok(half_even_cents('p25_rent_per_ping'), 'rent_per_ping_low')},
               {if_ok(half_even_cents('median_rent_per_ping'), 'rent_per_ping_mid')},
               {if_ok(half_even_cents('p75_rent_per_ping'), 'rent_per_ping_high')},
               {if_ok('round_even(median_rent_ntd, 0)', 'district_median_rent_ntd')},
               {if_ok('round(confidence_score, 6)', 'confidence_score')},
               {if_ok('sample_size', 'sample_size')}, {if_ok("'TWD'", 'currency')},
               {if_ok(quoted(vocab.RENT_SOURCE), 'data_source')}, {if_ok('mid', 'market_rent')},
               {if_ok("'Conservative (P25)'", 'conservative_label')}, {if_ok('high * 12', 'annual_high')}
        from quotes"""),
    "quote_breakdown": with_(TX, GOOD, METRICS, QUOTES, final=" union all ".join(
        f"""select request_id, district, building_type, area_ping, {place} as place,
                   '{label}' as strategy, {side} as monthly_rent,
                   {half_even_cents(unit)} as rent_per_ping, {side} * 12 as annual_rent
            from quotes where status = 'ok'"""
        for place, (side, unit, label) in enumerate((
            ("low", "p25_rent_per_ping", "Conservative (P25)"),
            ("mid", "median_rent_per_ping", "Market median"),
            ("high", "p75_rent_per_ping", "Aggressive (P75)"))))),
    "transactions_summary": with_(TX, final="""
        select count(*) as total_transactions, string_agg(distinct district, ',' order by district)
                   as districts,
               strftime(max(transaction_date), '%Y-%m-%dT%H:%M:%S') as latest_ingested_at from tx"""),
    "district_count": with_(TX, GOOD, final="select count(distinct district) as districts from good"),
    "dashboard_figures": with_(TX, GOOD, METRICS, final=f"""
        select count(distinct district) as districts,
               cast(trunc(median(cast(sample_size as double))) as bigint) as median_sample_size,
               round(avg({CONFIDENCE}), 6) as mean_confidence, cast(4 as bigint) as segments
        from metrics"""),
    "rent_table": with_(TX, GOOD, METRICS, final="select district, " + ", ".join(
        f"round(max(median_rent_per_ping) filter (where building_type = '{b}'), 6) as {b}"
        for b in BUILDING_TYPES) + " from metrics group by district"),
    "building_type_options": with_(TX, GOOD, final="select distinct building_type from good"),
    "metrics_listing": with_(TX, GOOD, METRICS, final=METRIC_ROWS.replace(
        "\nfrom metrics", ", true as updated_at\nfrom metrics")),
    "feature_scaling": with_(TX, GOOD, kmeans(0)[0], kmeans(0)[1], final="""
        select district, count(*) as n, round(avg(z0), 6) as z_area_ping,
               round(avg(z1), 6) as z_rent_per_ping from p group by district"""),
    "market_segments": with_(TX, GOOD, *kmeans(), SEGMENTS, final="""
        select cast(cluster_id as int) as cluster_id,
               ['budget', 'value', 'premium', 'luxury'][
                 least(4, row_number() over (order by centroid_rent_per_ping, cluster_id))]
                   as segment_label,
               round(centroid_area_ping, 4) as centroid_area_ping,
               round(centroid_rent_per_ping, 4) as centroid_rent_per_ping, sample_size
        from segments"""),
    "segment_assignments": with_(TX, GOOD, *kmeans(), final="""
        select district, cast(cluster_id as int) as cluster_id, count(*) as n
        from assigned group by 1, 2"""),
    "post_tags": with_(ARTICLES, POSTS, final=f"""
        select doc_id, {text_list(keywords('t', vocab.KEYWORDS, vocab.DISTRICTS))} as keywords,
               {text_list(names('t', vocab.DISTRICTS))} as districts,
               {asks('t', vocab.KEYWORDS['pricing'], vocab.QUESTION_WORDS, vocab.QUESTION_MARKS)}
                   as asks_price from posts"""),
    "word_tags": f"""
        select doc_id, {text_list(keywords('text', {'article': 'the|les|das', 'ending': 'tion|ing',
                                                    'number': '[0-9]{3}'}, ['and', 'Is', 'que']))}
                   as keywords,
               {asks('text', 'price|the', 'what|with', '[!?]')} as asks_price from documents""",
    "post_prices": with_(ARTICLES, POSTS, final=f"""
        select doc_id, {text_list(post_prices('t'))} as prices from posts"""),
    "post_areas": with_(ARTICLES, POSTS, final=f"""
        select doc_id, {hundredths(post_areas('t'))} as areas from posts"""),
    "post_snippets": with_(ARTICLES, final=f"""
        select doc_id, board, regexp_extract(url, '/([^/]*)\\.html$', 1) as thread_id,
               {snippet('content')} as short_snippet from articles"""),
    "redacted_posts": with_(ARTICLES, final=f"""
        select doc_id, {mask_post(f"concat({POST_TEXT}, ' Line ID：abc.def_1')")} as masked
        from articles"""),
    "post_dates": with_(ARTICLES, POSTS, final=f"""
        select doc_id, {STAMP} as posted_at, {RECENT} as recent from posts"""),
    "newest_articles": with_(ARTICLES, POSTS, NEWEST, final="select board, url, doc_id, date from newest"),
    "articles_once": with_(ARTICLES, POSTS, final="""
        select board, url, doc_id from (
          select *, row_number() over (partition by board, url
                     order by posted_at desc nulls last, doc_id desc) as copy from posts)
        where copy = 1"""),
    "kept_signals": with_(ARTICLES, POSTS, NEWEST, ("signals", SIGNALS[1].replace("from posts", "from newest")),
        final=SIGNAL_ROWS + f"""signals
        where {RECENT} and (contains_pricing_question or len(prices) > 0)
          and (len(districts) > 0 or regexp_matches(concat(title, ' ', short_snippet), '台北|臺北|新北'))"""),
    "top_tags": with_(ARTICLES, POSTS, SIGNALS, final=f"""
        select kind, cast(rank as int) as rank, key, n as count from (
          select *, row_number() over (partition by kind order by n desc, first, place) as rank
          from (select kind, key, count(*) as n, min(doc_id) as first, min_by(place, doc_id) as place
                from ({TOP_KINDS}) group by kind, key))
        where rank <= 10"""),
    "forum_summary": with_(ARTICLES, POSTS, SIGNALS, final=FORUM),
    "forum_overview": with_(ARTICLES, POSTS, SIGNALS, final=f"""
        select count(*) as threads_analyzed,
               round_even(count(*) filter (where contains_pricing_question) / count(*), 3)
                   as pricing_question_ratio,
               round_even(count(*) filter (where list_contains(keywords, 'tool')) / count(*), 3)
                   as tool_seeking_ratio,
               {top_list('keywords', 8)} as top_keywords, {top_list('districts', 8)} as top_districts,
               {top_list('[board]', None)} as boards,
               (select median(cast(v as double)) from {PRICES}) as median_extracted_rent_ntd,
               (select string_agg(concat(board, '/', title, '/',
                         cast(contains_pricing_question as varchar), '/',
                         array_to_string(districts, '+')), ';' order by doc_id)
                from (select * from signals order by doc_id limit 5)) as example_titles
        from signals"""),
    "review_signals": with_(REVIEW_ROWS, final=f"""
        select * replace ({text_list('pain_keywords')} as pain_keywords) from reviews"""),
    "review_summary": with_(REVIEW_ROWS, final=REVIEW_SUMMARY),
    "page_text": f"""
        select page_id, {page_title('html')} as page_title, {visible('html')} as page_text from pages""",
    "page_numbers": with_(PAGES, final=f"""
        select page_id, {text_list(page_prices('page_text'))} as prices,
               {hundredths(page_percents('page_text'))} as percents,
               {price_snippet('page_text')} as snippet from read"""),
    "document_numbers": f"""
        select doc_id, {text_list(page_prices('text'))} as prices,
               {hundredths(page_percents('text'))} as percents from documents""",
    "price_records": with_(PAGES, RECORDS, final=f"""
        select * exclude (prices, percents), {text_list('prices')} as extracted_price_values_ntd,
               {hundredths('percents')} as extracted_percent_values from records"""),
    "verified_benchmarks": with_(PAGES, RECORDS, final="""
        select product, pricing_plan_name, manual_verified_price_ntd, source_url from records
        where manual_verified_price_ntd is not null"""),
    "price_products": with_(PAGES, RECORDS, OTHERS, final="""
        select product, source_url from others where product is not null"""),
    "price_summary": with_(PAGES, RECORDS, final=f"""
        select count(*) as pages_checked, cast(count(product) as int) as products,
               cast(count(manual_verified_price_ntd) as int) as benchmarks,
               {text_list(smallest('prices', 50))} as prices,
               {text_list(smallest('[manual_verified_price_ntd]', 1000000).replace(
                   'from records', 'from records where manual_verified_price_ntd is not null'))}
                   as verified_prices,
               {hundredths(smallest('percents', 30))} as percents from records"""),
    "price_report": with_(PAGES, RECORDS, OTHERS, final=PRICE_REPORT),
    "index_pages": with_(ARTICLES, final=f"""
        select doc_id, board, concat('{FORUM_URL}/bbs/p', cast(doc_id as varchar), '.html')
                   as previous_url, cast(0 as int) as position, trim(title) as title, url, author,
               trim(date) as date
        from articles where doc_id % 5 <> 0"""),
    "post_pages": with_(ARTICLES, final=f"""
        select doc_id, case when doc_id % 3 <> 0 then author end as author,
               case when doc_id % 3 <> 0 then board end as board,
               case when doc_id % 3 <> 0 then '標題' else title end as title, date,
               {mask_post("regexp_replace(regexp_replace(split_part(split_part(content, '※ 發信站:', 1), '--', 1), '\\n{3,}', chr(10) || chr(10), 'g'), '^" + SPACES + "|" + SPACES + "$', '', 'g')")}
                   as content
        from articles"""),
    "interest_series": with_(INTEREST, final="select * from series"),
    "interest_stats": with_(INTEREST, STATS, final="select * exclude (raw_mean) from stats"),
    "interest_summary": with_(INTEREST, STATS, final=f"""
        select 'Google Trends' as source,
               'Google Trends public widget API (interest_over_time)' as method,
               '{TIMEFRAME}' as timeframe, '{GEO}' as geo, '{",".join(EVENT_TYPES)}' as keywords,
               arg_max(keyword, raw_mean) as top_keyword_by_mean_interest,
               string_agg(concat(keyword, ':', cast(max_interest as varchar), ':',
                                 cast(weeks_observed as varchar)), ',' order by raw_mean desc, keyword)
                   as keyword_stats,
               'Google Trends values are relative search interest scores from 0 to 100, not absolute search volume.'
                   as note, true as available from stats"""),
    "evidence_report": with_(
        ARTICLES, POSTS, SIGNALS, INTEREST, STATS, REVIEW_ROWS, PAGES, RECORDS, OTHERS,
        ("forum", FORUM), ("app", REVIEW_SUMMARY), ("price", PRICE_REPORT),
        final="""
        select false as private_interviews_used, threads_analyzed, pricing_question_ratio, top_keywords,
               median_extracted_rent_ntd, rent_mentions_observed,
               (select arg_max(keyword, raw_mean) from stats) as top_keyword_by_mean_interest,
               (select cast(count(*) as int) from stats) as keywords,
               reviews_collected, average_rating, top_pain_keywords, pages_checked, candidates,
               median_price
        from forum, app, price"""),
    "report_districts": with_(ARTICLES, POSTS, SIGNALS, final="""
        select cast(row_number() over (order by n desc, first, place) - 1 as int) as position,
               key, n as count
        from (select key, count(*) as n, min(doc_id) as first, min_by(place, doc_id) as place
              from (select doc_id, unnest(districts) as key, generate_subscripts(districts, 1) as place
                    from signals) group by key order by n desc, first, place limit 10)"""),
    "loaded_open_data": with_(RAW, RENTAL, CLEAN, final="""
        select count(*) as stored, cast(sum(rent_total_ntd) as bigint) as rent_ntd,
               count(*) as csv_rows, count(*) as ingested, count(distinct district) as districts
        from clean"""),
    "price_source_files": f"""
        select concat('folder=', pricing_plan_name) as folder, count(*) as n, count(product) as named,
               cast(sum(manual_verified_price_ntd) as bigint) as verified
        from ({tables.shape(tables.PRICE_SOURCES)}) where coalesce(enabled, true) group by 1""",
    "stored_transactions": with_(TX, final="""
        select district, building_type, count(*) as n, cast(sum(rent_ntd) as bigint) as rent_ntd,
               round(sum(rent_per_ping), 2) as rent_per_ping,
               strftime(max(transaction_date), '%Y-%m-%d') as latest
        from (select * from tx union all select * from tx where area_ping < 10)
        group by district, building_type"""),
    "metrics_pipeline": with_(TX, GOOD, METRICS, final=f"""
        select count(*) as recommendations,
               cast(sum({band('median_rent_per_ping', '10.0::double')}) as bigint) as mid_rents,
               cast(sum(sample_size) as bigint) as transactions, cast(4 as bigint) as clusters,
               cast(sum(sample_size) as bigint) as clustered from metrics"""),
    "snapshots": with_(TX, GOOD, METRICS, final=f"""
        select count(*) as recommendations,
               cast(sum({band('p75_rent_per_ping', '10.0::double')}) as bigint) as high_rents,
               cast(sum(sample_size) as bigint) as clustered,
               (select count(*) from tx) as total_transactions,
               (select cast(count(distinct district) as int) from tx) as districts,
               cast(0 as bigint) as absent_rows from metrics"""),
    "signal_files": with_(ARTICLES, ("articles_once", """
        select * exclude (copy) from (
          select *, row_number() over (partition by board, url order by
              try_strptime(trim(regexp_replace(date, '\\s+', ' ', 'g')),
                ['%a %b %d %H:%M:%S %Y', '%Y/%m/%d %H:%M', '%Y-%m-%d %H:%M:%S']) desc nulls last,
              title desc, content desc) as copy from articles) where copy = 1"""),
        ("posts", POSTS[1].replace("from articles", "from articles_once")), SIGNALS, final=f"""
        select doc_id, {text_list('keywords')} as keywords,
               concat('[', array_to_string(list_transform(keywords, lambda w: concat('"', w, '"')), ','),
                      ']') as keywords_json,
               {text_list('prices')} as prices, 'default' as origin
        from signals where contains_pricing_question or len(prices) > 0"""),
    "streamed_transactions": with_(TX, final="""
        select district, count(*) as n, cast(sum(rent_ntd) as bigint) as rent_ntd from tx
        group by district"""),
}

# Files and tables read back hold what the same operators return.
ORACLES |= {
    "review_files": ORACLES["review_signals"],
    "price_files": f"select * exclude (checked_at) from ({ORACLES['price_records']})",
    "interest_files": f"""
        select * replace (concat(keywords, ',nothing') as keywords,
                          'Partial Google Trends failures: nothing: empty timeline' as note),
               (select count(*) from ({ORACLES['interest_series']})) as csv_rows
        from ({ORACLES['interest_summary']})""",
    "stored_segments": ORACLES["market_segments"],
    "appended_metrics": ORACLES["district_metrics"],
    "rejected_pages": f"""
        select app_name, case when role = 'system' then 'not JSON' when title = 'ok' then 'no feed'
                 when updated = 'yesterday' then 'entry is neither record nor list'
                 when title = '租金太貴' then 'no payload' else 'read' end as reason, count(*) as n
        from ({tables.shape(tables.REVIEWS)}) group by 1, 2""",
    "rejected_payloads": """
        select keyword, count(*) as payloads, count(*) filter (where n % 10 in (3, 7)) as rejected
        from (select event_type as keyword, date_trunc('week', ts) as week, count(*) as n
              from events group by 1, 2)
        group by keyword""",
    "recent_signals": ORACLES["kept_signals"],
    "recent_reviews": ORACLES["review_signals"],
    "relative_interest": ORACLES["interest_series"].replace(TIMEFRAME, "2025-06-14 2026-06-14"),
    "report_head": f"select * from ({ORACLES['report_districts']}) where position < 3",
}
