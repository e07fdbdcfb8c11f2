"""Names, patterns and limits that decide what the engine computes.

Patterns are Java regular expressions. ``SPACE`` lists Unicode white space and
``WORD_END`` is a Unicode word border, so that the slow ``(?U)`` mode is not needed;
full-width digits are turned into ASCII ones before a number pattern is applied.
Every dictionary here is a default: the operators take other dictionaries.
"""

# --- fixed values: district names, order significant -------------------------
CITY_DISTRICTS = [
    "中正", "大同", "中山", "松山", "大安", "萬華", "信義", "士林", "北投", "內湖", "南港", "文山",
]
SUBURB_DISTRICTS = [
    "板橋", "三重", "中和", "永和", "新莊", "新店", "土城", "蘆洲", "汐止", "樹林", "淡水", "五股",
    "泰山", "林口", "深坑", "石碇", "坪林", "三峽", "鶯歌", "瑞芳", "八里", "金山", "萬里",
]
DISTRICTS = CITY_DISTRICTS + SUBURB_DISTRICTS
CITY_NAMES = ["台北", "臺北", "新北"]

# --- fixed values: forum keyword categories -----------------------------------
KEYWORDS = {
    "pricing": "租金|房租|價格|價錢|開價|月租|租多少",
    "reasonable": "合理|划算|太貴|太高|貴嗎|便宜|行情",
    "comparable": "比較|參考|附近|周邊|同區|實價|行情",
    "vacancy": "空租|空置|租不掉|沒人看|降租",
    "landlord": "房東|出租|租客|租約",
    "tool": "工具|網站|平台|app|APP|系統|估價",
    "elevator": "電梯|華廈|大樓",
    "walkup": "公寓|爬樓梯|無電梯",
    "studio": "套房|雅房|分租|整層|獨立",
    "renovation": "裝潢|翻新|整理|新裝",
}
QUESTION_MARKS = "[?？]"
QUESTION_WORDS = "多少|合理|行情|太貴|太高|便宜|估價|怎麼定|如何定|會不會太貴"

# --- fixed values: review complaint categories ---------------------------------
PAIN_POINTS = {
    "pricing": "價格|租金|房租|太貴|行情|實價|價錢",
    "trust": "假|詐騙|不實|騙|仲介|廣告|真實",
    "search_quality": "搜尋|篩選|地圖|定位|找不到|排序",
    "data_quality": "更新|過期|重複|資訊|資料|照片",
    "ads": "廣告|付費|收費|會員|置頂",
    "contact": "聯絡|電話|訊息|客服|回覆",
}

# --- fixed values: money, area and percent patterns ----------------------------
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_END = r"(?![\p{L}\p{N}_])"
# Signs from here on (CJK, full-width forms and beyond) are called wide. Labels and units of
# amounts are made of wide signs, but for k, p and ping; ``functions.text.gist`` rests on that.
FIRST_WIDE = 0x2E80
AMOUNT = r"[\d,.]+(?:\.\d{3})?|\d+(?:\.\d+)?[万萬](?:\d+)?"
MONTHLY_RENT_LABEL = rf"每月租金[：:{SPACE}]*({AMOUNT})"
MONEY_LABEL = rf"(?:租金|房租|月租|價格|價錢|開價)[：:{SPACE}]*({AMOUNT})"
DOT_THOUSANDS = r"(?<!\d)(\d{1,2}\.\d{3})(?!\d)"
COMMA_THOUSANDS = r"(?<!\d)(\d{1,3}(?:,\d{3})+)(?!\d)"
PLAIN_AMOUNT = r"(?<!\d)(\d{4,6})(?!\d)"
K_AMOUNT = rf"(\d+(?:\.\d+)?)[{SPACE}]*[kK]{WORD_END}"
QIAN_AMOUNT = rf"(\d+(?:\.\d+)?)[{SPACE}]*千"
WAN_AMOUNT = r"(\d+(?:\.\d+)?)[万萬](\d+)?"
AREA = rf"(?iu)(\d+(?:\.\d+)?)[{SPACE}]*(?:坪|ping|p){WORD_END}"
PAGE_PRICE = r"(\d{1,3}(?:,\d{3})+|\d{2,6})"
PERCENT = rf"(\d+(?:\.\d+)?)[{SPACE}]*%"
NUMBER = r"([-+]?\d*\.?\d+)"
# Left out of COMMA_THOUSANDS, PLAIN_AMOUNT and PAGE_PRICE: the optional currency
# word before and unit after the number. They hold no digit, so they change neither
# where a match starts nor what it captures.

# --- fixed values: personal data patterns and their replacements ----------------
DIGIT = "[0-9０-９]"
MOBILE = rf"(?<!{DIGIT})09{DIGIT}{{2}}[-{SPACE}]?{DIGIT}{{3}}[-{SPACE}]?{DIGIT}{{3}}(?!{DIGIT})"
# A number's first digit comes before the look behind it, so that other signs are passed over at once.
PHONE = (
    rf"{DIGIT}(?<!{DIGIT}{DIGIT})(?:(?<=0)9{DIGIT}{{2}}[-{SPACE}]?{DIGIT}{{3}}[-{SPACE}]?{DIGIT}{{3}}"
    rf"|{DIGIT}{{1,3}}[-{SPACE}]?{DIGIT}{{6,8}})(?!{DIGIT})"
)
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
LINE_ID = rf"(?iu)(line[{SPACE}]*(?:id|帳號)?[{SPACE}]*[:：]?[{SPACE}]*)[A-Za-z0-9_.-]{{4,}}"
PHONE_MASK = "[PHONE_REDACTED]"
EMAIL_MASK = "[EMAIL_REDACTED]"
LINE_ID_MASK = "[LINE_ID_REDACTED]"

# --- fixed values: limits --------------------------------------------------------
RENT_RANGE = (2000, 300000)
AREA_RANGE = (1, 200)
PAGE_PRICE_RANGE = (50, 300000)
MONTHLY_FEE_RANGE = (50, 5000)

# --- fixed values: page snippet anchors, post cut marks, missing-value words -----
SNIPPET_ANCHORS = ["價格", "費用", "方案", "月", "元", "收費", "租金", "抽成", "刊登"]
POST_ORIGIN_MARK = "※ 發信站:"
POST_SIGNATURE_MARK = "--"
PREVIOUS_PAGE_LABEL = "上頁"
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: segments, sources, defaults ------------------------------------
SEGMENT_LABELS = ["budget", "value", "premium", "luxury"]
RENTAL_WORD = "租"
RENTAL_COLUMNS = ["CASE_T", "CASE_F", "RENT_TYPE", "RENT_PERIOD"]
RENT_SOURCE = "taipei_open_data_real_price_weekly"
CURRENCY = "TWD"
DEFAULT_CATEGORY = "competitor_or_analogous_product"
DEFAULT_BOARDS = ["Rent_apart", "rent_tao", "Rent_ya", "home-sale"]
DEFAULT_TREND_KEYWORDS = ["台北租金", "租屋行情", "租金行情", "實價登錄租賃", "租屋價格"]
JSON_GUARD = ")]}'"
QUOTE_TIERS = [
    ("conservative", "Conservative (P25)",
     "Lower vacancy risk; suitable when you need a tenant quickly."),
    ("market", "Market median",
     "Balanced target based on recent comparable transactions."),
    ("aggressive", "Aggressive (P75)",
     "Higher upside, but may lengthen vacancy if the unit is average."),
]

# Texts of the price summary.
PRICE_SOURCE = "Current public competitor / analogous pricing pages"
PRICE_NOTE = (
    "Manual verified prices are checked against public pages. "
    "Extracted numbers are candidates and should be cited with source URLs."
)

# Texts of the review summary.
REVIEW_SOURCE = "Apple App Store public RSS customer reviews"
REVIEW_NOTE = (
    "Reviews are public user-generated content and are treated as qualitative "
    "demand/pain-point evidence, not as interviews."
)

# Texts of the search-interest table and its summary.
INTEREST_SERIES_SOURCE = "Google Trends public widget API"
INTEREST_SOURCE = "Google Trends"
INTEREST_METHOD = "Google Trends public widget API (interest_over_time)"
INTEREST_FAILED = "Google Trends request failed: "
INTEREST_PARTIAL = "Partial Google Trends failures: "
INTEREST_NOTE = (
    "Google Trends values are relative search interest scores from 0 to 100, "
    "not absolute search volume."
)

# Days that two years back are, for posts and for reviews.
POST_DAYS, REVIEW_DAYS = 730, 730
