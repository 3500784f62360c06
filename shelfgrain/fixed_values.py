"""Lists, tables and patterns whose exact content decides results.

They are stated as plain text because the collected payloads and pages use them.
Every function that needs one takes it as a default argument.
"""

# --- sentiment labels and thresholds -------------------------------------------------
POSITIVE = "positive"
NEUTRAL = "neutral"
NEGATIVE = "negative"
STAR_POSITIVE_FROM = 4
STAR_NEGATIVE_UPTO = 2
THRESH_POS = 0.6
THRESH_NEG = 0.4
MAX_LEN = 128

# --- category code -> name of the ranking shop ---------------------------------------
RANKING_CATEGORIES = {
    "104000": "전체",
    "104001": "스킨케어",
    "104013": "마스크팩",
    "104014": "베이스메이크업",
    "104015": "립메이크업",
    "104016": "아이메이크업",
    "104017": "네일",
    "104005": "프레그런스",
    "104002": "선케어",
    "104003": "클렌징/필링",
    "104006": "헤어케어",
    "104007": "바디케어",
    "104009": "쉐이빙/제모",
    "104010": "뷰티 디바이스/소품",
    "104011": "미용소품",
    "104012": "헬스/푸드",
}

# --- category name -> id of the card shop --------------------------------------------
CARD_CATEGORIES = {
    "전체": "20006491",
    "스킨케어": "20006492",
    "선케어": "20006505",
    "마스크_팩": "20006513",
    "클렌징": "20006522",
    "메이크업": "20006536",
    "네일케어": "20006567",
    "바디케어": "20006585",
    "헤어케어": "20006612",
    "뷰티소품": "20006651",
    "향수": "20006681",
    "맨즈케어": "20006688",
    "뷰티디바이스": "20006713",
    "키즈": "20006719",
}

# --- request options -----------------------------------------------------------------
REVIEW_SORTS = ["최신순", "랭킹순", "평점 높은순", "평점 낮은순"]
PRODUCT_SORTS = ["POPULARITY", "PRICE_LOW", "PRICE_HIGH", "REVIEW", "RECENT", "SALE", "RATING"]
FORCED_SORT = "DISPLAY_CATEGORY_GENDER_AGE_GROUP_F20"
RECOMMEND_SORT = "up_cnt_desc"
PROBE_PAGES = [1, 10, 50, 100, 200, 500, 1000]
PAGE_SIZE = 20
GRID_PAGE_SIZE = 24
PAGES_PER_BATCH = 10
EMPTY_PAGES_TO_STOP = 3

# --- payload node types --------------------------------------------------------------
LIST_MODULE = "MULTICOLUMN"
PRODUCT_NODE = "PRODUCT_COLUMN"
PAYLOAD_PATHS = [
    ["data", "category", "cards"],
    ["data", "window", "cards"],
    ["data", "products"],
    ["data", "items"],
    ["data", "results"],
]

# --- label texts ---------------------------------------------------------------------
VIEWING_PHRASE = "명이 보는 중"
VIEWERS_PLAIN = r"(\d+)명이 보는 중"
VIEWERS_COMMA = r"([\d,]+)명이 보는 중"
SALES_THOUSANDS = r"판매 ([\d.]+)천개"
COUNT_IN_PARENS = r"\(([0-9,]+)(\+?)\)"
WIDTH_PERCENT = r"width:\s*([\d.]+)\s*%"
WON = "원"
OFFLINE_MARKER = "ico_offlineStore"
OFFLINE = "매장"
ONLINE = "온라인"
MISSING = "N/A"
OPINION_WORDS = ["좋아요", "만족", "추천", "괜찮", "별로"]
RATING_WORDS = ["평점", "rating", "별점"]
CHALLENGE_MARKERS = ["Just a moment", "Checking your browser"]
PRICE_EDGES = [10000, 30000, 50000]
PRICE_LABELS = ["1만원 미만", "1-3만원", "3-5만원", "5만원 이상"]

# --- class names of the HTML shops ---------------------------------------------------
LISTING_SELECTORS = [
    ("div", "prd_info"),
    ("li", "prd_item"),
    ("div", "item"),
    ("div", "product"),
    ("li", "item"),
    ("article", None),
    ("div", "goods-list-item"),
]
REVIEW_CONTAINERS = ["prd_social_info", "review_wrap", "review_list", "prd_review_wrap"]
REVIEW_BLOCK_WORDS = ["review", "comment", "item"]
GENERIC_RATING = [("span", "rating"), ("span", "star"), ("span", "score"), ("span", "point"), ("div", "rating")]
GENERIC_TITLE = [("h3", "title"), ("div", "title"), ("span", "title"), ("p", "title")]
GENERIC_CONTENT = [("div", "content"), ("div", "comment"), ("p", "content"), ("span", "content"), ("div", "text"), ("p", "review")]
GENERIC_AUTHOR = [("span", "author"), ("span", "user"), ("span", "name"), ("span", "writer"), ("div", "user")]
GENERIC_DATE = [("span", "date"), ("span", "time"), ("div", "date"), ("p", "date")]
GENERIC_HELPFUL = [("span", "helpful"), ("span", "like"), ("button", "helpful"), ("span", "recommend")]
SPAN_REVIEW = {
    "item": ("li", "BnwL_cs1av"),
    "id_attr": "data-shp-contents-id",
    "user": ("strong", "_2L3vDiadT9"),
    "spans": ("span", "_2L3vDiadT9"),
    "rating": ("em", "_15NU42F3kT"),
    "content_box": ("div", "_1kMfD5ErZ6"),
    "content_fallback": ("div", "_3z6gI4oI6l"),
    "option": ("div", "_2FXNMst_ak"),
}
MENU_ITEM = ("li", "displayCategoryImageMenu_list__eEKrH")
MENU_TITLE = ("span", "displayCategoryImageMenu_title__Wizki")
MENU_URL_ATTR = "data-shp-contents-id"
