"""Fixed values that must equal the reference's behaviour for right results.

Patterns are written in the portable form of ``regex.py`` (ASCII digits, explicit space class,
no look-around).  Order matters everywhere: the first matching entry wins.
"""

from .regex import END_WORD, NUM, NUM_ANY_SEP, WS

# ---------------------------------------------------------------- fixed values: clean_text
# Punctuation kept by clean_text besides letters, digits, '_' and whitespace.
CLEAN_KEEP_PUNCT = "-.,:;()[]{}!?@#$%^&*+=<>/\\|`~\"'"
# The same set written as a character-class body valid in Java and RE2.
CLEAN_KEEP_CLASS = r"\-.,:;()\[\]{}!?@#$%^&*+=<>/\\|`~" + "\"'"

# ---------------------------------------------------------------- fixed values: price
# Summed unit parts: (pattern, multiplier); the first match of each is added up.
PRICE_SUM_PARTS = [
    (NUM_ANY_SEP + WS + "*t[ỷy]", 1_000_000_000.0),
    (NUM_ANY_SEP + WS + "*triệu", 1_000_000.0),
    (NUM_ANY_SEP + WS + "*(?:nghìn|ngàn|k)", 1_000.0),
]
# Fallback chain used when the sum is not positive: (pattern, multiplier, groups).
# Two-group patterns read "a.b" as a + b/10 (b < 10) or a + b/100.
_TR_NOT_VOWEL = "tr(?:$|[^aăâ])"
PRICE_FALLBACK = [
    ("([0-9]+)[,.]([0-9]+)" + WS + "*tỷ", 1_000_000_000.0, 2),
    ("([0-9]+)[,.]([0-9]+)" + WS + "*ty", 1_000_000_000.0, 2),
    ("([0-9]+)" + WS + "*tỷ", 1_000_000_000.0, 1),
    ("([0-9]+)" + WS + "*ty", 1_000_000_000.0, 1),
    ("([0-9]+)[,.]([0-9]+)" + WS + "*triệu", 1_000_000.0, 2),
    ("([0-9]+)[,.]([0-9]+)" + WS + "*" + _TR_NOT_VOWEL, 1_000_000.0, 2),
    ("([0-9]+)" + WS + "*triệu", 1_000_000.0, 1),
    ("([0-9]+)" + WS + "*" + _TR_NOT_VOWEL, 1_000_000.0, 1),
    ("([0-9]+)[,.]([0-9]+)" + WS + "*nghìn", 1_000.0, 2),
    ("([0-9]+)[,.]([0-9]+)" + WS + "*ngàn", 1_000.0, 2),
    ("([0-9]+)[,.]([0-9]+)" + WS + "*k", 1_000.0, 2),
    ("([0-9]+)" + WS + "*nghìn", 1_000.0, 1),
    ("([0-9]+)" + WS + "*ngàn", 1_000.0, 1),
    ("([0-9]+)" + WS + "*k", 1_000.0, 1),
    ("([0-9]+)", 1.0, 1),
]

# ---------------------------------------------------------------- fixed values: area
AREA_PATTERNS = [
    NUM + WS + "*m[²2]",
    NUM + WS + "*m" + WS + "*2",
    NUM + WS + "*mét" + WS + "*vuông",
    NUM + WS + "*met" + WS + "*vuong",
]

# ---------------------------------------------------------------- fixed values: phone
PHONE_PATTERNS = [
    "(0[0-9]{9,10})",
    "(\\+84[0-9]{9,10})",
    "(84[0-9]{9,10})",
]

# ---------------------------------------------------------------- fixed values: rooms
ROOM_PATTERNS = [
    "([0-9]+)" + WS + "*phòng" + WS + "*ngủ",
    "([0-9]+)" + WS + "*pn" + END_WORD,
    "([0-9]+)" + WS + "*bed(?:room)?" + END_WORD,
    "([0-9]+)" + WS + "*bed" + END_WORD,
    "([0-9]+)" + WS + "* ngủ" + END_WORD,
    "([0-9]+)" + WS + "*pn",
    "([0-9]+)" + WS + "*phòng",
]
BATH_PATTERNS = [
    "([0-9]+)" + WS + "*phòng",
    "([0-9]+)" + WS + "*phòng" + WS + "*tắm",
    "([0-9]+)" + WS + "*phòng" + WS + "*vệ" + WS + "*sinh",
    "([0-9]+)" + WS + "*wc" + END_WORD,
    "([0-9]+)" + WS + "*toilet" + END_WORD,
    "([0-9]+)" + WS + "*bath(?:room)?" + END_WORD,
    "([0-9]+)" + WS + "*tắm" + END_WORD,
    "([0-9]+)" + WS + "*vệ" + WS + "*sinh" + END_WORD,
    "([0-9]+)" + WS + "*wc",
]

# ---------------------------------------------------------------- fixed values: dates
# (pattern, order of the three groups); invalid calendar dates fall through to the next one.
DATE_PATTERNS = [
    ("([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})", "dmy"),
    ("([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})", "dmy"),
    ("([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})", "ymd"),
    ("([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", "ymd"),
]
DATE_TODAY = ["hôm nay", "today"]
DATE_YESTERDAY = ["hôm qua", "yesterday"]
DATE_WEEK_WORDS = ("tuần", "trước")          # both present: one week ago
DATE_DAYS_AGO = "([0-9]+)" + WS + "*ngày" + WS + "*trước"
DATE_HOURS_AGO = "([0-9]+)" + WS + "*giờ" + WS + "*trước"
DATE_MINUTES_AGO = "([0-9]+)" + WS + "*phút" + WS + "*trước"

# ---------------------------------------------------------------- fixed values: frontage
# A plain decimal number as Python's float() reads it, digit-group underscores included
# ('1_000.5'); 'nan'/'inf' are deliberately not numbers here.
_DIGITS = "[0-9](?:_?[0-9])*"
FRONTAGE_NUMBER = ("^[+-]?(?:" + _DIGITS + "(?:\\.(?:" + _DIGITS + ")?)?|\\." + _DIGITS + ")"
                   "(?:e[+-]?" + _DIGITS + ")?$")
FRONTAGE_METRES = NUM + WS + "*m(?:$|[^²2])"

# ---------------------------------------------------------------- fixed values: city
CITY_PREFIX = "^(?:TP\\.?" + WS + "*|Thành phố" + WS + "*|Tỉnh" + WS + "*|Huyện" + WS + "*)"
CITY_COUNTRY_SUFFIX = "(?:việt nam|vietnam|vn)$"
# (name found anywhere in the last address part, case-insensitive) -> canonical city
CITY_MAPPING = [
    ("Hồ Chí Minh", "Hồ Chí Minh"),
    ("HCM", "Hồ Chí Minh"),
    ("TPHCM", "Hồ Chí Minh"),
    ("Ho Chi Minh", "Hồ Chí Minh"),
    ("Sai Gon", "Hồ Chí Minh"),
    ("Sài Gòn", "Hồ Chí Minh"),
    ("Hà Nội", "Hà Nội"),
    ("Ha Noi", "Hà Nội"),
    ("Hanoi", "Hà Nội"),
    ("Đà Nẵng", "Đà Nẵng"),
    ("Da Nang", "Đà Nẵng"),
    ("Danang", "Đà Nẵng"),
    ("Hải Phòng", "Hải Phòng"),
    ("Hai Phong", "Hải Phòng"),
    ("Cần Thơ", "Cần Thơ"),
    ("Can Tho", "Cần Thơ"),
    ("Biên Hòa", "Biên Hòa"),
    ("Bien Hoa", "Biên Hòa"),
    ("Nha Trang", "Nha Trang"),
    ("Vũng Tàu", "Vũng Tàu"),
    ("Vung Tau", "Vũng Tàu"),
    ("Huế", "Huế"),
    ("Hue", "Huế"),
]

# ---------------------------------------------------------------- fixed values: URL test
URL_VALID = (
    "^https?://"
    "(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\\.)+[A-Z]{2,6}\\.?|"
    "localhost|"
    "[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3})"
    "(?::[0-9]+)?"
    "(?:/?|[/?][^\\t\\n\\x{0B}\\f\\r \\p{Z}\\x{85}\\x{1C}-\\x{1F}]+)\\n?\\z"
)

# ---------------------------------------------------------------- fixed values: property types
PROPERTY_TYPES = ["căn hộ", "nhà phố", "đất nền", "biệt thự", "shophouse", "kho xưởng"]
PROPERTY_TYPE_DEFAULT = "căn hộ"
# Classification keywords per type, in rule order.
TYPE_KEYWORDS = [
    ("căn hộ", ["chung cư", "apartment", "căn hộ cao cấp"]),
    ("nhà phố", ["nhà riêng", "nhà phố", "townhouse"]),
    ("đất nền", ["đất thổ cư", "đất nền", "lô đất"]),
    ("biệt thự", ["villa", "biệt thự", "nhà vườn lớn"]),
    ("shophouse", ["nhà mặt phố kinh doanh", "shophouse"]),
    ("kho xưởng", ["nhà xưởng", "kho bãi", "đất công nghiệp"]),
]
LEGAL_PHRASES = ["sổ đỏ", "sổ hồng", "hợp đồng mua bán", "giấy tờ tay"]
AMENITY_PHRASES = ["trường học", "bệnh viện", "trung tâm thương mại", "công viên",
                   "giao thông công cộng", "khu dân cư đông đúc"]

# ---------------------------------------------------------------- fixed values: enrichment
# The 16 fields a listing may have filled in by the enricher, in request order.
ENRICH_FIELDS = ["title", "address", "price", "area", "unit_price", "seller", "bedroom", "bathroom",
                 "frontage", "legal", "postedDate", "description", "link", "city",
                 "amenityLocation", "type"]
ENRICH_BATCH = 10
LINK_BATCH = 20
PAGES_PER_SITE = 1
