"""Fixed values that must equal the reference pipeline's for right results.

Everything here is plain data. Operators turn these into small DataFrames
(or literal column expressions) and accept replacements as parameters, so a
caller or a test can pass its own tables.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — countries, currencies, market time zones
# ---------------------------------------------------------------------------
COUNTRY_NAME_TO_CODE = {
    "Australia": "AU",
    "New Zealand": "NZ",
    "United States": "US",
    "United Kingdom": "GB",
    "AU": "AU",
    "NZ": "NZ",
    "US": "US",
    "GB": "GB",
}

COUNTRY_CURRENCY = {"AU": "AUD", "NZ": "NZD", "US": "USD", "GB": "GBP"}

COUNTRY_TIMEZONE = {
    "AU": "Australia/Sydney",
    "NZ": "Pacific/Auckland",
    "US": "America/New_York",
    "GB": "Europe/London",
}

# ---------------------------------------------------------------------------
# FIXED VALUES — data-quality rule catalogue
# (rule_id, rule_name, rule_category, severity, target_stage)
# ---------------------------------------------------------------------------
RULES = [
    ("DQ_NULL_001", "Required: crawl_ts", "null_check", "HIGH", "INGEST"),
    ("DQ_NULL_002", "Required: country", "null_check", "HIGH", "INGEST"),
    ("DQ_NULL_004", "Required: product name", "null_check", "HIGH", "INGEST"),
    ("DQ_FMT_001", "Format: country code resolves", "format", "HIGH", "INGEST"),
    ("DQ_RANGE_001", "Range: full_price positive", "range", "HIGH", "INGEST"),
    ("DQ_RANGE_002", "Range: monthly_amount positive", "range", "HIGH", "INGEST"),
    ("DQ_RANGE_003", "Range: instalment_months 1-60", "range", "HIGH", "INGEST"),
    ("DQ_COND_001", "Conditional: payment fields", "conditional", "HIGH", "INGEST"),
    ("DQ_CONS_001", "Consistency: country↔currency", "consistency", "HIGH", "PRE_FACT"),
    ("DQ_CONS_002", "Consistency: partner country", "consistency", "HIGH", "PRE_FACT"),
    ("DQ_HARM_002", "Harmonise: unmatched", "harmonise", "HIGH", "PRE_FACT"),
    ("DQ_HARM_001", "Harmonise: low confidence", "harmonise", "MEDIUM", "SEMANTIC"),
    ("DQ_PRICE_001", "Price: category sanity", "range", "MEDIUM", "SEMANTIC"),
]

STAGES = ["INGEST", "PRE_FACT", "SEMANTIC"]

# ---------------------------------------------------------------------------
# FIXED VALUES — USD price band per category (inclusive), DQ_PRICE_001
# ---------------------------------------------------------------------------
PRICE_BANDS = [
    ("IPHONE", 400, 3500),
    ("IPAD", 300, 4000),
    ("MAC", 800, 8000),
    ("AIRPODS", 80, 800),
    ("WATCH", 200, 2500),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — anomaly severity ladders
# relative deviation bars (LOW, MEDIUM, HIGH) per profile; z-score bars
# ---------------------------------------------------------------------------
SEVERITY_PROFILES = {
    "live": (0.10, 0.15, 0.25),
    "config": (0.25, 0.50, 0.80),
}
Z_BARS = (1.5, 2.5, 4.0)
SEVERITY_RANK = {"HIGH": 3, "MEDIUM": 2, "LOW": 1}
STATISTICAL_WINDOW_DAYS = 30
LOW_SUCCESS_BAR = 0.85

# ---------------------------------------------------------------------------
# FIXED VALUES — product-name matcher dictionary
# ---------------------------------------------------------------------------
# Whole-token expansions (a value with a space yields two tokens).
TOKEN_ABBREVIATIONS = {
    "ip": "iphone",
    "pm": "pro max",
    "pr": "pro",
    "wf": "wifi",
    "cl": "cellular",
    "cell": "cellular",
    "wi-fi": "wifi",
    "gen": "generation",
}

# Ordered regex rewrites applied to the lower-cased name before splitting.
# Java regex syntax; (?U) makes \d, \s and \b Unicode-aware like Python's.
# The terabyte rule needs arithmetic and is handled separately (see
# functions.text), between the third and the fourth entry below.
PATTERN_EXPANSIONS = [
    (r"(?U)\bip(\d{1,2})pm\b", "iphone $1 pro max"),
    (r"(?U)\bip(\d{1,2})p\b", "iphone $1 pro"),
    (r"(?U)\bip(\d{1,2})\b", "iphone $1"),
    # terabytes -> gigabytes (x1024) goes here
    (r"(?U)(\d+)\s*gb\b", "$1 gb"),
    (r"(?U)(\d{1,2}(?:\.\d)?)\s*(?:in|inch|-inch)\b", "$1inch"),
    (r'(?U)(\d{1,2}(?:\.\d)?)\s*"', "$1inch"),
    (r"(?U)\bactive\s+noise\s+cancellation\b", "anc"),
    (r"(?U)\bactive\s+noise\s+cancelling\b", "anc"),
    (r"(?U)\bnoise\s+cancellation\b", "anc"),
    (r"(?U)\bnoise\s+cancelling\b", "anc"),
    (r"(?U)\bnon[- ]?anc\b", "non-anc"),
]
TERABYTE_PATTERN = r"(?U)(\d+)\s*tb\b"
PUNCT_STRIP = r"[,()+\[\]{}]"
TOKEN_EDGE_CHARS = "-.,;:'\""

NOISE_WORDS = [
    "apple", "storage", "chip", "display", "liquid", "retina", "usb-c", "usbc",
    "neural", "engine", "intelligence", "with", "and", "the", "standard",
    "glass", "bionic",
    "starlight", "midnight", "blue", "purple", "white", "black", "silver",
    "space", "grey", "gray", "graphite", "pink", "red", "yellow",
    "ultramarine", "teal", "cloud", "titanium", "deep", "natural",
    "corange", "deserttitanium",
    "pnk", "pur", "stl", "blk", "ylw",
    "brand", "new", "edition",
    "wireless", "headphones", "earphones", "headphone", "earphone",
    "in-ear", "true",
    "magsafe", "lightning", "case", "charging",
    "adaptive",
    "battery", "life", "hours",
    "hearing", "aid", "test", "clinical-grade",
    "ios",
]

# First keyword found anywhere in the joined tokens wins.
CATEGORY_KEYWORDS = [
    ("airpods", "AIRPODS"),
    ("macbook", "MAC"),
    ("imac", "MAC"),
    ("ipad", "IPAD"),
    ("iphone", "IPHONE"),
    ("watch", "WATCH"),
    ("mac", "MAC"),
]

# Chip patterns, first hit wins: literal label, or prefix + captured digits.
CHIP_PATTERNS = [
    (r"(?U)\ba17\s*pro\b", "A17 Pro", None),
    (r"(?U)\ba(\d{2})\b", "A", 1),
    (r"(?U)\bm(\d)\b", "M", 1),
]

CONNECTIVITY_KEYWORDS = [("cellular", "Cellular"), ("wifi", "WiFi")]
SIZE_PATTERN = r"(?U)(\d{1,2}(?:\.\d)?)\s*inch"
STORAGE_PATTERN = r"(?U)(\d+)\s*gb\b"
STORAGE_SIZES_GB = [64, 128, 256, 512, 1024, 2048]

# Registry category column -> category code, used when the text has none.
CATEGORY_COLUMN_CODES = {
    "iphone": "IPHONE",
    "ipad": "IPAD",
    "airpods": "AIRPODS",
    "watch": "WATCH",
}  # any value starting with "mac" maps to MAC

# Scoring weights and tier bars.
ATTRIBUTE_WEIGHTS = [
    ("category", 1.5),
    ("storage_gb", 2.0),
    ("chip", 1.0),
    ("model_line", 1.5),
    ("connectivity", 0.5),
    ("size_inch", 0.5),
]
WEIGHT_ATTR = 0.5
WEIGHT_JACCARD = 0.3
WEIGHT_FUZZ = 0.2
TIER_HIGH = 0.85
TIER_MEDIUM = 0.60
STRUCTURAL_OVERRIDE_ATTR = 0.95
TIER_RANK = {"MANUAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}

# Keys left out of the matching text built from a feed row.
HARMONISE_PAYLOAD_EXCLUDE = [
    "__row_num", "PRODUCT_NAME_VAL", "CRAWL_TS", "COUNTRY_VAL", "PARTNER",
    "FULL PRICE", "MONTHLY_INSTALMENT_AMT", "INSTALMENT_MONTH",
]

# ---------------------------------------------------------------------------
# FIXED VALUES — colour codes in registry long descriptions
# ---------------------------------------------------------------------------
COLOR_CODES = {
    "PNK": "Pink", "PUR": "Purple", "STL": "Starlight", "BLK": "Black",
    "WHT": "White", "YLW": "Yellow", "BLU": "Blue", "RED": "Red",
    "SLV": "Silver", "GRY": "Grey", "GRN": "Green", "ORG": "Orange",
    "GLD": "Gold", "MDN": "Midnight", "CORANGE": "Cosmic Orange",
    "DEEPBLUE": "Deep Blue", "SKYBLUE": "Sky Blue",
}

# ---------------------------------------------------------------------------
# FIXED VALUES — category lifecycle (months) and volatility class
# ---------------------------------------------------------------------------
CATEGORY_LIFECYCLE = [
    ("IPHONE", 12, "MEDIUM"),
    ("IPAD", 18, "LOW"),
    ("MAC", 24, "LOW"),
    ("AIRPODS", 24, "HIGH"),
    ("WATCH", 12, "MEDIUM"),
]

# Feed column names.
FEED_COLUMNS = {
    "crawl_ts": "CRAWL_TS",
    "country": "COUNTRY_VAL",
    "partner": "PARTNER",
    "product": "PRODUCT_NAME_VAL",
    "full_price": "FULL PRICE",
    "monthly": "MONTHLY_INSTALMENT_AMT",
    "months": "INSTALMENT_MONTH",
}

# ---------------------------------------------------------------------------
# FIXED VALUES — context factors for adjusted anomaly scores
# ---------------------------------------------------------------------------
LIFECYCLE_FACTORS = {"NEW": 0.30, "STABLE": 1.00, "LEGACY": 0.60, "EOL": 0.00}
EVENT_SUPPRESSION = {"APPLE_LAUNCH": 0.40, "BLACK_FRIDAY": 0.50, "BOXING_DAY": 0.50}
CATEGORY_SENSITIVITY = {"LOW": 1.00, "MEDIUM": 1.30, "HIGH": 1.80}
NEW_PRODUCT_DAYS = 14
