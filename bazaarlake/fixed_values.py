"""Values a warehouse must share with its users to give the same answers.

Everything here is a constant of the business definition (labels, limits, status
names, default report windows). Logic lives elsewhere.
"""

from __future__ import annotations

from datetime import date

# ---- fixed values: statuses and payment types --------------------------------
DELIVERED = "delivered"
NOT_A_SALE = ("canceled", "unavailable")
UNDEFINED_PAYMENT = "not_defined"
CREDIT_CARD = "credit_card"

# ---- fixed values: cleansing ---------------------------------------------------
NO_CATEGORY = "uncategorized"
LATITUDE_BOUNDS = (-35, 6)
LONGITUDE_BOUNDS = (-75, -33)

# ---- fixed values: calendar and report windows ---------------------------------
CALENDAR_FROM = date(2016, 9, 1)
CALENDAR_TO = date(2018, 12, 31)
MONTHS_FROM = date(2017, 1, 1)
MONTHS_TO = date(2018, 8, 1)
YEAR_ON_YEAR_UNTIL = date(2018, 8, 1)
COHORTS_FROM = date(2017, 1, 1)
COHORTS_TO = date(2018, 2, 1)
COHORT_MONTHS = 6

# ---- fixed values: thresholds and row counts of the reports ---------------------
MIN_CATEGORY_ORDERS = 100
MIN_STATE_ORDERS = 100
MIN_CATEGORY_ITEMS = 200
MIN_SELLER_ORDERS = 30
MIN_AT_RISK_ORDERS = 50
AT_RISK_LATE_PCT = 15.0
AT_RISK_REVIEW = 3.5
TOP_DAYS = 10
TOP_CATEGORIES = 20
LOWEST_RATED_CATEGORIES = 10
TOP_FREIGHT_CATEGORIES = 15
TOP_SELLERS = 50
SELLER_TILES = 10
RFM_TILES = 5

# ---- fixed values: bands (upper edges, then one label per band) -----------------
PRICE_BAND_EDGES = (50, 100, 200, 500)
PRICE_BAND_LABELS = ("1. Under 50", "2. 50-99", "3. 100-199", "4. 200-499", "5. 500+")

DELAY_BUCKET_EDGES = (-1, 0, 3, 7, 14)
DELAY_BUCKET_LABELS = (
    "1. Early",
    "2. On estimated date",
    "3. Late 1-3 days",
    "4. Late 4-7 days",
    "5. Late 8-14 days",
    "6. Late 15+ days",
)

PAYMENT_BAND_EDGES = (100, 300, 1000)
PAYMENT_BAND_LABELS = ("1. Under 100", "2. 100-299", "3. 300-999", "4. 1000+")

# ---- fixed values: two-way classes and segments ---------------------------------
SAME_STATE, CROSS_STATE = "Same state", "Cross state"
MULTI_SELLER, SINGLE_SELLER = "Multi-seller", "Single seller"

LOYAL = "Loyal / Repeat"
LAPSING = "Repeat - Lapsing"
HIGH_VALUE_NEW = "High-Value New"
ONE_TIME_LAPSED = "One-Time - Lapsed"
ONE_TIME_RECENT = "One-Time - Recent"

# ---- fixed values: row errors a bulk load tolerates before it fails --------------
MAX_LOAD_ERRORS = 10
