"""Names, labels and thresholds that results depend on.

They are stated as plain text; nothing here is computed.
"""

from __future__ import annotations

from datetime import date

# Brazilian states as (code, name, macro-region), in key order.
STATES = (
    ("AC", "Acre", "Norte"),
    ("AL", "Alagoas", "Nordeste"),
    ("AP", "Amapá", "Norte"),
    ("AM", "Amazonas", "Norte"),
    ("BA", "Bahia", "Nordeste"),
    ("CE", "Ceará", "Nordeste"),
    ("DF", "Distrito Federal", "Centro-Oeste"),
    ("ES", "Espírito Santo", "Sudeste"),
    ("GO", "Goiás", "Centro-Oeste"),
    ("MA", "Maranhão", "Nordeste"),
    ("MT", "Mato Grosso", "Centro-Oeste"),
    ("MS", "Mato Grosso do Sul", "Centro-Oeste"),
    ("MG", "Minas Gerais", "Sudeste"),
    ("PA", "Pará", "Norte"),
    ("PB", "Paraíba", "Nordeste"),
    ("PR", "Paraná", "Sul"),
    ("PE", "Pernambuco", "Nordeste"),
    ("PI", "Piauí", "Nordeste"),
    ("RJ", "Rio de Janeiro", "Sudeste"),
    ("RN", "Rio Grande do Norte", "Nordeste"),
    ("RS", "Rio Grande do Sul", "Sul"),
    ("RO", "Rondônia", "Norte"),
    ("RR", "Roraima", "Norte"),
    ("SC", "Santa Catarina", "Sul"),
    ("SP", "São Paulo", "Sudeste"),
    ("SE", "Sergipe", "Nordeste"),
    ("TO", "Tocantins", "Norte"),
)

# Texts that mean "missing" in a CSV cell (the pandas defaults).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Order states and the fallback category.
DELIVERED = "delivered"
SOLD = ("delivered", "shipped")
UNKNOWN_CATEGORY = "unknown"

# Payment types and how reports show them.
PAYMENT_LABELS = (
    ("credit_card", "Credit Card"),
    ("boleto", "Boleto"),
    ("voucher", "Voucher"),
    ("debit_card", "Debit Card"),
)
OTHER_PAYMENT = "Other"
UNDEFINED_PAYMENT = "not_defined"

# Review scores and how reports show them.
SCORE_LABELS = (
    (5, "5 - Excellent"),
    (4, "4 - Good"),
    (3, "3 - Neutral"),
    (2, "2 - Poor"),
    (1, "1 - Terrible"),
)

# Bands as (upper bound, label); the last band has no bound.
PRICE_BANDS = (  # price below the bound
    (50, "1. Budget (< R$50)"),
    (150, "2. Mid-Range (R$50-150)"),
    (500, "3. Premium (R$150-500)"),
    (None, "4. Luxury (R$500+)"),
)
DELAY_BANDS = (  # delay in days up to and including the bound
    (-7, "1. Very Early (7+ days early)"),
    (-1, "2. Early (1-7 days early)"),
    (0, "3. Exactly On Time"),
    (3, "4. Slightly Late (1-3 days)"),
    (7, "5. Late (4-7 days)"),
    (None, "6. Very Late (7+ days)"),
)
DELIVERY_BANDS = (  # delivery days up to and including the bound
    (3, "1. Express (1-3 days)"),
    (7, "2. Fast (4-7 days)"),
    (14, "3. Standard (8-14 days)"),
    (21, "4. Slow (15-21 days)"),
    (30, "5. Very Slow (22-30 days)"),
    (None, "6. Critical (31+ days)"),
)
BUYER_BANDS = (  # orders per person up to and including the bound
    (1, "1. One-Time Buyer"),
    (2, "2. Bought Twice"),
    (3, "3. Bought 3x"),
    (None, "4. Loyal (4+ orders)"),
)

# Segments as (label, lowest and highest r, f, m score); the
# first match wins, and everything else is RFM_DEFAULT.
RFM_SEGMENTS = (
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (1, 5)),
    ("Recent Customers", (4, 5), (1, 2), (1, 5)),
    ("At Risk", (1, 2), (3, 5), (1, 5)),
    ("Lost", (1, 1), (1, 1), (1, 5)),
)
RFM_DEFAULT = "Potential Loyalists"
RFM_TILES = 5

# Default report parameters.
RFM_DATE = date(2018, 10, 1)
TREND_CUTOFF = date(2018, 9, 1)
HOT_PERIOD = "2018-08"
COHORT_FLOOR = "2017-01"
MIN_SELLER_ORDERS = 5
MIN_TIER_ORDERS = 10
MIN_CATEGORY_ITEMS = 100
SLA_EXCELLENT = 90
SLA_GOOD = 75
TIER_TOP = (4.5, 90)
TIER_GOOD = (4.0, 75)
TIER_LOW = 3.5

# Quality thresholds.
MINIMUM_ROWS = (
    ("dim_time", 500),
    ("dim_region", 27),
    ("dim_customer", 90_000),
    ("dim_product", 30_000),
    ("dim_seller", 3_000),
    ("fact_orders", 100_000),
)
MIN_ORDER_MATCH_PCT = 90
MAX_CUSTOMER_GAP = 100
MIN_DELIVERED_PCT = 85
SCORE_RANGE = (1, 5)
MEAN_SCORE_RANGE = (2.5, 5.0)

# Sample of the locations, for callers that ask for one.
SAMPLE_FRACTION = 0.2
SAMPLE_SEED = 42
