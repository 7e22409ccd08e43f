"""Reports over the wide table."""

from __future__ import annotations

from mercastar.sources.testdata import PARAMETERS as P
from oracles.star_sql import (
    band_numbers,
    bands,
    half_up,
    mean,
    mean_money,
    money,
    over_star,
    percent,
    share,
)

# Labels, bounds and score ranges, written out apart from the library's.
RFM_SEGMENTS = (
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (1, 5)),
    ("Recent Customers", (4, 5), (1, 2), (1, 5)),
    ("At Risk", (1, 2), (3, 5), (1, 5)),
    ("Lost", (1, 1), (1, 1), (1, 5)),
)
PRICE_BANDS = (
    (50, "1. Budget (< R$50)"),
    (150, "2. Mid-Range (R$50-150)"),
    (500, "3. Premium (R$150-500)"),
    (None, "4. Luxury (R$500+)"),
)
DELAY_BANDS = (
    (-7, "1. Very Early (7+ days early)"),
    (-1, "2. Early (1-7 days early)"),
    (0, "3. Exactly On Time"),
    (3, "4. Slightly Late (1-3 days)"),
    (7, "5. Late (4-7 days)"),
    (None, "6. Very Late (7+ days)"),
)
DELIVERY_BANDS = (
    (3, "1. Express (1-3 days)"),
    (7, "2. Fast (4-7 days)"),
    (14, "3. Standard (8-14 days)"),
    (21, "4. Slow (15-21 days)"),
    (30, "5. Very Slow (22-30 days)"),
    (None, "6. Critical (31+ days)"),
)
BUYER_BANDS = (
    (1, "1. One-Time Buyer"),
    (2, "2. Bought Twice"),
    (3, "3. Bought 3x"),
    (None, "4. Loyal (4+ orders)"),
)

ORDERS = "count(DISTINCT order_id)"
BUYERS = "count(DISTINCT customer_key)"
DONE = "status = 'delivered'"
SOLD = "status IN ('delivered', 'shipped')"
ARRIVED = "status = 'delivered' AND took IS NOT NULL"
MONTH = "strftime(day, '%Y-%m')"
YEAR = "CAST(year(day) AS BIGINT)"
QUARTER = "CAST(quarter(day) AS BIGINT)"
WEEKDAY = "CAST(isodow(day) AS BIGINT)"
ORDER_VALUE = half_up("sum(cents)", f"100 * {ORDERS}", 2)
SCORE = mean("score", 2)
ON_TIME = percent("on_time")


def report(columns: dict[str, str], where: str, group: str = "", tail: str = "") -> str:
    """SELECT over the wide table; `group` names grouping expressions."""
    picked = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    grouped = f"GROUP BY {group} " if group else ""
    return over_star(f"SELECT {picked} FROM w WHERE {where} {grouped}{tail}")


def rfm(recency: str, frequency: str, monetary: str) -> str:
    """People with three scores and a segment; arguments are SQL scores."""
    cases = " ".join(
        f"WHEN r_score BETWEEN {r[0]} AND {r[1]} AND f_score BETWEEN {f[0]} AND {f[1]} "
        f"AND m_score BETWEEN {m[0]} AND {m[1]} THEN '{label}'"
        for label, r, f, m in RFM_SEGMENTS
    )
    return f""",
people AS (
  SELECT person, max(day) AS last_day, date_diff('day', max(day), DATE '{P.rfm_date}') AS recency,
         {ORDERS} AS frequency, sum(cents) AS cents
  FROM w WHERE {DONE} GROUP BY person
),
scored AS (
  SELECT *, {recency} AS r_score, {frequency} AS f_score, {monetary} AS m_score FROM people
),
segmented AS (
  SELECT *, CASE {cases} ELSE 'Potential Loyalists' END AS segment FROM scored
)
"""


def tile(order: str) -> str:
    return f"CAST(ntile(5) OVER (ORDER BY {order}, person) AS BIGINT)"


RAW_RFM = rfm(tile("recency"), tile("frequency DESC"), tile("cents DESC"))
FAIR_RFM = rfm(
    tile("recency DESC"),
    "CASE WHEN frequency >= 3 THEN 5 WHEN frequency = 2 THEN 4 ELSE 1 END",
    tile("cents"),
)


def segments(base: str, scale: int, names: list[str]) -> str:
    values = [
        "segment",
        "count(*)",
        share("count(*)"),
        mean("recency", 0),
        mean("frequency", scale),
        mean_money("cents"),
        money("cents"),
    ]
    picked = ", ".join(f"{v} AS {n}" for v, n in zip(values, names, strict=True))
    return over_star(base + f"SELECT {picked} FROM segmented GROUP BY segment")


COHORTS = f""",
visits AS (SELECT DISTINCT person, year(day) * 12 + month(day) AS m FROM w WHERE {DONE}),
firsts AS (SELECT person, min(m) AS m0 FROM visits GROUP BY person),
activity AS (
  SELECT CAST((m0 - 1) // 12 AS VARCHAR) || '-'
           || lpad(CAST((m0 - 1) % 12 + 1 AS VARCHAR), 2, '0') AS cohort_month,
         CAST(m - m0 AS BIGINT) AS gap, count(DISTINCT person) AS n
  FROM visits JOIN firsts USING (person) GROUP BY ALL
),
sizes AS (
  SELECT CAST((m0 - 1) // 12 AS VARCHAR) || '-'
           || lpad(CAST((m0 - 1) % 12 + 1 AS VARCHAR), 2, '0') AS cohort_month, count(*) AS size
  FROM firsts GROUP BY ALL
),
matrix AS (
  SELECT * FROM activity JOIN sizes USING (cohort_month)
  WHERE gap > 0 AND cohort_month >= '{P.cohort_floor}'
)
"""

SELLER = {
    "total_orders": ORDERS,
    "items_sold": "count(*)",
    "total_revenue": money("cents"),
    "avg_item_price": mean_money("cents"),
    "avg_review_score": SCORE,
    "avg_delivery_days": mean("took", 1),
}


def _over_hundred(number: float) -> int:
    return round(number * 100)


def _tier(pair: tuple[float, float]) -> str:
    return f"100 * sum(score) >= {_over_hundred(pair[0])} * count(score) AND {ON_TIME} >= {pair[1]}"


TIER = (
    f"CASE WHEN {_tier(P.tier_top)} THEN 'Top Performer' "
    f"WHEN {_tier(P.tier_good)} THEN 'Good Seller' "
    f"WHEN 100 * sum(score) < {_over_hundred(P.tier_low)} * count(score) THEN 'Needs Review' "
    "ELSE 'Average' END"
)
RATING = (
    f"CASE WHEN {ON_TIME} >= {P.sla_excellent} THEN 'Excellent' "
    f"WHEN {ON_TIME} >= {P.sla_good} THEN 'Good' ELSE 'Needs Improvement' END"
)
PAYMENT_LABEL = """CASE kind WHEN 'credit_card' THEN 'Credit Card' WHEN 'boleto' THEN 'Boleto'
  WHEN 'voucher' THEN 'Voucher' WHEN 'debit_card' THEN 'Debit Card' ELSE 'Other' END"""
SCORE_LABEL = """CASE score WHEN 5 THEN '5 - Excellent' WHEN 4 THEN '4 - Good'
  WHEN 3 THEN '3 - Neutral' WHEN 2 THEN '2 - Poor' WHEN 1 THEN '1 - Terrible' END"""
STATE = {"state_code": "home_code", "state_name": "home_name", "macro_region": "home_macro"}
STATE_METRICS = {
    "total_orders": ORDERS,
    "unique_customers": BUYERS,
    "total_revenue": money("cents"),
    "avg_order_value": mean_money("cents"),
    "avg_delivery_days": mean("took", 1),
    "avg_review_score": SCORE,
}
QUALITY = half_up(
    "12 * sum(score) * count(*) + 40 * count(*) FILTER (WHERE on_time) * count(score)",
    "count(score) * count(*)",
    1,
)


def cities(group: str, shown: str) -> str:
    return report(
        {
            "city_state": f"{shown} || ' - ' || state",
            "unique_customers": "count(DISTINCT person)",
            "total_orders": ORDERS,
            "total_revenue": money("cents"),
            "avg_review_score": SCORE,
        },
        DONE,
        f"{group}, state",
        "ORDER BY unique_customers DESC, city_state LIMIT 10",
    )


CATEGORY_MONTHS = f""",
months AS (
  SELECT {MONTH} AS period, category, {ORDERS} AS orders, sum(cents) AS cents
  FROM w WHERE {DONE} GROUP BY ALL
)
"""

REPORTS = {
    "q3_exec_kpis": report(
        {
            "total_orders": ORDERS,
            "total_order_items": "count(*)",
            "total_product_revenue": money("cents"),
            "total_freight_revenue": money("freight_cents"),
            "total_revenue": money("gross_cents"),
            "avg_item_price": mean_money("cents"),
            "avg_order_value": ORDER_VALUE,
            "avg_review_score": SCORE,
            "unique_customers": BUYERS,
        },
        DONE,
    ),
    "q3_category_by_revenue": report(
        {
            "category": "category",
            "items_sold": "count(*)",
            "orders": ORDERS,
            "total_revenue": money("cents"),
            "avg_price": mean_money("cents"),
            "avg_review_score": SCORE,
        },
        DONE,
        "category",
        "ORDER BY sum(cents) DESC, category LIMIT 20",
    ),
    "q3_category_by_items": report(
        {
            "category": "category",
            "items_sold": "count(*)",
            "total_revenue": money("cents"),
            "avg_price": mean_money("cents"),
        },
        DONE,
        "category",
        "ORDER BY count(*) DESC, category LIMIT 20",
    ),
    "q3_revenue_by_month": report(
        {
            "year": YEAR,
            "month": "CAST(month(day) AS BIGINT)",
            "month_name": "monthname(day)",
            "year_month": MONTH,
            "total_orders": ORDERS,
            "total_items": "count(*)",
            "product_revenue": money("cents"),
            "freight_revenue": money("freight_cents"),
            "total_revenue": money("gross_cents"),
            "avg_review_score": SCORE,
        },
        SOLD,
        f"{YEAR}, month(day), monthname(day), {MONTH}",
    ),
    "q3_revenue_by_quarter": report(
        {
            "year": YEAR,
            "quarter": QUARTER,
            "year_quarter": f"{YEAR} || ' Q' || {QUARTER}",
            "total_orders": ORDERS,
            "product_revenue": money("cents"),
            "total_revenue": money("gross_cents"),
            "avg_review_score": SCORE,
        },
        SOLD,
        f"{YEAR}, {QUARTER}",
    ),
    "q3_revenue_by_weekday": report(
        {
            "day_of_week": WEEKDAY,
            "day_name": "dayname(day)",
            "total_orders": ORDERS,
            "total_revenue": money("cents"),
            "avg_order_value": mean_money("cents"),
        },
        SOLD,
        f"{WEEKDAY}, dayname(day)",
    ),
    "q3_state_revenue": report(
        STATE | STATE_METRICS | {"pct_on_time": ON_TIME}, DONE, "home_code, home_name, home_macro"
    ),
    "q3_macro_region_share": report(
        {
            "macro_region": "home_macro",
            "total_orders": ORDERS,
            "total_revenue": money("cents"),
            "pct_revenue": share("sum(cents)"),
        },
        DONE,
        "home_macro",
    ),
    "q3_rfm_customers": over_star(
        RAW_RFM
        + "SELECT person AS customer_unique_id, CAST(last_day AS VARCHAR) AS last_purchase_date, "
        "recency AS recency_days, frequency, CAST(cents AS DOUBLE) / 100 AS monetary, "
        "r_score, f_score, m_score, r_score + f_score + m_score AS rfm_total, "
        "segment AS rfm_segment FROM segmented"
    ),
    "q3_rfm_segments": segments(
        RAW_RFM,
        1,
        [
            "rfm_segment",
            "customer_count",
            "pct_customers",
            "avg_recency_days",
            "avg_frequency",
            "avg_monetary",
            "total_monetary",
        ],
    ),
    "q3_delivery_by_seller_state": report(
        {
            "seller_state": "from_code",
            "state_name": "from_name",
            "deliveries": "count(*)",
            "avg_delivery_days": mean("took", 1),
            "avg_estimated_days": mean("planned", 1),
            "avg_delay_days": mean("late", 1),
            "pct_on_time": ON_TIME,
        },
        f"{ARRIVED} AND from_key IS NOT NULL",
        "from_code, from_name",
    ),
    "q3_review_distribution": report(
        {"review_score": "CAST(score AS BIGINT)", "count": "count(*)", "pct": share("count(*)")},
        "score IS NOT NULL",
        "score",
    ),
    "q3_payment_methods": report(
        {
            "payment_type": "kind",
            "orders": ORDERS,
            "pct_orders": share(ORDERS),
            "total_payment": money("pay_cents"),
            "avg_installments": mean("installments", 1),
        },
        "kind IS NOT NULL",
        "kind",
    ),
    "q3_seller_performance": report(
        {"seller_id": "seller_id", "seller_state": "seller_state"}
        | SELLER
        | {"pct_on_time": ON_TIME},
        DONE,
        "seller_id, seller_state",
        f"HAVING {ORDERS} >= {P.min_seller_orders} "
        "ORDER BY sum(cents) DESC, seller_id LIMIT 50",
    ),
    "q3_cohort_activity": over_star(
        COHORTS
        + "SELECT cohort_month, gap AS months_since_first, n AS active_customers FROM activity"
    ),
    "ex1_kpi_cards": report(
        {
            "total_orders": ORDERS,
            "unique_customers": "count(DISTINCT person)",
            "gross_revenue": "'R$ ' || "
            "format('{:,}', CAST((2 * sum(cents) + 100) // 200 AS BIGINT))",
            "avg_review_score": f"CAST(CAST({SCORE} AS DECIMAL(6,2)) AS VARCHAR) || ' / 5'",
            "on_time_rate": f"CAST(CAST({ON_TIME} AS DECIMAL(6,1)) AS VARCHAR) || '%'",
        },
        DONE,
    ),
    "ex2_revenue_trend": over_star(
        f""", months AS (
          SELECT {MONTH} AS period, {ORDERS} AS total_orders, sum(cents) AS cents,
                 {money("freight_cents")} AS freight_revenue,
                 {money("gross_cents")} AS total_revenue,
                 {SCORE} AS avg_review_score
          FROM w WHERE {SOLD} AND day < DATE '{P.trend_cutoff}' GROUP BY 1
        ), paired AS (SELECT *, lag(cents) OVER (ORDER BY period) AS before FROM months)
        SELECT period, total_orders, CAST(cents AS DOUBLE) / 100 AS gross_revenue, freight_revenue,
               total_revenue, avg_review_score,
               {half_up("100 * (cents - before)", "before", 1)} AS mom_growth_pct
        FROM paired"""
    ),
    "ex3_quarterly": report(
        {
            "quarter_label": f"{YEAR} || ' Q' || {QUARTER}",
            "total_orders": ORDERS,
            "unique_customers": BUYERS,
            "product_revenue": money("cents"),
            "freight_revenue": money("freight_cents"),
            "total_revenue": money("gross_cents"),
            "avg_review_score": SCORE,
            "avg_order_value": ORDER_VALUE,
        },
        SOLD,
        f"{YEAR}, {QUARTER}",
    ),
    "ex4_macro_region": report(
        {
            "macro_region": "home_macro",
            "total_orders": ORDERS,
            "unique_customers": BUYERS,
            "total_revenue": money("cents"),
            "revenue_share_pct": share("sum(cents)"),
            "avg_review_score": SCORE,
            "avg_delivery_days": mean("took", 1),
        },
        DONE,
        "home_macro",
    ),
    "ex5_payment_mix": report(
        {
            "payment_method": PAYMENT_LABEL,
            "order_count": ORDERS,
            "share_pct": share(ORDERS),
            "avg_payment_value": mean_money("pay_cents"),
            "avg_installments": mean("installments", 1),
            "total_payment_volume": money("pay_cents"),
        },
        "kind <> 'not_defined'",
        "kind",
    ),
    "ex6_weekday_pattern": report(
        {
            "day_of_week": WEEKDAY,
            "day_name": "dayname(day)",
            "day_type": f"CASE WHEN {WEEKDAY} >= 6 THEN 'Weekend' ELSE 'Weekday' END",
            "total_orders": ORDERS,
            "total_revenue": money("cents"),
            "avg_order_value": mean_money("cents"),
            "orders_share_pct": share(ORDERS),
        },
        SOLD,
        f"{WEEKDAY}, dayname(day)",
    ),
    "cus1_rfm_segments": segments(
        FAIR_RFM,
        2,
        [
            "segment_label",
            "customer_count",
            "pct_of_customers",
            "avg_recency_days",
            "avg_orders",
            "avg_spend_per_customer",
            "total_revenue_from_segment",
        ],
    ),
    "cus2_state_map": report(
        STATE | STATE_METRICS | {"revenue_share_pct": share("sum(cents)"), "on_time_pct": ON_TIME},
        DONE,
        "home_code, home_name, home_macro",
    ),
    "cus3_repeat_buyers": over_star(
        f""", people AS (
          SELECT person, {ORDERS} AS n, sum(cents) AS cents FROM w WHERE {DONE} GROUP BY person
        )
        SELECT {bands("n", BUYER_BANDS)} AS buyer_type, count(*) AS customer_count,
               {share("count(*)")} AS pct_of_customers, {mean_money("cents")} AS avg_lifetime_value,
               {money("cents")} AS total_revenue_contribution
        FROM people GROUP BY 1"""
    ),
    "cus4_cohort_retention": over_star(
        COHORTS
        + f"""SELECT cohort_month, size AS cohort_size, gap AS month_number, n AS active_customers,
                     {half_up("100 * n", "size", 1)} AS retention_rate_pct FROM matrix"""
    ),
    "cus4b_retention_curve": over_star(
        COHORTS
        + f"""SELECT gap AS month_number,
                     {half_up("sum((100::HUGEINT * n * 1000000000000000) // size)",
                              "count(*) * 1000000000000000::HUGEINT", 2)} AS avg_retention_rate_pct
              FROM matrix GROUP BY gap"""
    ),
    "cus5_review_distribution": report(
        {
            "review_score": "CAST(score AS BIGINT)",
            "score_label": SCORE_LABEL,
            "review_count": "count(*)",
            "pct_of_reviews": share("count(*)"),
        },
        f"score IS NOT NULL AND {DONE}",
        "score",
    ),
    "cus6_top_cities": cities("city", "city"),
    "cus6_top_cities_collated": cities("strip_accents(lower(rtrim(city)))", "min(city)"),
    "prd1_category_leaderboard": report(
        {
            "category": "category",
            "items_sold": "count(*)",
            "unique_orders": ORDERS,
            "unique_buyers": BUYERS,
            "total_revenue": money("cents"),
            "revenue_share_pct": share("sum(cents)"),
            "avg_price": mean_money("cents"),
            "avg_review_score": SCORE,
            "avg_delivery_days": mean("took", 1),
        },
        DONE,
        "category",
        "ORDER BY sum(cents) DESC, category LIMIT 15",
    ),
    "prd2_category_trend": over_star(
        CATEGORY_MONTHS
        + """SELECT period, category, orders, CAST(cents AS DOUBLE) / 100 AS revenue
             FROM months
             WHERE category IN (SELECT category FROM months GROUP BY category
                                ORDER BY sum(cents) DESC, category LIMIT 5)"""
    ),
    "prd3_price_segments": report(
        {
            "price_segment": bands("cents / 100", PRICE_BANDS, "<"),
            "segment_order": band_numbers("cents / 100", PRICE_BANDS, "<"),
            "items_sold": "count(*)",
            "pct_items": share("count(*)"),
            "total_revenue": money("cents"),
            "pct_revenue": share("sum(cents)"),
            "avg_review_score": SCORE,
            "avg_delivery_days": mean("took", 1),
        },
        DONE,
        "1, 2",
    ),
    "prd4_quality_matrix": report(
        {
            "category": "category",
            "items_sold": "count(*)",
            "total_revenue": money("cents"),
            "avg_price": mean_money("cents"),
            "avg_review_score": SCORE,
            "avg_delivery_days": mean("took", 1),
            "on_time_pct": ON_TIME,
            "quality_score_100": QUALITY,
        },
        DONE,
        "category",
        f"HAVING count(*) >= {P.min_category_items} "
        "ORDER BY quality_score_100 DESC, category LIMIT 20",
    ),
    "prd5_hot_categories": over_star(
        CATEGORY_MONTHS
        + f""", paired AS (
          SELECT *, lag(cents) OVER (PARTITION BY category ORDER BY period) AS before FROM months
        )
        SELECT period, category, CAST(cents AS DOUBLE) / 100 AS current_revenue,
               CAST(before AS DOUBLE) / 100 AS prev_month_revenue,
               {half_up("100 * (cents - before)", "before", 1)} AS mom_growth_pct,
               CASE sign(cents - before) WHEN 1 THEN 'Growing' WHEN -1 THEN 'Declining'
                    ELSE 'Stable' END AS trend
        FROM paired WHERE period = '{P.hot_period}' AND before IS NOT NULL
        ORDER BY mom_growth_pct DESC, category LIMIT 15"""
    ),
    "ops1_delivery_scorecard": report(
        {
            "total_deliveries": "count(*)",
            "avg_delivery_days": mean("took", 1),
            "avg_estimated_days": mean("planned", 1),
            "avg_delay_when_late": half_up(
                "sum(late) FILTER (WHERE late > 0)", "count(*) FILTER (WHERE late > 0)", 1
            ),
            "avg_early_days": half_up(
                "sum(-late) FILTER (WHERE late <= 0)", "count(*) FILTER (WHERE late <= 0)", 1
            ),
            "on_time_count": "count(*) FILTER (WHERE on_time)",
            "late_count": "count(*) FILTER (WHERE NOT on_time)",
            "on_time_rate_pct": ON_TIME,
            "late_rate_pct": percent("NOT on_time"),
        },
        ARRIVED,
    ),
    "ops2_seller_state_sla": report(
        {
            "seller_state": "from_code",
            "state_name": "from_name",
            "macro_region": "from_macro",
            "total_deliveries": "count(*)",
            "avg_delivery_days": mean("took", 1),
            "avg_estimated_days": mean("planned", 1),
            "avg_delay_days": mean("late", 1),
            "on_time_pct": ON_TIME,
            "avg_review_score": SCORE,
            "sla_rating": RATING,
        },
        f"{ARRIVED} AND from_key IS NOT NULL",
        "from_code, from_name, from_macro",
    ),
    "ops3_delay_review_impact": report(
        {
            "delivery_status": bands("late", DELAY_BANDS),
            "sort_order": band_numbers("late", DELAY_BANDS),
            "order_count": "count(*)",
            "pct_of_orders": share("count(*)"),
            "avg_review_score": SCORE,
            "min_review": "CAST(min(score) AS BIGINT)",
            "max_review": "CAST(max(score) AS BIGINT)",
        },
        f"{DONE} AND late IS NOT NULL AND score IS NOT NULL",
        "1, 2",
    ),
    "ops4_seller_tiers": report(
        {"seller_id": "seller_id", "seller_city": "seller_city", "seller_state": "seller_state"}
        | SELLER
        | {"on_time_pct": ON_TIME, "seller_tier": TIER},
        DONE,
        "seller_id, seller_city, seller_state",
        f"HAVING {ORDERS} >= {P.min_tier_orders} ORDER BY sum(cents) DESC, seller_id LIMIT 50",
    ),
    "ops5_delivery_histogram": report(
        {
            "delivery_bucket": bands("took", DELIVERY_BANDS),
            "order_count": "count(*)",
            "pct_of_orders": share("count(*)"),
            "avg_review_score": SCORE,
            "avg_delay_days": mean("late", 1),
        },
        f"{DONE} AND took > 0",
        "1",
    ),
    "ops6_ontime_trend": report(
        {
            "period": MONTH,
            "total_deliveries": "count(*)",
            "on_time_count": "count(*) FILTER (WHERE on_time)",
            "late_count": "count(*) FILTER (WHERE NOT on_time)",
            "on_time_rate_pct": ON_TIME,
            "avg_delivery_days": mean("took", 1),
            "avg_delay_days": mean("late", 1),
            "avg_review_score": SCORE,
        },
        ARRIVED,
        MONTH,
    ),
}
