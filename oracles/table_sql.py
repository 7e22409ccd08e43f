"""Star tables, staging tables, profiles and quality checks."""

from __future__ import annotations

from mercastar.sources.testdata import PARAMETERS as P
from oracles.star_sql import (
    half_up,
    mean,
    mean_money,
    moment,
    over_sources,
    over_star,
    title,
)

# Fixed values, written out here so that a wrong one in the library shows.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
SAMPLE_FRACTION = 0.2
SAMPLE_SEED = 42

DATE_KEY = "CAST(strftime({}, '%Y%m%d') AS BIGINT)"

STAR_TABLES = {
    "dim_time": over_star(
        f"""SELECT {DATE_KEY.format("day")} AS time_key, CAST(day AS VARCHAR) AS full_date,
                   year(day)::BIGINT AS year, quarter(day)::BIGINT AS quarter,
                   month(day)::BIGINT AS month, monthname(day) AS month_name,
                   weekofyear(day)::BIGINT AS week_of_year, day(day)::BIGINT AS day_of_month,
                   isodow(day)::BIGINT AS day_of_week, dayname(day) AS day_name,
                   (isodow(day) > 5)::BIGINT AS is_weekend FROM d_time"""
    ),
    "dim_region": over_star(
        "SELECT region_key::BIGINT AS region_key, code AS state_code, name AS state_name, "
        "macro AS macro_region FROM d_region"
    ),
    "dim_customer": over_star(
        "SELECT customer_key, customer_id, person AS customer_unique_id, "
        "zip AS customer_zip_code_prefix, city AS customer_city, state AS customer_state "
        "FROM d_customer"
    ),
    "dim_product": over_star(
        "SELECT product_key, product_id, own_name AS product_category_name, "
        "category AS product_category_name_english, weight AS product_weight_g, "
        "len AS product_length_cm, height AS product_height_cm, width AS product_width_cm "
        "FROM d_product"
    ),
    "dim_seller": over_star(
        "SELECT seller_key, seller_id, zip AS seller_zip_code_prefix, city AS seller_city, "
        "state AS seller_state FROM d_seller"
    ),
    "fact_orders": over_star(
        f"""SELECT order_id, item_no::BIGINT AS order_item_id, customer_key, product_key,
                   seller_key,
                   {DATE_KEY.format("day")} AS purchase_time_key,
                   {DATE_KEY.format("end_day")} AS delivery_time_key,
                   home_key::BIGINT AS customer_region_key, from_key::BIGINT AS seller_region_key,
                   cents::DOUBLE / 100 AS price, freight_cents::DOUBLE / 100 AS freight_value,
                   gross_cents::DOUBLE / 100 AS total_revenue,
                   pay_cents::DOUBLE / 100 AS payment_value,
                   installments::BIGINT AS payment_installments, score::BIGINT AS review_score,
                   took AS delivery_days, planned AS estimated_delivery_days, late AS delay_days,
                   on_time::INT::BIGINT AS is_on_time, status AS order_status,
                   kind AS payment_type FROM w"""
    ),
}

STAGING_TABLES = {
    "stg_orders": over_sources(
        f"""SELECT order_id, customer_id, order_status,
                   {moment("bought")} AS order_purchase_timestamp,
                   {moment("approved")} AS order_approved_at,
                   {moment("handed_over")} AS order_delivered_carrier_date,
                   {moment("arrived")} AS order_delivered_customer_date,
                   {moment("due")} AS order_estimated_delivery_date FROM s_orders"""
    ),
    "stg_order_items": over_sources(
        f"""SELECT order_id, item_no::BIGINT AS order_item_id, product_id, seller_id,
                   {moment("ship_limit")} AS shipping_limit_date, cents::DOUBLE / 100 AS price,
                   freight_cents::DOUBLE / 100 AS freight_value FROM s_items
            QUALIFY row_number() OVER (PARTITION BY order_id, item_no
              ORDER BY product_id, seller_id, ship_limit, cents, freight_cents) = 1"""
    ),
    "stg_order_payments": over_sources(
        """SELECT order_id, seq::BIGINT AS payment_sequential, kind AS payment_type,
                  installments::BIGINT AS payment_installments,
                  pay_cents::DOUBLE / 100 AS payment_value FROM s_payments
           QUALIFY row_number() OVER (PARTITION BY order_id, seq
             ORDER BY kind NULLS FIRST, installments, pay_cents) = 1"""
    ),
    "stg_order_reviews": over_sources(
        f"""SELECT review_id, order_id, score::BIGINT AS review_score,
                   NULL::VARCHAR AS review_comment_title, NULL::VARCHAR AS review_comment_message,
                   {moment("due")} AS review_creation_date,
                   {moment("due + INTERVAL 1 DAY")} AS review_answer_timestamp FROM s_reviews"""
    ),
    "stg_customers": over_sources(
        "SELECT customer_id, person AS customer_unique_id, zip AS customer_zip_code_prefix, "
        "city AS customer_city, state AS customer_state FROM s_customers"
    ),
    "stg_sellers": over_sources(
        "SELECT seller_id, zip AS seller_zip_code_prefix, city AS seller_city, "
        "state AS seller_state FROM s_sellers"
    ),
    "stg_products": over_sources(
        """SELECT product_id, coalesce(p.own_name, 'unknown') AS product_category_name,
                  coalesce(english, p.own_name, 'unknown') AS product_category_name_english,
                  name_length::BIGINT AS product_name_lenght,
                  0::BIGINT AS product_description_lenght, 0::BIGINT AS product_photos_qty,
                  trunc(coalesce(weight, 0))::BIGINT AS product_weight_g,
                  len::BIGINT AS product_length_cm, height::BIGINT AS product_height_cm,
                  width::BIGINT AS product_width_cm
           FROM s_products p LEFT JOIN s_translation t ON p.own_name = t.own_name"""
    ),
}

# Least digests first; `wanted` is exact, with halves rounded to even.
SAMPLE = f""", digested AS (
  SELECT *, md5(concat('{SAMPLE_SEED}', chr(1), zip, chr(1), lat::VARCHAR, chr(1), lng::VARCHAR,
                       chr(1), city, chr(1), coalesce(state, chr(0)))) AS digest FROM s_geolocation
), sampled AS (
  SELECT * FROM digested
  QUALIFY row_number() OVER (ORDER BY digest)
    <= round_even(count(*) OVER () * {SAMPLE_FRACTION}::DOUBLE, 0)
)
SELECT """
_PLACES = (
    "zip AS geolocation_zip_code_prefix, lat AS geolocation_lat, lng AS geolocation_lng, "
    "city AS geolocation_city, state AS geolocation_state FROM "
)
STAGING_TABLES["stg_geolocation"] = over_sources("SELECT " + _PLACES + "s_geolocation")

# Columns of every source as (name, type, SQL value), for the profiles.
T, I, D, M, N = "string", "int", "double", "decimal(10,2)", "timestamp_ntz"
PROFILED = {
    "orders": (
        "s_orders",
        [
            ("order_id", T, "order_id"),
            ("customer_id", T, "customer_id"),
            ("order_status", T, "order_status"),
            ("order_purchase_timestamp", N, "bought"),
            ("order_approved_at", N, "approved"),
            ("order_delivered_carrier_date", N, "handed_over"),
            ("order_delivered_customer_date", N, "arrived"),
            ("order_estimated_delivery_date", N, "due"),
        ],
    ),
    "order_items": (
        "s_items",
        [
            ("order_id", T, "order_id"),
            ("order_item_id", I, "item_no"),
            ("product_id", T, "product_id"),
            ("seller_id", T, "seller_id"),
            ("shipping_limit_date", N, "ship_limit"),
            ("price", M, "cents"),
            ("freight_value", M, "freight_cents"),
        ],
    ),
    "payments": (
        "s_payments",
        [
            ("order_id", T, "order_id"),
            ("payment_sequential", I, "seq"),
            ("payment_type", T, "kind"),
            ("payment_installments", I, "installments"),
            ("payment_value", M, "pay_cents"),
        ],
    ),
    "reviews": (
        "s_reviews",
        [
            ("review_id", T, "review_id"),
            ("order_id", T, "order_id"),
            ("review_score", I, "score"),
            ("review_comment_title", T, "NULL::VARCHAR"),
            ("review_comment_message", T, "NULL::VARCHAR"),
            ("review_creation_date", N, "due"),
            ("review_answer_timestamp", N, "due + INTERVAL 1 DAY"),
        ],
    ),
    "customers": (
        "s_customers",
        [
            ("customer_id", T, "customer_id"),
            ("customer_unique_id", T, "person"),
            ("customer_zip_code_prefix", T, "zip"),
            ("customer_city", T, "city"),
            ("customer_state", T, "state"),
        ],
    ),
    "sellers": (
        "s_sellers",
        [
            ("seller_id", T, "seller_id"),
            ("seller_zip_code_prefix", T, "zip"),
            ("seller_city", T, "city"),
            ("seller_state", T, "state"),
        ],
    ),
    "products": (
        "s_products",
        [
            ("product_id", T, "product_id"),
            ("product_category_name", T, "own_name"),
            ("product_name_lenght", D, "name_length"),
            ("product_description_lenght", D, "NULL::DOUBLE"),
            ("product_photos_qty", D, "NULL::DOUBLE"),
            ("product_weight_g", D, "weight"),
            ("product_length_cm", D, "len"),
            ("product_height_cm", D, "height"),
            ("product_width_cm", D, "width"),
        ],
    ),
    "geolocation": (
        "s_geolocation",
        [
            ("geolocation_zip_code_prefix", T, "zip"),
            ("geolocation_lat", D, "lat"),
            ("geolocation_lng", D, "lng"),
            ("geolocation_city", T, "city"),
            ("geolocation_state", T, "state"),
        ],
    ),
    "translation": (
        "s_translation",
        [
            ("product_category_name", T, "own_name"),
            ("product_category_name_english", T, "english"),
        ],
    ),
}


def _edge(kind: str, least: bool, value: str) -> str:
    picked = f"{'min' if least else 'max'}({value})"
    if kind == T:
        return "'-'"
    if kind == N:
        return moment(picked)
    if kind == M:
        return f"CAST(CAST({picked} AS DECIMAL(20,0)) * 0.01 AS VARCHAR)"
    return f"CAST({picked} AS VARCHAR)"


def _plain(kind: str, value: str) -> str:
    """A source value as results show it."""
    if kind == N:
        return moment(value)
    if kind == M:
        return f"({value})::DOUBLE / 100"
    return f"CAST({value} AS {({T: 'VARCHAR', I: 'BIGINT', D: 'DOUBLE'})[kind]})"


CSV_SOURCES = {
    f"csv_{table}": over_sources(
        "SELECT "
        + ", ".join(f"{_plain(kind, value)} AS {name}" for name, kind, value in columns)
        + f" FROM {source}"
    )
    for table, (source, columns) in PROFILED.items()
}


def _profile_columns() -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS dtype, "
        f"count(*) - count({value}) AS null_count, "
        f"{half_up(f'100 * (count(*) - count({value}))', 'count(*)', 1)} AS null_pct, "
        f"count(DISTINCT {value}) AS distinct_count, "
        f"{_edge(kind, True, value)} AS min_value, {_edge(kind, False, value)} AS max_value "
        f"FROM {source}"
        for table, (source, columns) in PROFILED.items()
        for name, kind, value in columns
    ]
    return over_sources("\nUNION ALL ".join(parts))


def _profile_tables() -> str:
    parts = []
    for table, (source, columns) in PROFILED.items():
        values = ", ".join(value for _, _, value in columns)
        nulls = " + ".join(f"(count({v}) < count(*))::BIGINT" for _, _, v in columns)
        parts.append(
            f"SELECT '{table}' AS table_name, count(*) AS row_count, "
            f"{len(columns)}::BIGINT AS column_count, "
            f"count(*) - count(DISTINCT row({values})) AS duplicate_count, "
            f"({nulls})::BIGINT AS null_columns FROM {source}"
        )
    return over_sources("\nUNION ALL ".join(parts))


KEYS = {
    "orders": ("s_orders", "order_id", "order_id"),
    "order_items": ("s_items", "order_id, order_item_id", "row(order_id, item_no)"),
    "payments": ("s_payments", "order_id, payment_sequential", "row(order_id, seq)"),
    "reviews": ("s_reviews", "review_id", "review_id"),
    "customers": ("s_customers", "customer_id", "customer_id"),
    "sellers": ("s_sellers", "seller_id", "seller_id"),
    "products": ("s_products", "product_id", "product_id"),
}
VALIDATION = {
    "validate_primary_keys": over_sources(
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{shown}' AS key_columns, "
            f"count(*) - count(DISTINCT {key}) AS duplicate_count FROM {source}"
            for table, (source, shown, key) in KEYS.items()
        )
    ),
    "validate_non_negative": over_sources(
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{name}' AS column_name, "
            f"count(*) FILTER (WHERE {value} < 0) AS negative_count FROM {source}"
            for table, name, source, value in (
                ("order_items", "price", "s_items", "cents"),
                ("order_items", "freight_value", "s_items", "freight_cents"),
                ("payments", "payment_value", "s_payments", "pay_cents"),
                ("reviews", "review_score", "s_reviews", "score"),
            )
        )
    ),
    "validate_score_range": over_sources(
        "SELECT 'reviews' AS table_name, count(*) FILTER (WHERE score NOT BETWEEN 1 AND 5) "
        "AS invalid_count FROM s_reviews"
    ),
}

VALIDATION["validate_warnings"] = over_sources(
    "SELECT '[orders] EMPTY' AS warning UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '[{table}] ' || (count(*) - count(DISTINCT {key})) || "
        f"' duplicate rows on key {shown}' FROM {source} HAVING count(*) > count(DISTINCT {key})"
        for table, (source, shown, key) in KEYS.items()
        if table != "orders"
    )
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '[{table}] ' || count(*) || ' {said}' FROM {source} WHERE {wrong} HAVING count(*) > 0"
        for table, said, source, wrong in (
            ("order_items", "negative values in price", "s_items", "cents < 0"),
            ("order_items", "negative values in freight_value", "s_items", "freight_cents < 0"),
            ("payments", "negative values in payment_value", "s_payments", "pay_cents < 0"),
            ("reviews", "negative values in review_score", "s_reviews", "score < 0"),
            ("reviews", "review scores outside 1-5", "s_reviews", "score NOT BETWEEN 1 AND 5"),
        )
    )
)

# Columns of tables as the catalog has them; staging tables end with the moment of the load.
AUDIT = "_etl_loaded_at timestamp"
PRODUCT_INTS = (
    "product_name_lenght int, product_description_lenght int, product_photos_qty int, "
    "product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int"
)
STAGING_COLUMNS = {
    f"stg_{own}": ", ".join(f"{name} {kind}" for name, kind, _ in PROFILED[table][1]) + f", {AUDIT}"
    for own, table in (
        ("orders", "orders"),
        ("order_items", "order_items"),
        ("order_payments", "payments"),
        ("order_reviews", "reviews"),
        ("customers", "customers"),
        ("sellers", "sellers"),
    )
} | {
    "stg_products": "product_id string, product_category_name string, "
    f"product_category_name_english string, {PRODUCT_INTS}, {AUDIT}",
    "stg_geolocation": "geolocation_zip_code_prefix string, geolocation_lat decimal(10,6), "
    f"geolocation_lng decimal(10,6), geolocation_city string, geolocation_state string, {AUDIT}",
}
STAR_COLUMNS = {
    "dim_time": "time_key int, full_date date, year int, quarter int, month int, "
    "month_name string, week_of_year int, day_of_month int, day_of_week int, day_name string, "
    "is_weekend boolean",
    "dim_region": "region_key int, state_code string, state_name string, macro_region string",
    "dim_customer": "customer_key bigint, customer_id string, customer_unique_id string, "
    "customer_zip_code_prefix string, customer_city string, customer_state string",
    "dim_product": "product_key bigint, product_id string, product_category_name string, "
    "product_category_name_english string, product_weight_g int, product_length_cm int, "
    "product_height_cm int, product_width_cm int",
    "dim_seller": "seller_key bigint, seller_id string, seller_zip_code_prefix string, "
    "seller_city string, seller_state string",
    "fact_orders": "order_id string, order_item_id int, customer_key bigint, product_key bigint, "
    "seller_key bigint, purchase_time_key int, delivery_time_key int, customer_region_key int, "
    "seller_region_key int, price decimal(10,2), freight_value decimal(10,2), "
    "total_revenue decimal(11,2), payment_value decimal(20,2), payment_installments int, "
    "review_score int, delivery_days int, estimated_delivery_days int, delay_days int, "
    "is_on_time boolean, order_status string, payment_type string",
}


def _described(columns: dict[str, str], rows: dict[str, str]) -> str:
    """One row per column: its place, type, rows and values that are not NULL."""
    tables = ",\n".join(f"t_{name} AS MATERIALIZED ({rows[name]})" for name in columns)
    parts = []
    for name, listed in columns.items():
        for place, column in enumerate(listed.split(", "), 1):
            own, kind = column.split(" ")
            values = "*" if column == AUDIT else own
            parts.append(
                f"SELECT '{name}' AS table_name, {place}::BIGINT AS position, "
                f"'{own}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, "
                f"count({values}) AS value_count FROM t_{name}"
            )
    return f"WITH {tables}\n" + "\nUNION ALL ".join(parts)


CREATED = {
    "create_staging": _described(STAGING_COLUMNS, STAGING_TABLES),
    "create_warehouse": _described(STAR_COLUMNS, STAR_TABLES),
}

TABLE_SIZES = {
    "dim_time": "d_time",
    "dim_region": "d_region",
    "dim_customer": "d_customer",
    "dim_product": "d_product",
    "dim_seller": "d_seller",
    "fact_orders": "w",
}
COLUMN_COUNTS = {
    "dim_time": 11,
    "dim_region": 4,
    "dim_customer": 6,
    "dim_product": 8,
    "dim_seller": 5,
    "fact_orders": 21,
}
ROW_COUNTS = over_star(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}"
        for name, cte in TABLE_SIZES.items()
    )
)
STAGED_COUNTS = over_sources(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {n} AS row_count FROM {source}"
        for name, source, n in (
            ("stg_orders", "s_orders", "count(*)"),
            ("stg_order_items", "s_items", "count(DISTINCT row(order_id, item_no))"),
            ("stg_order_payments", "s_payments", "count(DISTINCT row(order_id, seq))"),
            ("stg_order_reviews", "s_reviews", "count(*)"),
            ("stg_customers", "s_customers", "count(*)"),
            ("stg_sellers", "s_sellers", "count(*)"),
            ("stg_products", "s_products", "count(*)"),
            ("stg_geolocation", "s_geolocation", "count(*)"),
        )
    )
)
STAR_SUMMARY = over_star(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, "
        f"{COLUMN_COUNTS[name]}::BIGINT AS column_count FROM {cte}"
        for name, cte in TABLE_SIZES.items()
    )
)
FACT_SUMMARY = over_star(
    f"""SELECT count(*) AS fact_rows, count(DISTINCT order_id) AS orders,
               count(*) FILTER (WHERE status = 'delivered') AS delivered_rows,
               sum(cents)::DOUBLE / 100 AS total_price, {mean_money("cents")} AS avg_price,
               {mean("score", 2)} AS avg_review_score, {mean("took", 1)} AS avg_delivery_days
        FROM w"""
)


def _n(value: str) -> str:
    return f"format('{{:,}}', ({value})::BIGINT)"


def _fixed(value: str, scale: int) -> str:
    return f"CAST(CAST({value} AS DECIMAL(20,{scale})) AS VARCHAR)"


def _check(name: str, passed: str, detail: str, source: str, otherwise: str = "FAIL") -> str:
    return (
        f"SELECT '{name}' AS check_name, CASE WHEN {passed} THEN 'PASS' ELSE '{otherwise}' END "
        f"AS status, {detail} AS detail FROM {source}"
    )


ROW_CHECKS = [
    _check(
        f"row_count_{name}",
        f"count(*) >= {least}",
        f"{_n('count(*)')} || ' rows (at least {least:,})'",
        TABLE_SIZES[name],
    )
    for name, least in P.minimum_rows
]
_STAGED_ORDERS = "(SELECT count(DISTINCT order_id) FROM s_orders)"
_MATCH = f"100.0 * count(DISTINCT order_id) / {_STAGED_ORDERS}"
STAGING_CHECKS = [
    _check(
        "staging_vs_dwh_orders",
        f"{_MATCH} >= {P.min_order_match_pct}",
        f"'Staging: ' || {_n(_STAGED_ORDERS)} || ' | Warehouse: ' || "
        f"{_n('count(DISTINCT order_id)')} || ' | Match: ' || "
        f"{_fixed(half_up('100 * count(DISTINCT order_id)', _STAGED_ORDERS, 1), 1)} || '%'",
        "w",
        "WARN",
    ),
    _check(
        "staging_vs_dwh_customers",
        f"abs(count(*) - (SELECT count(*) FROM s_customers)) <= {P.max_customer_gap}",
        f"'Staging: ' || {_n('(SELECT count(*) FROM s_customers)')} || ' | Warehouse: ' || "
        f"{_n('count(*)')}",
        "d_customer",
    ),
]


def _none(name: str, condition: str, text: str, otherwise: str = "FAIL") -> str:
    """A check that no fact row meets the condition."""
    count = f"count(*) FILTER (WHERE {condition})"
    shown = text.replace("'", "''")
    return _check(name, f"{count} = 0", f"{_n(count)} || '{shown}'", "w", otherwise)


NULL_CHECKS = [
    _none(f"null_check_{name}", condition, f" rows where {shown}")
    for name, condition, shown in (
        ("price", "cents IS NULL OR cents < 0", "price IS NULL OR price < 0"),
        ("freight_value", "freight_cents IS NULL", "freight_value IS NULL"),
        (
            "total_revenue",
            "gross_cents IS NULL OR gross_cents < 0",
            "total_revenue IS NULL OR total_revenue < 0",
        ),
        ("customer_key", "customer_key IS NULL", "customer_key IS NULL"),
        ("product_key", "product_key IS NULL", "product_key IS NULL"),
        ("purchase_time_key", "day IS NULL", "purchase_time_key IS NULL"),
    )
]
REFERENCE_CHECKS = [
    _none(f"fk_orphan_{name}", f"{key} NOT IN (SELECT {own} FROM {table})", " orphan rows")
    for name, key, own, table in (
        ("customer_key", "customer_key", "customer_key", "d_customer"),
        ("product_key", "product_key", "product_key", "d_product"),
        ("seller_key", "seller_key", "seller_key", "d_seller"),
        ("purchase_time_key", "day", "day", "d_time"),
        ("customer_region_key", "home_key", "region_key", "d_region"),
    )
]
_DELIVERED = "count(*) FILTER (WHERE status = 'delivered')"
RULE_CHECKS = [
    _none(
        "review_score_range",
        "score NOT BETWEEN 1 AND 5",
        " rows with a review score outside 1-5",
    ),
    _none("delivery_days_positive", "took <= 0", " rows with delivery_days <= 0", "WARN"),
    _check(
        "delivered_rate",
        f"100 * {_DELIVERED} >= {P.min_delivered_pct} * count(*)",
        f"{_fixed(half_up(f'100 * {_DELIVERED}', 'count(*)', 1), 1)} || '% delivered (' || "
        f"{_n(_DELIVERED)} || '/' || {_n('count(*)')} || ')'",
        "w",
    ),
    _check(
        "avg_review_score",
        f"{mean('score', 2)} BETWEEN 2.5 AND 5.0",
        f"'Mean review score = ' || {_fixed(mean('score', 2), 2)} || ' (expected 2.5-5.0)'",
        "w",
    ),
]
_ON_TIME = half_up("100 * count(*) FILTER (WHERE on_time)", "count(on_time)", 1)
DISTRIBUTION_CHECK = _check(
    "distribution_stats",
    "true",
    f"'Mean price=R$' || {_fixed(mean_money('cents'), 2)} || ', mean review=' || "
    f"{_fixed(mean('score', 2), 2)} || ', on time=' || {_fixed(_ON_TIME, 1)} || '%'",
    "w WHERE status = 'delivered'",
)
ALL_CHECKS = [
    *ROW_CHECKS,
    *STAGING_CHECKS,
    *NULL_CHECKS,
    *REFERENCE_CHECKS,
    *RULE_CHECKS,
    DISTRIBUTION_CHECK,
]


def _union(checks: list[str]) -> str:
    return over_star("\nUNION ALL ".join(checks))


QUALITY = {
    "dq_row_counts": _union(ROW_CHECKS),
    "dq_staging_consistency": _union(STAGING_CHECKS),
    "dq_null_checks": _union(NULL_CHECKS),
    "dq_referential_integrity": _union(REFERENCE_CHECKS),
    "dq_business_rules": _union(RULE_CHECKS),
    "dq_report": _union(ALL_CHECKS),
    "dq_verdict": over_star(
        f""", results AS ({" UNION ALL ".join(ALL_CHECKS)})
        SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
               count(*) FILTER (WHERE status = 'WARN') AS warned,
               count(*) FILTER (WHERE status = 'FAIL') AS failed,
               (count(*) FILTER (WHERE status = 'FAIL') = 0)::BIGINT AS success FROM results"""
    ),
    "dq_distribution": over_star(
        f"""SELECT count(*) AS total_items, count(DISTINCT order_id) AS total_orders,
                   count(DISTINCT customer_key) AS unique_customers,
                   min(cents)::DOUBLE / 100 AS min_price, max(cents)::DOUBLE / 100 AS max_price,
                   {mean_money("cents")} AS avg_price, {mean("score", 2)} AS avg_review,
                   {mean("took", 1)} AS avg_delivery_days, {_ON_TIME} AS pct_on_time
            FROM w WHERE status = 'delivered'"""
    ),
    "dq_top_categories": over_star(
        f"""SELECT category, count(*) AS items, {half_up("sum(cents)", "100", 0)} AS revenue
            FROM w WHERE status = 'delivered' GROUP BY category
            ORDER BY revenue DESC, category LIMIT 10"""
    ),
    "dq_status_mix": over_star(
        "SELECT status AS order_status, count(*) AS item_rows FROM w GROUP BY status"
    ),
    "dq_fact_unique": over_star(
        f"""SELECT 'fact_item_unique' AS check_name,
                   CASE WHEN count(*) = count(DISTINCT row(order_id, item_no)) THEN 'PASS'
                        ELSE 'FAIL' END AS status,
                   {_n("count(*) - count(DISTINCT row(order_id, item_no))")}
                     || ' duplicate rows of ' || {_n("count(*)")} AS detail FROM w"""
    ),
}

_TOKENS = ", ".join(f"'{t}'" for t in MISSING_TOKENS)
OPERATORS = {
    "coerce_timestamps": """
        SELECT o_orderkey, raw_text, strftime(try_cast(raw_text AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')
                 AS moment
        FROM (SELECT o_orderkey,
                     CASE WHEN o_orderkey % 13 = 0
                            THEN 'about ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                          WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                          WHEN o_orderkey % 5 = 0 THEN o_orderpriority
                          ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS raw_text
              FROM orders)""",
    "normalize_missing": f"""
        SELECT c_custkey, CASE WHEN c_custkey % 40 >= {len(MISSING_TOKENS)} THEN c_mktsegment END
                 AS segment FROM customer""",
    "title_case": over_sources(
        f"SELECT DISTINCT city AS customer_city, {title('city')} AS clean_city FROM s_customers"
    ),
    "csv_documents": f"""
        SELECT doc_id, CASE WHEN text NOT IN ({_TOKENS}) THEN text END AS text,
               CASE WHEN lang NOT IN ({_TOKENS}) THEN lang END AS lang,
               CASE WHEN source NOT IN ({_TOKENS}) THEN source END AS source, n_chars
        FROM documents""",
    "sample_hash": over_sources(SAMPLE + _PLACES + "sampled"),
    "state_table": """
        WITH states(region_key, state_code, state_name, macro_region) AS (VALUES
          (1, 'AC', 'Acre', 'Norte'), (2, 'AL', 'Alagoas', 'Nordeste'),
          (3, 'AP', 'Amapá', 'Norte'), (4, 'AM', 'Amazonas', 'Norte'),
          (5, 'BA', 'Bahia', 'Nordeste'), (6, 'CE', 'Ceará', 'Nordeste'),
          (7, 'DF', 'Distrito Federal', 'Centro-Oeste'), (8, 'ES', 'Espírito Santo', 'Sudeste'),
          (9, 'GO', 'Goiás', 'Centro-Oeste'), (10, 'MA', 'Maranhão', 'Nordeste'),
          (11, 'MT', 'Mato Grosso', 'Centro-Oeste'), (12, 'MS', 'Mato Grosso do Sul', 'Centro-Oeste'),
          (13, 'MG', 'Minas Gerais', 'Sudeste'), (14, 'PA', 'Pará', 'Norte'),
          (15, 'PB', 'Paraíba', 'Nordeste'), (16, 'PR', 'Paraná', 'Sul'),
          (17, 'PE', 'Pernambuco', 'Nordeste'), (18, 'PI', 'Piauí', 'Nordeste'),
          (19, 'RJ', 'Rio de Janeiro', 'Sudeste'), (20, 'RN', 'Rio Grande do Norte', 'Nordeste'),
          (21, 'RS', 'Rio Grande do Sul', 'Sul'), (22, 'RO', 'Rondônia', 'Norte'),
          (23, 'RR', 'Roraima', 'Norte'), (24, 'SC', 'Santa Catarina', 'Sul'),
          (25, 'SP', 'São Paulo', 'Sudeste'), (26, 'SE', 'Sergipe', 'Nordeste'),
          (27, 'TO', 'Tocantins', 'Norte'))
        SELECT region_key::BIGINT AS region_key, state_code, state_name, macro_region,
               count(o_orderkey) AS orders
        FROM states LEFT JOIN orders ON o_orderkey % 27 + 1 = region_key
        GROUP BY 1, 2, 3, 4""",
    "global_ntile": """
        SELECT c_custkey,
               CAST(ntile(5) OVER (ORDER BY c_acctbal, c_custkey) AS BIGINT) AS poor_tile,
               CAST(ntile(5) OVER (ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS rich_tile
        FROM customer""",
    "load_staging": STAGED_COUNTS,
    "load_warehouse": ROW_COUNTS,
    "table_row_counts": ROW_COUNTS,
    "star_schema_summary": STAR_SUMMARY,
    "fact_summary": FACT_SUMMARY,
    "profile_columns": _profile_columns(),
    "profile_tables": _profile_tables(),
}

TABLES = STAR_TABLES | STAGING_TABLES | CSV_SOURCES | CREATED | VALIDATION | QUALITY | OPERATORS
