"""Common table expressions for sources, dimensions and the wide fact."""

from __future__ import annotations


def half_up(top: str, bottom: str, scale: int) -> str:
    """top / bottom rounded half away from zero, in integers, as a double."""
    t, b, f = f"({top})", f"({bottom})", 10**scale
    return (
        f"(CASE WHEN {b} = 0 THEN NULL ELSE CAST(sign({t}) * "
        f"((2 * abs({t}) * {f} + {b}) // (2 * {b})) AS DOUBLE) / {f} END)"
    )


def money(column: str) -> str:
    return f"(CAST(sum({column}) AS DOUBLE) / 100)"


def mean(column: str, scale: int) -> str:
    return half_up(f"sum({column})", f"count({column})", scale)


def mean_money(column: str) -> str:
    return half_up(f"sum({column})", f"100 * count({column})", 2)


def percent(condition: str) -> str:
    return half_up(f"100 * count(*) FILTER (WHERE {condition})", "count(*)", 1)


def share(value: str) -> str:
    """Percent of the total over all result rows."""
    return half_up(f"100 * {value}", f"sum({value}) OVER ()", 1)


def bands(value: str, pairs: tuple, operator: str = "<=") -> str:
    *bounded, (_, last) = pairs
    cases = " ".join(f"WHEN {value} {operator} {bound} THEN '{out}'" for bound, out in bounded)
    return f"(CASE {cases} ELSE '{last}' END)"


def band_numbers(value: str, pairs: tuple, operator: str = "<=") -> str:
    numbered = tuple((bound, n) for n, (bound, _) in enumerate(pairs, 1))
    return f"CAST({bands(value, numbered, operator)} AS BIGINT)"


def title(column: str) -> str:
    runs = f"regexp_extract_all(lower(trim({column})), '\\p{{L}}+|\\P{{L}}+')"
    return f"array_to_string([upper(x[1]) || x[2:] FOR x IN {runs}], '')"


def moment(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def key_order(column: str) -> str:
    return f"row_number() OVER (ORDER BY substr(md5({column}), 1, 4), {column})"


def days_between(start: str, end: str) -> str:
    micros = f"date_diff('microsecond', {start}, {end})"
    return f"CAST(floor({micros} / 86400000000.0) AS BIGINT)"


SOURCES = """
s_orders AS (
  SELECT 'o' || o_orderkey AS order_id, 'c' || o_orderkey AS customer_id, k.order_status,
         k.bought,
         CASE WHEN k.order_status <> 'canceled' THEN k.bought + INTERVAL 1 HOUR END AS approved,
         CASE WHEN k.order_status <> 'canceled' THEN k.bought + INTERVAL 1 DAY END AS handed_over,
         CASE WHEN k.order_status = 'delivered' AND o_orderkey % 97 <> 0 THEN
           CAST(o_orderdate AS TIMESTAMP)
           + to_days(CAST(1 + (o_orderkey * 37 + o_custkey * 11) % 36 AS INTEGER))
           + to_seconds(o_orderkey * 7919 % 86400) END AS arrived,
         CAST(o_orderdate AS TIMESTAMP)
           + to_days(CAST(18 + o_orderkey * 13 % 23 AS INTEGER)) AS due
  FROM (SELECT *, CASE WHEN o_orderstatus IN ('F', 'O') THEN 'delivered'
                       WHEN o_orderkey % 10 = 0 THEN 'canceled'
                       ELSE 'shipped' END AS order_status,
               CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey * 104729 % 86400) AS bought
        FROM orders) k
),
s_items AS (
  SELECT 'o' || l_orderkey AS order_id, l_linenumber AS item_no, 'p' || l_partkey AS product_id,
         's' || l_suppkey AS seller_id, l_shipdate AS ship_limit,
         CAST(floor(l_extendedprice) AS BIGINT) AS cents,
         CAST(l_quantity AS BIGINT) * 100 AS freight_cents
  FROM lineitem
),
s_payments AS (
  SELECT 'o' || l_orderkey AS order_id, l_linenumber AS seq,
         CASE WHEN l_linenumber = 1 AND l_orderkey % 53 = 0 THEN NULL
              WHEN l_orderkey % 101 = 0 THEN 'not_defined'
              WHEN round(l_tax * 100) = 8 THEN 'debit_card'
              WHEN l_returnflag = 'A' THEN 'credit_card'
              WHEN l_returnflag = 'N' THEN 'boleto'
              ELSE 'voucher' END AS kind,
         l_linenumber + 1 AS installments,
         CAST(floor(l_extendedprice) AS BIGINT) + CAST(l_quantity AS BIGINT) * 100 AS pay_cents
  FROM lineitem WHERE l_orderkey % 211 <> 0
),
s_reviews AS (
  SELECT 'r' || o_orderkey || m.mark AS review_id, 'o' || o_orderkey AS order_id,
         CASE WHEN m.mark = 'b' THEN 6 - g.score ELSE g.score END AS score,
         CAST(o_orderdate AS TIMESTAMP)
           + to_days(CAST(18 + o_orderkey * 13 % 23 AS INTEGER)) AS due
  FROM (SELECT *, CASE WHEN (o_orderkey * 7 + o_custkey * 3) % 10 < 3
                         THEN (o_orderkey * 7 + o_custkey * 3) % 10 + 1
                       WHEN (o_orderkey * 7 + o_custkey * 3) % 10 < 5 THEN 4
                       ELSE 5 END AS score FROM orders WHERE o_orderkey % 11 <> 0) g
  JOIN (VALUES (''), ('b')) m(mark) ON m.mark = '' OR o_orderkey % 50 = 0
),
s_people AS (
  SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS zip,
         CASE c_custkey % 4 WHEN 0 THEN ' são paulo ' WHEN 1 THEN 'SAO PAULO'
              ELSE '  ' || lower(c_mktsegment) || ' d''oeste ' END AS city,
         CASE WHEN c_custkey <> 7 THEN ' ' || lower(n_name) || ' ' END AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
s_customers AS (
  SELECT 'c' || o_orderkey AS customer_id,
         CASE WHEN o_orderkey % 10 < 7 THEN 'u' || o_orderkey ELSE 'g' || o_custkey END AS person,
         zip, city, state
  FROM orders JOIN s_people ON o_custkey = c_custkey
),
s_sellers AS (
  SELECT 's' || s_suppkey AS seller_id, lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS zip,
         CASE WHEN s_suppkey % 2 = 1 THEN 'são paulo' ELSE 'sao paulo' END AS city,
         CASE WHEN s_suppkey <> 3 THEN n_name END AS state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
s_products AS (
  SELECT 'p' || p_partkey AS product_id,
         CASE WHEN p_partkey % 40 <> 0 THEN 'brand_' || regexp_extract(p_brand, '[0-9]+') END
           AS own_name,
         CAST(length(p_name) AS DOUBLE) AS name_length,
         CASE WHEN p_partkey % 33 <> 0 THEN p_size * 100.5::DOUBLE END AS weight,
         CAST(p_size AS DOUBLE) AS len, CAST(p_size + 1 AS DOUBLE) AS height,
         CAST(p_size + 2 AS DOUBLE) AS width
  FROM part
),
s_translation AS (
  SELECT DISTINCT 'brand_' || n AS own_name, 'category_' || n AS english
  FROM (SELECT regexp_extract(p_brand, '[0-9]+') AS n FROM part) WHERE CAST(n AS INTEGER) <= 20
),
s_geolocation AS (
  SELECT zip, CAST(c_custkey % 180 - 90 AS DOUBLE) AS lat,
         CAST(c_custkey % 360 - 180 AS DOUBLE) AS lng, city, state
  FROM s_people
)"""

STAR = f""",
d_region AS (
  SELECT n_nationkey + 1 AS region_key, n_name AS code, 'State ' || n_nationkey AS name,
         r_name AS macro
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
d_time AS (
  SELECT CAST(unnest(generate_series(
           (SELECT min(least(bought, coalesce(arrived, bought), due)) FROM s_orders)::DATE,
           (SELECT max(greatest(bought, coalesce(arrived, bought), due)) FROM s_orders)::DATE,
           INTERVAL 1 DAY)) AS DATE) AS day
),
d_customer AS (
  SELECT {key_order("customer_id")} AS customer_key, customer_id, person, zip,
         {title("city")} AS city, upper(trim(state)) AS state
  FROM s_customers
),
d_product AS (
  SELECT {key_order("product_id")} AS product_key, product_id,
         coalesce(p.own_name, 'unknown') AS own_name,
         coalesce(english, p.own_name, 'unknown') AS category,
         CAST(trunc(coalesce(weight, 0)) AS BIGINT) AS weight, CAST(len AS BIGINT) AS len,
         CAST(height AS BIGINT) AS height, CAST(width AS BIGINT) AS width
  FROM s_products p LEFT JOIN s_translation t ON p.own_name = t.own_name
),
d_seller AS (
  SELECT {key_order("seller_id")} AS seller_key, seller_id, zip, {title("city")} AS city,
         upper(trim(state)) AS state
  FROM s_sellers
),
pay AS (
  SELECT order_id, sum(pay_cents) AS pay_cents, max(installments) AS installments,
         arg_min(kind, lpad(CAST(seq AS VARCHAR), 9, '0') || kind)
           FILTER (WHERE kind IS NOT NULL) AS kind
  FROM s_payments GROUP BY order_id
),
rev AS (
  SELECT order_id, score FROM s_reviews
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_id) = 1
),
w AS (
  SELECT i.order_id, i.item_no, c.customer_key, c.person, c.city, c.state,
         p.product_key, p.category, s.seller_key, s.seller_id, s.city AS seller_city,
         s.state AS seller_state, CAST(o.bought AS DATE) AS day, CAST(o.arrived AS DATE) AS end_day,
         h.region_key AS home_key, h.code AS home_code, h.name AS home_name, h.macro AS home_macro,
         f.region_key AS from_key, f.code AS from_code, f.name AS from_name, f.macro AS from_macro,
         i.cents, i.freight_cents, i.cents + i.freight_cents AS gross_cents, pay.pay_cents,
         pay.installments, pay.kind, rev.score, {days_between("o.bought", "o.arrived")} AS took,
         {days_between("o.bought", "o.due")} AS planned,
         {days_between("o.due", "o.arrived")} AS late, o.arrived <= o.due AS on_time,
         o.order_status AS status
  FROM s_items i
  JOIN s_orders o ON i.order_id = o.order_id
  JOIN d_customer c ON o.customer_id = c.customer_id
  JOIN d_region h ON c.state = h.code
  JOIN d_product p ON i.product_id = p.product_id
  JOIN d_seller s ON i.seller_id = s.seller_id
  LEFT JOIN d_region f ON s.state = f.code
  LEFT JOIN pay ON i.order_id = pay.order_id
  LEFT JOIN rev ON i.order_id = rev.order_id
)"""


def over_sources(body: str) -> str:
    return f"WITH {SOURCES}\n{body}"


def over_star(body: str) -> str:
    return f"WITH {SOURCES}{STAR}\n{body}"
