"""Adapter: the order-processing test tables seen as marketplace sources.

All values are derived by integer, decimal and date arithmetic, row by row or by
key joins, so the sources grow with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercastar.plans.parameters import ReportParameters
from mercastar.schemas import SOURCES, WAREHOUSE, conform
from mercastar.sources.lazy import LazyTables

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Parameters under which the reports have something to cut on this data.
PARAMETERS = ReportParameters(
    rfm_date="2001-10-01",
    trend_cutoff="2001-08-01",
    hot_period="2001-07",
    cohort_floor="1996-01",
    min_seller_orders=390,
    min_tier_orders=400,
    min_category_items=1500,
    sla_excellent=78,
    sla_good=76.5,
    tier_top=(3.92, 75),
    tier_good=(3.86, 72),
    tier_low=3.84,
    minimum_rows=(
        ("dim_time", 500),
        ("dim_region", 27),
        ("dim_customer", 9_000),
        ("dim_product", 3_000),
        ("dim_seller", 50),
        ("fact_orders", 10_000),
    ),
)


# Expressions that occur in more than one source.
STATUS = """CASE WHEN o_orderstatus IN ('F', 'O') THEN 'delivered'
                 WHEN o_orderkey % 10 = 0 THEN 'canceled' ELSE 'shipped' END"""
DUE_DAYS = "CAST(18 + o_orderkey * 13 % 23 AS INT)"
ARRIVAL_DAYS = "CAST(1 + (o_orderkey * 37 + o_custkey * 11) % 36 AS INT)"
GRADE = "(o_orderkey * 7 + o_custkey * 3) % 10"
PRICE = "CAST(CAST(floor(l_extendedprice) AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,2))"
FREIGHT = "CAST(l_quantity AS DECIMAL(10,2))"
BRAND = r"regexp_extract(p_brand, '([0-9]+)', 1)"


def _after(moment: str, days: str = "0", seconds: str = "0") -> str:
    return f"{moment} + make_dt_interval({days}, 0, 0, CAST({seconds} AS DECIMAL(18,6)))"


class TestTables:
    """Views of the test tables of one folder as sources."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read = LazyTables({name: self._reader(name) for name in TABLES})

    def _reader(self, name: str) -> Callable[[], DataFrame]:
        return lambda: self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def orders(self) -> DataFrame:
        live = "order_status <> 'canceled'"
        arrived = "order_status = 'delivered' AND o_orderkey % 97 <> 0"
        arrival = _after("o_orderdate", ARRIVAL_DAYS, "o_orderkey * 7919 % 86400")
        bought = _after("o_orderdate", seconds="o_orderkey * 104729 % 86400")
        return (
            self._read["orders"]
            .selectExpr("*", f"{STATUS} AS order_status", f"{bought} AS bought")
            .selectExpr(
                "'o' || o_orderkey AS order_id",
                "'c' || o_orderkey AS customer_id",
                "order_status",
                "bought AS order_purchase_timestamp",
                f"CASE WHEN {live} THEN bought + INTERVAL 1 HOUR END AS order_approved_at",
                f"CASE WHEN {live} THEN bought + INTERVAL 1 DAY END "
                "AS order_delivered_carrier_date",
                f"CASE WHEN {arrived} THEN {arrival} END AS order_delivered_customer_date",
                f"{_after('o_orderdate', DUE_DAYS)} AS order_estimated_delivery_date",
            )
        )

    def order_items(self) -> DataFrame:
        # The line number is the item number as it stands: numbering an order's
        # lines anew would put each order, however large, into one task.
        return self._read["lineitem"].selectExpr(
            "'o' || l_orderkey AS order_id",
            "l_linenumber AS order_item_id",
            "'p' || l_partkey AS product_id",
            "'s' || l_suppkey AS seller_id",
            "l_shipdate AS shipping_limit_date",
            f"{PRICE} AS price",
            f"{FREIGHT} AS freight_value",
        )

    def payments(self) -> DataFrame:
        kind = """CASE WHEN l_linenumber = 1 AND l_orderkey % 53 = 0 THEN NULL
                       WHEN l_orderkey % 101 = 0 THEN 'not_defined'
                       WHEN round(l_tax * 100) = 8 THEN 'debit_card'
                       WHEN l_returnflag = 'A' THEN 'credit_card'
                       WHEN l_returnflag = 'N' THEN 'boleto' ELSE 'voucher' END"""
        return (
            self._read["lineitem"]
            .where("l_orderkey % 211 <> 0")
            .selectExpr(
                "'o' || l_orderkey AS order_id",
                "l_linenumber AS payment_sequential",
                f"{kind} AS payment_type",
                "l_linenumber + 1 AS payment_installments",
                f"{PRICE} + {FREIGHT} AS payment_value",
            )
        )

    def reviews(self) -> DataFrame:
        """Some orders are reviewed twice, with the opposite score."""
        score = f"CASE WHEN {GRADE} < 3 THEN {GRADE} + 1 WHEN {GRADE} < 5 THEN 4 ELSE 5 END"
        return (
            self._read["orders"]
            .where("o_orderkey % 11 <> 0")
            .selectExpr(
                "o_orderkey",
                f"{score} AS score",
                f"{_after('o_orderdate', DUE_DAYS)} AS due",
                "explode(IF(o_orderkey % 50 = 0, array('', 'b'), array(''))) AS mark",
            )
            .selectExpr(
                "'r' || o_orderkey || mark AS review_id",
                "'o' || o_orderkey AS order_id",
                "IF(mark = 'b', 6 - score, score) AS review_score",
                "CAST(NULL AS STRING) AS review_comment_title",
                "CAST(NULL AS STRING) AS review_comment_message",
                "due AS review_creation_date",
                "due + INTERVAL 1 DAY AS review_answer_timestamp",
            )
        )

    def people(self) -> DataFrame:
        """The customer table with zip, city and state."""
        city = """CASE c_custkey % 4 WHEN 0 THEN ' são paulo ' WHEN 1 THEN 'SAO PAULO'
                       ELSE '  ' || lower(c_mktsegment) || " d'oeste " END"""
        named = self._read["nation"].selectExpr("n_nationkey AS c_nationkey", "n_name")
        return (
            self._read["customer"]
            .join(named, "c_nationkey")
            .selectExpr(
                "c_custkey",
                "lpad(CAST(c_custkey AS STRING), 5, '0') AS zip",
                f"{city} AS city",
                "CASE WHEN c_custkey <> 7 THEN ' ' || lower(n_name) || ' ' END AS state",
            )
        )

    def customers(self) -> DataFrame:
        """One customer record per order; some people have several."""
        orders = self._read["orders"].selectExpr("o_orderkey", "o_custkey AS c_custkey")
        person = "IF(o_orderkey % 10 < 7, 'u' || o_orderkey, 'g' || c_custkey)"
        return orders.join(self.people(), "c_custkey").selectExpr(
            "'c' || o_orderkey AS customer_id",
            f"{person} AS customer_unique_id",
            "zip AS customer_zip_code_prefix",
            "city AS customer_city",
            "state AS customer_state",
        )

    def sellers(self) -> DataFrame:
        named = self._read["nation"].selectExpr("n_nationkey AS s_nationkey", "n_name")
        return (
            self._read["supplier"]
            .join(named, "s_nationkey")
            .selectExpr(
                "'s' || s_suppkey AS seller_id",
                "lpad(CAST(s_suppkey AS STRING), 5, '0') AS seller_zip_code_prefix",
                "IF(s_suppkey % 2 = 1, 'são paulo', 'sao paulo') AS seller_city",
                "CASE WHEN s_suppkey <> 3 THEN n_name END AS seller_state",
            )
        )

    def products(self) -> DataFrame:
        return self._read["part"].selectExpr(
            "'p' || p_partkey AS product_id",
            f"CASE WHEN p_partkey % 40 <> 0 THEN 'brand_' || {BRAND} END AS product_category_name",
            "CAST(length(p_name) AS DOUBLE) AS product_name_lenght",
            "CAST(NULL AS DOUBLE) AS product_description_lenght",
            "CAST(NULL AS DOUBLE) AS product_photos_qty",
            "CASE WHEN p_partkey % 33 <> 0 THEN p_size * 100.5D END AS product_weight_g",
            "p_size AS product_length_cm",
            "p_size + 1 AS product_height_cm",
            "p_size + 2 AS product_width_cm",
        )

    def translation(self) -> DataFrame:
        """Twenty brand numbers have an English category."""
        numbers = self._read["part"].selectExpr(f"{BRAND} AS n").distinct()
        return numbers.where("CAST(n AS INT) <= 20").selectExpr(
            "'brand_' || n AS product_category_name",
            "'category_' || n AS product_category_name_english",
        )

    def geolocation(self) -> DataFrame:
        return self.people().selectExpr(
            "zip AS geolocation_zip_code_prefix",
            "c_custkey % 180 - 90 AS geolocation_lat",
            "c_custkey % 360 - 180 AS geolocation_lng",
            "city AS geolocation_city",
            "state AS geolocation_state",
        )

    def regions(self) -> DataFrame:
        """Nations as states, regions as macro-regions."""
        named = self._read["region"].selectExpr("r_regionkey AS n_regionkey", "r_name")
        joined = (
            self._read["nation"]
            .join(named, "n_regionkey")
            .selectExpr(
                "n_nationkey + 1 AS region_key",
                "n_name AS state_code",
                "'State ' || n_nationkey AS state_name",
                "r_name AS macro_region",
            )
        )
        return conform(joined, WAREHOUSE["dim_region"])

    def sources(self) -> LazyTables:
        def builder(key: str) -> Callable[[], DataFrame]:
            return lambda: conform(getattr(self, key)(), SOURCES[key])

        return LazyTables({key: builder(key) for key in SOURCES})


def sources(spark: SparkSession, folder: str) -> LazyTables:
    return TestTables(spark, folder).sources()


def regions(spark: SparkSession, folder: str) -> DataFrame:
    return TestTables(spark, folder).regions()
