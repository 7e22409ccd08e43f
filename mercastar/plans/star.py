"""Star schema: five dimensions and one fact row per order item."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercastar.fixed_values import DELIVERED, STATES
from mercastar.functions.measures import mean, tally
from mercastar.functions.text import state_code, title_case
from mercastar.functions.time import date_key, floor_days
from mercastar.operators.dedup import first_per_key
from mercastar.operators.keys import with_dense_key
from mercastar.schemas import WAREHOUSE, conform

CALENDAR_SOURCES = (
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

# Payment types that are told by their number, with 0 for none, in so many bits.
TYPE_BITS = 6
MOST_TYPES = (1 << TYPE_BITS) - 1


def dim_time(orders: DataFrame) -> DataFrame:
    """One row per day from the first to the last date of the orders."""
    span = orders.agg(
        F.least(*[F.min(c) for c in CALENDAR_SOURCES]).cast("date").alias("first"),
        F.greatest(*[F.max(c) for c in CALENDAR_SOURCES]).cast("date").alias("last"),
    )
    day = F.col("full_date")
    days = span.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("full_date")
    )
    return conform(
        days.select(
            date_key(day).alias("time_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.weekofyear(day).alias("week_of_year"),
            F.dayofmonth(day).alias("day_of_month"),
            (F.weekday(day) + 1).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            (F.weekday(day) >= 5).alias("is_weekend"),
        ),
        WAREHOUSE["dim_time"],
    )


def dim_region(spark: SparkSession) -> DataFrame:
    """The fixed state table, numbered in its own order."""
    rows = [(n, *state) for n, state in enumerate(STATES, 1)]
    return spark.createDataFrame(rows, WAREHOUSE["dim_region"])


def dim_customer(customers: DataFrame) -> DataFrame:
    """`customers` have one row per id, as staged."""
    clean = customers.withColumns(
        {
            "customer_city": title_case(F.col("customer_city")),
            "customer_state": state_code(F.col("customer_state")),
        }
    )
    return conform(
        with_dense_key(clean, "customer_id", "customer_key"), WAREHOUSE["dim_customer"]
    )


def dim_product(products: DataFrame) -> DataFrame:
    """`products` have one row per id, whole numbers and an English category, as staged."""
    return conform(with_dense_key(products, "product_id", "product_key"), WAREHOUSE["dim_product"])


def dim_seller(sellers: DataFrame) -> DataFrame:
    """`sellers` have one row per id, as staged."""
    clean = sellers.withColumns(
        {
            "seller_city": title_case(F.col("seller_city")),
            "seller_state": state_code(F.col("seller_state")),
        }
    )
    return conform(with_dense_key(clean, "seller_id", "seller_key"), WAREHOUSE["dim_seller"])


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Sum of values, type of the first payment that names one, most installments.

    The first type is found as a whole number: place in the order, then place of the type
    among all types. Numbers are hash-aggregated where they are read; a least struct with
    a text would have every task sort all of its payments before the shuffle. Beyond
    MOST_TYPES types, which are listed by a scan of their own, the struct is taken.
    """
    kind, place = F.col("payment_type"), F.col("payment_sequential")
    listed = payments.where(kind.isNotNull()).select(kind).distinct().limit(MOST_TYPES + 1).collect()
    types = sorted((r["payment_type"] for r in listed), key=str.encode)
    if len(types) > MOST_TYPES:
        first = F.min(F.when(kind.isNotNull(), F.struct(place, kind)))["payment_type"]
    else:
        names = F.array(*[F.lit(t) for t in types]).cast("array<string>")
        # A payment without a place comes before all others.
        rank = F.coalesce(place.cast("bigint"), F.lit(-(1 << 31) - 1)) * F.lit(1 << TYPE_BITS)
        code = F.min(F.when(kind.isNotNull(), rank + F.array_position(names, kind)))
        first = F.get(names, code.bitwiseAND(F.lit((1 << TYPE_BITS) - 1)).cast("int") - 1)
    return payments.groupBy("order_id").agg(
        F.coalesce(F.sum("payment_value"), F.lit(0)).alias("payment_value"),
        first.alias("payment_type"),
        F.max("payment_installments").alias("payment_installments"),
    )


def review_per_order(reviews: DataFrame) -> DataFrame:
    """Score of the order's first review by id, even where that score is NULL.

    Reviews are dealt by order first, since few orders have two: to collapse them before
    the shuffle, every task would sort all reviews that it reads. Reviews of no order
    meet none.
    """
    dealt = reviews.select("order_id", "review_id", "review_score").where("order_id IS NOT NULL")
    first = first_per_key(dealt.repartition("order_id"), ["order_id"], ["review_id"])
    return first.select("order_id", "review_score")


def placed_orders(orders: DataFrame, customer: DataFrame, region: DataFrame) -> DataFrame:
    """Orders with their days and their customer's keys.

    Orders without a known customer or customer region cannot become facts and end here.
    """
    bought = F.col("order_purchase_timestamp")
    arrived = F.col("order_delivered_customer_date")
    due = F.col("order_estimated_delivery_date")
    # A delivery without an estimate counts as late.
    on_time = F.when(arrived.isNotNull(), F.coalesce(arrived <= due, F.lit(False)))
    dated = orders.where(bought.isNotNull()).select(
        "order_id",
        "customer_id",
        "order_status",
        date_key(bought).alias("purchase_time_key"),
        date_key(arrived).alias("delivery_time_key"),
        floor_days(bought, arrived).alias("delivery_days"),
        floor_days(bought, due).alias("estimated_delivery_days"),
        floor_days(due, arrived).alias("delay_days"),
        on_time.alias("is_on_time"),
    )
    home = customer.join(region, customer.customer_state == region.state_code).select(
        "customer_id", "customer_key", F.col("region_key").alias("customer_region_key")
    )
    return dated.join(home, "customer_id").drop("customer_id")


def keyed_items(
    items: DataFrame, product: DataFrame, seller: DataFrame, region: DataFrame
) -> DataFrame:
    """Items with the keys of their product and seller, met while the rows are narrow."""
    origin = seller.join(region, seller.seller_state == region.state_code, "left").select(
        "seller_id", "seller_key", F.col("region_key").alias("seller_region_key")
    )
    return (
        items.select(
            "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"
        )
        .join(product.select("product_id", "product_key"), "product_id")
        .drop("product_id")
        .join(origin, "seller_id")
        .drop("seller_id")
    )


def fact_parts(
    sources: Mapping[str, DataFrame],
    customer: DataFrame,
    product: DataFrame,
    seller: DataFrame,
    region: DataFrame,
) -> dict[str, DataFrame]:
    """What `fact_orders` joins by order.

    Each has an `order_id`, so that a condition on it in all of them gives the fact of
    those orders.
    """
    return {
        "orders": placed_orders(sources["orders"], customer, region),
        "payments": payments_per_order(sources["payments"]),
        "reviews": review_per_order(sources["reviews"]),
        "items": keyed_items(sources["order_items"], product, seller, region),
    }


def fact_orders(parts: Mapping[str, DataFrame]) -> DataFrame:
    """One row per order item with a known order, customer, region, product and seller.

    `parts` are those of `fact_parts`. The required keys are inner joins, so rows that
    would lack one never move on.
    Every join has its own key with unique rows on the dimension side. No side is
    forced to broadcast: the planner does so below its size threshold, and
    otherwise the adaptive skew join splits a hot product or seller. Orders move once by
    customer and once by order; items take the wide values of their order last.
    """
    headers = (
        parts["orders"]
        .join(parts["payments"], "order_id", "left")
        .join(parts["reviews"], "order_id", "left")
    )
    zero = F.lit(0)
    rows = (
        parts["items"]
        .join(headers, "order_id")
        .withColumns(
            {
                # The total is taken first: with one part missing it becomes 0.
                "total_revenue": F.coalesce(F.col("price") + F.col("freight_value"), zero),
                "price": F.coalesce("price", zero),
                "freight_value": F.coalesce("freight_value", zero),
            }
        )
    )
    return conform(rows, WAREHOUSE["fact_orders"])


def fact_summary(fact: DataFrame) -> DataFrame:
    """Run statistics of the fact, one row."""
    return fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.countDistinct("order_id").alias("orders"),
        F.coalesce(tally(F.col("order_status") == DELIVERED), F.lit(0)).alias("delivered_rows"),
        F.sum("price").alias("total_price"),
        mean("price", 2).alias("avg_price"),
        mean("review_score", 2).alias("avg_review_score"),
        mean("delivery_days", 1).alias("avg_delivery_days"),
    )


def star_summary(star: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of every table."""
    out = None
    for name, df in star.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        )
        out = one if out is None else out.unionByName(one)
    return out
