"""Row sets and metric groups that several reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercastar.fixed_values import DELIVERED, SOLD
from mercastar.functions.measures import items, mean, percent_of_rows, rounded, tally
from mercastar.plans.warehouse import Warehouse

CATEGORY = "product_category_name_english"


def delivered(w: Warehouse) -> DataFrame:
    return w.fact.where(F.col("order_status") == DELIVERED)


def sold(w: Warehouse) -> DataFrame:
    return w.fact.where(F.col("order_status").isin(*SOLD))


def arrived(w: Warehouse) -> DataFrame:
    """Delivered items whose delivery time is known."""
    return delivered(w).where(F.col("delivery_days").isNotNull())


def bought_before(rows: DataFrame, time_key: int) -> DataFrame:
    """Rows bought before a day, given as yyyymmdd; the month lets the scan skip folders."""
    last_month = (time_key - 2) // 100  # before the first of a month: not that month
    return rows.where(
        (F.col("purchase_time_key") < time_key) & (F.col("purchase_month") <= last_month)
    )


def with_purchase_day(rows: DataFrame, w: Warehouse) -> DataFrame:
    return rows.join(w.time.withColumnRenamed("time_key", "purchase_time_key"), "purchase_time_key")


def with_customer(rows: DataFrame, w: Warehouse) -> DataFrame:
    return rows.join(w.customer, "customer_key")


def with_product(rows: DataFrame, w: Warehouse) -> DataFrame:
    return rows.join(w.product, "product_key")


def with_seller(rows: DataFrame, w: Warehouse) -> DataFrame:
    return rows.join(w.seller, "seller_key")


def with_region(rows: DataFrame, w: Warehouse, role: str) -> DataFrame:
    """`role` is the fact's region key: of the customer or of the seller."""
    return rows.join(w.dim_region.withColumnRenamed("region_key", role), role)


# Compares without case, accents and trailing blanks, as some databases do.
LENIENT_COLLATION = "UNICODE_CI_AI_RTRIM"


def with_least_spelling(rows: DataFrame, dim: DataFrame, column: str, name: str) -> DataFrame:
    """Add `name`: the least of all spellings in `dim` that are equal to `column` leniently.

    Collated texts cannot be hash-aggregated, so spellings are brought together once,
    over the distinct ones of the dimension, and rows are grouped by plain text.
    """
    alike = Window.partitionBy(F.collate(column, LENIENT_COLLATION))
    spellings = dim.select(column).where(F.col(column).isNotNull()).distinct()
    least = spellings.select(column, F.min(column).over(alike).alias(name))
    return rows.join(least, column, "left")


# Metric by concept. A report picks concepts and names its own columns.
METRICS = {
    "items": lambda: items(),
    "orders": lambda: F.countDistinct("order_id"),
    "buyers": lambda: F.countDistinct("customer_key"),
    "people": lambda: F.countDistinct("customer_unique_id"),
    "price_sum": lambda: F.sum("price"),
    "freight_sum": lambda: F.sum("freight_value"),
    "gross_sum": lambda: F.sum("total_revenue"),
    "payment_sum": lambda: F.sum("payment_value"),
    "price_mean": lambda: mean("price", 2),
    "payment_mean": lambda: mean("payment_value", 2),
    "installments_mean": lambda: mean("payment_installments", 1),
    "score_mean": lambda: mean("review_score", 2),
    "delivery_mean": lambda: mean("delivery_days", 1),
    "estimate_mean": lambda: mean("estimated_delivery_days", 1),
    "delay_mean": lambda: mean("delay_days", 1),
    "order_value": lambda: rounded(F.sum("price"), F.countDistinct("order_id"), 2),
    "on_time": lambda: tally(F.col("is_on_time")),
    "late": lambda: tally(~F.col("is_on_time")),
    "on_time_pct": lambda: percent_of_rows(F.col("is_on_time")),
    "late_pct": lambda: percent_of_rows(~F.col("is_on_time")),
}


def metrics(**columns: str) -> list[Column]:
    """Aggregates for `agg`, as output_column="concept"."""
    return [METRICS[concept]().alias(name) for name, concept in columns.items()]
