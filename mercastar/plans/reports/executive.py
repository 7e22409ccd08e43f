"""Executive reports: headline numbers, revenue over time, regions, payments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercastar import fixed_values as fixed
from mercastar.functions.measures import growth, label_of, percent_of_rows, quotient, share_of_all
from mercastar.functions.text import fixed_point, thousands
from mercastar.functions.time import month_label, quarter_label
from mercastar.plans.parameters import ReportParameters
from mercastar.plans.reports.scopes import (
    CATEGORY,
    bought_before,
    delivered,
    metrics,
    sold,
    with_customer,
    with_product,
    with_purchase_day,
    with_region,
)
from mercastar.plans.warehouse import Warehouse


def exec_kpis(w: Warehouse, p: ReportParameters) -> DataFrame:
    return delivered(w).agg(
        *metrics(
            total_orders="orders",
            total_order_items="items",
            total_product_revenue="price_sum",
            total_freight_revenue="freight_sum",
            total_revenue="gross_sum",
            avg_item_price="price_mean",
            avg_order_value="order_value",
            avg_review_score="score_mean",
            unique_customers="buyers",
        )
    )


def category_by_revenue(w: Warehouse, p: ReportParameters) -> DataFrame:
    by_category = with_product(delivered(w), w).groupBy(F.col(CATEGORY).alias("category"))
    return (
        by_category.agg(
            *metrics(
                items_sold="items",
                orders="orders",
                total_revenue="price_sum",
                avg_price="price_mean",
                avg_review_score="score_mean",
            )
        )
        .orderBy(F.desc("total_revenue"), "category")
        .limit(20)
    )


def category_by_items(w: Warehouse, p: ReportParameters) -> DataFrame:
    by_category = with_product(delivered(w), w).groupBy(F.col(CATEGORY).alias("category"))
    return (
        by_category.agg(
            *metrics(items_sold="items", total_revenue="price_sum", avg_price="price_mean")
        )
        .orderBy(F.desc("items_sold"), "category")
        .limit(20)
    )


def revenue_by_month(w: Warehouse, p: ReportParameters) -> DataFrame:
    monthly = (
        with_purchase_day(sold(w), w)
        .groupBy("year", "month", "month_name")
        .agg(
            *metrics(
                total_orders="orders",
                total_items="items",
                product_revenue="price_sum",
                freight_revenue="freight_sum",
                total_revenue="gross_sum",
                avg_review_score="score_mean",
            )
        )
    )
    label = month_label(F.col("year"), F.col("month"))
    return monthly.withColumn("year_month", label).orderBy("year", "month")


def revenue_by_quarter(w: Warehouse, p: ReportParameters) -> DataFrame:
    quarterly = (
        with_purchase_day(sold(w), w)
        .groupBy("year", "quarter")
        .agg(
            *metrics(
                total_orders="orders",
                product_revenue="price_sum",
                total_revenue="gross_sum",
                avg_review_score="score_mean",
            )
        )
    )
    label = quarter_label(F.col("year"), F.col("quarter"))
    return quarterly.withColumn("year_quarter", label).orderBy("year", "quarter")


def revenue_by_weekday(w: Warehouse, p: ReportParameters) -> DataFrame:
    """`avg_order_value` is the mean item price, as the source report defines it."""
    return (
        with_purchase_day(sold(w), w)
        .groupBy("day_of_week", "day_name")
        .agg(
            *metrics(total_orders="orders", total_revenue="price_sum", avg_order_value="price_mean")
        )
        .orderBy("day_of_week")
    )


def macro_region_share(w: Warehouse, p: ReportParameters) -> DataFrame:
    return (
        with_region(delivered(w), w, "customer_region_key")
        .groupBy("macro_region")
        .agg(*metrics(total_orders="orders", total_revenue="price_sum"))
        .withColumn("pct_revenue", share_of_all(F.col("total_revenue")))
        .orderBy(F.desc("total_revenue"), "macro_region")
    )


def payment_methods(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Payment values are per order and repeat on its items, so the sum counts them so."""
    return (
        w.fact.where(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(
            *metrics(
                orders="orders", total_payment="payment_sum", avg_installments="installments_mean"
            )
        )
        .withColumn("pct_orders", share_of_all(F.col("orders")))
        .orderBy(F.desc("orders"), "payment_type")
    )


def kpi_cards(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Five headline values, three of them formatted as text."""
    score = quotient(F.sum("review_score"), F.count("review_score"))
    on_time = percent_of_rows(F.col("is_on_time"))
    return with_customer(delivered(w), w).agg(
        *metrics(total_orders="orders", unique_customers="people"),
        F.concat(F.lit("R$ "), thousands(F.sum("price"))).alias("gross_revenue"),
        F.concat(fixed_point(score, 2), F.lit(" / 5")).alias("avg_review_score"),
        F.concat(fixed_point(on_time, 1), F.lit("%")).alias("on_time_rate"),
    )


def revenue_trend(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Monthly revenue with growth over the previous month that has sales.

    The cutoff drops days at the end that are not a complete month. It is put on
    the fact's own date key, so that it reaches the scan.
    """
    cutoff = int(p.trend_cutoff.replace("-", ""))
    monthly = (
        with_purchase_day(bought_before(sold(w), cutoff), w)
        .groupBy("year", "month")
        .agg(
            *metrics(
                total_orders="orders",
                gross_revenue="price_sum",
                freight_revenue="freight_sum",
                total_revenue="gross_sum",
                avg_review_score="score_mean",
            )
        )
    )
    # One row per month of the calendar: a window over all of them is small.
    previous = F.lag("gross_revenue").over(Window.orderBy("year", "month"))
    return (
        monthly.withColumn("mom_growth_pct", growth(F.col("gross_revenue"), previous))
        .orderBy("year", "month")
        .select(
            month_label(F.col("year"), F.col("month")).alias("period"),
            "total_orders",
            "gross_revenue",
            "freight_revenue",
            "total_revenue",
            "avg_review_score",
            "mom_growth_pct",
        )
    )


def quarterly_performance(w: Warehouse, p: ReportParameters) -> DataFrame:
    names = {
        "total_orders": "orders",
        "unique_customers": "buyers",
        "product_revenue": "price_sum",
        "freight_revenue": "freight_sum",
        "total_revenue": "gross_sum",
        "avg_review_score": "score_mean",
        "avg_order_value": "order_value",
    }
    return (
        with_purchase_day(sold(w), w)
        .groupBy("year", "quarter")
        .agg(*metrics(**names))
        .orderBy("year", "quarter")
        .select(quarter_label(F.col("year"), F.col("quarter")).alias("quarter_label"), *names)
    )


def macro_region(w: Warehouse, p: ReportParameters) -> DataFrame:
    return (
        with_region(delivered(w), w, "customer_region_key")
        .groupBy("macro_region")
        .agg(
            *metrics(
                total_orders="orders",
                unique_customers="buyers",
                total_revenue="price_sum",
                avg_review_score="score_mean",
                avg_delivery_days="delivery_mean",
            )
        )
        .withColumn("revenue_share_pct", share_of_all(F.col("total_revenue")))
        .orderBy(F.desc("total_revenue"), "macro_region")
    )


def payment_mix(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Groups by the raw type but shows a label, so `Other` may appear more than once."""
    kind = F.col("payment_type")
    by_type = (
        w.fact.where(kind.isNotNull() & (kind != fixed.UNDEFINED_PAYMENT))
        .groupBy("payment_type")
        .agg(
            *metrics(
                order_count="orders",
                avg_payment_value="payment_mean",
                avg_installments="installments_mean",
                total_payment_volume="payment_sum",
            )
        )
    )
    return (
        by_type.withColumn("share_pct", share_of_all(F.col("order_count")))
        .withColumn("payment_method", label_of(kind, fixed.PAYMENT_LABELS, fixed.OTHER_PAYMENT))
        .orderBy(F.desc("order_count"), "payment_type")
        .drop("payment_type")
    )


def weekday_pattern(w: Warehouse, p: ReportParameters) -> DataFrame:
    return (
        with_purchase_day(sold(w), w)
        .groupBy("day_of_week", "day_name", "is_weekend")
        .agg(
            *metrics(total_orders="orders", total_revenue="price_sum", avg_order_value="price_mean")
        )
        .withColumn("orders_share_pct", share_of_all(F.col("total_orders")))
        .withColumn("day_type", F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday"))
        .orderBy("day_of_week")
        .drop("is_weekend")
    )
