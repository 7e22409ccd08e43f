"""Operations reports: delivery performance and sellers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercastar import fixed_values as fixed
from mercastar.functions.measures import (
    band_label,
    band_number,
    exact,
    items,
    mean,
    quotient,
    share_of_all,
)
from mercastar.functions.time import month_label
from mercastar.plans.parameters import ReportParameters
from mercastar.plans.reports.scopes import (
    arrived,
    delivered,
    metrics,
    with_purchase_day,
    with_region,
    with_seller,
)
from mercastar.plans.warehouse import Warehouse

TOP_SELLERS = 50
SELLER_METRICS = {
    "total_orders": "orders",
    "items_sold": "items",
    "total_revenue": "price_sum",
    "avg_item_price": "price_mean",
    "avg_review_score": "score_mean",
    "avg_delivery_days": "delivery_mean",
}


def delivery_by_seller_state(w: Warehouse, p: ReportParameters) -> DataFrame:
    return (
        with_region(arrived(w), w, "seller_region_key")
        .groupBy(F.col("state_code").alias("seller_state"), "state_name")
        .agg(
            *metrics(
                deliveries="items",
                avg_delivery_days="delivery_mean",
                avg_estimated_days="estimate_mean",
                avg_delay_days="delay_mean",
                pct_on_time="on_time_pct",
            )
        )
        .orderBy("avg_delivery_days", "seller_state")
    )


def seller_performance(w: Warehouse, p: ReportParameters) -> DataFrame:
    return (
        with_seller(delivered(w), w)
        .groupBy("seller_id", "seller_state")
        .agg(*metrics(**SELLER_METRICS, pct_on_time="on_time_pct"))
        .where(F.col("total_orders") >= p.min_seller_orders)
        .orderBy(F.desc("total_revenue"), "seller_id")
        .limit(TOP_SELLERS)
    )


def seller_tiers(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Tiers compare the unrounded mean score and the rounded on-time percent."""
    score = quotient(F.sum("review_score"), F.count("review_score"))
    by_seller = (
        with_seller(delivered(w), w)
        .groupBy("seller_id", "seller_city", "seller_state")
        .agg(*metrics(**SELLER_METRICS, on_time_pct="on_time_pct"), score.alias("_score"))
    )

    def reaches(tier: tuple[float, float]) -> F.Column:
        return (F.col("_score") >= exact(tier[0])) & (F.col("on_time_pct") >= exact(tier[1]))

    tier = (
        F.when(reaches(p.tier_top), "Top Performer")
        .when(reaches(p.tier_good), "Good Seller")
        .when(F.col("_score") < exact(p.tier_low), "Needs Review")
        .otherwise("Average")
    )
    return (
        by_seller.where(F.col("total_orders") >= p.min_tier_orders)
        .withColumn("seller_tier", tier)
        .drop("_score")
        .orderBy(F.desc("total_revenue"), "seller_id")
        .limit(TOP_SELLERS)
    )


def delivery_scorecard(w: Warehouse, p: ReportParameters) -> DataFrame:
    """A delivery within its due day has delay 0 and counts among the early days."""
    delay = F.col("delay_days")
    return arrived(w).agg(
        *metrics(
            total_deliveries="items",
            avg_delivery_days="delivery_mean",
            avg_estimated_days="estimate_mean",
        ),
        mean(F.when(delay > 0, delay), 1).alias("avg_delay_when_late"),
        mean(F.when(delay <= 0, F.abs(delay)), 1).alias("avg_early_days"),
        *metrics(
            on_time_count="on_time",
            late_count="late",
            on_time_rate_pct="on_time_pct",
            late_rate_pct="late_pct",
        ),
    )


def seller_state_sla(w: Warehouse, p: ReportParameters) -> DataFrame:
    rate = F.col("on_time_pct")
    rating = (
        F.when(rate >= exact(p.sla_excellent), "Excellent")
        .when(rate >= exact(p.sla_good), "Good")
        .otherwise("Needs Improvement")
    )
    return (
        with_region(arrived(w), w, "seller_region_key")
        .groupBy(F.col("state_code").alias("seller_state"), "state_name", "macro_region")
        .agg(
            *metrics(
                total_deliveries="items",
                avg_delivery_days="delivery_mean",
                avg_estimated_days="estimate_mean",
                avg_delay_days="delay_mean",
                on_time_pct="on_time_pct",
                avg_review_score="score_mean",
            )
        )
        .withColumn("sla_rating", rating)
        .orderBy(F.desc("on_time_pct"), "seller_state")
    )


def delay_review_impact(w: Warehouse, p: ReportParameters) -> DataFrame:
    """`order_count` counts item rows."""
    delay = F.col("delay_days")
    return (
        delivered(w)
        .where(delay.isNotNull() & F.col("review_score").isNotNull())
        .groupBy(
            band_label(delay, fixed.DELAY_BANDS).alias("delivery_status"),
            band_number(delay, fixed.DELAY_BANDS).alias("sort_order"),
        )
        .agg(
            *metrics(order_count="items", avg_review_score="score_mean"),
            F.min("review_score").alias("min_review"),
            F.max("review_score").alias("max_review"),
        )
        .withColumn("pct_of_orders", share_of_all(F.col("order_count")))
        .orderBy("sort_order")
    )


def delivery_histogram(w: Warehouse, p: ReportParameters) -> DataFrame:
    """`order_count` counts item rows; same-day deliveries are left out."""
    days = F.col("delivery_days")
    return (
        delivered(w)
        .where(days > 0)
        .groupBy(band_label(days, fixed.DELIVERY_BANDS).alias("delivery_bucket"))
        .agg(
            items().alias("order_count"),
            *metrics(avg_review_score="score_mean", avg_delay_days="delay_mean"),
        )
        .withColumn("pct_of_orders", share_of_all(F.col("order_count")))
        .orderBy("delivery_bucket")
    )


def on_time_trend(w: Warehouse, p: ReportParameters) -> DataFrame:
    names = {
        "total_deliveries": "items",
        "on_time_count": "on_time",
        "late_count": "late",
        "on_time_rate_pct": "on_time_pct",
        "avg_delivery_days": "delivery_mean",
        "avg_delay_days": "delay_mean",
        "avg_review_score": "score_mean",
    }
    return (
        with_purchase_day(arrived(w), w)
        .groupBy("year", "month")
        .agg(*metrics(**names))
        .orderBy("year", "month")
        .select(month_label(F.col("year"), F.col("month")).alias("period"), *names)
    )
