"""Customer reports: states, RFM segments, repeat buyers, cohorts, reviews, cities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercastar import fixed_values as fixed
from mercastar.functions.measures import (
    band_label,
    items,
    label_of,
    mean,
    quotient,
    rounded,
    share_of_all,
)
from mercastar.functions.time import label_of_month_index, month_index
from mercastar.operators.ranking import global_ntile
from mercastar.plans.parameters import ReportParameters
from mercastar.plans.reports.scopes import (
    delivered,
    metrics,
    with_customer,
    with_least_spelling,
    with_purchase_day,
    with_region,
)
from mercastar.plans.warehouse import Warehouse

PERSON = "customer_unique_id"
STATE = ("state_code", "state_name", "macro_region")


def state_revenue(w: Warehouse, p: ReportParameters) -> DataFrame:
    return (
        with_region(delivered(w), w, "customer_region_key")
        .groupBy(*STATE)
        .agg(
            *metrics(
                total_orders="orders",
                unique_customers="buyers",
                total_revenue="price_sum",
                avg_order_value="price_mean",
                avg_delivery_days="delivery_mean",
                avg_review_score="score_mean",
                pct_on_time="on_time_pct",
            )
        )
        .orderBy(F.desc("total_revenue"), "state_code")
    )


def state_map(w: Warehouse, p: ReportParameters) -> DataFrame:
    return (
        state_revenue(w, p)
        .withColumnRenamed("pct_on_time", "on_time_pct")
        .withColumn("revenue_share_pct", share_of_all(F.col("total_revenue")))
        .orderBy(F.desc("total_revenue"), "state_code")
    )


def _purchases_per_person(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Recency, frequency and monetary value of every person; stored once for all reports."""

    def build() -> DataFrame:
        # An order has one customer and one day: orders collapse before they meet customers.
        orders = (
            delivered(w)
            .groupBy("customer_key", "order_id", "purchase_time_key")
            .agg(F.sum("price").alias("spent"))
        )
        people = with_customer(with_purchase_day(orders, w), w)
        return people.groupBy(PERSON).agg(
            F.max("full_date").alias("last_purchase_date"),
            F.countDistinct("order_id").alias("frequency"),
            F.sum("spent").cast("decimal(20,2)").alias("monetary"),
        )

    return (
        w.derived("purchases_per_person", build)
        .withColumn(
            "recency_days", F.datediff(F.lit(p.rfm_date).cast("date"), "last_purchase_date")
        )
    )


def _segment() -> Column:
    def within(score: str, bounds: tuple[int, int]) -> Column:
        return F.col(score).between(*bounds)

    out = None
    for label, *ranges in fixed.RFM_SEGMENTS:
        scores = zip(("r_score", "f_score", "m_score"), ranges, strict=True)
        holds = reduce(lambda a, b: a & b, [within(s, bounds) for s, bounds in scores])
        out = F.when(holds, label) if out is None else out.when(holds, label)
    return out.otherwise(fixed.RFM_DEFAULT)


def _raw_rfm(w: Warehouse, p: ReportParameters) -> DataFrame:
    """All three scores by tile, the best customers in tile 1.

    The segment rules treat high scores as best. This first version of the
    analysis is kept as it is; `rfm_leaderboard` is the corrected one.
    """
    scores = {
        "r_score": ("recency_days", True),
        "f_score": ("frequency", False),
        "m_score": ("monetary", False),
    }
    scored = global_ntile(_purchases_per_person(w, p), PERSON, scores, fixed.RFM_TILES)
    return scored.withColumn("rfm_segment", _segment())


def rfm_customers(w: Warehouse, p: ReportParameters) -> DataFrame:
    return (
        _raw_rfm(w, p)
        .withColumn("rfm_total", F.col("r_score") + F.col("f_score") + F.col("m_score"))
        .orderBy(F.desc("rfm_total"), PERSON)
    )


def _segment_summary(scored: DataFrame, frequency_scale: int, names: tuple[str, ...]) -> DataFrame:
    """One row per segment; `names` are the output columns in order."""
    label, count, share, recency, frequency, monetary, revenue = names
    return (
        scored.groupBy(F.col("rfm_segment").alias(label))
        .agg(
            items().alias(count),
            mean("recency_days", 0).alias(recency),
            mean("frequency", frequency_scale).alias(frequency),
            mean("monetary", 2).alias(monetary),
            F.sum("monetary").alias(revenue),
        )
        .withColumn(share, share_of_all(F.col(count)))
        .orderBy(F.desc(revenue), label)
    )


def rfm_segments(w: Warehouse, p: ReportParameters) -> DataFrame:
    return _segment_summary(
        _raw_rfm(w, p),
        1,
        (
            "rfm_segment",
            "customer_count",
            "pct_customers",
            "avg_recency_days",
            "avg_frequency",
            "avg_monetary",
            "total_monetary",
        ),
    )


def rfm_leaderboard(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Corrected scores: 5 is best, and frequency is scored by value, not by tile.

    Most people buy once, so a tile would split equal frequencies at random.
    """
    scores = {"r_score": ("recency_days", False), "m_score": ("monetary", True)}
    scored = global_ntile(_purchases_per_person(w, p), PERSON, scores, fixed.RFM_TILES)
    often = F.when(F.col("frequency") >= 3, 5).when(F.col("frequency") == 2, 4).otherwise(1)
    return _segment_summary(
        scored.withColumn("f_score", often).withColumn("rfm_segment", _segment()),
        2,
        (
            "segment_label",
            "customer_count",
            "pct_of_customers",
            "avg_recency_days",
            "avg_orders",
            "avg_spend_per_customer",
            "total_revenue_from_segment",
        ),
    )


def repeat_buyers(w: Warehouse, p: ReportParameters) -> DataFrame:
    spending = (
        with_customer(delivered(w), w)
        .groupBy(PERSON)
        .agg(*metrics(order_count="orders", total_spend="price_sum"))
    )
    return (
        spending.groupBy(band_label(F.col("order_count"), fixed.BUYER_BANDS).alias("buyer_type"))
        .agg(
            items().alias("customer_count"),
            mean("total_spend", 2).alias("avg_lifetime_value"),
            F.sum("total_spend").alias("total_revenue_contribution"),
        )
        .withColumn("pct_of_customers", share_of_all(F.col("customer_count")))
        .orderBy(F.desc("customer_count"), "buyer_type")
    )


def _active_months(w: Warehouse) -> DataFrame:
    """Distinct (person, month) with the person's first month.

    Reduced to months before the window, so that even a person with a large share
    of all purchases brings at most one row per calendar month into it.
    """
    month = month_index(F.col("year"), F.col("month"))
    active = (
        with_customer(with_purchase_day(delivered(w), w), w)
        .select(PERSON, month.alias("activity"))
        .distinct()
    )
    first = F.min("activity").over(Window.partitionBy(PERSON))
    return active.withColumn("cohort", first)


def cohort_activity(w: Warehouse, p: ReportParameters) -> DataFrame:
    # Pairs are distinct, so counting them counts people.
    return (
        _active_months(w)
        .groupBy("cohort", (F.col("activity") - F.col("cohort")).alias("months_since_first"))
        .agg(items().alias("active_customers"))
        .select(
            label_of_month_index(F.col("cohort")).alias("cohort_month"),
            "months_since_first",
            "active_customers",
        )
        .orderBy("cohort_month", "months_since_first")
    )


def _retention(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Cohort by month offset, with the cohort's size; offset 0 is the cohort itself."""
    cohorts = cohort_activity(w, p).where(F.col("cohort_month") >= p.cohort_floor)
    at_start = F.when(F.col("months_since_first") == 0, F.col("active_customers"))
    # One row per pair of calendar months at most.
    size = F.max(at_start).over(Window.partitionBy("cohort_month"))
    return cohorts.withColumn("cohort_size", size).where(F.col("months_since_first") > 0)


def cohort_retention(w: Warehouse, p: ReportParameters) -> DataFrame:
    rate = rounded(F.lit(100) * F.col("active_customers"), F.col("cohort_size"), 1)
    return (
        _retention(w, p)
        .select(
            "cohort_month",
            "cohort_size",
            F.col("months_since_first").alias("month_number"),
            "active_customers",
            rate.alias("retention_rate_pct"),
        )
        .orderBy("cohort_month", "month_number")
    )


def retention_curve(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Mean of the cohorts' rates per offset, over cohorts active at that offset."""
    rate = quotient(F.lit(100) * F.col("active_customers"), F.col("cohort_size"))
    curve = F.sum(rate) / F.count(rate).cast("decimal(10,0)")
    return (
        _retention(w, p)
        .groupBy(F.col("months_since_first").alias("month_number"))
        .agg(F.round(curve, 2).alias("avg_retention_rate_pct"))
        .orderBy("month_number")
    )


def _review_distribution(rows: DataFrame, count: str, share: str) -> DataFrame:
    return (
        rows.where(F.col("review_score").isNotNull())
        .groupBy("review_score")
        .agg(items().alias(count))
        .withColumn(share, share_of_all(F.col(count)))
    )


def review_distribution(w: Warehouse, p: ReportParameters) -> DataFrame:
    """All order states."""
    return _review_distribution(w.fact, "count", "pct").orderBy("review_score")


def delivered_review_distribution(w: Warehouse, p: ReportParameters) -> DataFrame:
    return (
        _review_distribution(delivered(w), "review_count", "pct_of_reviews")
        .withColumn("score_label", label_of(F.col("review_score"), fixed.SCORE_LABELS))
        .orderBy(F.desc("review_score"))
    )


def top_cities(w: Warehouse, p: ReportParameters, collate: bool = False) -> DataFrame:
    """Ten cities with the most people.

    With `collate`, spellings that differ in case, accents or trailing blanks
    are one city, shown by the least spelling among all customers.
    """
    city = F.col("customer_city")
    rows = with_customer(delivered(w), w)
    if collate:
        rows = with_least_spelling(rows, w.customer, "customer_city", "city_key")
    else:
        rows = rows.withColumn("city_key", city)
    return (
        rows.groupBy("city_key", "customer_state")
        .agg(
            *metrics(
                unique_customers="people",
                total_orders="orders",
                total_revenue="price_sum",
                avg_review_score="score_mean",
            ),
        )
        .select(
            F.concat("city_key", F.lit(" - "), "customer_state").alias("city_state"),
            "unique_customers",
            "total_orders",
            "total_revenue",
            "avg_review_score",
        )
        .orderBy(F.desc("unique_customers"), "city_state")
        .limit(10)
    )


def top_cities_collated(w: Warehouse, p: ReportParameters) -> DataFrame:
    return top_cities(w, p, collate=True)
