"""Report name to function."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from mercastar.plans.parameters import ReportParameters
from mercastar.plans.reports import customers, executive, operations, products
from mercastar.plans.warehouse import Warehouse

Report = Callable[[Warehouse, ReportParameters], DataFrame]


def _shown(report: Report, columns: str) -> Report:
    """The report with its columns in the order they are shown in."""
    return lambda w, p: report(w, p).select(*columns.split())


REPORTS: dict[str, Report] = {
    "q3_exec_kpis": _shown(
        executive.exec_kpis,
        "total_orders total_order_items total_product_revenue total_freight_revenue "
        "total_revenue avg_item_price avg_order_value avg_review_score unique_customers",
    ),
    "q3_category_by_revenue": _shown(
        executive.category_by_revenue,
        "category items_sold orders total_revenue avg_price avg_review_score",
    ),
    "q3_category_by_items": _shown(
        executive.category_by_items,
        "category items_sold total_revenue avg_price",
    ),
    "q3_revenue_by_month": _shown(
        executive.revenue_by_month,
        "year month month_name year_month total_orders total_items product_revenue "
        "freight_revenue total_revenue avg_review_score",
    ),
    "q3_revenue_by_quarter": _shown(
        executive.revenue_by_quarter,
        "year quarter year_quarter total_orders product_revenue total_revenue "
        "avg_review_score",
    ),
    "q3_revenue_by_weekday": _shown(
        executive.revenue_by_weekday,
        "day_of_week day_name total_orders total_revenue avg_order_value",
    ),
    "q3_state_revenue": _shown(
        customers.state_revenue,
        "state_code state_name macro_region total_orders unique_customers total_revenue "
        "avg_order_value avg_delivery_days avg_review_score pct_on_time",
    ),
    "q3_macro_region_share": _shown(
        executive.macro_region_share,
        "macro_region total_orders total_revenue pct_revenue",
    ),
    "q3_rfm_customers": _shown(
        customers.rfm_customers,
        "customer_unique_id last_purchase_date recency_days frequency monetary r_score "
        "f_score m_score rfm_total rfm_segment",
    ),
    "q3_rfm_segments": _shown(
        customers.rfm_segments,
        "rfm_segment customer_count pct_customers avg_recency_days avg_frequency "
        "avg_monetary total_monetary",
    ),
    "q3_delivery_by_seller_state": _shown(
        operations.delivery_by_seller_state,
        "seller_state state_name deliveries avg_delivery_days avg_estimated_days "
        "avg_delay_days pct_on_time",
    ),
    "q3_review_distribution": _shown(
        customers.review_distribution,
        "review_score count pct",
    ),
    "q3_payment_methods": _shown(
        executive.payment_methods,
        "payment_type orders pct_orders total_payment avg_installments",
    ),
    "q3_seller_performance": _shown(
        operations.seller_performance,
        "seller_id seller_state total_orders items_sold total_revenue avg_item_price "
        "avg_review_score avg_delivery_days pct_on_time",
    ),
    "q3_cohort_activity": _shown(
        customers.cohort_activity,
        "cohort_month months_since_first active_customers",
    ),
    "ex1_kpi_cards": _shown(
        executive.kpi_cards,
        "total_orders unique_customers gross_revenue avg_review_score on_time_rate",
    ),
    "ex2_revenue_trend": _shown(
        executive.revenue_trend,
        "period total_orders gross_revenue freight_revenue total_revenue "
        "avg_review_score mom_growth_pct",
    ),
    "ex3_quarterly": _shown(
        executive.quarterly_performance,
        "quarter_label total_orders unique_customers product_revenue freight_revenue "
        "total_revenue avg_review_score avg_order_value",
    ),
    "ex4_macro_region": _shown(
        executive.macro_region,
        "macro_region total_orders unique_customers total_revenue revenue_share_pct "
        "avg_review_score avg_delivery_days",
    ),
    "ex5_payment_mix": _shown(
        executive.payment_mix,
        "payment_method order_count share_pct avg_payment_value avg_installments "
        "total_payment_volume",
    ),
    "ex6_weekday_pattern": _shown(
        executive.weekday_pattern,
        "day_of_week day_name day_type total_orders total_revenue avg_order_value "
        "orders_share_pct",
    ),
    "cus1_rfm_segments": _shown(
        customers.rfm_leaderboard,
        "segment_label customer_count pct_of_customers avg_recency_days avg_orders "
        "avg_spend_per_customer total_revenue_from_segment",
    ),
    "cus2_state_map": _shown(
        customers.state_map,
        "state_code state_name macro_region total_orders unique_customers total_revenue "
        "revenue_share_pct avg_order_value avg_review_score avg_delivery_days "
        "on_time_pct",
    ),
    "cus3_repeat_buyers": _shown(
        customers.repeat_buyers,
        "buyer_type customer_count pct_of_customers avg_lifetime_value "
        "total_revenue_contribution",
    ),
    "cus4_cohort_retention": _shown(
        customers.cohort_retention,
        "cohort_month cohort_size month_number active_customers retention_rate_pct",
    ),
    "cus4b_retention_curve": _shown(
        customers.retention_curve,
        "month_number avg_retention_rate_pct",
    ),
    "cus5_review_distribution": _shown(
        customers.delivered_review_distribution,
        "review_score score_label review_count pct_of_reviews",
    ),
    "cus6_top_cities": _shown(
        customers.top_cities,
        "city_state unique_customers total_orders total_revenue avg_review_score",
    ),
    "cus6_top_cities_collated": _shown(
        customers.top_cities_collated,
        "city_state unique_customers total_orders total_revenue avg_review_score",
    ),
    "prd1_category_leaderboard": _shown(
        products.category_leaderboard,
        "category items_sold unique_orders unique_buyers total_revenue revenue_share_pct "
        "avg_price avg_review_score avg_delivery_days",
    ),
    "prd2_category_trend": _shown(
        products.category_trend,
        "period category orders revenue",
    ),
    "prd3_price_segments": _shown(
        products.price_segments,
        "price_segment segment_order items_sold pct_items total_revenue pct_revenue "
        "avg_review_score avg_delivery_days",
    ),
    "prd4_quality_matrix": _shown(
        products.quality_matrix,
        "category items_sold total_revenue avg_price avg_review_score avg_delivery_days "
        "on_time_pct quality_score_100",
    ),
    "prd5_hot_categories": _shown(
        products.hot_categories,
        "period category current_revenue prev_month_revenue mom_growth_pct trend",
    ),
    "ops1_delivery_scorecard": _shown(
        operations.delivery_scorecard,
        "total_deliveries avg_delivery_days avg_estimated_days avg_delay_when_late "
        "avg_early_days on_time_count late_count on_time_rate_pct late_rate_pct",
    ),
    "ops2_seller_state_sla": _shown(
        operations.seller_state_sla,
        "seller_state state_name macro_region total_deliveries avg_delivery_days "
        "avg_estimated_days avg_delay_days on_time_pct avg_review_score sla_rating",
    ),
    "ops3_delay_review_impact": _shown(
        operations.delay_review_impact,
        "delivery_status sort_order order_count pct_of_orders avg_review_score "
        "min_review max_review",
    ),
    "ops4_seller_tiers": _shown(
        operations.seller_tiers,
        "seller_id seller_city seller_state total_orders items_sold total_revenue "
        "avg_item_price avg_review_score avg_delivery_days on_time_pct seller_tier",
    ),
    "ops5_delivery_histogram": _shown(
        operations.delivery_histogram,
        "delivery_bucket order_count pct_of_orders avg_review_score avg_delay_days",
    ),
    "ops6_ontime_trend": _shown(
        operations.on_time_trend,
        "period total_deliveries on_time_count late_count on_time_rate_pct "
        "avg_delivery_days avg_delay_days avg_review_score",
    ),
}
