"""What a caller may change about the reports and checks."""

from __future__ import annotations

from dataclasses import dataclass

from mercastar import fixed_values as fixed


@dataclass(frozen=True)
class ReportParameters:
    """Dates are ISO texts, periods and cohort months are `yyyy-MM`."""

    rfm_date: str = fixed.RFM_DATE.isoformat()
    trend_cutoff: str = fixed.TREND_CUTOFF.isoformat()
    hot_period: str = fixed.HOT_PERIOD
    cohort_floor: str = fixed.COHORT_FLOOR
    min_seller_orders: int = fixed.MIN_SELLER_ORDERS
    min_tier_orders: int = fixed.MIN_TIER_ORDERS
    min_category_items: int = fixed.MIN_CATEGORY_ITEMS
    sla_excellent: float = fixed.SLA_EXCELLENT
    sla_good: float = fixed.SLA_GOOD
    tier_top: tuple[float, float] = fixed.TIER_TOP
    tier_good: tuple[float, float] = fixed.TIER_GOOD
    tier_low: float = fixed.TIER_LOW
    minimum_rows: tuple[tuple[str, int], ...] = fixed.MINIMUM_ROWS
    min_order_match_pct: float = fixed.MIN_ORDER_MATCH_PCT
    max_customer_gap: int = fixed.MAX_CUSTOMER_GAP
    min_delivered_pct: float = fixed.MIN_DELIVERED_PCT
