"""Quality checks over staging and warehouse: 24 results and a verdict."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercastar.fixed_values import DELIVERED, MEAN_SCORE_RANGE, SCORE_RANGE
from mercastar.functions.measures import mean, quotient, rounded, tally
from mercastar.functions.text import fixed_point
from mercastar.operators.dedup import duplicate_rows
from mercastar.plans.parameters import ReportParameters
from mercastar.plans.reports.scopes import CATEGORY, delivered, with_product
from mercastar.plans.warehouse import Warehouse

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
RESULT = ("check_name", "status", "detail")

# SQL condition that marks a bad value, per required measure or key.
REQUIRED = {
    "price": "price IS NULL OR price < 0",
    "freight_value": "freight_value IS NULL",
    "total_revenue": "total_revenue IS NULL OR total_revenue < 0",
    "customer_key": "customer_key IS NULL",
    "product_key": "product_key IS NULL",
    "purchase_time_key": "purchase_time_key IS NULL",
}
# Fact key, dimension and the dimension's key.
FOREIGN_KEYS = (
    ("customer_key", "dim_customer", "customer_key"),
    ("product_key", "dim_product", "product_key"),
    ("seller_key", "dim_seller", "seller_key"),
    ("purchase_time_key", "dim_time", "time_key"),
    ("customer_region_key", "dim_region", "region_key"),
)


def _grouped(number: Column) -> Column:
    return F.format_number(number, 0)


def _result(name: str, passed: Column, detail: Column, otherwise: str = FAIL) -> Column:
    """One check as a struct. An unknown outcome does not pass."""
    return F.struct(
        F.lit(name).alias("check_name"),
        F.when(F.coalesce(passed, F.lit(False)), PASS).otherwise(otherwise).alias("status"),
        detail.alias("detail"),
    )


def _results(one_row: DataFrame, checks: list[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*checks)))


def _side_by_side(counts: list[tuple[str, DataFrame, Column]]) -> DataFrame:
    """One row with a column per (name, table, aggregate)."""
    labelled = [
        df.agg(value.alias("n")).select(F.lit(name).alias("what"), "n")
        for name, df, value in counts
    ]
    stacked = reduce(DataFrame.unionByName, labelled)
    return stacked.agg(
        *[F.max(F.when(F.col("what") == name, F.col("n"))).alias(name) for name, _, _ in counts]
    )


def check_row_counts(w: Warehouse, p: ReportParameters) -> DataFrame:
    counts = _side_by_side(
        [(name, w.table(name), F.count(F.lit(1))) for name, _ in p.minimum_rows]
    )
    return _results(
        counts,
        [
            _result(
                f"row_count_{name}",
                F.col(name) >= least,
                F.concat(_grouped(F.col(name)), F.lit(f" rows (at least {least:,})")),
            )
            for name, least in p.minimum_rows
        ],
    )


def check_staging(w: Warehouse, staging: Mapping[str, DataFrame], p: ReportParameters) -> DataFrame:
    """Orders may be lost on the way, up to a share; customers hardly any."""
    counts = _side_by_side(
        [
            ("staged_orders", staging["stg_orders"], F.countDistinct("order_id")),
            ("orders", w.fact, F.countDistinct("order_id")),
            ("staged_customers", staging["stg_customers"], F.count(F.lit(1))),
            ("customers", w.customer, F.count(F.lit(1))),
        ]
    )
    share = quotient(F.lit(100) * F.col("orders"), F.col("staged_orders"))
    match = F.coalesce(share, F.lit(0))

    def pair(staged: str, loaded: str) -> list[Column]:
        return [
            F.lit("Staging: "),
            _grouped(F.col(staged)),
            F.lit(" | Warehouse: "),
            _grouped(F.col(loaded)),
        ]

    return _results(
        counts,
        [
            _result(
                "staging_vs_dwh_orders",
                match >= p.min_order_match_pct,
                F.concat(
                    *pair("staged_orders", "orders"),
                    F.lit(" | Match: "),
                    fixed_point(match, 1),
                    F.lit("%"),
                ),
                otherwise=WARN,
            ),
            _result(
                "staging_vs_dwh_customers",
                F.abs(F.col("staged_customers") - F.col("customers")) <= p.max_customer_gap,
                F.concat(*pair("staged_customers", "customers")),
            ),
        ],
    )


def _fact_counts(w: Warehouse) -> DataFrame:
    """All counts the null checks and business rules need, in one pass."""
    score = F.col("review_score")
    bad = [F.count_if(F.expr(condition)).alias(f"bad_{name}") for name, condition in REQUIRED.items()]
    return w.fact.agg(
        *bad,
        F.count_if(~score.between(*SCORE_RANGE)).alias("odd_scores"),
        F.count_if(F.col("delivery_days") <= 0).alias("odd_days"),
        F.count_if(F.col("order_status") == DELIVERED).alias("delivered"),
        F.count(F.lit(1)).alias("total"),
        mean("review_score", 2).alias("mean_score"),
    )


def _null_results() -> list[Column]:
    return [
        _result(
            f"null_check_{name}",
            F.col(f"bad_{name}") == 0,
            F.concat(_grouped(F.col(f"bad_{name}")), F.lit(f" rows where {condition}")),
        )
        for name, condition in REQUIRED.items()
    ]


def _rule_results(p: ReportParameters) -> list[Column]:
    share = F.coalesce(quotient(F.lit(100) * F.col("delivered"), F.col("total")), F.lit(0))
    low, high = MEAN_SCORE_RANGE
    return [
        _result(
            "review_score_range",
            F.col("odd_scores") == 0,
            F.concat(
                _grouped(F.col("odd_scores")),
                F.lit(f" rows with a review score outside {SCORE_RANGE[0]}-{SCORE_RANGE[1]}"),
            ),
        ),
        _result(
            "delivery_days_positive",
            F.col("odd_days") == 0,
            F.concat(_grouped(F.col("odd_days")), F.lit(" rows with delivery_days <= 0")),
            otherwise=WARN,
        ),
        _result(
            "delivered_rate",
            share >= p.min_delivered_pct,
            F.concat(
                fixed_point(share, 1),
                F.lit("% delivered ("),
                _grouped(F.col("delivered")),
                F.lit("/"),
                _grouped(F.col("total")),
                F.lit(")"),
            ),
        ),
        _result(
            "avg_review_score",
            F.col("mean_score").between(F.lit(low), F.lit(high)),
            F.concat(
                F.lit("Mean review score = "),
                F.coalesce(fixed_point(F.col("mean_score"), 2), F.lit("none")),
                F.lit(f" (expected {low}-{high})"),
            ),
        ),
    ]


def check_nulls(w: Warehouse) -> DataFrame:
    return _results(_fact_counts(w), _null_results())


def check_business_rules(w: Warehouse, p: ReportParameters) -> DataFrame:
    return _results(_fact_counts(w), _rule_results(p))


def orphan_rows(w: Warehouse) -> DataFrame:
    """Fact rows per foreign key that find no dimension row; a NULL key is an orphan.

    Keys are counted before the anti join, so it moves distinct keys, not rows.
    """
    counts = [
        w.fact.groupBy(F.col(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(w.table(table).select(F.col(own).alias("_key")), "_key", "left_anti")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))
        .select(F.lit(key).alias("key_column"), "orphans")
        for key, table, own in FOREIGN_KEYS
    ]
    return reduce(DataFrame.unionByName, counts)


def check_references(w: Warehouse) -> DataFrame:
    return orphan_rows(w).select(
        F.concat(F.lit("fk_orphan_"), "key_column").alias("check_name"),
        F.when(F.col("orphans") == 0, PASS).otherwise(FAIL).alias("status"),
        F.concat(_grouped(F.col("orphans")), F.lit(" orphan rows")).alias("detail"),
    )


def distribution(w: Warehouse) -> DataFrame:
    """Statistics of delivered items; the on-time percent is of known outcomes only."""
    on_time = F.col("is_on_time")
    return delivered(w).agg(
        F.count(F.lit(1)).alias("total_items"),
        F.countDistinct("order_id").alias("total_orders"),
        F.countDistinct("customer_key").alias("unique_customers"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        mean("price", 2).alias("avg_price"),
        mean("review_score", 2).alias("avg_review"),
        mean("delivery_days", 1).alias("avg_delivery_days"),
        rounded(F.lit(100) * tally(on_time), F.count(on_time), 1).alias("pct_on_time"),
    )


def check_distribution(w: Warehouse) -> DataFrame:
    """Always passes; it reports the figures."""

    def figure(name: str, scale: int) -> Column:
        return F.coalesce(fixed_point(F.col(name), scale), F.lit("none"))

    on_time = F.col("is_on_time")
    figures = delivered(w).agg(
        mean("price", 2).alias("avg_price"),
        mean("review_score", 2).alias("avg_review"),
        rounded(F.lit(100) * tally(on_time), F.count(on_time), 1).alias("pct_on_time"),
    )
    detail = F.concat(
        F.lit("Mean price=R$"),
        figure("avg_price", 2),
        F.lit(", mean review="),
        figure("avg_review", 2),
        F.lit(", on time="),
        figure("pct_on_time", 1),
        F.lit("%"),
    )
    return _results(figures, [_result("distribution_stats", F.lit(True), detail)])


def top_categories(w: Warehouse) -> DataFrame:
    return (
        with_product(delivered(w), w)
        .groupBy(F.col(CATEGORY).alias("category"))
        .agg(F.count(F.lit(1)).alias("items"), F.round(F.sum("price"), 0).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
        .limit(10)
    )


def status_mix(w: Warehouse) -> DataFrame:
    """Items by order state, most frequent first."""
    mix = w.fact.groupBy("order_status").agg(F.count(F.lit(1)).alias("item_rows"))
    return mix.orderBy(F.desc("item_rows"), "order_status")


def fact_duplicates(w: Warehouse) -> DataFrame:
    """Rows beyond the first per (order, item): the fact's natural key."""
    keys = ["order_id", "order_item_id"]
    counted = duplicate_rows(w.fact.select(*keys), keys)
    return counted.select(
        F.lit("fact_item_unique").alias("check_name"),
        F.when(F.col("duplicates") == 0, PASS).otherwise(FAIL).alias("status"),
        F.concat(
            _grouped(F.col("duplicates")),
            F.lit(" duplicate rows of "),
            _grouped(F.col("rows")),
        ).alias("detail"),
    )


def run_checks(w: Warehouse, staging: Mapping[str, DataFrame], p: ReportParameters) -> DataFrame:
    """All 24 results. The fact is aggregated once for all null and rule checks."""
    parts = [
        check_row_counts(w, p),
        check_staging(w, staging, p),
        _results(_fact_counts(w), _null_results() + _rule_results(p)),
        check_references(w),
        check_distribution(w),
    ]
    return reduce(DataFrame.unionByName, parts).select(*RESULT)


def verdict(results: DataFrame) -> DataFrame:
    """One row: checks by status, and success when none failed."""
    status = F.col("status")
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(status == PASS).alias("passed"),
        F.count_if(status == WARN).alias("warned"),
        F.count_if(status == FAIL).alias("failed"),
        (F.count_if(status == FAIL) == 0).alias("success"),
    )


