"""Report rules on small hand-made data, and the shape of plans."""

from __future__ import annotations

import re
from dataclasses import replace
from decimal import Decimal

import pytest
from helpers import customer, item, order, small_sources
from mercastar.plans import warehouse
from mercastar.plans.parameters import ReportParameters
from mercastar.plans.reports import REPORTS
from mercastar.plans.warehouse import Warehouse
from mercastar.registry import presentable
from pyspark.sql import functions as F

DEFAULTS = ReportParameters()


def shop(spark, *sales: tuple) -> Warehouse:
    """A warehouse of (person, purchase day, price) sales, one order each."""
    orders, items, customers = [], [], []
    for n, (person, day, price) in enumerate(sales, 1):
        orders.append(
            order(
                n,
                order_purchase_timestamp=f"{day} 12:00:00",
                order_delivered_customer_date=f"{day} 13:00:00",
                order_estimated_delivery_date=f"{day} 14:00:00",
            )
        )
        items.append(item(n, price=price))
        customers.append(customer(n, customer_unique_id=person))
    sources = small_sources(spark, orders=orders, order_items=items, customers=customers)
    return Warehouse(sources)


def test_growth_uses_the_previous_month_with_sales(spark):
    w = shop(
        spark,
        ("u1", "2018-01-05", 100),
        ("u2", "2018-02-05", 150),
        ("u3", "2018-04-05", 75),
        ("u4", "2018-09-01", 999),
    )
    rows = REPORTS["ex2_revenue_trend"](w, DEFAULTS).collect()
    assert [(r["period"], r["mom_growth_pct"]) for r in rows] == [
        ("2018-01", None),
        ("2018-02", Decimal("50.0")),
        ("2018-04", Decimal("-50.0")),
    ]


def test_growth_from_nothing_is_unknown(spark):
    w = shop(spark, ("u1", "2018-01-05", 0), ("u2", "2018-02-05", 10))
    rows = REPORTS["ex2_revenue_trend"](w, DEFAULTS).collect()
    assert [r["mom_growth_pct"] for r in rows] == [None, None]


def test_cohorts_count_people_once_per_month(spark):
    w = shop(
        spark,
        ("u1", "2017-12-05", 10),
        ("u1", "2018-01-05", 10),
        ("u1", "2018-01-06", 10),
        ("u2", "2017-12-09", 10),
        ("u3", "2016-12-09", 10),
        ("u3", "2017-01-09", 10),
    )
    activity = [tuple(r) for r in REPORTS["q3_cohort_activity"](w, DEFAULTS).collect()]
    assert activity == [("2016-12", 0, 1), ("2016-12", 1, 1), ("2017-12", 0, 2), ("2017-12", 1, 1)]
    retention = [tuple(r) for r in REPORTS["cus4_cohort_retention"](w, DEFAULTS).collect()]
    assert retention == [("2017-12", 2, 1, 1, Decimal("50.0"))]


def test_buyers_by_number_of_orders(spark):
    sales = [("a", f"2018-01-0{n}", 10) for n in range(1, 6)]
    sales += [("b", "2018-01-01", 10), ("c", "2018-01-01", 20), ("c", "2018-01-02", 20)]
    rows = REPORTS["cus3_repeat_buyers"](shop(spark, *sales), DEFAULTS).collect()
    got = {r["buyer_type"]: (r["customer_count"], r["avg_lifetime_value"]) for r in rows}
    assert got == {
        "1. One-Time Buyer": (1, 10),
        "2. Bought Twice": (1, 40),
        "4. Loyal (4+ orders)": (1, 50),
    }


def test_headline_texts(spark):
    w = shop(spark, ("u1", "2018-01-05", "1234567.50"))
    row = REPORTS["ex1_kpi_cards"](w, DEFAULTS).first()
    assert row["gross_revenue"] == "R$ 1,234,568"
    assert row["avg_review_score"] == "4.00 / 5"
    assert row["on_time_rate"] == "100.0%"


def test_every_report_runs_on_no_rows(spark):
    w = shop(spark, ("u1", "2018-01-05", 10))
    for name in w.load():
        w._tables[name] = w._tables[name].limit(0)
    for name, report in REPORTS.items():
        rows = report(w, DEFAULTS).collect()
        assert len(rows) <= 1, name


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    w = shop(spark, ("u1", "2018-01-05", 10), ("u2", "2018-02-05", 20))
    loaded = Warehouse(w.sources, folder=str(tmp_path_factory.mktemp("wh")))
    loaded.load()
    return loaded


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Columns as the reports show them.
COLUMNS = {
    "q3_revenue_by_month": "year month month_name year_month total_orders total_items "
    "product_revenue freight_revenue total_revenue avg_review_score",
    "q3_payment_methods": "payment_type orders pct_orders total_payment avg_installments",
    "ex5_payment_mix": "payment_method order_count share_pct avg_payment_value avg_installments "
    "total_payment_volume",
    "ex6_weekday_pattern": "day_of_week day_name day_type total_orders total_revenue "
    "avg_order_value orders_share_pct",
    "cus1_rfm_segments": "segment_label customer_count pct_of_customers avg_recency_days avg_orders "
    "avg_spend_per_customer total_revenue_from_segment",
    "cus5_review_distribution": "review_score score_label review_count pct_of_reviews",
    "prd1_category_leaderboard": "category items_sold unique_orders unique_buyers total_revenue "
    "revenue_share_pct avg_price avg_review_score avg_delivery_days",
    "prd4_quality_matrix": "category items_sold total_revenue avg_price avg_review_score "
    "avg_delivery_days on_time_pct quality_score_100",
    "ops5_delivery_histogram": "delivery_bucket order_count pct_of_orders avg_review_score "
    "avg_delay_days",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_are_in_the_shown_order(stored, name):
    assert REPORTS[name](stored, DEFAULTS).columns == COLUMNS[name].split()


def test_collated_cities_are_grouped_by_plain_text(stored):
    plan = plan_of(REPORTS["cus6_top_cities_collated"](stored, DEFAULTS))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def files_read(df, table: str) -> int:
    """Files that the scans of a table opened in one run."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        inner = node.getClass().getSimpleName()
        if inner == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif inner.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif inner == "FileSourceScanExec" and table in node.simpleString(10_000):
            found += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_date_bounds_skip_months(spark, tmp_path):
    """Of eight months with one file each, reports open those before their bound."""
    days = ["2017-12-31", *(f"2018-{m:02}-{d:02}" for m in range(3, 10) for d in (1, 28))]
    w = shop(spark, *((f"u{i}", day, 10) for i, day in enumerate(days)))
    loaded = Warehouse(w.sources, folder=str(tmp_path))
    loaded.load()
    months = sorted(f.name for f in (tmp_path / "fact_orders").iterdir() if f.is_dir())
    assert months == ["purchase_month=201712", *(f"purchase_month=2018{m:02}" for m in range(3, 10))]
    assert files_read(loaded.fact.select("price"), "fact_orders") == 8
    for cutoff, files in (("2018-09-01", 7), ("2018-09-02", 8), ("2018-01-01", 1), ("2018-03-15", 2)):
        report = REPORTS["ex2_revenue_trend"](loaded, replace(DEFAULTS, trend_cutoff=cutoff))
        assert files_read(report, "fact_orders") == files, cutoff
        plain = REPORTS["ex2_revenue_trend"](w, replace(DEFAULTS, trend_cutoff=cutoff))
        assert report.collect() == plain.collect()
    for period, files in (("2018-08", 7), ("2017-12", 1), ("2018-04", 3)):
        report = REPORTS["prd5_hot_categories"](loaded, replace(DEFAULTS, hot_period=period))
        assert files_read(report, "fact_orders") == files, period


def test_a_large_month_lies_in_slices_of_whole_orders(spark, tmp_path, monkeypatch):
    assert [warehouse._slices(rows, 300) for rows in (0, 1, 10 * warehouse.FILE_ROWS, 1 + 10 * warehouse.FILE_ROWS)] == [1, 1, 1, 2]
    monkeypatch.setattr(warehouse, "FILE_ROWS", 5)
    w = shop(spark, *((f"u{i}", f"2018-03-{1 + i % 28:02}", 10) for i in range(60)))
    loaded = Warehouse(w.sources, folder=str(tmp_path))
    # Partitions far below the advised size would be merged again.
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        loaded.load()
    finally:
        spark.conf.set(setting, "true")
    rows = loaded.fact.select("order_id", "purchase_time_key", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at")).collect()
    files: dict = {}
    for r in sorted(rows, key=lambda r: r["at"]):
        files.setdefault(r["file"], []).append(r["purchase_time_key"])
    assert 2 <= len(files) <= 4  # shuffle partitions of the tests
    assert all(days == sorted(days) for days in files.values())
    assert len({(r["order_id"], r["file"]) for r in rows}) == len({r["order_id"] for r in rows})


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_plans_stay_in_the_engine_and_scale(stored, name):
    plan = plan_of(presentable(REPORTS[name](stored, DEFAULTS)))
    assert "Python" not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()

    def depth(line: str) -> int:
        return len(re.match(r"[\s:+\-*()\d]*", line).group())

    # Rows may meet in one task only after an aggregation has reduced them.
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        below = []
        for other in lines[i + 1 :]:
            if depth(other) <= depth(line):
                break
            below.append(other)
        assert any("Aggregate(" in other for other in below), plan


def test_views_answer_sql(spark, stored):
    stored.create_views()
    rows = spark.sql(
        """WITH monthly AS (
             SELECT t.year, t.month, count(DISTINCT f.order_id) AS orders, sum(f.price) AS revenue
             FROM fact_orders f JOIN dim_time t ON f.purchase_time_key = t.time_key
             GROUP BY t.year, t.month HAVING orders >= 1)
           SELECT month, revenue, round(100.0 * revenue / sum(revenue) OVER (), 1) AS share
           FROM monthly ORDER BY month"""
    ).collect()
    assert [tuple(map(float, r)) for r in rows] == [(1, 10, 33.3), (2, 20, 66.7)]


def test_only_needed_columns_and_pushed_filters_reach_the_scan(stored):
    plan = plan_of(REPORTS["ex2_revenue_trend"](stored, DEFAULTS))
    scan = next(
        line for line in plan.splitlines() if "FileScan" in line and "fact_orders" in line
    )
    assert "LessThan(purchase_time_key,20180901)" in scan
    assert "In(order_status" in scan
    schema = scan.split("ReadSchema:")[1]
    assert "payment" not in schema
    assert "seller_key" not in schema
