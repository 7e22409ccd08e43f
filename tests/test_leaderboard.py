from __future__ import annotations

from collections import defaultdict

import pytest
from mercastar.plans.parameters import ReportParameters
from mercastar.plans.reports import REPORTS, products
from mercastar.plans.warehouse import Warehouse

NAME = "prd1_category_leaderboard"
DEFAULTS = ReportParameters()


def star(spark, facts: list[tuple], categories: dict[int, str | None]) -> Warehouse:
    w = Warehouse({})
    w._tables["fact_orders"] = spark.createDataFrame(
        [(*f, "delivered") for f in facts],
        "order_id string, customer_key bigint, product_key bigint, cost int, review_score int, "
        "delivery_days int, order_status string",
    ).selectExpr("*", "CAST(cost AS DECIMAL(10,2)) AS price", "20180101 AS purchase_time_key", "201801 AS purchase_month")
    w._tables["dim_product"] = spark.createDataFrame(
        list(categories.items()), "product_key bigint, product_category_name_english string"
    ).selectExpr(
        "product_key", "'p' || product_key AS product_id", "'x' AS product_category_name", "product_category_name_english",
        "1 AS product_weight_g", "1 AS product_length_cm", "1 AS product_height_cm", "1 AS product_width_cm",
    )
    return w


def counted(facts, categories):
    """Items, orders and buyers by category, from plain sets."""
    found = defaultdict(lambda: [0, set(), set()])
    for order_id, buyer, product, *_ in facts:
        if product in categories:
            one = found[categories[product]]
            one[0] += 1
            one[1].add(order_id)
            one[2].add(buyer)
    return {
        ("Unknown" if name is None else name, n, len(orders - {None}), len(buyers - {None}))
        for name, (n, orders, buyers) in found.items()
    }


@pytest.mark.parametrize("few", [7, 100])
def test_orders_and_buyers_are_counted_once_for_each_category(spark, few, monkeypatch):
    """More categories than a number has bits, NULL for one, products in several blocks and with gaps."""
    monkeypatch.setattr(products, "BLOCK", 16)
    categories = {n: (None if n % few == 3 else f"c{n % few}") for n in range(1, 301) if n % 9 != 4}
    facts = [
        (f"o{n % 83}", n % 83 % 31 if n % 50 else n % 7, 1 + n * n % 310, n % 13, n % 5 or None, n % 4)
        for n in range(700)
    ]
    facts += [(None, 5, 1, 1, 1, 1), ("o1", None, 2, 1, 1, 1), (None, None, 120, 99, None, None)]
    rows = REPORTS[NAME](star(spark, facts, categories), DEFAULTS).collect()
    expected = counted(facts, categories)
    got = {(r["category"], r["items_sold"], r["unique_orders"], r["unique_buyers"]) for r in rows}
    assert len(got) == min(15, few) and got <= expected
    shares = [float(r["revenue_share_pct"]) for r in rows]
    assert shares == sorted(shares, reverse=True)


def test_no_orders_and_no_products(spark):
    assert REPORTS[NAME](star(spark, [], {1: "a"}), DEFAULTS).collect() == []
    assert REPORTS[NAME](star(spark, [("o", 1, 1, 1, 1, 1)], {}), DEFAULTS).collect() == []
    (row,) = REPORTS[NAME](star(spark, [(None, None, 1, 1, None, None)], {1: None}), DEFAULTS).collect()
    assert (row["category"], row["items_sold"], row["unique_orders"], row["unique_buyers"]) == ("Unknown", 1, 0, 0)


def test_items_are_not_multiplied_for_distinct_counts(spark):
    plan = REPORTS[NAME](star(spark, [("o", 1, 1, 1, 1, 1)], {1: "a"}), DEFAULTS)._jdf.queryExecution()
    assert "Expand" not in plan.executedPlan().toString()
