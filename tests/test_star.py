from __future__ import annotations

from datetime import date

from helpers import customer, frame, item, order, small_sources
from mercastar.fixed_values import STATES
from mercastar.plans import star
from mercastar.plans.star import dim_region, dim_time, fact_summary, star_summary
from mercastar.plans.warehouse import build_star
from mercastar.schemas import WAREHOUSE


def fact(spark, **tables):
    rows = build_star(small_sources(spark, **tables))["fact_orders"].collect()
    return sorted(rows, key=lambda r: (r["order_id"], r["order_item_id"]))


def test_tables_have_the_declared_schema(spark):
    for name, df in build_star(small_sources(spark)).items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in WAREHOUSE[name]
        ]


def test_plain_row(spark):
    (row,) = fact(spark)
    assert row["total_revenue"] == 110
    assert (row["delivery_days"], row["estimated_delivery_days"], row["delay_days"]) == (6, 9, -3)
    assert (row["purchase_time_key"], row["delivery_time_key"]) == (20180101, 20180108)
    assert row["is_on_time"] is True
    codes = [code for code, _, _ in STATES]
    assert row["customer_region_key"] == codes.index("SP") + 1
    assert row["seller_region_key"] == codes.index("RJ") + 1


def numbered(count: int, make) -> dict:
    """Orders, items and customers 1..count; `make` gives an order's columns."""
    numbers = range(1, count + 1)
    return {
        "orders": [order(n, **make(n)) for n in numbers],
        "order_items": [item(n) for n in numbers],
        "customers": [customer(n) for n in numbers],
    }


def test_delay_floors_but_on_time_compares_instants(spark):
    cases = [
        ("2018-01-11 00:00:00", 0, True),
        ("2018-01-11 10:00:00", 0, False),
        ("2018-01-10 10:00:00", -1, True),
        ("2018-01-12 00:00:00", 1, False),
    ]
    tables = numbered(4, lambda n: {"order_delivered_customer_date": cases[n - 1][0]})
    got = [(r["delay_days"], r["is_on_time"]) for r in fact(spark, **tables)]
    assert got == [case[1:] for case in cases]


def test_undelivered_keeps_only_the_estimate(spark):
    (row,) = fact(spark, orders=[order(order_delivered_customer_date=None)])
    assert row["delivery_days"] is None
    assert row["delay_days"] is None
    assert row["is_on_time"] is None
    assert row["delivery_time_key"] is None
    assert row["estimated_delivery_days"] == 9


def test_delivery_without_estimate_is_late(spark):
    (row,) = fact(spark, orders=[order(order_estimated_delivery_date=None)])
    assert row["is_on_time"] is False
    assert row["delay_days"] is None


def payment(sequence, kind, value, installments=1, n=1):
    return {
        "order_id": f"o{n}",
        "payment_sequential": sequence,
        "payment_type": kind,
        "payment_installments": installments,
        "payment_value": value,
    }


def test_payments_sum_first_named_type_and_most_installments(spark):
    (row,) = fact(
        spark,
        payments=[
            payment(3, "voucher", 5, 1),
            payment(1, None, 7.5, 9),
            payment(2, "boleto", None, 3),
        ],
    )
    assert row["payment_type"] == "boleto"
    assert row["payment_value"] == 12.5
    assert row["payment_installments"] == 9


def test_all_missing_payment_values_sum_to_zero(spark):
    (row,) = fact(spark, payments=[payment(1, "boleto", None)])
    assert row["payment_value"] == 0


def test_order_without_payment_or_review_is_kept(spark):
    (row,) = fact(spark, payments=[], reviews=[])
    assert row["payment_value"] is None
    assert row["payment_type"] is None
    assert row["review_score"] is None


def test_one_review_per_order_even_if_its_score_is_missing(spark):
    def review(name, score, n):
        return {"review_id": name, "order_id": f"o{n}", "review_score": score}

    reviews = [review("r2", 1, 1), review("r1", 5, 1), review("r4", 1, 2), review("r3", None, 2)]
    rows = fact(spark, reviews=reviews, **numbered(2, lambda n: {}))
    assert [r["review_score"] for r in rows] == [5, None]


def test_rows_without_a_required_key_are_dropped(spark):
    got = fact(
        spark,
        orders=[order(n) for n in range(1, 7)]
        + [order(7, order_purchase_timestamp=None), order(8)],
        order_items=[
            item(1, product_id="gone"),
            item(2, seller_id="gone"),
            item(3),
            item(4),
            item(5),
            item(7),
            item(8),
            item(9),
        ],
        customers=[
            customer(1),
            customer(2),
            customer(3, customer_state=None),
            customer(4, customer_state="XX"),
            customer(7),
            customer(8),
            customer(9),
        ],
    )
    assert [r["order_id"] for r in got] == ["o8"]


def test_unknown_seller_state_keeps_the_row(spark):
    (row,) = fact(spark, sellers=[{"seller_id": "s1", "seller_state": None}])
    assert row["seller_region_key"] is None


def test_missing_money_becomes_zero_and_so_does_the_total(spark):
    (row,) = fact(spark, order_items=[item(price=None)])
    assert (row["price"], row["freight_value"], row["total_revenue"]) == (0, 10, 0)


def test_repeated_orders_and_items_stay_in_the_fact(spark):
    assert len(fact(spark, orders=[order(), order()], order_items=[item(), item()])) == 4


def test_categories_fall_back_to_their_own_name(spark):
    products = [
        {"product_id": "p1", "product_category_name": "livros", "product_weight_g": 10.9},
        {"product_id": "p2", "product_category_name": "pcs"},
        {"product_id": "p3"},
    ]
    star = build_star(small_sources(spark, products=products))
    rows = {r["product_id"]: r for r in star["dim_product"].collect()}
    assert rows["p1"]["product_category_name_english"] == "books"
    assert rows["p1"]["product_weight_g"] == 10
    assert rows["p2"]["product_category_name_english"] == "pcs"
    assert rows["p2"]["product_weight_g"] == 0
    assert rows["p3"]["product_category_name"] == "unknown"
    assert rows["p3"]["product_category_name_english"] == "unknown"


def test_dimension_rows_are_clean_and_unique(spark):
    customers = [
        customer(customer_city=" santa BARBARA d'oeste "),
        customer(customer_city="zz"),
        customer(n=2, customer_city=None),
    ]
    star = build_star(small_sources(spark, customers=customers))
    rows = {r["customer_id"]: r for r in star["dim_customer"].collect()}
    assert len(rows) == 2
    assert sorted(r["customer_key"] for r in rows.values()) == [1, 2]
    assert rows["c1"]["customer_city"] == "Santa Barbara D'Oeste"
    assert rows["c1"]["customer_state"] == "SP"
    assert rows["c1"]["customer_zip_code_prefix"] == "01310"
    assert rows["c2"]["customer_city"] is None


def test_calendar(spark):
    orders = frame(
        spark,
        "orders",
        order(
            order_purchase_timestamp="2016-12-31 23:00:00",
            order_delivered_customer_date=None,
            order_estimated_delivery_date="2018-10-01 00:00:00",
        ),
    )
    days = {r["full_date"]: r for r in dim_time(orders).collect()}
    assert len(days) == 640
    first = days[date(2017, 1, 1)]
    assert (first["week_of_year"], first["year"], first["day_of_week"]) == (52, 2017, 7)
    assert first["is_weekend"] is True
    assert days[date(2018, 1, 1)]["week_of_year"] == 1
    last = days[date(2018, 10, 1)]
    assert (last["time_key"], last["quarter"], last["month_name"]) == (20181001, 4, "October")
    assert (last["day_of_week"], last["day_name"], last["is_weekend"]) == (1, "Monday", False)


def test_calendar_without_orders_is_empty(spark):
    assert dim_time(frame(spark, "orders")).count() == 0


def test_state_table(spark):
    rows = dim_region(spark).orderBy("region_key").collect()
    assert [r["region_key"] for r in rows] == list(range(1, 28))
    assert tuple(rows[24])[1:] == ("SP", "São Paulo", "Sudeste")
    assert len({r["macro_region"] for r in rows}) == 5


def test_summaries(spark):
    star = build_star(small_sources(spark))
    sizes = {r["table_name"]: r["row_count"] for r in star_summary(star).collect()}
    assert sizes == {
        "dim_time": 11,
        "dim_region": 27,
        "dim_customer": 1,
        "dim_product": 1,
        "dim_seller": 1,
        "fact_orders": 1,
    }
    row = fact_summary(star["fact_orders"]).first()
    assert (row["fact_rows"], row["delivered_rows"], row["total_price"]) == (1, 1, 100)
    empty = fact_summary(star["fact_orders"].limit(0)).first()
    assert (empty["fact_rows"], empty["delivered_rows"], empty["avg_price"]) == (0, 0, None)


def paid(order_id, place, kind) -> dict:
    return {"order_id": order_id, "payment_sequential": place, "payment_type": kind, "payment_value": 1}


def test_first_payment_type_by_number_as_by_struct(spark, monkeypatch):
    rows = [
        paid("a", 2, "x"), paid("a", -(1 << 31), "z"), paid("a", -(1 << 31), "y"),
        paid("b", 1, "x"), paid("b", None, "z"), paid("b", None, "é"),
        paid("c", 1, None), paid("c", 3, "ä"), paid("c", 3, "z"),
        paid("d", None, None), paid(None, 1, "x"), paid(None, 1, "x"),
    ]
    payments = frame(spark, "payments", *rows)

    def found():
        per_order = star.payments_per_order(payments)
        return per_order, {r["order_id"]: (r["payment_value"], r["payment_type"]) for r in per_order.collect()}

    numbered, got = found()
    assert got == {"a": (3, "y"), "b": (3, "z"), "c": (3, "z"), "d": (1, None), None: (2, "x")}
    assert "SortAggregate" not in numbered._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(star, "MOST_TYPES", 2)
    assert found()[1] == got


def test_orders_move_once_by_order(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = build_star(small_sources(spark))["fact_orders"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Orders with their customers, payments, reviews and items.
    assert plan.count("Exchange hashpartitioning(order_id") == 4
