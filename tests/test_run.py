"""CSV reading, staging, quality checks and a whole run."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from helpers import customer, frame, item, order, small_sources
from mercastar.operators.profiling import (
    profile_all_columns,
    profile_all_tables,
    profile_columns,
    profile_table,
    validate,
)
from mercastar.plans import quality
from mercastar.plans.parameters import ReportParameters
from mercastar.plans.run import run, stored_run
from mercastar.plans.staging import build_staging
from mercastar.plans.warehouse import Warehouse
from mercastar.schemas import SOURCES, STAGING, WAREHOUSE, create_table_ddl
from mercastar.sources.csv_files import read_source, read_sources
from mercastar.sources.sinks import described, fill_tables
from pyspark.sql import functions as F

CSV = {
    "shop_orders_dataset.csv": (
        "customer_id,order_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "c1,o1,delivered,2018-01-01 10:00:00,,not a date,2018-01-08 09:00:00,2018-01-11\n"
        "c2,o2,shipped,2018-02-01 10:00:00,NA,,,2018-02-20 00:00:00\n"
    ),
    "shop_order_items_dataset.csv": (
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2018-01-03 00:00:00,100.10,10\n"
        "o2,1,p2,s1,2018-02-03 00:00:00,20.00,5.55\n"
    ),
    "shop_order_payments_dataset.csv": (
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1,credit_card,3,110.10\n"
    ),
    "shop_order_reviews_dataset.csv": (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5.0,"good, ""very""","two\nlines",2018-01-12,2018-01-13 01:02:03\n'
    ),
    "shop_customers_dataset.csv": (
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,01310,são paulo,SP\n"
        "c2,u2,null,rio,RJ\n"
    ),
    "shop_sellers_dataset.csv": (
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,00001,rio,RJ\n"
    ),
    "shop_products_dataset.csv": (
        "product_id,product_category_name,product_name_lenght,product_description_lenght,"
        "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p1,livros,10,20,1,500.9,1,2,3\n"
        "p2,,,,,,,,\n"
    ),
    "shop_geolocation_dataset.csv": (
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,"
        "geolocation_state\n01310,-23.5,-46.625,são paulo,SP\n"
    ),
    "product_category_name_translation.csv": (
        "﻿product_category_name,product_category_name_english\nlivros,books\n"
    ),
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    place = tmp_path_factory.mktemp("csv")
    for name, text in CSV.items():
        (place / name).write_text(text, encoding="utf-8")
    return str(place)


def test_csv_sources(spark, folder):
    sources = read_sources(spark, folder)
    for name, schema in SOURCES.items():
        assert [(f.name, f.dataType) for f in sources[name].schema] == [
            (f.name, f.dataType) for f in schema
        ]
    first = sources["orders"].orderBy("order_id").first()
    assert first["order_id"] == "o1"  # by name, whatever the column order
    assert first["order_approved_at"] is None
    assert first["order_delivered_carrier_date"] is None
    assert first["order_estimated_delivery_date"] == datetime(2018, 1, 11)
    (review,) = sources["reviews"].collect()
    assert review["review_comment_title"] == 'good, "very"'
    assert review["review_comment_message"] == "two\nlines"
    assert review["review_score"] == 5
    people = sources["customers"].orderBy("customer_id").collect()
    assert [r["customer_zip_code_prefix"] for r in people] == ["01310", None]
    assert sources["translation"].columns[0] == "product_category_name"
    assert sources["order_items"].orderBy("order_id").first()["price"] == Decimal("100.10")


def test_csv_with_a_missing_column_is_refused(spark, tmp_path):
    path = tmp_path / "x_sellers_dataset.csv"
    path.write_text("seller_id,seller_city\ns1,rio\n")
    with pytest.raises(ValueError, match="seller_zip_code_prefix"):
        read_source(spark, str(path), "sellers")


ITEMS = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"


def test_csv_columns_are_bound_by_name_in_every_file(spark, tmp_path):
    (tmp_path / "a_sellers_dataset.csv").write_text(
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01000,rio,RJ\n"
    )
    (tmp_path / "b_sellers_dataset.csv").write_text(
        "seller_state,extra,seller_city,seller_id,seller_zip_code_prefix\nSP,9,santos,s2,02000\n"
    )
    rows = read_source(spark, str(tmp_path / "*_sellers_dataset.csv"), "sellers").collect()
    assert sorted(tuple(r) for r in rows) == [
        ("s1", "01000", "rio", "RJ"),
        ("s2", "02000", "santos", "SP"),
    ]


@pytest.mark.parametrize(
    "line",
    [
        "o1,1",  # short
        "o1,1,p1,s1,2018-01-03,1,1,1",  # long
        "o1,1.7,p1,s1,2018-01-03,1,1",  # a fraction of an item
        "o1,1,p1,s1,2018-01-03,12.345,1",  # a tenth of a cent
    ],
)
def test_csv_rows_that_do_not_fit_fail(spark, tmp_path, line):
    path = tmp_path / "x_order_items_dataset.csv"
    path.write_text(ITEMS + line + "\n")
    with pytest.raises(Exception, match="MALFORMED|USER_RAISED|no int|no decimal"):
        read_source(spark, str(path), "order_items").collect()


def test_csv_numbers_may_have_zeros_at_the_end(spark, tmp_path):
    path = tmp_path / "x_order_items_dataset.csv"
    path.write_text(ITEMS + "o1,1.0,p1,s1,2018-01-03,12.3400,\n")
    row = read_source(spark, str(path), "order_items").first()
    assert (row["order_item_id"], row["price"], row["freight_value"]) == (1, Decimal("12.34"), None)


def test_all_locations_are_read_unless_a_fraction_is_asked_for(spark, folder, tmp_path):
    place = tmp_path / "many"
    place.mkdir()
    for name, text in CSV.items():
        (place / name).write_text(text, encoding="utf-8")
    header = CSV["shop_geolocation_dataset.csv"].split("\n")[0]
    lines = [f"{n:05},-23.5,-46.6,são paulo,SP" for n in range(50)]
    (place / "shop_geolocation_dataset.csv").write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    assert read_sources(spark, str(place))["geolocation"].count() == 50
    assert read_sources(spark, str(place), sample_fraction=0.2)["geolocation"].count() == 10


def test_csv_with_an_unreadable_number_fails(spark, tmp_path):
    path = tmp_path / "x_order_payments_dataset.csv"
    path.write_text(
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,x,a,1,1\n"
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_source(spark, str(path), "payments").collect()


def test_whole_run_and_rerun(spark, folder, tmp_path):
    parameters = ReportParameters(
        minimum_rows=(("dim_time", 40), ("dim_region", 27), ("fact_orders", 3))
    )
    for _ in range(2):  # a second run replaces the tables
        result = run(spark, folder, str(tmp_path / "out"), parameters)
    assert result.warnings == []
    assert result.warehouse.fact.count() == 2
    assert result.staging["stg_products"].count() == 2
    status = {r["check_name"]: r["status"] for r in result.checks.collect()}
    assert status["row_count_dim_time"] == "PASS"
    assert status["row_count_fact_orders"] == "FAIL"
    assert status["staging_vs_dwh_orders"] == "PASS"
    assert status["delivered_rate"] == "FAIL"  # 1 of 2
    assert result.success is False
    reopened = stored_run(spark, str(tmp_path / "out"))
    assert sorted(reopened.warehouse.fact.collect()) == sorted(result.warehouse.fact.collect())
    assert reopened.staging["stg_products"].count() == 2
    assert reopened.success is False


def test_a_run_drops_copies_of_dimensions_once(spark, tmp_path):
    """The stored dimensions come from stored staging tables: their plans group nothing."""
    w = Warehouse(small_sources(spark), folder=str(tmp_path))
    for name in ("dim_customer", "dim_product", "dim_seller"):
        plan = w._plan(name)._jdf.queryExecution().optimizedPlan().toString()
        assert "_row" not in plan and "min(struct" not in plan, plan


def test_checks_are_24_and_all_pass_on_good_data(spark):
    sources = small_sources(spark)
    parameters = ReportParameters(minimum_rows=tuple((name, 1) for name in WAREHOUSE))
    results = quality.run_checks(Warehouse(sources), build_staging(sources), parameters)
    assert results.columns == list(quality.RESULT)
    rows = results.collect()
    assert len(rows) == 24
    assert {r["status"] for r in rows} == {"PASS"}
    assert tuple(quality.verdict(results).first()) == (24, 24, 0, 0, True)


def test_checks_on_no_data_do_not_divide_by_zero(spark):
    sources = {name: frame(spark, name) for name in SOURCES}
    checks = quality.run_checks(Warehouse(sources), build_staging(sources), ReportParameters())
    status = {r["check_name"]: r["status"] for r in checks.collect()}
    assert len(status) == 24
    assert status["staging_vs_dwh_orders"] == "WARN"
    assert status["delivered_rate"] == "FAIL"
    assert status["avg_review_score"] == "FAIL"


def test_checks_find_bad_facts(spark):
    w = Warehouse(small_sources(spark))
    good = w.fact
    bad = good.selectExpr(
        *[
            {
                "customer_key": "CAST(NULL AS BIGINT) AS customer_key",
                "seller_key": "CAST(77 AS BIGINT) AS seller_key",
                "price": "CAST(-1 AS DECIMAL(10,2)) AS price",
                "review_score": "6 AS review_score",
                "delivery_days": "0 AS delivery_days",
            }.get(c, c)
            for c in good.columns
        ]
    )
    w._tables["fact_orders"] = good.union(bad)
    orphans = {r["key_column"]: r["orphans"] for r in quality.orphan_rows(w).collect()}
    assert orphans == {
        "customer_key": 1,
        "product_key": 0,
        "seller_key": 1,
        "purchase_time_key": 0,
        "customer_region_key": 0,
    }
    status = {r["check_name"]: r["status"] for r in quality.check_nulls(w).collect()}
    assert [k for k, v in status.items() if v == "FAIL"] == [
        "null_check_price",
        "null_check_customer_key",
    ]
    rules = quality.check_business_rules(w, ReportParameters()).collect()
    status = {r["check_name"]: r["status"] for r in rules}
    assert status["review_score_range"] == "FAIL"
    assert status["delivery_days_positive"] == "WARN"
    assert quality.fact_duplicates(w).first()["status"] == "FAIL"


def test_staging_keeps_one_row_per_key(spark):
    sources = small_sources(
        spark,
        orders=[order(), order(order_status="shipped")],
        order_items=[item(price=2), item(price=1), item(line=2)],
        customers=[customer(), customer(customer_city="x")],
    )
    moment = datetime(2020, 1, 2, 3, 4, 5)
    staging = build_staging(sources, moment)
    assert staging["stg_orders"].count() == 1
    items = staging["stg_order_items"].orderBy("order_item_id").collect()
    assert [r["price"] for r in items] == [1, 100]
    assert {r["_etl_loaded_at"] for r in items} == {moment}
    (product,) = staging["stg_products"].collect()
    assert product["product_category_name_english"] == "books"
    assert product["product_weight_g"] == 0
    for name, df in staging.items():
        assert df.columns == STAGING[name].names


def test_validation_warnings(spark):
    assert validate("orders", frame(spark, "orders")) == ["[orders] EMPTY"]
    assert validate("orders", frame(spark, "orders", order(), order())) == [
        "[orders] 1 duplicate rows on key order_id"
    ]
    bad = frame(spark, "order_items", item(price=-1, freight_value=-2))
    assert len(validate("order_items", bad)) == 2
    scores = [
        {"review_id": f"r{n}", "order_id": "o1", "review_score": s}
        for n, s in enumerate([0, 6, 3, None])
    ]
    assert validate("reviews", frame(spark, "reviews", *scores)) == [
        "[reviews] 2 review scores outside 1-5"
    ]
    assert validate("customers", frame(spark, "customers", customer())) == []


def test_profile(spark):
    df = frame(spark, "customers", customer(), customer(), customer(2, customer_city=None))
    assert tuple(profile_table("customers", df).first()) == ("customers", 3, 5, 1, 1)
    rows = {r["column_name"]: r for r in profile_columns("customers", df).collect()}
    assert rows["customer_city"]["null_count"] == 1
    assert rows["customer_city"]["null_pct"] == Decimal("33.3")
    assert rows["customer_city"]["distinct_count"] == 1
    assert rows["customer_id"]["min_value"] == "-"
    prices = frame(spark, "order_items", item(price=2), item(price=10.5))
    rows = {r["column_name"]: r for r in profile_columns("order_items", prices).collect()}
    assert (rows["price"]["min_value"], rows["price"]["max_value"]) == ("2.00", "10.50")
    empty = profile_columns("sellers", frame(spark, "sellers")).collect()
    assert {r["null_pct"] for r in empty} == {None}


def test_profiles_scan_each_source_once(spark, tmp_path):
    sources = {}
    for name, df in small_sources(spark).items():
        df.write.parquet(str(tmp_path / name))
        sources[name] = spark.read.schema(SOURCES[name]).parquet(str(tmp_path / name))
    for build in (profile_all_columns, profile_all_tables):
        plan = build(sources)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == len(SOURCES)
        assert "Window" not in plan and "SinglePartition" not in plan
    tables = {r["table_name"]: r for r in profile_all_tables(sources).collect()}
    assert {n: r["row_count"] for n, r in tables.items()} == {n: int(n != "geolocation") for n in SOURCES}
    assert {n: r["column_count"] for n, r in tables.items()} == {n: len(s) for n, s in SOURCES.items()}


def test_profile_of_tables_moves_one_entry_a_row(spark):
    many = spark.range(3).selectExpr(*[f"IF(id = {i % 3} AND {i} > 60, NULL, 1) AS c{i}" for i in range(70)])
    assert tuple(profile_table("t", many.union(many)).first()) == ("t", 6, 70, 3, 9)
    assert tuple(profile_table("t", many.where("id < 0")).first()) == ("t", 0, 70, 0, 0)
    plan = profile_all_tables({"t": many})._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_profile_bounds_of_every_kind(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
           (-2, 1.5D, 10.25BD, DATE'2018-01-02', TIMESTAMP_NTZ'2018-01-02 03:04:05.678', 9L, 'b', NULL, 1e20BD, 1.1F, TIMESTAMP'2020-01-01 00:00:01'),
           (10, -0.5D, 9.75BD, DATE'0999-12-31', TIMESTAMP_NTZ'2018-01-02 03:04:05.679', NULL, 'a', NULL, 99BD, 2.2F, NULL),
           (NULL, NULL, NULL, NULL, NULL, -9L, NULL, NULL, NULL, NULL, NULL)
           AS t(i, d, m, day, at, l, s, nothing, wide, f, moment)"""
    ).withColumn("nothing", F.col("nothing").cast("int"))
    rows = {r["column_name"]: (r["null_count"], r["distinct_count"], r["min_value"], r["max_value"]) for r in profile_columns("t", df).collect()}
    assert rows == {
        "i": (1, 2, "-2", "10"),
        "d": (1, 2, "-0.5", "1.5"),
        "m": (1, 2, "9.75", "10.25"),
        "day": (1, 2, "0999-12-31", "2018-01-02"),
        "at": (1, 2, "2018-01-02 03:04:05", "2018-01-02 03:04:05"),
        "l": (1, 2, "-9", "9"),
        "s": (1, 2, "-", "-"),
        "nothing": (3, 0, None, None),
        "wide": (1, 2, "99", "100000000000000000000"),
        "f": (1, 2, "1.1", "2.2"),
        "moment": (2, 1, "2020-01-01 00:00:01", "2020-01-01 00:00:01"),
    }


def test_rows_that_differ_in_the_place_of_a_null_are_no_copies(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None), (None, None)], "x string, y string")
    assert tuple(profile_table("t", df).first()) == ("t", 4, 2, 1, 2)


def test_short_decimals_are_counted_exactly(spark):
    texts = ["-9999999999999.99", "9999999999999.99", "9999999999999.98", "0.01", "-0.01", "0.07", "1.15", "4.35"]
    df = spark.createDataFrame([(Decimal(t),) for t in texts], "m decimal(15,2)")
    row = profile_columns("t", df).first()
    assert (row["distinct_count"], row["min_value"], row["max_value"]) == (8, texts[0], texts[1])


def test_table_definitions(spark):
    for name in STAGING | WAREHOUSE:
        spark.sql(create_table_ddl(name, f"made_{name}"))
        made = spark.table(f"made_{name}")
        assert made.columns == (STAGING | WAREHOUSE)[name].names


def test_tables_are_filled_anew_and_described(spark, tmp_path):
    place = str(tmp_path / "catalog")
    first = build_staging(small_sources(spark))
    fill_tables(spark, first, place, "filled_")
    second = build_staging(small_sources(spark, orders=[order(1), order(2, order_status=None)]))
    tables = fill_tables(spark, second, place, "filled_")
    assert list(tables) == list(STAGING)
    rows = {(r["table_name"], r["column_name"]): r for r in described(tables).collect()}
    assert len(rows) == sum(len(schema) for schema in STAGING.values())
    status = rows["stg_orders", "order_status"]
    assert (status["position"], status["data_type"]) == (3, "string")
    assert (status["row_count"], status["value_count"]) == (2, 1)
    audit = rows["stg_orders", "_etl_loaded_at"]
    assert (audit["row_count"], audit["value_count"]) == (2, 2)
    nothing = rows["stg_geolocation", "geolocation_lat"]
    assert (nothing["data_type"], nothing["row_count"], nothing["value_count"]) == ("decimal(10,6)", 0, 0)


def test_locations_of_tables(spark, tmp_path):
    assert "LOCATION" not in create_table_ddl("dim_time")
    assert create_table_ddl("dim_region", "r", "/a b").endswith("USING parquet LOCATION '/a b'")
    for wrong in ("/it's", "/back\\slash"):
        with pytest.raises(ValueError, match="no location"):
            create_table_ddl("dim_time", location=wrong)


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    Warehouse(small_sources(spark)).save_to_catalog("shop", 4)
    w = Warehouse.catalog(spark, "shop")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = w.fact.join(w.customer, "customer_key")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "Exchange" not in plan
        assert joined.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
