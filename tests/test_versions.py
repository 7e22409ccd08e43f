"""Loads that end badly leave what was there; loads that end well replace it as a whole."""

from __future__ import annotations

import os

import pytest
from helpers import customer, item, order, small_sources
from mercastar.plans import run as whole_run
from mercastar.plans import star
from mercastar.plans.staging import load_staging, stored_staging
from mercastar.plans.warehouse import Warehouse, load_warehouse
from mercastar.sources.versions import current, drop_unpublished, loading, published
from test_run import CSV


class Stop(Exception):
    pass


def stop(*_, **__):
    raise Stop


def two_orders(spark):
    return small_sources(
        spark, orders=[order(1), order(2)], order_items=[item(1), item(2)], customers=[customer(1), customer(2)]
    )


def test_a_load_that_fails_in_the_fact_leaves_the_old_star(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    load_warehouse(spark, small_sources(spark), folder)
    monkeypatch.setattr(star, "fact_orders", stop)
    with pytest.raises(Stop):
        load_warehouse(spark, two_orders(spark), folder)
    old = Warehouse.stored(spark, folder)
    assert [old.fact.count(), old.customer.count()] == [1, 1]  # not the new customers
    assert len(os.listdir(tmp_path / "versions")) == 1
    monkeypatch.undo()
    load_warehouse(spark, two_orders(spark), folder)
    new = Warehouse.stored(spark, folder)
    assert [new.fact.count(), new.customer.count()] == [2, 2]
    assert [old.fact.count(), old.customer.count()] == [1, 1]  # still there for who opened it


def test_a_task_that_fails_in_the_middle_of_a_load(spark, tmp_path):
    """The error comes from the data, while later staging tables are being written."""
    folder = str(tmp_path)
    load_staging(spark, small_sources(spark), folder)
    bad = two_orders(spark)
    bad["sellers"] = bad["sellers"].selectExpr(
        "seller_id", "raise_error('unreadable') AS seller_zip_code_prefix", "seller_city", "seller_state"
    )
    with pytest.raises(Exception, match="unreadable"):
        load_staging(spark, bad, folder)
    assert {n: df.count() for n, df in stored_staging(spark, folder).items()}["stg_orders"] == 1


def test_a_run_that_stops_leaves_the_run_before(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "csv", str(tmp_path / "out")
    source.mkdir()
    for name, text in CSV.items():
        (source / name).write_text(text, encoding="utf-8")
    whole_run.run(spark, str(source), target)
    with open(source / "shop_customers_dataset.csv", "a") as file:
        file.write("c3,u3,null,rio,RJ\n")
    monkeypatch.setattr(whole_run, "run_checks", stop)
    with pytest.raises(Stop):
        whole_run.run(spark, str(source), target)
    monkeypatch.undo()
    old = whole_run.stored_run(spark, target)
    assert old.staging["stg_customers"].count() == old.warehouse.customer.count() == 2
    assert old.checks.count() == 24
    whole_run.run(spark, str(source), target)
    assert whole_run.stored_run(spark, target).warehouse.customer.count() == 3


def test_versions_that_are_kept(spark, tmp_path):
    folder = str(tmp_path)
    assert current(spark, folder) == folder and published(spark, folder) == []
    made = []
    for n in range(4):
        with loading(spark, folder) as version:
            spark.range(n).write.parquet(f"{version}/t")
        made.append(version)
        assert current(spark, folder) == version
    assert [os.path.exists(v) for v in made] == [False, False, True, True]
    assert spark.read.parquet(f"{current(spark, folder)}/t").count() == 3


def test_loads_at_the_same_time_are_whole(spark, tmp_path):
    folder = str(tmp_path)
    with loading(spark, folder) as first:
        spark.range(1).write.parquet(f"{first}/t")
        with loading(spark, folder) as second:
            spark.range(2).write.parquet(f"{second}/t")
        assert current(spark, folder) == second
    assert first != second
    assert current(spark, folder) == second  # it began later
    assert spark.read.parquet(f"{first}/t").count() == 1


def test_what_a_killed_load_leaves(spark, tmp_path):
    folder = str(tmp_path)
    with loading(spark, folder) as whole:
        spark.range(1).write.parquet(f"{whole}/t")
    left = "000000000009-killed"
    spark.range(9).write.parquet(f"{folder}/versions/{left}/t")
    assert current(spark, folder) == whole
    with loading(spark, folder) as later:
        spark.range(2).write.parquet(f"{later}/t")
    assert current(spark, folder) == later  # numbered after it
    assert drop_unpublished(spark, folder) == [left]
    assert spark.read.parquet(f"{current(spark, folder)}/t").count() == 2
