from __future__ import annotations

import time

from helpers import customer, item, order, small_sources
from mercastar.plans import warehouse
from mercastar.plans.warehouse import Warehouse, load_warehouse
from mercastar.sources.sinks import DROP_SHUFFLES, write_parquet

ORDERS = 40


def many(spark, tmp_path):
    """Orders of three items, some of them twice, without customer or with NULL for an id, as files."""
    numbers = range(1, ORDERS + 1)
    tables = small_sources(
        spark,
        orders=[order(n, order_purchase_timestamp=f"2018-0{1 + n % 3}-10 10:00:00") for n in numbers]
        + [order(5), order(6, order_id=None)],
        order_items=[item(n, line) for n in numbers for line in (1, 2, 3)]
        + [item(7), item(8, order_id=None)],
        payments=[
            {"order_id": f"o{n}", "payment_sequential": n % 2, "payment_type": f"t{n % 4}", "payment_value": n}
            for n in numbers
            for _ in range(2)
        ],
        reviews=[{"review_id": f"r{n}", "order_id": f"o{n}", "review_score": n % 5} for n in numbers if n % 3],
        customers=[customer(n) for n in numbers if n != 9],
    )
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/sources/{name}")
    return {name: spark.read.parquet(f"{tmp_path}/sources/{name}") for name in tables}


def test_passes_load_the_same_fact(spark, tmp_path, monkeypatch):
    assert [warehouse._passes(n * warehouse.PASS_ROWS + 1) for n in (0, 1, 6)] == [1, 2, 7]
    assert warehouse._passes(0) == 1
    sources = many(spark, tmp_path)
    whole = Warehouse(sources).table("fact_orders").collect()
    assert len(whole) == 3 * (ORDERS - 1) + 1 + 3
    written = []
    monkeypatch.setattr(warehouse, "PASS_ROWS", 30)
    monkeypatch.setattr(
        warehouse, "write_parquet", lambda df, path, *a, **b: (written.append(path), write_parquet(df, path, *a, **b))
    )
    stored = load_warehouse(spark, sources, str(tmp_path / "star"))
    assert sum(path.endswith("/fact_orders") for path in written) == 5
    assert sorted(map(str, stored.table("fact_orders").collect())) == sorted(map(str, whole))
    again = Warehouse(sources, folder=stored.folder)  # what is there is replaced
    assert again.table("fact_orders").count() == len(whole)
    assert "placed_orders" not in {path.name for path in (tmp_path / "star").rglob("*")}
    months = {path.name for path in (tmp_path / "star").rglob("purchase_month=*")}
    assert months == {f"purchase_month=20180{m}" for m in (1, 2, 3)}


def test_a_pass_shuffles_its_own_orders_only(spark, tmp_path):
    """Each of the four inputs that meet by order is filtered at its scan, below the shuffles."""
    parts = Warehouse(many(spark, tmp_path))._fact_parts()
    for name, df in parts.items():
        plan = warehouse._of_pass(df, 1, 3)._jdf.queryExecution().executedPlan().toString().splitlines()
        (at,) = [i for i, line in enumerate(plan) if "Filter (" in line and "pmod(xxhash64" in line]
        exchanges = [line for line in plan[at:] if "Exchange hashpartitioning(order_id" in line]
        assert not exchanges, name
    rows = [warehouse._of_pass(parts["items"], n, 3).count() for n in range(3)]
    assert sum(rows) == parts["items"].count() and min(rows) > 10


def shuffle_files(spark) -> set[str]:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    before = spark.conf.get(DROP_SHUFFLES)
    known = shuffle_files(spark)
    rows = spark.range(1000).selectExpr("id % 10 AS a", "id AS b")
    kept = rows.groupBy("a").count()
    assert len(kept.collect()) == 10
    assert shuffle_files(spark) - known  # the test sees such files
    known = shuffle_files(spark)
    write_parquet(rows.repartition(3, "b").groupBy("a").sum("b"), str(tmp_path / "sums"))
    end = time.time() + 20  # files are deleted in the background
    while shuffle_files(spark) - known and time.time() < end:
        time.sleep(0.1)
    assert not shuffle_files(spark) - known
    write_parquet(kept, str(tmp_path / "kept"))
    assert len(kept.collect()) == 10  # a plan that ran before runs again
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 10
    assert spark.conf.get(DROP_SHUFFLES) == before
