from __future__ import annotations

import hashlib
import random

import pytest
from mercastar.functions.text import blank_missing, fixed_point, thousands, title_case
from mercastar.functions.time import label_of_month_index, month_index
from mercastar.operators.dedup import duplicate_rows, first_per_key
from mercastar.operators import keys, ranking, sampling
from mercastar.operators.keys import bucket_digits, with_dense_key
from mercastar.operators.ranking import global_ntile, global_rank
from mercastar.operators.sampling import exact_sample
from pyspark.sql import Window
from pyspark.sql import functions as F


@pytest.mark.parametrize("count", [1, 3, 5, 7, 12, 1003])
def test_tiles_equal_the_built_in(spark, count):
    chance = random.Random(count)
    rows = [(f"u{i}", chance.choice([1, 1, 1, 2, 3]), chance.random() * 9) for i in range(count)]
    df = spark.createDataFrame(rows, "id string, often int, spent double").withColumn(
        "spent", F.col("spent").cast("decimal(10,2)")
    )
    scores = {"a": ("often", True), "b": ("often", False), "c": ("spent", True)}
    ours = global_ntile(df, "id", scores, 5)
    assert ours.columns == ["id", "often", "spent", "a", "b", "c"]

    def tile(*order):
        return F.ntile(5).over(Window.orderBy(*order, "id"))

    expected = df.withColumns(
        {"a": tile("often"), "b": tile(F.desc("often")), "c": tile("spent")}
    )
    assert sorted(ours.collect()) == sorted(expected.collect())


def test_tiles_move_no_payload(spark):
    df = spark.range(100).select("id", F.col("id").alias("v"), F.lit("x" * 50).alias("payload"))
    plan = global_ntile(df, "id", {"a": ("v", True)}, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_rank_spreads_one_heavy_value(spark):
    """All rows share the first sort column; the second still splits them."""
    df = spark.range(5000).select(F.lit(1).alias("v"), F.col("id"))
    ranked = global_rank(df, ["v", "id"], "position")
    assert ranked.where("position <> id").count() == 0
    assert ranked.agg(F.countDistinct("position")).first()[0] == 5000


def test_dense_keys_have_no_gaps_and_repeat(spark):
    df = spark.range(2000).select(F.concat(F.lit("x"), "id").alias("name"))
    first = {r["name"]: r["k"] for r in with_dense_key(df, "name", "k").collect()}
    assert sorted(first.values()) == list(range(1, 2001))
    again = with_dense_key(df.repartition(5), "name", "k").collect()
    assert {r["name"]: r["k"] for r in again} == first


@pytest.mark.parametrize("digits", [1, 4, 5, 7])
def test_dense_keys_follow_the_digits(spark, digits):
    names = [f"é{n}" for n in range(700)]
    df = spark.createDataFrame([(n, "more") for n in names], "name string, more string")
    keyed = with_dense_key(df, "name", "k", digits)
    assert keyed.columns == ["k", "name", "more"]
    order = sorted(names, key=lambda n: (hashlib.md5(n.encode()).hexdigest()[:digits], n.encode()))
    assert {r["name"]: r["k"] for r in keyed.collect()} == {n: k for k, n in enumerate(order, 1)}
    assert with_dense_key(df.limit(0), "name", "k", digits).count() == 0


def test_dense_keys_of_a_large_table(spark, monkeypatch):
    """More buckets by count; their starts are joined where the rows lie, not broadcast."""
    assert [bucket_digits(n) for n in (0, 1 << 34, (1 << 34) + 1, 10**12)] == [4, 4, 5, 6]
    monkeypatch.setattr(keys, "bucket_digits", lambda rows: 4 if rows < 500 else 6)
    df = spark.range(500).select(F.concat(F.lit("x"), "id").alias("name"), F.lit("y" * 40).alias("payload"))
    lines = with_dense_key(df, "name", "k")._jdf.queryExecution().sparkPlan().toString().splitlines()
    joins = [line for line in lines if "Join" in line]
    assert "SortMergeJoin" in joins[0] and "BroadcastHashJoin" in joins[1] and len(joins) == 2
    plan = with_dense_key(df, "name", "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Range")[0].count("Exchange") == 1  # rows move once; their side comes first
    small = with_dense_key(df.limit(499), "name", "k")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in small


def test_first_per_key_orders_nulls_first(spark):
    rows = [("a", 2, "x"), ("a", None, "z"), ("a", None, "y"), ("b", 1, None), (None, 1, "q")]
    df = spark.createDataFrame(rows, "k string, n int, t string")
    got = sorted(first_per_key(df, ["k"]).collect(), key=str)
    assert [tuple(r) for r in got] == [("a", None, "y"), ("b", 1, None), (None, 1, "q")]
    by_text = {r["k"]: r["t"] for r in first_per_key(df, ["k"], ["t"]).collect()}
    assert by_text["a"] == "x"


def test_first_per_key_of_keys_only(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(r[0] for r in first_per_key(df, ["k"]).collect()) == [1, 2]


def test_duplicate_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (3, 4)], "a int, b int")
    assert tuple(duplicate_rows(df, ["a", "b"]).first()) == (4, 1)
    assert tuple(duplicate_rows(df.limit(0), ["a", "b"]).first()) == (0, 0)


def test_sample_is_exact_and_repeats(spark):
    df = spark.range(1234).select("id", (F.col("id") % 7).cast("string").alias("t"))
    sample = exact_sample(df, 0.2, 42)
    assert sample.count() == round(1234 * 0.2)
    again = exact_sample(df.repartition(3), 0.2, 42)
    assert sorted(sample.collect()) == sorted(again.collect())
    assert exact_sample(df, 1.0, 42).count() == 1234
    assert exact_sample(df, 0.0, 42).count() == 0
    assert exact_sample(df.limit(10), 0.2, 42).count() == 2  # no table is too small
    assert sorted(exact_sample(df, 0.2, 7).collect()) != sorted(sample.collect())


def test_sample_of_copies_is_exact(spark):
    """One row makes up most of the table; its copies are cut, not dropped or kept whole."""
    copies = spark.range(250_000).select(F.lit("same").alias("t"))
    others = spark.range(1000).select(F.col("id").cast("string").alias("t"))
    df = copies.union(others)
    for seed in (1, 2, 3):
        assert exact_sample(df, 0.5, seed).count() == 125_500


def test_sample_of_nothing(spark):
    assert exact_sample(spark.range(0), 0.2, 42).count() == 0


@pytest.mark.parametrize(
    "text",
    [" santa BARBARA d'oeste ", "mogi-guacu", "2nd", "SÃO PAULO", "\tx\n", "", "a.b_c1d"],
)
def test_title_case_follows_python(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(title_case(F.col("t"))).first()
    assert row[0] == text.strip().lower().title()


def test_missing_tokens(spark):
    texts = ["NA", "null", "None", "", "nan", "n/a", "#N/A", "na", "Nada", " NA", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.selectExpr(blank_missing("t")).collect()]
    assert got == [None] * 7 + ["na", "Nada", " NA", None]


def test_number_texts(spark):
    row = spark.range(1).select(
        thousands(F.lit("1234567.50").cast("decimal(12,2)")),
        thousands(F.lit("2.50").cast("decimal(12,2)")),
        fixed_point(F.lit("4.1").cast("decimal(12,4)"), 2),
        fixed_point(F.lit("1.005").cast("decimal(12,4)"), 2),
    ).first()
    assert tuple(row) == ("1,234,568", "3", "4.10", "1.01")


def test_month_arithmetic(spark):
    row = spark.range(1).select(
        month_index(F.lit(2018), F.lit(1)) - month_index(F.lit(2017), F.lit(12)),
        label_of_month_index(month_index(F.lit(2017), F.lit(12))),
        label_of_month_index(month_index(F.lit(2018), F.lit(1))),
    ).first()
    assert tuple(row) == (1, "2017-12", "2018-01")


def built_in_tiles(df, scores, tiles):
    order = {o: F.col(c).asc_nulls_first() if up else F.when(F.col(c).isNotNull(), -F.col(c)).asc_nulls_first() for o, (c, up) in scores.items()}
    return df.withColumns({o: F.ntile(tiles).over(Window.orderBy(by, "id")) for o, by in order.items()})


@pytest.mark.parametrize("ids,few", [("bigint", 7), ("string", 9), ("long prefix", 9), ("short", 1), ("string", 2_000)])
def test_tiles_by_counting(spark, monkeypatch, ids, few):
    """One heavy value, NULLs, negative and wide values, ids of several kinds."""
    monkeypatch.setattr(ranking, "FEW", few)
    monkeypatch.setattr(ranking, "CELLS", 256)
    rng = random.Random(few)
    shown = {
        "bigint": lambda i: i * 7 - 900, "string": lambda i: f"{rng.getrandbits(64):016x}{i}",
        "long prefix": lambda i: f"customer #00000{i:05}", "short": lambda i: "aé😀b"[i % 4] * (i // 4),
    }[ids]
    rows = [
        (shown(i), rng.choice([5, 5, 5, 5, None, i]), rng.choice([None, rng.uniform(-1e6, 1e6), 0.0]), rng.randint(-(10**15), 10**15))
        for i in range(250)
    ]
    kind = "bigint" if ids == "bigint" else "string"
    df = spark.createDataFrame(rows, f"id {kind}, often int, spent double, wide bigint").select(
        "id", "often", F.col("spent").cast("decimal(12,2)").alias("spent"), "wide"
    )
    scores = {"a": ("often", True), "b": ("often", False), "c": ("spent", False), "d": ("wide", True), "e": ("spent", True)}
    assert sorted(map(str, global_ntile(df, "id", scores, 5).collect())) == sorted(map(str, built_in_tiles(df, scores, 5).collect()))


def test_tiles_of_missing_values_only(spark):
    df = spark.range(11).select("id", F.lit(None).cast("int").alias("v"))
    scores = {"a": ("v", True)}
    assert sorted(global_ntile(df, "id", scores, 4).collect()) == sorted(built_in_tiles(df, scores, 4).collect())
    assert global_ntile(df.limit(0), "id", scores, 4).count() == 0


@pytest.mark.parametrize("digits", [1, 3])
def test_sample_is_the_least_digests(spark, monkeypatch, digits):
    monkeypatch.setattr(sampling, "DIGITS", digits)
    df = spark.range(3000).select((F.col("id") % 900).alias("id"), F.when(F.col("id") % 3 > 0, "x").alias("t"))
    for seed in range(4):
        text = F.concat_ws("\u0001", F.lit(str(seed)), F.col("id").cast("string"), F.coalesce("t", F.lit("\u0000")))
        want = df.orderBy(F.md5(text.cast("binary"))).limit(1111)
        assert sorted(map(str, exact_sample(df, 1111 / 3000, seed).collect())) == sorted(map(str, want.collect()))


def test_sample_plan_sorts_and_windows_no_rows(spark):
    plan = exact_sample(spark.range(5000), 0.3, 1)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan and "Sort" not in plan
