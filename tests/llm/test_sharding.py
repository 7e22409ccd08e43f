from __future__ import annotations

from collections import Counter

import pytest

from mercastar.llm.sharding import interleave


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, shard string, `a.b` int")


def test_counts_and_mixture(spark):
    rows = [(i, "big" if i % 3 else f"s{i % 4}", "old", i) for i in range(1003)]
    out = interleave(rows_of(spark, rows), "doc_id", "source", 16).collect()
    assert len(out) == len(rows) and {r.doc_id for r in out} == set(range(1003))
    sizes = Counter(r.shard for r in out)
    assert sorted(sizes) == list(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(16):
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sizes[shard]))
    totals = Counter(r[1] for r in rows)
    for source, total in totals.items():
        held = Counter(r.shard for r in out if r.source == source)
        assert all(abs(held[s] - total / 16) <= 2 for s in range(16))


def test_order_repeats(spark):
    rows = [(i, str(i % 5), None, 0) for i in range(200)]
    first = interleave(rows_of(spark, rows), "doc_id", "source", 7).collect()
    again = interleave(rows_of(spark, rows[::-1]).repartition(5), "doc_id", "source", 7).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in first} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_nulls_repeated_rows_and_clashing_names(spark):
    rows = [(None, None, "x", None)] * 5 + [(1, None, "x", 1)] * 5 + [(2, "s", "x", 2)]
    out = interleave(rows_of(spark, rows), "doc_id", "source", 2).collect()
    assert len(out) == 11 and set(Counter(r.shard for r in out).values()) == {5, 6}
    assert set(out[0].asDict()) == {"doc_id", "source", "a.b", "shard", "slot"}


def test_empty_and_fewer_rows_than_shards(spark):
    assert interleave(rows_of(spark, []), "doc_id", "source").collect() == []
    out = interleave(rows_of(spark, [(1, "a", "", 0), (2, "b", "", 0)]), "doc_id", "source", 16).collect()
    assert len({r.shard for r in out}) == 2 and {r.slot for r in out} == {0}
    with pytest.raises(ValueError):
        interleave(rows_of(spark, []), "doc_id", "source", 0)
