from __future__ import annotations

import numpy as np

from mercastar.llm import neighbours as N


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string")


def find(spark, rows, k, asked=None):
    vectors = N.usable(vectors_of(spark, rows))
    index = N.build_index(vectors, k)
    queries = vectors if asked is None else vectors.where(vectors["vec_id"].isin(asked))
    found = {}
    for r in N.search(index, queries, k).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return found


def brute(rows, query, k):
    x = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows}
    near = sorted((-float(x[query] @ v), i) for i, v in x.items() if i != query and len(v) == len(x[query]))
    return [(n, i, -s) for n, (s, i) in enumerate(near[:k], 1)]


def test_recall_of_several_shards(spark, small, monkeypatch):
    monkeypatch.setattr(N, "SHARD_VECTORS", 100)
    rows = [(r.vec_id, r.embedding, None) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    asked = [r[0] for r in rows if r[0] % 20 == 0]
    found = find(spark, rows, 20, asked)
    hits = 0
    for q in asked:
        want, got = brute(rows, q, 20), found[q]
        assert [g[0] for g in got] == list(range(1, 21))
        hits += len({w[1] for w in want} & {g[1] for g in got})
        assert [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)
    assert hits / (20 * len(asked)) >= 0.9


def test_shards_and_blocks_grow_with_the_table(spark, small, monkeypatch):
    assert [N._share(n, 4096, 16384) for n in (0, 51_282, 640_000, 10**8)] == [4096, 4096, 10_000, 16384]
    for name, value in (("SHARD_VECTORS", 10), ("MOST_VECTORS", 100), ("SPREAD", 4), ("BLOCK_QUERIES", 7)):
        monkeypatch.setattr(N, name, value)
    vectors = N.usable(spark.read.parquet(f"{small}/embeddings.parquet"))
    index = N.build_index(vectors, 20)
    n = vectors.select("dim", "embedding").distinct().count()
    assert index.count() <= -(-n // N._share(n, 10, 100)) and n >= 100
    assert index.selectExpr("sum(size(ids))").first()[0] == n
    found = N.search(index, vectors, 3)
    assert found.count() == 3 * vectors.select("vec_id").distinct().count()


def test_lengths_count(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 5)).tolist(), None) for i in range(300)]
    found = find(spark, rows, 5)
    same = [len({w[1] for w in brute(rows, q, 5)} & {g[1] for g in found[q]}) for q in range(300)]
    assert np.mean(same) / 5 >= 0.9


def test_ties_copies_and_own_id(spark):
    rows = [(i, [1.0, 0.0], None) for i in range(50)] + [(i, [0.5, 0.5], None) for i in range(50, 60)]
    found = find(spark, rows, 20, [0, 30, 55])
    for q in (0, 30, 55):
        assert [(r, v) for r, v, _ in found[q]] == [(r, v) for r, v, _ in brute(rows, q, 20)]


def test_unusable_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None, None), (1, [], None), (2, [0.0, 0.0], None), (3, [1.0, None], None), (4, [nan, 1.0], None)]
    rows += [(5, [inf, 1.0], None), (None, [1.0, 1.0], None), (6, [1.0, 2.0], "x"), (6, [1.0, 2.0], "x"), (7, [3.0, 1.0], None)]
    rows += [(8, [1.0, 1.0, 1.0], None)]
    found = find(spark, rows, 3)
    assert {q: [v for _, v, _ in got] for q, got in found.items()} == {6: [7], 7: [6]}
    assert find(spark, [], 3) == {}
