"""Nearest neighbours by inner product on robust-pruned directed graphs, one for each shard."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercastar.llm.columns import quoted
from mercastar.storage import durable

# A shard holds the rows / SPREAD, within these bounds. Every shard is asked every query, so
# shards must not be many: they grow with the table, up to a size whose graph still finds
# nearly all neighbours with these beams (0.98 of 20 at 16,384 vectors, 0.92 at 51,282).
SHARD_VECTORS = 4096
MOST_VECTORS = 16384
SPREAD = 64
# A graph goes to each block of queries, so blocks grow with the queries in the same way.
BLOCK_QUERIES = 2048
MOST_QUERIES = 16384
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
ALPHA = 1.2
EXPANDED = 4  # nodes a search expands at once
BATCH = 256

INDEX_SCHEMA = "dim int, shard int, vectors binary, edges binary, entry int, ids array<array<bigint>>"


@dataclass
class Graph:
    """Points lifted so that L2 order from a lifted query is inner-product order."""

    points: np.ndarray
    edges: np.ndarray  # (n, DEGREE), -1 where there is none
    entry: int

    @staticmethod
    def lifted(vectors: np.ndarray) -> np.ndarray:
        square = np.einsum("ij,ij->i", vectors, vectors)
        last = np.sqrt(np.maximum(square.max() - square, 0))
        return np.concatenate([vectors, last[:, None]], axis=1).astype(np.float32)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Greedy beam search of all queries in step.

        Returns the beams (ids, nearest first, -1 where empty) and their squared
        distances up to a constant of the query.
        """
        m, n = len(queries), len(self.points)
        norms = np.einsum("ij,ij->i", self.points, self.points)
        ids = np.full((m, beam), -1, np.int64)
        far = np.full((m, beam), np.inf, np.float32)
        done = np.ones((m, beam), bool)
        seen = np.zeros((m, n + 1), bool)  # the last column takes the missing edges
        seen[:, n] = True
        ids[:, 0], done[:, 0], seen[:, self.entry] = self.entry, False, True
        far[:, 0] = norms[self.entry] - 2 * queries @ self.points[self.entry]
        line = np.arange(m)[:, None]
        while True:
            rank = np.cumsum(~done, axis=1)
            pick = ~done & (rank <= EXPANDED)
            active = np.flatnonzero(pick.any(axis=1))
            if not len(active):
                return ids, far
            # The chosen beam places, padded with a node that has no edges.
            chosen = np.full((len(active), EXPANDED), -1, np.int64)
            r, c = np.nonzero(pick[active])
            chosen[r, rank[active][r, c] - 1] = ids[active][r, c]
            done[pick] = True
            new = np.where(chosen[:, :, None] >= 0, self.edges[chosen], -1).reshape(len(active), -1)
            new = np.where(new < 0, n, new)
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = n
            rows = line[: len(active)]
            new[seen[active[:, None], new]] = n
            seen[active[:, None], new] = True
            safe = np.minimum(new, n - 1)
            away = norms[safe] - 2 * np.einsum("mkd,md->mk", self.points[safe], queries[active])
            away = np.where(new < n, away, np.inf).astype(np.float32)
            all_ids = np.concatenate([ids[active], np.where(new < n, new, -1)], axis=1)
            all_far = np.concatenate([far[active], away], axis=1)
            all_done = np.concatenate([done[active], new >= n], axis=1)
            best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            ids[active], far[active], done[active] = all_ids[rows, best], all_far[rows, best], all_done[rows, best]

    def prune(self, at: np.ndarray, candidates: np.ndarray, alpha: float) -> None:
        """Give the points `at` diverse out-edges from `candidates` (-1: none).

        The nearest candidate is kept, and it drops every candidate that is nearer to
        it, by the factor alpha, than to the point; and so on up to DEGREE edges.
        """
        candidates = np.sort(candidates, axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        candidates[candidates == at[:, None]] = -1
        there = self.points[np.maximum(candidates, 0)]
        gap = there - self.points[at][:, None, :]
        own = np.einsum("mkd,mkd->mk", gap, gap)
        own[candidates < 0] = np.inf
        product = there @ there.transpose(0, 2, 1)
        square = np.einsum("mkk->mk", product)
        between = square[:, :, None] + square[:, None, :] - 2 * product
        edges = np.full((len(at), DEGREE), -1, self.edges.dtype)
        rows = np.arange(len(at))
        left = own.copy()
        for place in range(DEGREE):
            best = left.argmin(axis=1)
            some = np.isfinite(left[rows, best])
            if not some.any():
                break
            edges[some, place] = candidates[rows, best][some]
            drop = alpha * alpha * between[rows, best] <= own
            left[drop] = np.inf
            left[rows, best] = np.inf
        self.edges[at] = edges

    def link_back(self, at: np.ndarray, alpha: float) -> None:
        """Offer each point of `at` to the points it leads to."""
        source = np.repeat(at, DEGREE)
        target = self.edges[at].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        while len(target):
            starts = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
            place = np.arange(len(target)) - np.repeat(starts, np.diff(np.r_[starts, len(target)]))
            now = place < DEGREE  # further offers wait for the next round
            points = target[starts]
            offered = np.full((len(points), DEGREE), -1, np.int64)
            offered[np.searchsorted(points, target[now]), place[now]] = source[now]
            for low in range(0, len(points), BATCH):
                some = points[low : low + BATCH]
                self.prune(some, np.concatenate([self.edges[some], offered[low : low + BATCH]], axis=1), alpha)
            source, target = source[~now], target[~now]

    @classmethod
    def built(cls, vectors: np.ndarray, seed: int = 7) -> Graph:
        points = cls.lifted(vectors)
        n = len(points)
        rng = np.random.default_rng(seed)
        edges = np.full((n, DEGREE), -1, np.int32)
        if n > 1:
            random = rng.integers(0, n - 1, (n, min(DEGREE // 2, n - 1)))
            edges[:, : random.shape[1]] = random + (random >= np.arange(n)[:, None])
        middle = points - points.mean(axis=0)
        graph = cls(points, edges, int(np.einsum("ij,ij->i", middle, middle).argmin()))
        for alpha in (1.0, ALPHA):
            order = rng.permutation(n)
            for low in range(0, n, BATCH):
                at = order[low : low + BATCH]
                beams, _ = graph.search(points[at], BUILD_BEAM)
                graph.prune(at, np.concatenate([beams, graph.edges[at]], axis=1), alpha)
                graph.link_back(at, alpha)
        return graph


def _build(group: pa.Table) -> pa.Table:
    dim, shard = group.column("dim")[0].as_py(), group.column("shard")[0].as_py()
    flat = group.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.astype(np.float32).reshape(-1, dim)
    order = np.lexsort(vectors.T)  # the graph does not depend on the order of the rows
    graph = Graph.built(vectors[order])
    ids = group.column("ids").combine_chunks().take(pa.array(order))
    return pa.table(
        {
            "dim": pa.array([dim], pa.int32()),
            "shard": pa.array([shard], pa.int32()),
            "vectors": pa.array([vectors[order].tobytes()], pa.binary()),
            "edges": pa.array([graph.edges.tobytes()], pa.binary()),
            "entry": pa.array([graph.entry], pa.int32()),
            "ids": pa.array([ids.to_pylist()], pa.list_(pa.list_(pa.int64()))),
        }
    )


def _searcher(k: int, beam: int):
    def search(queries: pa.Table, index: pa.Table) -> pa.Table:
        query_id: list[int] = []
        vec_id: list[int] = []
        score: list[float] = []
        if queries.num_rows and index.num_rows:
            row = index.slice(0, 1).to_pylist()[0]
            vectors = np.frombuffer(row["vectors"], np.float32).reshape(-1, row["dim"])
            edges = np.frombuffer(row["edges"], np.int32).reshape(-1, DEGREE)
            graph = Graph(Graph.lifted(vectors), edges, row["entry"])
            names = queries.column("query_id").to_numpy()
            flat = queries.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            wanted = flat.astype(np.float32).reshape(-1, row["dim"])
            exact = vectors.astype(np.float64)
            for low in range(0, len(wanted), BATCH):
                some = wanted[low : low + BATCH]
                lifted = np.concatenate([some, np.zeros((len(some), 1), np.float32)], axis=1)
                beams, _ = graph.search(lifted, beam)
                scores = (some.astype(np.float64)[:, None, :] * exact[np.maximum(beams, 0)]).sum(axis=2)
                scores[beams < 0] = -np.inf
                best = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1]
                for i, name in enumerate(names[low : low + BATCH].tolist()):
                    found = [
                        (-scores[i, j], v)
                        for j in best[i]
                        if beams[i, j] >= 0
                        for v in row["ids"][beams[i, j]]
                        if v != name
                    ]
                    for minus, v in sorted(found)[:k]:
                        query_id.append(name)
                        vec_id.append(v)
                        score.append(-minus)
        return pa.table(
            {
                "query_id": pa.array(query_id, pa.int64()),
                "vec_id": pa.array(vec_id, pa.int64()),
                "score": pa.array(score, pa.float64()),
            }
        )

    return search


def usable(df: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """`(vec_id, embedding, dim)` of the vectors that take part.

    Left out: NULL keys, NULL or empty vectors, vectors with NULL or non-finite
    components, and zero vectors.
    """
    rows = df.select(F.col(quoted(key)).alias("vec_id"), F.col(quoted(embedding)).cast("array<float>").alias("embedding"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(
        F.col("vec_id").isNotNull() & sound & F.exists("embedding", lambda x: x != 0)
    ).withColumn("dim", F.size("embedding"))


def _share(rows: int, least: int, most: int) -> int:
    """Rows of one shard or block: a fixed share of all, within bounds."""
    return max(least, min(most, rows // SPREAD))


def build_index(vectors: DataFrame, k: int) -> DataFrame:
    """Index every usable vector: one row for each shard.

    Shards hold a 64th of the vectors of their length, 4,096 at least and 16,384 at most, and
    each is built by a task of its own. An empty table gives an empty index. Only the columns
    that `usable` makes are read, so no other column can clash.

    Equal vectors become one node that lists its k + 1 least ids: enough to answer
    any query, since ties go to smaller ids. The window that finds them keeps k + 1
    rows of a vector in each task before the shuffle, so a vector that many rows share
    does not meet in one task. Nodes are dealt to shards by a hash of the vector.
    """
    least = Window.partitionBy("embedding").orderBy("vec_id")
    rows = vectors.distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
    nodes = durable(
        rows.groupBy("dim", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    rows = F.count(F.lit(1))
    held = F.greatest(F.lit(SHARD_VECTORS), F.least(F.lit(MOST_VECTORS), F.floor(rows / SPREAD)))
    sizes = durable(nodes.groupBy("dim").agg(F.ceil(rows / held).cast("int").alias("shards")))
    dealt = nodes.join(sizes, "dim").withColumn(
        "shard", F.pmod(F.xxhash64("embedding"), F.col("shards")).cast("int")
    )
    # Shards are small and costly. Partitions merged by their size would build them one after
    # another, and so would hashes of few keys that meet; ranges of the keys give each its own.
    shards = sizes.agg(F.sum("shards")).first()[0] or 1
    graphs = dealt.select("dim", "shard", "embedding", "ids")
    graphs = graphs.repartitionByRange(2 * shards, "dim", "shard")
    return durable(graphs.groupBy("dim", "shard").applyInArrow(_build, INDEX_SCHEMA))


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """The k nearest indexed vectors of each query, by largest inner product.

    `queries` are usable vectors; of several with one id the least counts. Blocks of queries are searched in every shard of
    their dimension; a shard hands on at most k results of a query. Returns
    `query_id, rank, vec_id, score`, nearest first, ties to smaller ids; the query's
    own id is no result. No queries, an empty index or no indexed vector of the query's
    length give no rows. Columns of `queries` beside `vec_id` and `embedding` are not read.
    """
    queries = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    queries = queries.withColumn("dim", F.size("embedding"))
    count = queries.count()
    blocks = max(1, math.ceil(count / _share(count, BLOCK_QUERIES, MOST_QUERIES)))
    asked = queries.select(
        F.col("vec_id").alias("query_id"),
        "embedding",
        "dim",
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
    )
    shards = index.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    asked = asked.join(shards, "dim").select(
        "query_id", "embedding", "dim", "block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    )
    offered = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ("dim", "shard", "block")
    found = asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(
        _searcher(k, beam), "query_id bigint, vec_id bigint, score double"
    )
    nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
