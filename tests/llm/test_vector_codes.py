from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from mercastar.llm import vector_codes as V


def brute(rows, parts=4, entries=256, rounds=4):
    """Plain rescans in Python numbers: {(key, label): (code, error)} and the digest."""
    good = [(k, [math.floor(1024 * np.float32(c).item()) for c in v], lab) for k, v, lab in rows]
    width = len(good[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        sums = defaultdict(list)
        for _, v, _ in good:
            for p in range(parts):
                sums[p, nearest(v, p)[1]].append(cut(v, p))
        for (p, i), members in sums.items():
            books[p][i] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out = []
    for k, v, lab in good:
        near = [nearest(v, p) for p in range(parts)]
        out.append((k, "".join(f"{i:02x}" for _, i in near), sum(d for d, _ in near), lab))
    numbers = ",".join(str(c) for b in books for e in b for c in e)
    return out, hashlib.sha256(numbers.encode()).hexdigest()


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def compare(spark, rows, **more):
    want, digest = brute([r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])], **more)
    got = V.compress(table(spark, rows), **more).collect()
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.vec_id, r.code, r.error, r.label) for r in got), key=order) == sorted(want, key=order)
    assert {r.codebooks_sha256 for r in got} == {digest}
    by_label = defaultdict(int)
    for r in got:
        by_label[r.label] += r.error
    assert all(r.label_error == by_label[r.label] for r in got)


def test_equals_plain_rescans(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), int(i % 3) if i % 5 else None) for i in range(600)]
    compare(spark, rows, entries=16)
    compare(spark, rows[:40])


def test_ties_repeated_rows_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    # Whole steps of 1/1024 on a coarse grid make many equal distances.
    grid = [(i, (rng.integers(-3, 4, size=4) / 512).tolist(), 1) for i in range(300)]
    rows = grid + grid[:20] + [(None, [0.5] * 4, None), (1, [0.25] * 4, 2), (7, None, 1)]
    rows += [(8, [1.0, None, 0.0, 0.0], 1), (9, [math.nan] * 4, 1), (10, [math.inf, 0.0, 0.0, 0.0], 1)]
    compare(spark, rows, entries=32)


def test_net_bounds_spare_comparisons_and_stay_true():
    rng = np.random.default_rng(5)
    centres = rng.integers(-2000, 2000, size=(64, 6))
    x = (centres[rng.integers(0, 64, size=4000)] + rng.integers(-60, 60, size=(4000, 6))).astype(np.int64)
    books = V.Codebooks(1)
    books.biggest[6] = int(abs(x).max())
    books.books[6] = [x[:64].reshape(1, 64, 6).copy()]
    state = np.zeros(len(x), V.layout(1))
    spared = []
    for now in range(6):
        history = V.PartHistory([b[0] for b in books.books[6]], books.biggest[6])
        mine = x.astype(history.kind)
        best = history.again(mine, state, 0) if now else history.first(mine, state, 0)
        entries = books.books[6][-1][0]
        plain = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (state["entry"][:, 0] == plain.argmin(axis=1)).all() and (best == plain.min(axis=1)).all()
        # Every bound, moved by the net displacement, is below the true distance.
        for g in range(V.GROUPS):
            lo, hi = history.edges[g], history.edges[g + 1]
            others = plain[:, lo:hi].astype(float).copy()
            own = state["entry"][:, 0].astype(int)
            inside = (own >= lo) & (own < hi)
            others[inside, own[inside] - lo] = np.inf
            stamp = state["stamp"][:, 0, g].astype(int)
            moved = np.where(stamp < now, np.r_[history.most[:, g], 0][np.minimum(stamp, now)], 0)
            assert (state["low"][:, 0, g] - moved <= np.sqrt(others.min(axis=1)) + 1e-6).all()
        spared.append(1 - history.compared / (len(x) * 64))
        means = entries.copy()
        for e in range(64):
            if (own == e).any():
                means[e] = x[own == e].sum(axis=0) // (own == e).sum()
        books.books[6].append(means[None])
    assert spared[-1] > 0.5


def test_large_numbers_take_whole_number_arithmetic(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=4) * 1e5).astype(np.float32).tolist(), 0) for i in range(60)]
    compare(spark, rows, entries=8)
    with pytest.raises(ValueError, match="no long"):
        V.compress(table(spark, [(1, [1e30] * 4, 0)])).collect()


def test_lengths_clashing_names_and_empty_tables(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0, 5.0], 1, "a"), (2, [], 1, "b"), (3, [1.0, 2.0, 3.0, 4.0, 5.0], None, "c")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, code string")
    df = df.selectExpr("vec_id", "embedding", "label", "code", "1 AS _x", "2 AS _mx_row", "3 AS `a.b`")
    out = {r.vec_id: r for r in V.compress(df).collect()}
    assert out[2].code == "00000000" and out[2].error == 0 and out[2]["a.b"] == 3 and out[2]["_x"] == 1
    assert out[1].code == out[3].code == "00000000" and out[1].error == 0
    assert out[1].codebooks_sha256 != out[2].codebooks_sha256
    empty = V.compress(df.where("vec_id < 0"))
    assert empty.count() == 0 and set(V.RESULTS) <= set(empty.columns)
