from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from mercastar.llm import prefix_trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild=True):
    """A trie of Python dictionaries over whole texts."""
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            told[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in told.items()}
    whole = {}
    for c, turns in own.items():
        if not rebuild:
            whole[c] = turns
            continue
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    leaves, saved, children = defaultdict(int), defaultdict(int), defaultdict(set)
    for path, convs in members.items():
        is_leaf = all(len(whole[c]) == len(path) for c in convs)
        cost = (len(convs) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += is_leaf
            saved[path[:d]] += cost
        if path:
            children[path[:-1]].add(path)
    return {
        (
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children[path]),
            leaves[path], saved[path],
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(path)).encode()).hexdigest(),
        )
        for path, convs in members.items()
    }


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")


def trie(spark, rows, **more):
    out = T.conversation_trie(table(spark, rows), **more)
    assert out.columns == COLUMNS
    found = [tuple(r) for r in out.collect()]
    assert len(set(found)) == len(found)
    return set(found)


def sample(seed, n, longest, kinds=2):
    rng = random.Random(seed)
    return [
        (rng.choice([0, 100, -100]) + c, t, rng.choice(["user", "assistant"][:kinds]), "x" * rng.randint(0, 2))
        for c in range(n)
        for t in range(rng.randint(1, longest))
    ]


def test_equals_plain_trie(spark):
    rows = sample(1, 60, 7)
    assert trie(spark, rows) == brute(rows)


@pytest.mark.parametrize("band", [2, 3])
def test_deep_tries_go_up_in_several_rounds(spark, monkeypatch, band):
    monkeypatch.setattr(T, "BAND", band)
    rows = sample(2, 12, 30, kinds=1)
    shared = [(c, t, "user", "same") for c in (500, 501, 502, 503) for t in range(20 + c % 3)]
    assert trie(spark, rows + shared) == brute(rows + shared)


def test_one_long_conversation(spark):
    rows = [(7, t, "user", str(t % 5)) for t in range(300)] + [(8, t, "user", str(t % 5)) for t in range(290)]
    assert trie(spark, rows, block=None) == brute(rows, rebuild=False)


def test_many_equal_conversations_end_at_one_node(spark):
    rows = [(c, 0, "user", "a") for c in range(-3000, 12_000)]
    assert trie(spark, rows, block=None) == brute(rows, rebuild=False)


def test_nulls_ties_repeated_rows_and_absent_bases(spark):
    rows = [(None, 0, "user", "lost"), (101, None, None, None), (101, 0, "user", "b"), (101, 0, "user", "a")]
    rows += [(101, 0, "user", "a"), (202, 5, "user", "é" * 9), (-3, 1, "user", "q"), (0, None, "", "x"), (0, 1, "u", "😀")]
    rows += [(4, t, None, "") for t in range(9)] + [(100, 0, "user", "long " * 50_000)]
    assert trie(spark, rows) == brute(rows)


def test_empty_table_and_other_columns(spark):
    rows = sample(3, 9, 4)
    df = table(spark, rows).selectExpr("*", "1 AS depth", "2 AS f1", "3 AS `a.b`", "4 AS rank")
    assert {tuple(r) for r in T.conversation_trie(df).collect()} == brute(rows)
    assert T.conversation_trie(df.where("conv_id IS NULL")).count() == 0
