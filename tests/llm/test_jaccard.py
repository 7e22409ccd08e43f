from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from mercastar.llm import jaccard as J
from mercastar.llm.components import components
from mercastar.llm.shingles import Shingles, shingles
from mercastar.llm.text_arrays import slices


def shingle_set(text):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((k, len(s), least.get(find(i), k)) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.link_documents(docs).collect()), key=str)
    assert out == brute(rows)
    return out


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_near_copies_of_all_sizes(spark, words):
    rng = random.Random(1)
    texts = [None, "", " \t", "a", "A", "a b", "a b c d", "a b c d e", "a b c d e f"]
    for n in (6, 8, 9, 12, 15, 20, 30, 60, 200, 900):
        for _ in range(4):
            base = words(n)
            texts += [base, base.upper(), base + " tail", "  " + base.replace(" ", "\n ")]
            texts += [edited(rng, base, e) for e in (1, 1, 2, 3, max(1, n // 60), n // 30)]
            texts += [" ".join(base.split()[: int(n * f)]) for f in (0.75, 0.8, 0.85, 0.9, 0.95)]
    rng.shuffle(texts)
    out = check(spark, [(i * 3 + 1, t) for i, t in enumerate(texts)])
    assert sum(k != c for k, _, c in out) > 100


def test_chains_join_what_is_not_similar_itself(spark, words):
    w = words(400).split()
    check(spark, [(9 - i, " ".join(w[i * 20 : i * 20 + 300])) for i in range(6)])


def test_shared_passage_links_nothing(spark, words):
    passage = words(40)
    out = check(spark, [(i, passage + " " + words(30)) for i in range(60)] + [(99, passage)])
    assert all(k == c for k, _, c in out)


def test_many_near_copies_of_one_text(spark, words):
    rng = random.Random(2)
    base = words(60)
    check(spark, [(i, edited(rng, base, rng.randrange(5))) for i in range(150)])


def test_nulls_repeated_rows_extra_columns_empty(spark, words):
    a, b = words(30), words(30)
    check(spark, [(None, a), (None, a), (5, a), (7, a), (7, a), (None, b), (None, b), (None, None)])
    docs = spark.createDataFrame([(1, a, 2, 3)], "doc_id bigint, text string, class bigint, component_id bigint")
    assert J.link_documents(docs).first().asDict() == {"doc_id": 1, "n_shingles": 26, "component_id": 1}
    assert J.link_documents(docs.where("doc_id < 0")).collect() == []


def test_linked_sets_share_a_signature():
    """Straight from the sets, concentrated ones included."""
    rng = np.random.default_rng(4)
    for _ in range(3000):
        size = int(rng.integers(4, 40))
        a = rng.integers(0, 1 << 63, size).astype(np.uint64)
        keep = rng.permutation(size)[: size - rng.integers(0, 1 + size // 5)]
        b = np.concatenate([a[keep], rng.integers(0, 1 << 63, rng.integers(0, 1 + size // 6)).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        common = len(np.intersect1d(a, b))
        if np.array_equal(a, b) or 5 * common < 4 * (len(a) + len(b) - common):
            continue
        kept = []
        for x in (a, b):
            _, signature, spare = J.signatures(Shingles(x, np.array([0, len(x)])), np.array([0]))
            kept.append(set(signature.tolist()))
            assert (spare >= 0).all()
        assert kept[0] & kept[1]


def test_few_partitions_fall_back(monkeypatch):
    """With one seed, concentrated sets still meet in the last signature."""
    monkeypatch.setattr(J, "SEEDS", 1)
    test_linked_sets_share_a_signature()


@pytest.mark.parametrize("seed", range(3))
def test_shared_signatures_over_batches(seed):
    rng = random.Random(seed)
    rows = sorted((rng.randrange(40), rng.randrange(6), 0) for _ in range(300))
    batches, at = [], 0
    while at < len(rows):
        n = rng.randint(0, 7)
        cols = list(zip(*rows[at : at + n], strict=True)) or [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int32())
        batches.append(pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["sig", "class", "spare"]))
        at += n
    out = [tuple(r.values()) for b in J._shared(iter(batches)) for r in b.to_pylist()]
    groups = {}
    for s, c, _ in rows:
        groups.setdefault(s, set()).add(c)
    assert sorted(out) == sorted((s, c, 0) for s, cs in groups.items() if len(cs) > 1 for c in cs)


def test_shingles_do_not_depend_on_slices(words):
    texts = [words(n) for n in (3, 50, 7, 200, 1)] + ["", "x y z"]
    one = shingles(next(slices(pa.array(texts))))
    many = [shingles(p) for p in slices(pa.array(texts), 40)]
    assert one.names().tolist() == [n for p in many for n in p.names().tolist()]


def test_signatures_of_a_large_batch_take_little_memory(words):
    text = words(400)
    batch = pa.RecordBatch.from_arrays([pa.array([f"{i} {text}" for i in range(1500)])], ["text"])
    assert batch.nbytes > 3_000_000
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in J._emit_signatures(iter([batch]))) > 0
        assert tracemalloc.get_traced_memory()[1] < 25_000_000
    finally:
        tracemalloc.stop()


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    out = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert out == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
