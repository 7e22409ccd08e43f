from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from mercastar.llm import repeats as R
from mercastar.llm.run_index import RunLengthIndex

L = R.LENGTH


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - L + 1):
            seen[b[i : i + L]] = seen.get(b[i : i + L], 0) + 1
    out = []
    for b in raw:
        mark = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - L + 1):
            if seen[b[i : i + L]] > 1:
                mark[i + 1 : i + 1 + L] = True
        kept = bytes(c for c, m in zip(b, mark[1:-1], strict=True) if not m)
        out.append((len(b), int(mark.sum()), int((mark[1:] & ~mark[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept))
    return out


def check(documents, texts):
    out = R.remove_repeats(documents(*texts)).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in out] == brute(texts)
    return out


def corpus(words):
    rng = random.Random(8)
    passages = [words(120), words(70) + "é" * 60, words(200)]
    texts = [None, "", "short", words(300), "x" * 1500, "ab" * 500, "x" * (L - 1), "x" * L]
    for _ in range(12):
        texts.append(words(rng.randint(0, 40)) + rng.choice(passages) + words(rng.randint(0, 60)))
    for p in passages:
        cut = rng.randint(1, 60)
        texts += [p, p[cut:] + words(20), words(10) + p[:-cut]]
    texts.append(passages[0] + words(30) + passages[2])
    return texts + [texts[3], passages[0] + passages[0], texts[8], texts[8]]


def test_against_brute_force(documents, words):
    out = check(documents, corpus(words))
    assert any(r.n_spans > 1 for r in out)


def test_split_of_hot_anchors_gives_the_same(documents, words, monkeypatch):
    monkeypatch.setattr(R, "HOT_CONTEXTS", 1)
    check(documents, corpus(words))


def test_small_shards_give_the_same(documents, words, monkeypatch):
    monkeypatch.setattr(R, "SHARD_BYTES", 2000)
    check(documents, corpus(words))


def test_length_is_exact(documents, words):
    shared = words(400)[:L]
    check(documents, [words(30) + "|" + shared + "|" + words(30), words(30) + "!" + shared + "?" + words(9)])
    check(documents, [words(30) + "|" + shared[1:] + "|" + words(30), words(30) + "!" + shared[1:] + "?" + words(9)])
    check(documents, [shared + "z" + shared, shared[:200], "y" + shared])


def test_no_repeats_and_empty(documents, words):
    check(documents, [words(100), words(100)])
    docs = documents("x", digest="clash", kept="clash")
    assert R.remove_repeats(docs.where("doc_id < 0")).collect() == []
    assert R.remove_repeats(docs).first().kept == b"x"


@pytest.mark.parametrize("seed", range(8))
def test_index_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(97, 97 + rng.integers(1, 4), rng.integers(0, 14)).astype(np.uint8) for _ in range(5)]
    index = RunLengthIndex(texts)
    assert index.lengths.sum() == len(index.text)
    matches = index.matches()
    for a, (start, t) in enumerate(zip(index.starts, texts, strict=True)):
        for i in range(len(t)):
            best = 0
            for b, u in enumerate(texts):
                for j in range(len(u)):
                    n = 0
                    while (a, i) != (b, j) and i + n < len(t) and j + n < len(u) and t[i + n] == u[j + n]:
                        n += 1
                    best = max(best, n)
            assert matches[start + i] == best
