from __future__ import annotations

import random
import re
from collections import Counter

from mercastar.llm import licenses as L

EVERY = (*L.BASE, *L.TEMPLATES)


def brute(texts):
    """Every template at every place, by the words alone."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower)) for t in texts]
    counts = Counter(w for d in docs for w in set(d))
    out = []
    for words in docs:
        met = []
        for t in EVERY:
            rare = sorted(set(t.words) & set(words), key=lambda w: (counts[w], w))[: t.looked_up]
            for start in range(-len(t.words), len(words)):
                at = lambda k: words[start + k] if 0 <= start + k < len(words) else None  # noqa: E731, B023
                votes = sum(w in rare and at(k) == w for k, w in enumerate(t.words))
                if votes >= t.agreeing and all(at(k) == t.words[k] for k in t.key_places):
                    met.append((t, start, sum(at(k) == w for k, w in enumerate(t.words)) / len(t.words)))
        base = [start for t, start, _ in met if t in L.BASE]
        names = lambda of: ",".join(sorted({t.label for t, _, _ in met if t in of}))  # noqa: E731, B023
        out.append(
            (len(words), len(base), min(base, default=None), max(base, default=None), names(L.BASE), names(EVERY),
             max((s for _, _, s in met), default=0.0))
        )
    return out


def scanned(df):
    return [tuple(r[c] for c in L.RESULTS) for r in L.scan_licenses(df).orderBy("doc_id").collect()]


def test_equals_every_place_of_every_template(spark, documents):
    rng = random.Random(2)
    stock = [w for t in EVERY for w in t.words]
    texts = []
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(0, 6)):
            words = list(rng.choice(EVERY).words)
            if rng.random() < 0.5:
                words = words[rng.randint(0, 3) : len(words) - rng.randint(0, 3)]
            if rng.random() < 0.3 and words:
                words[rng.randrange(len(words))] = rng.choice(stock)
            parts += words + rng.choices([*stock, "Ünter", "x", "12"], k=rng.randint(0, 5))
        texts.append(rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < 0.3 else w for w in parts))
    assert scanned(documents(*texts)) == brute(texts)


def test_words_places_and_case(spark, documents):
    texts = [
        "CC-BY cc by. All\nRights/reserved",
        "cc éby; all rights reservedé",  # other letters belong to words
        "aKc cc by",  # the Kelvin sign is not a k
        "general public licenİse, Iİ",
        "All rights reserved all rights reserved all rights all rights reserved",
    ]
    out = scanned(documents(*texts))
    assert out == brute(texts)
    assert out[0][:5] == (7, 3, 0, 4, "cc-by,reserved") and out[4][1:4] == (3, 0, 8)


def test_mandatory_phrases_decide(spark, documents):
    mit = next(t for t in L.TEMPLATES if t.label == "mit" and len(t.words) > 9)
    whole, cut = mit.text, mit.text.replace("free of charge", "free of costs")
    rows = {r.doc_id: r for r in L.scan_licenses(documents(f"x y {whole}", cut, whole[:60])).collect()}
    assert rows[0].labels == "mit" and rows[0].score == 1.0 and rows[0].license_starts == [("mit", 2)]
    assert rows[1].labels == "" and rows[1].score == 0.0 and rows[1].n_base == 0
    assert rows[2].labels == "mit" and 0 < rows[2].score < 1 and rows[2].base_labels == ""


def test_nulls_empty_long_and_repeated_rows(spark):
    notice = "all rights reserved " * 30_000
    rows = [(None, None, 1), (1, "", 2), (2, notice, 3), (2, notice, 3), (3, "cc by", 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int").selectExpr("*", "1 AS _words", "2 AS `a.b`")
    out = L.scan_licenses(df).collect()
    assert len(out) == 5 and {r["a.b"] for r in out} == {2} and {r["_words"] for r in out} == {1}
    long = [r for r in out if r.doc_id == 2]
    assert [(r.n_words, r.n_base, r.first_word, r.last_word) for r in long] == [(90_000, 30_000, 0, 89_997)] * 2
    assert [(r.n_words, r.n_base, r.first_word, r.labels, r.score) for r in out if r.doc_id == 1] == [(0, 0, None, "", 0.0)]
    assert L.scan_licenses(df.where("doc_id > 9")).count() == 0


def test_no_python_and_no_shuffle_of_texts(spark, documents):
    plan = L.scan_licenses(documents("cc by"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
