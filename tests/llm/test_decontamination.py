from __future__ import annotations

import re

from mercastar.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall(ascii_lower(text))
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(item)
    out = []
    for text in docs:
        w, hit, found = WORD.findall(ascii_lower(text)), set(), set()
        for window, names in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= {str(n) for n in names if n is not None}
        out.append((len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def check(spark, documents, texts, items):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = D.mark_contamination(documents(*texts), bench).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r["items"], r.contaminated) for r in out] == brute(texts, items)
    return out


def test_against_brute_force(spark, documents, words):
    items = [(i, words(n)) for i, n in enumerate([13, 14, 20, 40, 5, 12])] + [(7, "one"), (8, "Two  words"), (None, words(15))]
    items += [(9, items[2][1] + " " + words(3)), (10, ""), (11, None)]
    texts = [words(60), "", None, "...", "one", "say one, TWO--words!", items[0][1], " ? " + items[1][1].upper() + "."]
    texts += [words(30) + " " + items[3][1] + " " + words(400), "-".join(items[2][1].split()), items[4][1] + items[5][1]]
    texts += [items[8][1], "É " + items[0][1], " ".join(items[0][1].split()[:12])] * 2
    out = check(spark, documents, texts, items)
    assert any(r.contaminated for r in out) and not all(r.contaminated for r in out)


def test_only_ascii_letters_lose_their_case(spark, documents):
    items = [(1, "Été à la Plage avec des amis et beaucoup de Glaces au citron")]
    texts = [items[0][1], items[0][1].replace("Été", "été"), items[0][1].replace("Plage", "pLAGE"), items[0][1].replace("citron", "ΣΑΣ")]
    check(spark, documents, texts, items)
    check(spark, documents, ["ΑΣ ΑΣ' ας İx Kelvin"], [(1, "ΑΣ"), (2, "ας"), (3, "Kelvin")])


def test_long_text_and_full_prefix_table(spark, documents, words, monkeypatch):
    monkeypatch.setattr(D, "LEAST_BITS", 64)
    monkeypatch.setattr(D, "MOST_BITS", 64)  # every position goes on to the exact comparison
    item = words(20)
    check(spark, documents, [words(9000) + " " + item + " " + words(9000), words(50)], [(1, item)])


def test_nothing_to_find(spark, documents, words):
    check(spark, documents, [words(20), None], [])
    empty = documents("x").where("doc_id < 0")
    assert D.mark_contamination(empty, spark.createDataFrame([(1, "x")], "item_id bigint, text string")).collect() == []


def test_clashing_names_and_repeated_rows(spark, documents, words):
    item = words(15)
    docs = documents(item, item, "other words", n_hit="old", digest="old", contaminated="old")
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    out = D.mark_contamination(docs.unionAll(docs), bench)
    assert out.count() == 6 and out.where("contaminated").count() == 4
    assert out.select("digest").distinct().first()[0] == "old"


def test_spans_and_documents_are_removed(spark, documents, words):
    item = words(13)
    docs = documents("Keep this, " + item + "; and that.", item, "clean")
    marked = D.mark_contamination(docs, spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    cut = {r.doc_id: r.text for r in D.without_spans(marked).collect()}
    assert cut == {0: "Keep this, and that.", 1: "", 2: "clean"}
    assert [r.doc_id for r in D.without_documents(marked).collect()] == [2]
