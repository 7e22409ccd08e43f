from __future__ import annotations

import random

import numpy as np
import pytest

from mercastar.llm import mixing as M

FACTORS = {"good": 1.0, "bad": 0.25}


def corpus(spark, words, n=800):
    """Texts over sixty words, a quarter of them with four bad ones."""
    rng, stock = random.Random(4), words(60).split()
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        rows.append((i, " ".join(rng.choice(stock) for _ in range(40)) + (" awful nasty awful vile" if bad else ""), "old"))
        if i % 2 == 0:
            labels.append((i, "bad" if bad else "good"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rate string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, domain string")


def descend(tokens, posterior, factors):
    present = tokens @ posterior
    targets, rate = factors * present, np.ones(len(tokens))
    for _ in range(M.ITERATIONS):
        totals = (tokens * rate) @ posterior
        if np.abs(totals - targets).max() <= M.TOLERANCE * present.sum():
            break
        error = np.divide(totals - targets, present, out=np.zeros_like(present), where=present > 0)
        rate = np.maximum(0, rate - posterior @ error)
    return rate


def test_rates_equal_a_plain_descent_and_reach_the_targets(spark, words):
    docs, labels = corpus(spark, words)
    out = M.mix(docs, labels, FACTORS).orderBy("doc_id").collect()
    tokens = np.array([r.n_tokens for r in out], float)
    posterior = np.array([r.posterior for r in out])
    rate = np.array([r.rate for r in out])
    assert posterior.sum(axis=1) == pytest.approx(np.ones(len(out)))
    assert rate == pytest.approx(descend(tokens, posterior, np.array(list(FACTORS.values()))), abs=1e-9)
    present, reached = tokens @ posterior, (tokens * rate) @ posterior
    assert reached == pytest.approx(present * np.array([1.0, 0.25]), rel=0.02)
    bad = np.array([r.doc_id % 4 == 0 for r in out])
    assert (posterior[:, 1] > 0.5)[bad].mean() > 0.9 and (posterior[:, 1] < 0.5)[~bad].mean() > 0.9
    assert rate[~bad].mean() > 0.95 and rate[bad].mean() < 0.5
    kept = np.array([r.n_copies > 0 for r in out])
    assert kept[~bad].mean() > 0.95 and kept[bad].mean() < 0.5


def test_posterior_equals_naive_bayes_by_hand(spark, words):
    docs, labels = corpus(spark, words, 24)
    model = M.fit_domains(docs, labels, list(FACTORS))
    row = M.with_memberships(docs, model).where("doc_id = 0").first()
    bins = docs.where("doc_id = 0").select(M._features(M._tokens(docs["text"])).alias("b")).first().b
    odds = model.priors[1] + sum(round(model.weights[1][b], 4) for b in bins)
    assert row.posterior[1] == pytest.approx(1 / (1 + np.exp(-odds / M.TEMPERATURE)), rel=1e-6)


def test_rare_domain_is_told_from_labels_left_out(spark):
    """Long texts of many words, one in twenty with four of ten abusive words; half of the labels are held out."""
    rng = random.Random(9)
    stock = [f"{a}{b}{c}" for a in "bdfgklmn" for b in ("a", "ei", "o", "u") for c in ("ran", "sel", "tig", "vor", "lum", "nex")]
    abuse = [f"vile{i}" for i in range(10)]
    rows, domain = [], {}
    for i in range(1200):
        bad = i % 20 == 0
        text = [rng.choice(stock) + rng.choice(stock) for _ in range(200)] + (rng.sample(abuse, 4) if bad else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        domain[i] = "bad" if bad else rng.choice(["good", "poor"])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, d) for i, d in domain.items() if i // 20 % 2], "doc_id bigint, domain string")
    out = M.mix(docs, labels, {"good": 1.0, "poor": 1.0, "bad": 0.1}).where("floor(doc_id / 20) % 2 = 0").collect()
    bad = np.array([domain[r.doc_id] == "bad" for r in out])
    p, kept = np.array([r.posterior[2] for r in out]), np.array([r.n_copies > 0 for r in out])
    assert (p > 0.5)[bad].mean() >= 0.9 and (p > 0.5)[~bad].mean() <= 0.02
    assert kept[bad].mean() <= 0.2 and kept[~bad].mean() >= 0.9


def members(spark, *rows):
    return spark.createDataFrame(list(rows), "n_tokens bigint, posterior array<double>")


def test_small_domain_reaches_its_own_target(spark):
    _, reached, targets = M.fit_rates(members(spark, (10_000_000, [1.0, 0.0]), (100, [0.0, 1.0])), [1.0, 0.1])
    assert reached == pytest.approx(targets, rel=M.OWN_TOLERANCE)


def test_rates_are_bounded_in_the_fit_and_missed_targets_are_told(spark, words):
    mixed = members(spark, (1000, [0.9, 0.1]), (1000, [0.2, 0.8]))
    rate, reached, targets = M.fit_rates(mixed, [1.0, 0.1], most=1.0)
    rates = [r.rate for r in mixed.select(rate.alias("rate")).collect()]
    assert max(rates) <= 1.0 and reached[0] == pytest.approx(900 * rates[0] + 200 * rates[1])
    docs, labels = corpus(spark, words, 80)
    with pytest.warns(UserWarning, match="targets not reached"):
        out = M.mix(docs, labels, {"good": 3.0, "bad": 1.0}, most=1.0).collect()
    assert all(r.rate <= 1.0 and r.n_copies <= 1 for r in out)


def test_nulls_empty_no_labels_and_repeated_rows(spark, words):
    docs, labels = corpus(spark, words, 16)
    odd = spark.createDataFrame([(None, None, None), (99, "", None), (98, "x " * 50_000, None), (98, "x " * 50_000, None)], docs.schema)
    out = M.mix(docs.unionAll(odd), labels.unionAll(labels.selectExpr("CAST(NULL AS bigint)", "domain")), FACTORS).collect()
    assert len(out) == 20 and all(r.rate >= 0 for r in out)
    assert len({(r.rate, r.n_copies) for r in out if r.doc_id == 98}) == 1
    assert [r.n_tokens for r in out if r.doc_id in (None, 99)] == [0, 0]
    assert M.mix(docs.where("doc_id < 0"), labels, FACTORS).collect() == []
    alike = M.mix(docs, labels.where("doc_id < 0"), FACTORS).collect()
    assert len({tuple(r.posterior) for r in alike}) == 1
