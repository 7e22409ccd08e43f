"""Document rates that bring soft domains to target token totals."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercastar.llm.columns import packed, quoted, unpacked
from mercastar.storage import durable

BINS = 1 << 16  # a long text has thousands of words, and shares few bins by chance
HASH_STEPS = 1 << 30
ROWS_PER_DOMAIN = 6000  # bound of the labelled sample, for each domain
SMOOTHING = 1.0
SIGNIFICANCE = 5.0  # standard deviations from which a bin tells domains apart; chance passes none of BINS
TEMPERATURE = 1.0  # only telling bins are weighed, each once: the odds are not softened
ITERATIONS = 25
TOLERANCE = 1e-4  # of all tokens; the descent stops when no domain is farther off,
OWN_TOLERANCE = 0.02  # nor farther off its own target than this part of it
KEPT_FROM = 0.95
ENDS = ".,;:!?\"'()"


def _tokens(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda t: t != "")


def _features(tokens: Column) -> Column:
    """Hashed words of a text without case and outer marks, each bin once."""
    words = F.transform(
        tokens, lambda t: F.pmod(F.xxhash64(F.rtrim(F.lower(t), F.lit(ENDS))), F.lit(BINS)).cast("int")
    )
    return F.array_distinct(words)


def _tells(counts: Sequence[int], sizes: Sequence[int]) -> bool:
    """Whether documents with a bin differ in share between domains, by a likelihood ratio test.

    The chi square bound is that of Wilson and Hilferty.
    """
    seen, whole = sum(counts), sum(sizes)
    ratio = 0.0
    for n, size in zip(counts, sizes, strict=True):
        for observed, share in ((n, seen / whole), (size - n, 1 - seen / whole)):
            if observed > 0:
                ratio += 2 * observed * math.log(observed / (size * share))
    free = max(1, sum(size > 0 for size in sizes) - 1)
    bound = free * (1 - 2 / (9 * free) + SIGNIFICANCE * math.sqrt(2 / (9 * free))) ** 3
    return ratio > bound


@dataclass(frozen=True)
class DomainModel:
    """Naive Bayes over hashed words that tell domains apart, by documents that have them.

    Priors hold the evidence of a text without any of these words, and a weight what the
    presence of one changes; both are log odds against the first domain.
    """

    domains: tuple[str, ...]
    priors: tuple[float, ...]
    weights: tuple[tuple[float, ...], ...]

    def posterior(self, tokens: Column, temperature: float = TEMPERATURE) -> Column:
        """Probabilities of the domains, in order, softened by `temperature`."""

        def scores(bins: Column) -> Column:
            odds = [F.lit(0.0)]
            for prior, weights in zip(self.priors[1:], self.weights[1:], strict=True):
                table = F.split(F.lit(",".join(f"{w:.4f}" if w else "0" for w in weights)), ",").cast("array<double>")
                odds.append(F.aggregate(bins, F.lit(prior), _adder(table)))
            return F.array(*odds)

        def shares(odds: Column) -> Column:
            top = F.array_max(odds)
            powers = F.transform(odds, lambda x: F.exp((x - top) / temperature))
            total = F.aggregate(powers, F.lit(0.0), lambda s, x: s + x)
            return F.transform(powers, lambda x: x / total)

        odds = F.get(F.transform(F.array(_features(tokens)), scores), F.lit(0))
        return F.get(F.transform(F.array(odds), shares), F.lit(0))


def _adder(table: Column):
    return lambda total, bin_: total + F.get(table, bin_)


def fit_domains(
    docs: DataFrame, labelled: DataFrame, domains: Sequence[str], key: str = "doc_id",
    text: str = "text", rows_per_domain: int = ROWS_PER_DOMAIN,
) -> DomainModel:
    """Learn the domains from labelled documents.

    `labelled` has `key` and `domain`; labels outside `domains`, NULL keys and NULL
    labels are ignored, and so are repeated labels. Priors count all labels. Documents
    that have a feature are counted over a bounded sample, and only features whose counts
    differ significantly between the domains are weighed. The sample: of each domain the labels whose hash of the key is
    below a threshold that lets about `rows_per_domain` through, so the table that is
    broadcast has about domains x rows_per_domain rows at most.
    """
    named = labelled.select(F.col(quoted(key)).alias("key"), F.col("domain").alias("domain"))
    named = named.where(F.col("key").isNotNull() & F.col("domain").isin(*domains)).distinct()
    found = {r["domain"]: r["n"] for r in named.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    luck, limit = F.pmod(F.xxhash64("key"), F.lit(HASH_STEPS)), F.lit(-1)
    for d, n in found.items():
        limit = F.when(F.col("domain") == d, F.lit(min(HASH_STEPS, HASH_STEPS * rows_per_domain // n))).otherwise(limit)
    sample = named.where(luck < limit)
    bodies = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    bins = bodies.join(F.broadcast(sample.select("key", "domain")), "key").select(
        "domain", F.explode(F.concat(F.array(F.lit(-1)), _features(_tokens(F.col("text"))))).alias("bin")
    )
    sizes = dict.fromkeys(domains, 0)
    counts = {d: [0] * BINS for d in domains}
    for row in bins.groupBy("domain", "bin").agg(F.count(F.lit(1)).alias("n")).collect():
        if row["bin"] < 0:
            sizes[row["domain"]] = row["n"]
        else:
            counts[row["domain"]][row["bin"]] = row["n"]  # at most BINS rows for each domain
    telling = [any(c) and _tells(c, list(sizes.values())) for c in zip(*counts.values(), strict=True)]
    logs, absent = [], []
    for d in domains:
        shares = [(n + SMOOTHING) / (sizes[d] + 2 * SMOOTHING) if t else 0.5 for n, t in zip(counts[d], telling, strict=True)]
        logs.append([math.log(p / (1 - p)) for p in shares])
        absent.append(sum(math.log(1 - p) for p, t in zip(shares, telling, strict=True) if t))
    labels = sum(found.values()) + len(domains)
    priors = [math.log((found.get(d, 0) + 1) / labels) + a for d, a in zip(domains, absent, strict=True)]
    return DomainModel(
        tuple(domains),
        tuple(p - priors[0] for p in priors),
        tuple(tuple(w - base for w, base in zip(row, logs[0], strict=True)) for row in logs),
    )


def with_memberships(docs: DataFrame, model: DomainModel, text: str = "text") -> DataFrame:
    """Add `n_tokens` (parts between blanks) and `posterior` (one share for each domain)."""
    rows = packed(docs, _text=F.col(quoted(text)))

    def members(tokens: Column) -> Column:
        return F.struct(
            F.size(tokens).cast("bigint").alias("n_tokens"), model.posterior(tokens).alias("posterior")
        )

    seen = F.get(F.transform(F.array(_tokens(F.col("_text"))), members), F.lit(0))
    rows = rows.select("_mx_row", seen.alias("_seen"))
    return unpacked(
        rows, docs.columns, n_tokens=F.col("_seen.n_tokens"), posterior=F.col("_seen.posterior")
    )


def _rate(history: Sequence[Sequence[float]], most: float | None = None) -> Column:
    """The rate of a document after the steps of `history`, from its posterior alone."""
    if not history:
        return F.lit(1.0)
    steps = F.array(*[F.array(*[F.lit(float(e)) for e in step]) for step in history])

    def move(rate: Column, step: Column) -> Column:
        slopes = F.zip_with("posterior", step, lambda p, e: p * e)
        moved = F.greatest(F.lit(0.0), rate - F.aggregate(slopes, F.lit(0.0), lambda s, x: s + x))
        return moved if most is None else F.least(F.lit(float(most)), moved)

    return F.aggregate(steps, F.lit(1.0), move)


def _totals(members: DataFrame, rate: Column, k: int) -> list[float]:
    rated = members.select("n_tokens", "posterior", rate.alias("rate"))
    sums = [F.sum(F.col("n_tokens") * F.col("rate") * F.get("posterior", F.lit(i))) for i in range(k)]
    row = rated.agg(*[F.coalesce(s, F.lit(0.0)).alias(f"t{i}") for i, s in enumerate(sums)]).first()
    return [row[f"t{i}"] for i in range(k)]


def _off(reached: Sequence[float], targets: Sequence[float]) -> float:
    """The largest error as a part of the domain's own target, of domains that have one."""
    return max([abs(s - t) / t for s, t in zip(reached, targets, strict=True) if t > 0], default=0.0)


def fit_rates(
    members: DataFrame, factors: Sequence[float], most: float | None = None
) -> tuple[Column, list[float], list[float]]:
    """Nonnegative document rates by projected gradient descent on least squares.

    `members` is a stored table with `n_tokens` and `posterior`. The target of domain
    k is `factors[k]` times its expected tokens. With rates r, expected totals S(r)
    and present totals S(1), the descent lowers the sum over k of
    (S_k(r) - T_k)^2 / S_k(1), from r = 1, with step 1 / S_k(1): each step subtracts
    from r_i the posterior mean of the relative errors, and cuts at zero. In this
    metric the largest curvature is 1, so the steps never overshoot, and a rate moves
    from 1 only as far as the targets ask. With `most`, rates are cut there as well.

    A pass over the table gives one total for each domain; the rate of a document is a
    function of its posterior and of the errors of all passes. Returns that function,
    the totals reached, and the targets.
    """
    k = len(factors)
    present = _totals(members, F.lit(1.0), k)
    targets = [f * s for f, s in zip(factors, present, strict=True)]
    history: list[list[float]] = []
    reached = present
    for _ in range(ITERATIONS):
        if max(abs(s - t) for s, t in zip(reached, targets, strict=True)) <= TOLERANCE * sum(present) and (
            _off(reached, targets) <= OWN_TOLERANCE
        ):
            break
        history.append(
            [(s - t) / p if p > 0 else 0.0 for s, t, p in zip(reached, targets, present, strict=True)]
        )
        reached = _totals(members, _rate(history, most), k)
    return _rate(history, most), reached, targets


def mix(
    docs: DataFrame, labelled: DataFrame, factors: Mapping[str, float], key: str = "doc_id",
    text: str = "text", keep: Sequence[str] | None = None, most: float | None = None,
) -> DataFrame:
    """Rate every document so that soft domains reach `factors` times their present tokens.

    Adds `n_tokens`, `posterior` (shares in the order of `factors`), `rate` (0 or
    more) and `n_copies`: the whole part of the rate, plus one if the rest exceeds a
    fixed hash of the key in [0, 1); a rate of KEPT_FROM to 1 gives one copy. `keep`
    names the input columns to return (all by default); input columns with the names
    of results are replaced. No rate is above `most`, if it is given. A warning
    names reached and asked totals when a domain is farther off its target than OWN_TOLERANCE.

    NULL or empty texts have no tokens and the posterior of the priors, so their rate
    follows the targets of the priors. NULL keys are rated and share one hash. Repeated
    rows are rated alike. Without labels every posterior is the same for each domain.
    An empty table gives no rows.
    """
    names = list(factors)
    model = fit_domains(docs, labelled, names, key, text)
    kept = list(docs.columns if keep is None else keep)
    seen = with_memberships(docs, model, text)
    members = durable(
        packed(
            seen.drop(*[c for c in docs.columns if c not in kept and c not in ("n_tokens", "posterior")]),
            _key=F.col(quoted(key)),
            n_tokens=F.col("n_tokens"),
            posterior=F.col("posterior"),
        )
    )
    rate, reached, targets = fit_rates(members, [factors[n] for n in names], most)
    if _off(reached, targets) > OWN_TOLERANCE:
        parts = (f"{n} {r:.6g} of {t:.6g}" for n, r, t in zip(names, reached, targets, strict=True))
        warnings.warn("targets not reached, expected tokens: " + ", ".join(parts), stacklevel=2)
    rated = members.withColumn("_rate", rate)
    luck = F.pmod(F.xxhash64("_key"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    whole = F.floor("_rate")
    copies = F.when(F.col("_rate").between(KEPT_FROM, 1.0), F.lit(1)).otherwise(
        whole + (luck < F.col("_rate") - whole).cast("int")
    )
    return unpacked(
        rated,
        [c for c in kept if c not in ("n_tokens", "posterior")],
        n_tokens=F.col("n_tokens"),
        posterior=F.col("posterior"),
        rate=F.col("_rate"),
        n_copies=copies.cast("bigint"),
    )
