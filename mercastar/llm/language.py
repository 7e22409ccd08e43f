"""Language of a text: family first, then linear support vector machines within it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercastar.llm.columns import packed, quoted, unpacked
from mercastar.llm.text_arrays import LOWER, MIX_1, Slice, slices

UNKNOWN = "und"
BINS = 1 << 12
ROWS_PER_LANGUAGE = 800  # bound of the labelled sample, for each language
HASH_STEPS = 1 << 30
EPOCHS = 20
COST = 10.0

# Families of common languages; a language not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indic": ("hi", "bn", "mr", "pa", "gu", "ur", "ne"),
}
_FAMILY_OF = {language: family for family, members in FAMILIES.items() for language in members}

# ASCII letters in lower case, all other ASCII as one blank; other bytes as they are.
_FOLDED = LOWER.copy()
_FOLDED[:128][~((_FOLDED[:128] >= 97) & (_FOLDED[:128] <= 122))] = 32
_IS_LETTER = (_FOLDED >= 97) & (_FOLDED <= 122)


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language, f"only-{language}")


def _trigrams(piece: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of the byte trigram at each place, and the first place and number of each text."""
    b = _FOLDED[piece.data].astype(np.uint32)
    if len(b) < 3:
        b = np.concatenate([b, np.full(3 - len(b), 32, np.uint32)])
    code = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
    bins = ((code * np.uint32(int(MIX_1) & 0xFFFFFFFF)) >> np.uint32(32 - 12)).astype(np.int32)
    first = piece.offsets[:-1]
    return bins, first, np.maximum(np.diff(piece.offsets) - 2, 0)


def _rows_with_letters(piece: Slice) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(_IS_LETTER[piece.data])])
    found = seen[piece.offsets[1:]] > seen[piece.offsets[:-1]]
    for i in np.flatnonzero(~found):
        text = bytes(piece.data[piece.offsets[i] : piece.offsets[i + 1]]).decode("utf-8", "replace")
        found[i] = any(map(str.isalpha, text))
    return found


def _vectors(piece: Slice) -> np.ndarray:
    """Share of each bin among the trigrams of each text."""
    bins, first, count = _trigrams(piece)
    out = np.zeros((len(piece), BINS), np.float32)
    for i, (at, n) in enumerate(zip(first, count, strict=True)):
        if n:
            out[i] = np.bincount(bins[at : at + n], minlength=BINS) / n
    return out


def _svm(x: np.ndarray, y: np.ndarray, seed: int = 1) -> np.ndarray:
    """Weights of a linear SVM with hinge loss, by dual coordinate descent."""
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    square = np.einsum("ij,ij->i", x, x)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(x)):
            if square[i] > 0:
                old = alpha[i]
                alpha[i] = min(max(old - (y[i] * (x[i] @ w) - 1) / square[i], 0.0), COST)
                w += (alpha[i] - old) * y[i] * x[i]
    return w


@dataclass(frozen=True)
class LanguageModel:
    """Weights by bin, the last row a bias: a column for each family, then for each pair."""

    languages: tuple[str, ...]
    families: tuple[str, ...]
    pairs: tuple[tuple[str, str], ...]
    weights: np.ndarray

    @classmethod
    def shaped(cls, languages: list[str], weights: np.ndarray | None = None) -> LanguageModel:
        languages = sorted(languages)
        families = sorted({family_of(x) for x in languages})
        pairs = [p for p in combinations(languages, 2) if family_of(p[0]) == family_of(p[1])]
        if weights is None:
            weights = np.zeros((BINS + 1, len(families) + len(pairs)), np.float32)
        return cls(tuple(languages), tuple(families), tuple(pairs), weights)

    @classmethod
    def fitted(cls, shares: np.ndarray, labels: np.ndarray) -> LanguageModel:
        """Learn from trigram shares; rare bins are scaled up for the solver."""
        model = cls.shaped(list(set(labels)))
        scale = 1 / np.sqrt(shares.mean(axis=0) + 1e-6)
        x = np.concatenate([shares * scale, np.ones((len(shares), 1), np.float32)], axis=1)
        kinship = np.array([family_of(x) for x in labels])
        tasks = [(np.ones(len(labels), bool), kinship == f) for f in model.families]
        tasks += [((labels == a) | (labels == b), labels == a) for a, b in model.pairs]
        for column, (rows, positive) in enumerate(tasks):
            if positive[rows].all():
                model.weights[-1, column] = 1.0
                continue
            w = _svm(x[rows], np.where(positive[rows], 1.0, -1.0))
            model.weights[:-1, column] = w[:-1] * scale
            model.weights[-1, column] = w[-1]
        return model

    def margins(self, piece: Slice) -> np.ndarray:
        bins, first, count = _trigrams(piece)
        sums = np.zeros((len(piece), self.weights.shape[1]))
        some = np.flatnonzero(count)
        if len(some):
            # Sums over [start, end) of each text, and over the gaps between them.
            edges = np.stack([first[some], first[some] + count[some]], axis=1).ravel()
            values = np.concatenate([self.weights[bins], np.zeros((3, sums.shape[1]), np.float32)])
            sums[some] = np.add.reduceat(values, edges, axis=0)[::2] / count[some, None]
        return sums + self.weights[-1]

    def predict(self, piece: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Language and confidence of each text."""
        if not self.languages:
            return np.full(len(piece), UNKNOWN, object), np.zeros(len(piece))
        margins = self.margins(piece)
        nf = len(self.families)
        powers = np.exp(np.clip(2 * (margins[:, :nf] - margins[:, :nf].max(axis=1, keepdims=True)), -50, 0))
        best = margins[:, :nf].argmax(axis=1)
        sure = powers.max(axis=1) / powers.sum(axis=1)
        votes = np.zeros((len(piece), len(self.languages)))
        firm = np.ones((len(piece), len(self.languages)))
        place = {x: i for i, x in enumerate(self.languages)}
        for column, (a, b) in enumerate(self.pairs, nf):
            m = margins[:, column]
            p = 1 / (1 + np.exp(-np.clip(2 * m, -50, 50)))
            for language, share in ((a, p), (b, 1 - p)):
                votes[:, place[language]] += 1 + (share >= 0.5) + 1e-3 * share
                firm[:, place[language]] = np.minimum(firm[:, place[language]], share)
        of = np.array([self.families.index(family_of(x)) for x in self.languages])
        votes[of[None, :] != best[:, None]] = -1
        chosen = votes.argmax(axis=1)
        names = np.array(self.languages, object)[chosen]
        score = sure * firm[np.arange(len(piece)), chosen]
        silent = ~_rows_with_letters(piece)
        names[silent], score[silent] = UNKNOWN, 0.0
        return names, score


def held_out(key: F.Column) -> F.Column:
    """Documents kept from learning: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_languages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from labelled documents that are not held out.

    The sample takes from each language the documents whose hash of the key is below
    a threshold that lets about `rows_per_language` through (all, if there are fewer).
    One task fits the machines on that bounded sample; only weights come back. NULL
    keys, texts and languages are not learned from.
    """
    body = F.col(quoted(text))
    rows = docs.select(
        F.col(quoted(key)).alias("key"), body.alias("text"), F.col(quoted(language)).cast("string").alias("lang")
    ).where(F.col("key").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.where(~held_out(F.col("key")) & F.col("text").rlike(r"\p{L}"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    luck = F.pmod(F.xxhash64("key"), F.lit(HASH_STEPS))
    limit = F.lit(-1)
    for row in counts:
        part = min(HASH_STEPS, HASH_STEPS * rows_per_language // row["n"])
        limit = F.when(F.col("lang") == row["lang"], F.lit(part)).otherwise(limit)
    sample = rows.where(luck < limit).select("text", "lang")

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column("text")):
                names = batch.column("lang").slice(piece.first, len(piece))
                raw = pa.array([v.tobytes() for v in _vectors(piece)], pa.binary())
                yield pa.RecordBatch.from_arrays([names, raw], ["lang", "shares"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, raw = [], []
        for batch in batches:
            names += batch.column("lang").to_pylist()
            raw += batch.column("shares").to_pylist()
        if names:
            # In a fixed order, so that the machines do not depend on that of the rows.
            line = sorted(range(len(names)), key=lambda i: (names[i], raw[i]))
            x = np.stack([np.frombuffer(raw[i], np.float32) for i in line])
            model = LanguageModel.fitted(x, np.array([names[i] for i in line], object))
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(model.languages)]), pa.array([model.weights.tobytes()], pa.binary())],
                ["languages", "weights"],
            )

    fitted = sample.mapInArrow(shares, "lang string, shares binary").repartition(1)
    learned = fitted.mapInArrow(fit, "languages array<string>, weights binary").collect()
    if not learned:
        return LanguageModel.shaped([])
    row = learned[0]  # the only one
    shape = LanguageModel.shaped(row["languages"])
    weights = np.frombuffer(row["weights"], np.float32).reshape(shape.weights.shape)
    return LanguageModel.shaped(row["languages"], weights)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add `lang_pred` and `score` (0 to 1) from the whole text alone.

    Texts that are NULL, empty or without a letter get `und` and 0, and so does every
    text if nothing was learned. Input columns of these names are replaced. Ties
    between languages go to the first in alphabetical order; repeated rows get the
    same answer; an empty table gives no rows.
    """

    def detect(texts: pa.Array) -> pa.Array:
        found = [model.predict(piece) for piece in slices(texts)]
        names = [x for part, _ in found for x in part]
        scores = np.concatenate([s for _, s in found]) if found else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    # Else a filter on the answer has Spark ask twice, with two workers in every task.
    answer = F.arrow_udf(detect, "lang_pred string, score double").asNondeterministic()
    rows = packed(docs, _text=F.col(quoted(text))).withColumn("_answer", answer("_text"))
    return unpacked(
        rows, docs.columns, lang_pred=F.col("_answer.lang_pred"), score=F.col("_answer.score")
    )
