"""Quality scores by a regularised quadratic discriminant.

Each document is turned into a short vector of statistics, transformed so that each is roughly bell-shaped. Every class
gets a mean and a covariance, shrunk towards the pooled diagonal; a document's score comes from the difference of the
two classes' log densities (Mahalanobis distance through a Cholesky factor computed once, log determinant and prior).

The statistics and the class sums cover every document and every labelled row: only counts, sums and products of
`len(STATISTICS)` numbers per class reach the driver. Labels, language, source and ids never enter a vector.

Edge cases: null and empty texts have the same vector (all counts zero) and so a score like any other; very long texts
are read whole; a null label, or a label row without document, teaches nothing; several labels of one id count as their
smallest; a row without id is scored but never labelled. Without labelled rows of both classes every score is 0.5
(none), 1 or 0 (the only class). An empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hydrolens.llm.common import bounded_batches

STATISTICS = (
    "log_chars",
    "word_length",
    "capitals",
    "shouted_words",
    "shouts",
    "signs",
    "bars",
    "digits",
    "stops",
    "lone_words",
    "repeated_neighbours",
    "distinct_words",
    "top_word",
    "line_length",
    "repeated_lines",
    "sentence_length",
    "odd_endings",
    "noisiest_line",
)
SHRINKAGE = 0.05
TEMPERATURE = 4.0

_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"#$%&*<>=@^_~\\{}[]+/")] = True
_ODD = frozenset("!#$%&*|~^<>=@")


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of one text, in the order of `STATISTICS`."""
    text = text or ""
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    n, m = len(words), max(len(text), 1)
    often = Counter(words)
    letters = counts[65:91].sum() + counts[97:123].sum() + 1
    stops, shouted = counts[46] + counts[63], sum(1 for w in words if len(w) > 1 and w.isupper())
    odd = sum(1 for w in words if w[-1] in _ODD)
    noisy = max((_noise(line) for line in lines), default=0.0)
    return np.array([
        np.log1p(len(text)),
        np.log((m - n + 1) / (n + 1) + 1),
        _logit(counts[65:91].sum(), letters),
        _logit(shouted, n),
        _logit(counts[33], m),
        _logit(counts[_SIGNS].sum(), m),
        _logit(counts[124], m),
        _logit(counts[48:58].sum(), m),
        _logit(stops, n),
        _logit(sum(1 for w in words if len(w) == 1), n),
        _logit(sum(map(str.__eq__, words, words[1:])), n),
        _logit(len(often), n),
        _logit(max(often.values(), default=0), n),
        np.log((n + 1) / (len(lines) + 1)),
        _logit(len(lines) - len(set(lines)), len(lines)),
        np.log((n + 1) / (stops + 1)),
        _logit(odd, n),
        _logit(noisy * 100, 100),
    ])


def _noise(line: str) -> float:
    """Share of a line's words that shout, end in an odd sign or repeat the word before."""
    words = line.split()
    odd = sum(1 for w in words if w[-1] in _ODD or (len(w) > 1 and w.isupper()))
    return (odd + sum(map(str.__eq__, words, words[1:]))) / (len(words) + 4)


def _logit(part: float, whole: float) -> float:
    return float(np.log((part + 0.5) / (max(whole - part, 0) + 0.5)))


def with_statistics(docs: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    """`docs` with an array of its text's statistics."""

    @F.pandas_udf("array<double>")
    def vectors(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t).tolist() for t in texts])

    bounded_batches(docs.sparkSession)
    return docs.withColumn(name, vectors(F.col(f"`{text}`")))


@dataclass(frozen=True)
class Discriminant:
    """Fitted classes: for each, the mean, the inverse Cholesky factor of its covariance, and the constant part."""

    means: np.ndarray
    inverse_factors: np.ndarray
    constants: np.ndarray
    fallback: float | None = None

    def score(self, vectors: np.ndarray) -> np.ndarray:
        """Probability-like score of class 1, from 0 to 1."""
        if self.fallback is not None:
            return np.full(len(vectors), self.fallback)
        parts = []
        for mean, factor, constant in zip(self.means, self.inverse_factors, self.constants):
            parts.append(constant - 0.5 * np.square((vectors - mean) @ factor.T).sum(1))
        return 1 / (1 + np.exp(-np.clip((parts[1] - parts[0]) / TEMPERATURE, -30, 30)))


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE) -> Discriminant:
    """From each class's number of rows, sum of vectors and sum of their outer products."""
    size, empty = len(STATISTICS), np.empty(0)
    have = [c for c in (0, 1) if c in sums and sums[c][0] > 0]
    if len(have) < 2:
        return Discriminant(empty, empty, empty, float(have[0]) if have else 0.5)
    means = {c: sums[c][1] / sums[c][0] for c in have}
    spread = {c: sums[c][2] / sums[c][0] - np.outer(means[c], means[c]) for c in have}
    total = sum(sums[c][0] for c in have)
    pooled = np.diag(sum(np.diag(spread[c]) * sums[c][0] for c in have) / total + 1e-3)
    factors, constants = [], []
    for c in have:
        weight = min(1.0, shrinkage + size / (sums[c][0] + size))
        factor = np.linalg.cholesky((1 - weight) * spread[c] + weight * pooled)
        factors.append(np.linalg.inv(factor))
        constants.append(np.log(sums[c][0] / total) - np.log(np.diag(factor)).sum())
    return Discriminant(np.stack([means[c] for c in have]), np.stack(factors), np.array(constants))


def class_sums(vectors: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Sums by class over rows of (`statistics`, `quality`): one row per task and class reaches the driver."""
    size = len(STATISTICS)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            x = np.array(batch.column("statistics").flatten().to_numpy(zero_copy_only=False)).reshape(-1, size)
            y = batch.column("quality").to_numpy(zero_copy_only=False)
            for c in (0, 1):
                own = x[y == c]
                if len(own):
                    old = held.get(c, [0.0, np.zeros(size), np.zeros((size, size))])
                    held[c] = [old[0] + len(own), old[1] + own.sum(0), old[2] + own.T @ own]
        if held:
            yield pa.RecordBatch.from_pydict({
                "quality": pa.array(list(held), pa.int32()),
                "sums": pa.array([[v[0], *v[1], *v[2].ravel()] for v in held.values()], pa.list_(pa.float64())),
            })

    parts = vectors.select("statistics", F.col("quality").cast("int").alias("quality")).mapInArrow(partial, "quality int, sums array<double>")
    width = 1 + size + size * size
    whole = parts.groupBy("quality").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums")).collect()
    shaped = {r["quality"]: np.array(r["sums"]) for r in whole}
    return {c: (v[0], v[1 : 1 + size], v[1 + size :].reshape(size, size)) for c, v in shaped.items()}


def held_out(doc_id) -> F.Column:
    """Whether a row is kept from training: its id's checksum is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(vectors: DataFrame, labels: DataFrame) -> Discriminant:
    """Fit on every labelled row that is not held out; `vectors` has `doc_id` and `statistics`."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = vectors.where(~held_out(F.col("doc_id"))).select("doc_id", "statistics")
    return fit(class_sums(rows.join(known, "doc_id")))


def with_score(vectors: DataFrame, model: Discriminant) -> DataFrame:
    """`vectors` with `score` in place of `statistics`."""
    size = len(STATISTICS)

    @F.pandas_udf("double")
    def scores(column: pd.Series) -> pd.Series:
        x = np.concatenate([np.asarray(v, float) for v in column]) if len(column) else np.empty(0)
        return pd.Series(model.score(x.reshape(-1, size)))

    return vectors.withColumn("score", scores("statistics")).drop("statistics")
