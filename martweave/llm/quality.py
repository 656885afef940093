"""Quality classifier by positive-unlabelled learning.

Trusted positives (texts marked as good) and unlabelled web text (all texts)
train a linear scorer g on form features of the text. With the class prior p
and the logistic loss l, the unbiased risk is

    p E_P[l(g)] + ( E_U[l(-g)] - p E_P[l(-g)] )

whose bracket is the risk on the unseen negatives. A flexible model can push the
bracket below zero, which is over-fitting; the non-negative risk forbids that.
As l(g) - l(-g) = -g, the risk is convex: it is minimised by Newton steps, and a
step that raises the risk or makes the bracket negative is halved until it does not.

Every text counts in every step: tasks add up gradient and Hessian over their
rows, Spark adds those up, and the driver gets some two thousand sums per step,
whatever the size of the corpus. The features are computed once and written.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.llm.common import add_column, settled, whole_text

STEPS, RIDGE = 30, 1e-3
_PUNCTUATION = [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]
N_FEATURES = len(_PUNCTUATION) + 16


def features(text: str) -> np.ndarray:
    """Form of a text: how much of which signs, and how words and lines vary and repeat.

    All zero but for the constant for an empty text.
    """
    out = np.zeros(N_FEATURES, dtype=np.float32)
    out[0] = 1.0
    raw = text.encode()
    if not raw:
        return out
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256).astype(np.float64)
    n, letters = float(len(raw)), counts[65:91].sum() + counts[97:123].sum()
    words, lines = raw.split(), raw.split(b"\n")
    n_words = max(1, len(words))
    again = sum(a == b for a, b in zip(words, words[1:]))
    out[1] = np.log1p(n)
    out[2] = counts[48:58].sum() / n
    out[3] = counts[65:91].sum() / max(1.0, letters)
    out[4] = letters / n
    out[5] = counts[128:].sum() / n
    out[6] = counts[32] / n
    out[7] = n_words / n
    out[8] = len(set(words)) / n_words
    out[9] = np.sqrt(again / n_words)
    out[10] = np.log1p(again)
    out[11] = np.log1p(len(lines))
    out[12] = len(set(lines)) / len(lines)
    out[13] = np.log1p(max(map(len, words), default=0))
    out[14] = np.log1p(sum(w.isupper() for w in words))
    out[15] = np.log1p(counts[48:58].sum())
    out[16:] = np.log1p(counts[_PUNCTUATION] * (1000.0 / (n + 200.0)))
    return out


@dataclass(frozen=True)
class Scorer:
    """A linear model on standardised features; picklable."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        g = ((rows - self.mean) / self.scale) @ self.weights
        return 1.0 / (1.0 + np.exp(-np.clip(g, -500, 500)))


def learnable(id_col: Column) -> Column:
    """True for ids whose label may be learned: CRC-32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 != 1, F.lit(True))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, N_FEATURES)


def _sums(table: DataFrame, of_rows, size: int) -> np.ndarray:
    """Adds ``of_rows(features, positive)``, an array of ``size``, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of_rows(_matrix(batch.column("x")), batch.column("positive").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "value"])

    added = table.select("x", "positive").mapInArrow(run, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    for row in added.collect():
        out[row["at"]] = row["value"]
    return out


def _soft(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, g)


def fit(table: DataFrame, prior: float, steps: int = STEPS, ridge: float = RIDGE) -> Scorer:
    """Minimises the non-negative risk over ``table(x array<float>, positive boolean)``.

    Without rows or without positives every score is the prior.
    """
    d = N_FEATURES
    prior = min(0.99, max(0.01, prior))

    def moments(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x), positive.sum()], x.sum(0), (x * x).sum(0), x[positive].sum(0)])

    s = _sums(table, moments, 2 + 3 * d)
    n, n_positive = s[0], s[1]
    mean, scale = np.zeros(d), np.ones(d)
    weights = np.zeros(d)
    weights[0] = np.log(prior / (1 - prior))
    if not n or not n_positive:
        return Scorer(mean, scale, weights, prior)
    mean = s[2 : 2 + d] / n
    deviation = np.sqrt(np.maximum(0.0, s[2 + d : 2 + 2 * d] / n - mean**2))
    scale = np.where(deviation > 1e-6, deviation, 1.0)
    mean[0], scale[0] = 0.0, 1.0
    mean_positive = (s[2 + 2 * d :] / n_positive - mean) / scale
    penalty = np.full(d, ridge)
    penalty[0] = 0.0

    def at(w: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        def of_rows(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
            z = (x - mean) / scale
            g = z @ w
            p = 1.0 / (1.0 + np.exp(-np.clip(g, -500, 500)))
            hessian = (z * (p * (1 - p))[:, None]).T @ z
            return np.concatenate([[_soft(g).sum(), _soft(g[positive]).sum()], p @ z, hessian.ravel()])

        v = _sums(table, of_rows, 2 + d + d * d)
        negatives = v[0] / n - prior * v[1] / n_positive
        risk = v[0] / n - prior * mean_positive @ w + 0.5 * (penalty * w) @ w
        gradient = v[2 : 2 + d] / n - prior * mean_positive + penalty * w
        return risk, negatives, gradient, v[2 + d :].reshape(d, d) / n + np.diag(penalty + 1e-9)

    now = at(weights)
    move = None
    for _ in range(steps):
        if move is None:
            move = -np.linalg.solve(now[3], now[2])
        then = at(weights + move)
        if then[0] <= now[0] and then[1] >= 0:
            gain, weights, now, move = now[0] - then[0], weights + move, then, None
            if gain < 1e-5:
                break
        else:
            move = move / 2
            if np.abs(move).max() < 1e-4:
                break
    return Scorer(mean, scale, weights, prior)


def feature_table(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table of id, features and whether the row is a trusted positive that may be learned."""

    def compute(texts: pa.Array) -> pa.Array:
        rows = [features(t) for t in texts.to_pylist()]
        flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * N_FEATURES, pa.int32()), pa.array(flat))

    plain = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = add_column(plain, "x", T.ArrayType(T.FloatType()), "text", compute, without=["text"])
    good = (
        labels.where(learnable(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("good_id"))
        .agg(F.max("quality").alias("quality"))
        .where("quality = 1")
        .select("good_id")
    )
    joined = rows.join(good, F.col("doc_id") == F.col("good_id"), "left")
    return settled(joined.select("doc_id", "x", F.col("good_id").isNotNull().alias("positive")), "features")


def class_prior(labels: DataFrame) -> float:
    """The estimated share of good texts: that of the labels which may be learned; one half without labels."""
    known = labels.where(learnable(F.col("doc_id"))).agg(F.avg(F.col("quality").cast("double"))).first()[0]
    return 0.5 if known is None else float(known)


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> tuple[Scorer, DataFrame]:
    """The scorer, and the feature table of ``docs``.

    Labels are read from learnable rows only and null labels are ignored. Ids,
    languages, sources and labels never enter a score. Null and empty texts take
    part with their (empty) features; repeated rows count as often as they stand.
    """
    table = feature_table(docs, labels)
    return fit(table, class_prior(labels) if prior is None else prior), table


def score_features(table: DataFrame, scorer: Scorer, name: str = "score") -> DataFrame:
    return add_column(table, name, T.DoubleType(), F.col("x"), lambda x: pa.array(scorer.score(_matrix(x))))


def score_texts(docs: DataFrame, scorer: Scorer, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the score of each text, 0 to 1; a column called ``name`` is replaced."""

    def compute(texts: pa.Array) -> pa.Array:
        rows = [features(t) for t in texts.to_pylist()]
        return pa.array(scorer.score(np.array(rows, dtype=np.float64).reshape(-1, N_FEATURES)))

    return add_column(docs, name, T.DoubleType(), text_col, compute)
