"""Quality classifier by positive-unlabelled learning with the non-negative risk."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exposura.llm.common import id_remainder

HASHED = 512
SAMPLE = 6000
THRESHOLD = 0.3
SYMBOLS = "!#$%&*|.,;:?-_=+/\\<>()[]{}\"'"

_pairs = (np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(55)).astype(np.int64)
_kind = np.zeros(256, np.int64)
_kind[ord("A"):ord("Z") + 1] = 1
_kind[ord("a"):ord("z") + 1] = 2
_kind[ord("0"):ord("9") + 1] = 3
_kind[ord(" ")] = 4
_kind[ord("\n")] = 5
_kind[128:] = 6
for _k, _c in enumerate(SYMBOLS):
    _kind[ord(_c)] = 7 + _k
WIDTH = HASHED + 7 + len(SYMBOLS) + 10


def features(text: str | None) -> np.ndarray:
    """Shares of hashed byte pairs and byte kinds, and of repeats, of one whole text."""
    out = np.zeros(WIDTH, np.float32)
    data = (text or "").encode()
    if not data:
        return out
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    if n > 1:
        pairs = raw[:-1].astype(np.int64) << 8 | raw[1:]
        out[:HASHED] = np.sqrt(np.bincount(_pairs[pairs], minlength=HASHED) / (n - 1))
    kinds = np.bincount(_kind[raw], minlength=7 + len(SYMBOLS)) / n
    out[HASHED:HASHED + len(kinds)] = np.sqrt(kinds)
    words = data.split()
    m = len(words) or 1
    lines = data.split(b"\n")
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    again = sum(map(eq, words, words[1:])) / m
    top = max(Counter(words).values(), default=0) / m
    out[-10:] = (
        np.sqrt(again), np.sqrt(top),
        np.log1p(n) / 12, np.log1p(len(set(words))) / np.log1p(m), len(set(lines)) / len(lines), np.log1p(lengths.mean()) / 3,
        (lengths <= 3).mean(), (lengths == 1).mean(), np.log1p(lengths.max()) / 10, np.log1p(n / len(lines)) / 10)
    return out


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.center) * self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _descend(x: np.ndarray, gradient, steps: int, rate: float) -> tuple[np.ndarray, float]:
    theta, first, second = np.zeros(x.shape[1] + 1, np.float32), 0.0, 0.0
    for step in range(1, steps + 1):
        g = gradient(theta)
        g[:-1] += 1e-4 * theta[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _mean_gradient(x: np.ndarray, slope: np.ndarray) -> np.ndarray:
    return np.append(slope @ x, slope.sum()) / len(x)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, floor: float = 0.05, most: float = 0.3) -> float:
    """Share of positives among the unlabelled.

    A first model tells positives from unlabelled rows on one half. On the other
    half, whatever part of the space one looks at, unlabelled mass is at least the
    prior times positive mass; the least ratio over the parts above a score, each
    with most of the positives, less its standard error, is the estimate.
    """
    p, u = positive[0::2], unlabelled[0::2]

    def gradient(theta):
        zp, zu = p @ theta[:-1] + theta[-1], u @ theta[:-1] + theta[-1]
        return _mean_gradient(p, -_sigmoid(-zp)) + _mean_gradient(u, _sigmoid(zu))

    w, b = _descend(p, gradient, 300, 0.02)
    sp, su = np.sort(positive[1::2] @ w + b), np.sort(unlabelled[1::2] @ w + b)
    if not len(sp) or not len(su):
        return 0.5
    cuts = np.quantile(sp, np.linspace(0, most, 31))
    ratios = [(su >= c).mean() / (sp >= c).mean() for c in cuts]
    ratio = min(ratios)
    error = np.sqrt(max(ratio * (1 - ratio), 0.0) / len(su))
    return float(np.clip(ratio - error, floor, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, steps: int = 600) -> Model:
    """Logistic model of least non-negative unbiased risk.

    The risk is prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)]). Where
    the second part falls below zero, the step undoes that part alone, so the model
    cannot gain by overfitting the positives. Without positives or unlabelled rows
    every score is one half.
    """
    width = positive.shape[1]
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.5)
    center = unlabelled.mean(axis=0, dtype=np.float32)
    scale = 1 / (unlabelled.std(axis=0, dtype=np.float32) + np.float32(0.02))
    p, u = (positive - center) * scale, (unlabelled - center) * scale
    prior = estimate_prior(p, u) if prior is None else prior

    def gradient(theta):
        zp, zu = p @ theta[:-1] + theta[-1], u @ theta[:-1] + theta[-1]
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        away = _mean_gradient(u, _sigmoid(zu)) - prior * _mean_gradient(p, _sigmoid(zp))
        if negative < 0:
            return -away
        return away + prior * _mean_gradient(p, -_sigmoid(-zp))

    w, b = _descend(p, gradient, steps, 0.02)
    return Model(center, scale, w, b, prior)


def _feature_rows(df: DataFrame, most: int) -> np.ndarray:
    """Features of at most so many rows, in the order of (id, features)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([features(t.as_py()).astype(np.float16).tobytes() for t in batch.column(1)], pa.binary()), batch.column(0)], ["x", "doc_id"])

    drawn = df.mapInArrow(run, "x binary, doc_id long").orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(most)
    rows = sorted(drawn.collect(), key=lambda r: (r["doc_id"], bytes(r["x"])))
    return np.array([np.frombuffer(r["x"], np.float16) for r in rows], np.float32).reshape(len(rows), WIDTH)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Learns from trusted positives (quality 1) and unlabelled documents.

    Only ids whose crc32 modulo 5 is not 0 take part. At most `sample` documents of
    either kind, those of the smallest hashes, whose features reach the driver; that
    bounds it whatever the input, since rows that repeat an id count as well. Labels 0 and null labels are not used.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(id_remainder(F.col("doc_id"), 5) != 0)

    def smallest(ids: DataFrame) -> DataFrame:
        return ids.where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    trusted = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).where(id_remainder(F.col("doc_id"), 5) != 0)
    present = trusted.join(texts.select("doc_id"), "doc_id", "left_semi")
    chosen = [smallest(present), smallest(texts.select("doc_id"))]
    found = [_feature_rows(texts.join(F.broadcast(ids), "doc_id", "left_semi"), sample) for ids in chosen]
    return fit(*found)


def score_column(model: Model, text: Column) -> Column:
    """Score of each whole text, 0 to 1; a null text scores as an empty one."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = np.empty(len(texts))
        for at in range(0, len(texts), 512):
            out[at:at + 512] = model.score(np.array([features(t) for t in texts.iloc[at:at + 512]]))
        return pd.Series(out)

    return score(text)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows doc_id, held_out, score, predicted; rows are independent, no shuffle."""
    scored = df.select(F.col(id_col).alias("doc_id"), score_column(model, F.col(text_col)).alias("score"))
    return scored.select(
        "doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))
