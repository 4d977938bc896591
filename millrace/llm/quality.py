"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of a whole text (lengths, character classes, repetition, each over the
text and its worst block) are standardised and mapped to random Fourier features,
which approximate a Gaussian kernel. The normal equations are sums over rows, so
partitions add theirs up and the driver solves one system of fixed size. Ridge
scores of labelled rows by models that have not seen them (folds) are counted in
fixed bins, and isotonic regression over the bins turns a score into a probability.

Every labelled row counts; nothing is sampled. Defined results: a null text counts
as empty; of several labels for an id the largest counts; labels without a
document and rows with a null label or id teach nothing; with no labelled row, or
labels of one kind only, every score is that kind's share (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut
from millrace.llm.sums import vector_sum

BLOCK_WORDS = 100
FOLDS = 4
BINS = 2_000
LOW, HIGH = -0.5, 1.5

_UPPER, _LOWER, _DIGIT = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_SPACE, _LINE, _STOP = b" \t\r\v\f", b"\n", b".,;:?"
_ODD = bytes(sorted(set(range(33, 127)) - {*_UPPER, *_LOWER, *_DIGIT, *_STOP, *b"'-!\"()"}))
_CLASSES = (_UPPER, _LOWER, _DIGIT, _SPACE, _LINE, _STOP, _ODD, b"!", bytes(range(128, 256)))
N_STATS = 4 + len(_CLASSES) + 10


def statistics(text: str | None) -> list[float]:
    """N_STATS numbers that depend on nothing but the text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    ws = raw.split()
    n, k = max(len(raw), 1), max(len(ws), 1)
    shares = [(len(raw) - len(raw.translate(None, c))) / n for c in _CLASSES]
    blocks = [ws[i : i + BLOCK_WORDS] for i in range(0, max(len(ws), 1), BLOCK_WORDS)]
    if len(blocks) > 1 and len(blocks[-1]) < BLOCK_WORDS // 2:
        blocks[-2:] = [blocks[-2] + blocks[-1]]
    each = []
    for b in blocks:
        m, joined = max(len(b), 1), b"".join(b)
        size = max(len(joined), 1)
        each.append((
            len(set(b)) / m,
            sum(x == y for x, y in zip(b, b[1:])) / m,
            (len(joined) - len(joined.translate(None, _UPPER))) / size,
            (len(joined) - len(joined.translate(None, _ODD))) / size,
            (len(joined) - len(joined.translate(None, b"!"))) / size,
        ))
    by = np.array(each)
    worst = [by[:, 0].min(), *by[:, 1:].max(axis=0)]
    return [np.log1p(len(raw)), np.log1p(len(ws)), len(b"".join(ws)) / k, raw.count(b"\n\n") / n, *shares, *by.mean(axis=0), *worst]


def features(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """The columns in ``keep`` and ``x``, the statistics. Only texts go to Python."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return docs.select(*keep, run(F.col(text)).alias("x"))


@dataclass
class Model:
    """Scores statistics; ``constant`` stands in where there was nothing to learn."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weights: np.ndarray | None = None
    at: np.ndarray | None = None
    value: np.ndarray | None = None
    constant: float = 0.5

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        wave = np.cos(z @ self.waves + self.phase) * np.sqrt(2 / len(self.phase))
        return np.concatenate([np.ones((len(z), 1)), z, wave], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.constant)
        return np.interp(self.features(x) @ self.weights, self.at, self.value)


def isotonic(total: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins: places and non-decreasing shares, a place for each end of a pool."""
    pools: list[list[float]] = []  # good, all, first bin, last bin
    for i in np.flatnonzero(total):
        pools.append([good[i], total[i], i, i])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            g, a, _, last = pools.pop()
            pools[-1][0] += g
            pools[-1][1] += a
            pools[-1][3] = last
    centre = lambda i: LOW + (i + 0.5) * (HIGH - LOW) / BINS
    at = [centre(b) for p in pools for b in ((p[2],) if p[2] == p[3] else (p[2], p[3]))]
    value = [(p[0] + 0.5) / (p[1] + 1) for p in pools for _ in ((0,) if p[2] == p[3] else (0, 1))]
    return np.array(at), np.maximum.accumulate(value)


def fit(labelled: DataFrame, dims: int = 256, width: float = 4.0, ridge: float = 1e-2, seed: int = 1) -> Model:
    """A model from rows (x, y, fold): y 0 or 1, fold from 0 to FOLDS - 1."""
    rng = np.random.default_rng(seed)
    model = Model(np.zeros(N_STATS), np.ones(N_STATS), rng.normal(size=(N_STATS, dims)) / width, rng.uniform(0, 2 * np.pi, dims))
    x_of = lambda b: np.stack(b["x"].to_numpy())

    def moments(b: pd.DataFrame) -> np.ndarray:
        x = x_of(b)
        return np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), [len(x), b["y"].sum()]])

    s = vector_sum(labelled, moments, 2 * N_STATS + 2)
    n, good = s[-2:]
    if not n or good in (0, n):
        model.constant = good / n if n else 0.5
        return model
    model.mean = s[:N_STATS] / n
    model.scale = np.sqrt(np.maximum(s[N_STATS : 2 * N_STATS] / n - model.mean**2, 0)) + 1e-6
    d = 1 + N_STATS + dims

    def equations(b: pd.DataFrame) -> np.ndarray:
        z, y, fold, out = model.features(x_of(b)), b["y"].to_numpy(float), b["fold"].to_numpy(), []
        for f in range(FOLDS):
            own = z[fold == f]
            out += [(own.T @ own).ravel(), own.T @ y[fold == f]]
        return np.concatenate(out)

    sums = vector_sum(labelled, equations, FOLDS * (d * d + d)).reshape(FOLDS, d * d + d)
    solve = lambda v, rows: np.linalg.solve(v[: d * d].reshape(d, d) + ridge * max(rows, 1) / d * np.eye(d), v[d * d :])
    weights = [solve(sums.sum(axis=0) - sums[f], n * (FOLDS - 1) / FOLDS) for f in range(FOLDS)]

    def binned(b: pd.DataFrame) -> np.ndarray:
        z, y, fold = model.features(x_of(b)), b["y"].to_numpy(float), b["fold"].to_numpy()
        raw = np.einsum("ij,ij->i", z, np.stack(weights)[fold])
        at = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)])

    counts = vector_sum(labelled, binned, 2 * BINS)
    model.at, model.value = isotonic(counts[:BINS], counts[BINS:])
    model.weights = solve(sums.sum(axis=0), n)
    return model


def classify(docs: DataFrame, labels: DataFrame, label: str, learn: Column, text: str = "text", doc_id: str = "doc_id", **fitting) -> DataFrame:
    """doc_id and score of every document; ``learn``: which documents (by columns of doc_id) may teach their labels."""
    x = cut(features(docs, (doc_id,), text))
    taught = labels.where(F.col(label).isNotNull()).groupBy(doc_id).agg(F.max(label).alias("y"))
    fold = F.pmod(F.xxhash64(doc_id), F.lit(FOLDS)).cast("int")
    model = fit(x.where(learn).join(taught, doc_id).select("x", F.col("y").cast("int").alias("y"), fold.alias("fold")), **fitting)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(xs: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.stack(xs.to_numpy())) if len(xs) else [], dtype=float)

    return x.select(doc_id, score("x").alias("score"))
