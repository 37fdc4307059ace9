"""Quality classifier by positive-unlabelled learning.

The model sees trusted positives (rows labelled 1), unlabelled text, and an estimate ``prior`` of
the share of positives; it minimises the non-negative unbiased risk
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` of a linear scorer over the shape of a text:
byte frequencies, hashed byte trigrams, and how its words repeat. The prior is the share of ones
among the labelled rows that may be learnt from, which also set the scale of the scores (a
logistic fit of label on margin). Labels, language, source and id are no inputs of a score.

The fit reads a bounded sample (``SAMPLE`` rows of each kind, chosen by a hash of the id); every
text is scored whole. A null text is an empty one and gets the score of an all-zero vector. With
no positives to learn from every score is the prior, or 0.5 without any label.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import crc_bucket, few, kept_in_worker

#: Rows of each kind (positives, unlabelled, labelled 0) that the fit may read.
SAMPLE = 5000
BYTES, TRIGRAMS, SHAPES = 129, 256, 8
WIDTH = BYTES + TRIGRAMS + SHAPES


def features(texts: list[str | None]) -> np.ndarray:
    """One row per text; frequencies enter by their square roots."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for row, text in zip(out, texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if not raw:
            continue
        a = np.frombuffer(raw, np.uint8)
        seen = np.bincount(a, minlength=256)
        row[:128] = seen[:128]
        row[128] = seen[128:].sum()
        row[:BYTES] = np.sqrt(row[:BYTES] / len(a))
        if len(a) > 2:
            b = a.astype(np.uint32)
            code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
            row[BYTES:BYTES + TRIGRAMS] = np.sqrt(
                np.bincount(code >> np.uint32(24), minlength=TRIGRAMS) / len(code))
        words = raw.split()
        n = max(1, len(words))
        lines = raw.count(b"\n") + 1
        twice = sum(map(operator.eq, words, words[1:])) if len(words) > 1 else 0
        upper = int(seen[65:91].sum())
        letters = upper + int(seen[97:123].sum()) + int(seen[128:].sum())
        row[BYTES + TRIGRAMS:] = (len(set(words)) / n, twice / n, np.log1p(len(words)) / 10,
                                  np.log1p(len(raw) / n) / 3, upper / max(1, letters),
                                  letters / len(raw), np.log1p(n / lines) / 5,
                                  (seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum()
                                   + seen[123:127].sum()) / n)
    return out


@dataclass
class Model:
    """Standardised linear margin and its logistic scale; a constant when ``weights`` is None."""

    weights: np.ndarray | None
    bias: float
    slope: float
    shift: float
    prior: float

    def predict(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        margin = features(texts).astype(np.float64) @ self.weights + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))

    def score(self, text: Column) -> Column:
        """The score of a text column, evaluated in Arrow batches."""
        model = self   # a few KB: it travels with the task

        @F.pandas_udf("double")
        def quality_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            kept_in_worker("quality", dict)   # drops the caches of stages before
            for s in batches:
                parts = [model.predict(part) for part in slices(s.tolist())]
                yield pd.Series(np.concatenate(parts) if parts else np.empty(0))
        return quality_score(text)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def nonnegative_risk(gp: np.ndarray, gu: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic non-negative risk of margins on positives and unlabelled rows, and the gradients
    by margin. When the negative part falls below zero its gradient is turned round."""
    sp, su = _sigmoid(gp), _sigmoid(gu)
    pos = prior * np.mean(np.logaddexp(0, -gp))
    neg = np.mean(np.logaddexp(0, gu)) - prior * np.mean(np.logaddexp(0, gp))
    dneg_p, dneg_u = -prior * sp / len(gp), su / len(gu)
    if neg >= 0:
        return pos + neg, prior * (sp - 1) / len(gp) + dneg_p, dneg_u
    return pos, -dneg_p, -dneg_u


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600,
          rate: float = 0.02, decay: float = 1e-3, seed: int = 1) -> tuple[np.ndarray, float]:
    """Adam on mini-batches of the non-negative risk; weights are for unscaled features."""
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, dev = both.mean(0), both.std(0) + 1e-3
    p, u = (positive - mean) / dev, (unlabelled - mean) / dev
    rng = np.random.default_rng(seed)
    w = np.zeros(p.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        i, j = (rng.integers(0, len(x), min(len(x), 1024)) for x in (p, u))
        _, dp, du = nonnegative_risk(p[i] @ w[1:] + w[0], u[j] @ w[1:] + w[0], prior)
        g = np.concatenate([[dp.sum() + du.sum()], p[i].T @ dp + u[j].T @ du + decay * w[1:]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    weights = w[1:] / dev
    return weights, float(w[0] - mean @ weights)


def calibrate(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic fit (Newton steps with a small ridge)."""
    scale = max(1e-9, float(np.std(margin)))
    x = np.stack([margin / scale, np.ones_like(margin)], 1)
    beta = np.zeros(2)
    for _ in range(50):
        q = _sigmoid(x @ beta)
        g = x.T @ (weight * (q - label)) + 1e-2 * beta
        h = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, g)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def _rows(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """Feature rows of a bounded list of ids; made on the executors, gathered as packed floats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for part in slices(rows.column(0).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.tobytes() for r in features(part)], pa.binary())], names=["x"])

    wanted = F.broadcast(ids.select(F.col(id_col).alias("__id")).distinct())   # SAMPLE rows or so
    rows = docs.join(wanted, docs[id_col] == F.col("__id"), "left_semi") \
        .select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "x binary").collect()
    return np.frombuffer(b"".join(bytes(r.x) for r in rows), np.float32).reshape(-1, WIDTH)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality", folds: int = 3, held: int = 1) -> Model:
    """Fit on the labelled rows whose crc32(id) mod ``folds`` is not ``held``, and on rows of
    ``docs`` that carry no label at all."""
    ids = labels.select(id_col, F.col(label_col).alias("y")).filter(f"{id_col} is not null")
    seen = ids.filter(crc_bucket(id_col, folds) != held).filter("y in (0, 1)") \
        .groupBy(id_col).agg(F.max("y").alias("y"))
    ones, zeros = (seen.filter(f"y = {y}").select(id_col) for y in (1, 0))
    n1, n0 = ones.count(), zeros.count()
    prior = n1 / (n1 + n0) if n1 + n0 else 0.5
    if not n1:
        return Model(None, 0.0, 0.0, 0.0, prior)
    free = docs.select(id_col).filter(f"{id_col} is not null").join(ids.select(id_col), id_col, "left_anti")
    xp, xu, xn = (_rows(docs, few(rows, id_col, sample, seed), id_col, text_col)
                  for seed, rows in enumerate((ones, free, zeros)))
    if not len(xu):   # everything is labelled: the labelled rows without their labels
        xu = np.concatenate([xp, xn])
    if not len(xp):
        return Model(None, 0.0, 0.0, 0.0, prior)
    weights, bias = train(xp, xu, min(max(prior, 0.01), 0.99))
    slope, shift = 1.0, 0.0
    if len(xn):
        margin = np.concatenate([xp, xn]).astype(np.float64) @ weights + bias
        label = np.repeat([1.0, 0.0], [len(xp), len(xn)])
        weight = np.repeat([n1 / len(xp), n0 / len(xn)], [len(xp), len(xn)])
        slope, shift = calibrate(margin, label, weight / weight.mean())
    return Model(weights, bias, slope, shift, prior)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.5) for every row."""
    scored = docs.select(F.col(id_col).alias("doc_id"),
                         (crc_bucket(id_col, folds) == held).alias("held_out"),
                         model.score(F.col(text_col).cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
