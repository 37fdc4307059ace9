"""Toxicity by a factorization machine over hashed terms.

Terms are words (ASCII lower-cased, cut at ASCII characters that are no letters or digits) and the
first four and five bytes of longer words, hashed into ``BUCKETS``. The terms whose document
frequency differs most between toxic and clean rows of the sample are the machine's inputs:
``w0 + sum(w_i) + sum over pairs <v_i, v_j>``, so that two terms together (an insult and a group
mention) can weigh more, or less, than each by itself. Every score is that of the whole text.

The fit reads a bounded sample of labelled rows (``SAMPLE`` toxic and twice as many clean ones,
chosen by a hash of the id) and shifts the intercept back to the labelled shares. A null text is
an empty one: its score is the intercept's. Without both labels every score is the share of toxic
rows, or 0 without labels.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import crc_bucket, few, kept_in_worker

BUCKETS = 1 << 18
#: Toxic rows in the sample; it holds up to twice as many clean ones.
SAMPLE = 3000
#: Inputs of the machine at most, and the least evidence (a G statistic) for one.
TERMS, EVIDENCE = 4096, 15.0
FACTORS = 8

_CUT = bytes(b + 32 if 65 <= b < 91 else b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else 32
             for b in range(256))


def words(text: str | None) -> set[bytes]:
    return set((text or "").encode("utf-8", "surrogatepass").translate(_CUT).split())


def hashed(word: bytes) -> set[int]:
    """Buckets of a word: itself and its first four and five bytes."""
    mask = BUCKETS - 1
    out = {zlib.crc32(word) & mask}
    for k in (4, 5):
        if len(word) > k:
            out.add(zlib.crc32(word[:k], k) & mask)
    return out


def terms(text: str | None) -> np.ndarray:
    found: set[int] = set()
    for w in words(text):
        found |= hashed(w)
    return np.fromiter(found, np.uint32, len(found))


@dataclass
class Machine:
    """w0, w and v of the selected terms; ``place`` maps a bucket to its row or -1."""

    w0: float
    w: np.ndarray
    v: np.ndarray
    place: np.ndarray
    _known: set = field(default_factory=set, repr=False)
    _live: dict = field(default_factory=dict, repr=False)
    _hot: set = field(default_factory=set, repr=False)

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """A worker remembers which words have an input; most have none."""
        out = np.full(len(texts), self.w0)
        if not len(self.w):
            return out
        for i, text in enumerate(texts):
            ws = words(text)
            new = ws - self._known
            if len(self._known) + len(new) > 400_000:
                for cache in (self._known, self._live, self._hot):
                    cache.clear()
                new = ws
            for word in new:
                rows = [r for r in (self.place[b] for b in hashed(word)) if r >= 0]
                if rows:
                    self._live[word] = rows
                    self._hot.add(word)
            self._known |= new
            rows = list({r for word in ws & self._hot for r in self._live[word]})
            if rows:
                v = self.v[rows]
                s = v.sum(0)
                out[i] += self.w[rows].sum() + 0.5 * float(s @ s - (v * v).sum())
        return out

    def predict(self, texts: list[str | None]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(texts), -500, 500)))

    def score(self, text: Column) -> Column:
        w0, w, v, place = self.w0, self.w, self.v, self.place   # at most 1.3 MB, with the task

        @F.pandas_udf("double")
        def toxicity_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            kept_in_worker("toxicity", dict)   # drops the caches of stages before
            machine = Machine(w0, w, v, place)
            for s in batches:
                parts = [machine.predict(part) for part in slices(s.tolist())]
                yield pd.Series(np.concatenate(parts) if parts else np.empty(0))
        return toxicity_score(text)


def select_terms(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Buckets with the largest G statistic of presence against label."""
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    have = [np.zeros(BUCKETS), np.zeros(BUCKETS)]
    for r, label in zip(rows, y):
        have[int(label)][r] += 1
    a, b = have[1], have[0]
    share = (a + b) / (n1 + n0)
    g = np.zeros(BUCKETS)
    for seen, n in ((a, n1), (b, n0)):
        for x, p in ((seen, share), (n - seen, 1 - share)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g += 2 * np.where(x > 0, x * np.log(x / (n * p)), 0.0)
    best = np.argsort(-g, kind="stable")[:TERMS]
    return best[g[best] >= EVIDENCE]


def train(rows: list[np.ndarray], y: np.ndarray, steps: int = 900, rate: float = 0.02,
          decay: float = 1e-4, pair_decay: float = 1e-3, scale: float = 0.01,
          heavier: float = 4.0, batch: int = 256, seed: int = 3) -> Machine:
    """Adam on the logistic loss over mini-batches of term rows."""
    chosen = select_terms(rows, y)
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen), dtype=np.int32)
    x = np.zeros((len(rows), len(chosen)), bool)
    for i, r in enumerate(rows):
        at = place[r]
        x[i, at[at >= 0]] = True
    rng = np.random.default_rng(seed)
    p = {"w0": np.zeros(1), "w": np.zeros(len(chosen)),
         "v": rng.normal(0, scale, (len(chosen), FACTORS))}
    m = {k: np.zeros_like(a) for k, a in p.items()}
    q = {k: np.zeros_like(a) for k, a in p.items()}
    t = 0
    while t < steps and len(chosen):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            pick, t = order[i:i + batch], t + 1
            xb = x[pick].astype(np.float64)
            s = xb @ p["v"]
            f = p["w0"] + xb @ p["w"] + 0.5 * ((s * s).sum(1) - xb @ (p["v"] ** 2).sum(1))
            d = (1 / (1 + np.exp(-np.clip(f, -500, 500))) - y[pick]) / len(pick)
            d *= np.where(y[pick] == 1, heavier, 1.0)
            xd = xb.T @ d
            grad = {"w0": np.array([d.sum()]), "w": xd + decay * p["w"],
                    "v": xb.T @ (d[:, None] * s) - xd[:, None] * p["v"] + pair_decay * p["v"]}
            for k, g in grad.items():
                m[k], q[k] = 0.9 * m[k] + 0.1 * g, 0.999 * q[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(q[k] / (1 - 0.999 ** t)) + 1e-8)
    return Machine(float(p["w0"][0]), p["w"], p["v"], place)


def _constant(share: float) -> Machine:
    share = min(max(share, 1e-9), 1 - 1e-9)
    return Machine(float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)),
                   np.full(BUCKETS, -1, np.int32))


def _rows(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> list[np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for part in slices(rows.column(0).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([terms(t).tobytes() for t in part], pa.binary())], names=["x"])

    wanted = F.broadcast(ids.select(F.col(id_col).alias("__id")).distinct())   # 2 x SAMPLE or so
    got = docs.join(wanted, docs[id_col] == F.col("__id"), "left_semi") \
        .select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "x binary").collect()
    return [np.frombuffer(bytes(r.x), np.uint32) for r in got]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", folds: int = 3, held: int = 1) -> Machine:
    """Fit on labelled rows whose crc32(id) mod ``folds`` is not ``held``."""
    seen = labels.select(id_col, F.col(label_col).alias("y")) \
        .filter(f"{id_col} is not null and y in (0, 1)") \
        .filter(crc_bucket(id_col, folds) != held).groupBy(id_col).agg(F.max("y").alias("y"))
    ones, zeros = (seen.filter(f"y = {y}").select(id_col) for y in (1, 0))
    n1, n0 = ones.count(), zeros.count()
    toxic = _rows(docs, few(ones, id_col, sample, 11), id_col, text_col) if n1 else []
    clean = _rows(docs, few(zeros, id_col, 2 * sample, 12), id_col, text_col) if n0 else []
    if not toxic or not clean:
        return _constant(n1 / (n1 + n0) if n1 + n0 else 0.0)
    machine = train(toxic + clean, np.repeat([1.0, 0.0], [len(toxic), len(clean)]))
    machine.w0 += float(np.log(n1 / n0) - np.log(len(toxic) / len(clean)))
    return machine


def score_documents(docs: DataFrame, machine: Machine, threshold: float = 0.7,
                    id_col: str = "doc_id", text_col: str = "text", folds: int = 3,
                    held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold) for every row."""
    scored = docs.select(F.col(id_col).alias("doc_id"),
                         (crc_bucket(id_col, folds) == held).alias("held_out"),
                         machine.score(F.col(text_col).cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
