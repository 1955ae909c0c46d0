"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled text are all it needs.  The class prior is
estimated first: a logistic model tells positives from unlabelled rows on one
half of the sample; on the other half, the share of unlabelled over the share of
positives above the best threshold bounds the prior (best-bin estimate).  Then a
logistic model minimises the non-negative unbiased risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)),

and where the second part turns negative, the step goes against it.  With the
logistic loss its output estimates the posterior, a score from 0 to 1.

Fitting is bounded: at most ``MAX_POSITIVES`` labelled positives and
``MAX_UNLABELLED`` rows, chosen by hash over the whole training table, reach the
driver as feature rows.  Scoring is narrow and covers every whole text.

Features are counted over the whole text: lengths, repetition, character classes
and a hashed profile of word shapes (letters, digits and signs with runs
collapsed), so no vocabulary is kept.

Defined results: NULL and empty texts have the features of no words and are scored like
any other; labels that are NULL or contradict each other are not used; without
positives every score is 0.5; of a key with several training rows one text is learned from;
repeated rows each get a result; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import keep_rows, worker_state

#: Rows that the fit uses at most.
MAX_POSITIVES, MAX_UNLABELLED = 5_000, 10_000
#: Buckets of word shapes; words of a window for repetition.
SHAPES, WINDOW = 128, 32
PLAIN = 9
FEATURES = PLAIN + SHAPES


def _classes() -> np.ndarray:
    """Shape class of each character of the basic plane: X, x, 9, the sign itself if ASCII, else o; blanks are blanks."""
    return worker_state("quality", _class_table)


def _class_table() -> np.ndarray:
    table = np.full(0x10000, ord("o"), dtype=np.uint8)
    for i in range(0x10000):
        c = chr(i)
        if c.isspace():
            table[i] = 32
        elif c.isupper():
            table[i] = ord("X")
        elif c.isalpha():
            table[i] = ord("x")
        elif c.isdigit():
            table[i] = ord("9")
        elif i < 128:
            table[i] = i
    return table


def features(text: str | None) -> np.ndarray:
    out = np.zeros(FEATURES, dtype=np.float32)
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return out
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    shape = _classes()[np.minimum(codes, 0xFFFF)]
    count = np.bincount(shape, minlength=256)
    letters, dense = count[88] + count[120], len(shape) - count[32]
    low = text.lower().split()
    repeated = sum(a == b for a, b in zip(low, low[1:]))
    fresh = sum(len(set(low[i:i + WINDOW])) for i in range(0, n, WINDOW))
    lines = [x for x in text.split("\n") if x.strip()]
    out[:PLAIN] = (np.log1p(n), repeated / n, fresh / n, count[88] / max(1, letters), 1 - (letters + count[57]) / max(1, dense),
                   count[57] / max(1, dense), min(dense / n, 40.0), min(len(lines) / n, 1.0),
                   1 - len(set(lines)) / max(1, len(lines)))
    kept = shape[np.concatenate(([True], shape[1:] != shape[:-1]))]
    for s, c in Counter(kept.tobytes().split()).items():
        out[PLAIN + zlib.crc32(s) % SHAPES] += c / n
    out[PLAIN:] = np.sqrt(out[PLAIN:])
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _adam(gradient, size: int, steps: int, rate: float = 0.05) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def class_prior(pos: np.ndarray, unl: np.ndarray, l2: float = 1e-3) -> float:
    """Best-bin estimate of the share of positives among unlabelled rows (rows end with a 1)."""
    fit_p, fit_u, est_p, est_u = pos[::2], unl[::2], pos[1::2], unl[1::2]
    if not min(len(fit_p), len(fit_u), len(est_p), len(est_u)):
        return 0.5
    w = _adam(lambda w: l2 * w - fit_p.T @ _sigmoid(-fit_p @ w) / len(fit_p) + fit_u.T @ _sigmoid(fit_u @ w) / len(fit_u),
              pos.shape[1], 150)
    sp, su = np.sort(est_p @ w), np.sort(est_u @ w)
    slack = np.sqrt(np.log(40) / (2 * len(sp))) + np.sqrt(np.log(40) / (2 * len(su)))
    edges = np.unique(np.quantile(sp, np.linspace(0, 0.95, 96)))
    share_p = 1 - np.searchsorted(sp, edges, side="left") / len(sp)
    share_u = 1 - np.searchsorted(su, edges, side="left") / len(su)
    best = np.argmin((share_u + slack) / share_p)
    return float(np.clip(share_u[best] / share_p[best], 0.01, 0.99))


def nn_pu(pos: np.ndarray, unl: np.ndarray, prior: float, l2: float = 1e-3, steps: int = 400) -> np.ndarray:
    """Weights that minimise the non-negative unbiased risk under the logistic loss."""
    soft = lambda z: np.logaddexp(0, z)

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = pos @ w, unl @ w
        plus = -prior * (pos.T @ _sigmoid(-zp)) / len(pos)
        minus = unl.T @ _sigmoid(zu) / len(unl) - prior * (pos.T @ _sigmoid(zp)) / len(pos)
        negative = soft(zu).mean() - prior * soft(zp).mean()
        return l2 * w + (plus + minus if negative >= 0 else -minus)

    return _adam(gradient, pos.shape[1], steps)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray | None                # the intercept last; None: nothing was learned
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    prior: float = 0.5

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), 0.5)
        z = np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]
        return _sigmoid(z)


def fit(pos: np.ndarray, unl: np.ndarray) -> Model:
    if not len(pos) or not len(unl):
        return Model(None)
    both = np.concatenate([pos, unl]).astype(np.float64)
    mean, scale = both.mean(axis=0), both.std(axis=0)
    scale[scale < 1e-6] = 1.0
    ready = lambda x: np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    pos, unl = ready(pos), ready(unl)
    prior = class_prior(pos, unl)
    return Model(nn_pu(pos, unl, prior), mean, scale, prior)


def _hash_share(key: str):
    return F.pmod(F.xxhash64(F.lit("quality sample"), key), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _bounded(ids: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows of ``ids``, by hash of the key."""
    n = ids.count()
    share = _hash_share(key)
    return ids.where(share * n < 1.2 * most + 50).orderBy(share, key).limit(most)


def _feature_rows(docs: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t.as_py()).tobytes() for t in b.column("text")]
            yield pa.record_batch([pa.array(rows, pa.binary())], names=["f"])

    rows = docs.select("text").mapInArrow(run, "f binary").collect()
    return np.stack([np.frombuffer(r["f"], dtype=np.float32) for r in sorted(rows)]) if rows else np.zeros((0, FEATURES))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """A model from the training rows ``docs``, of which ``labels`` marks trusted positives (1)."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key IS NOT NULL")
    trusted = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")) \
        .groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo = 1 AND hi = 1").select("key")
    # Keys alone are chosen first; at most the given numbers of them are sent to the scan of the texts.
    ids = source.select("key")
    of_positive = _bounded(trusted.join(ids.distinct(), "key", "left_semi"), "key", max_positives)
    of_unlabelled = _bounded(ids, "key", max_unlabelled).distinct()
    # Of a repeated key one text counts, so the driver gets a row per chosen key at most.
    chosen = lambda keys: _feature_rows(source.join(F.broadcast(keys), "key", "left_semi")
                                        .groupBy("key").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    return fit(chosen(of_positive), chosen(of_unlabelled))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` for every row."""
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    key_type = source.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                rows = np.stack([features(t.as_py()) for t in part.column("t")])
                yield pa.record_batch([part.column("k"), pa.array(model.score(rows))], names=["k", "score"])

    return source.mapInArrow(run, f"k {key_type}, score double").withColumnRenamed("k", key)


def keep(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that score ``threshold`` or more."""
    def judge():
        return lambda texts: model.score(np.stack([features(t) for t in texts])) >= threshold if texts else []

    return keep_rows(docs, text, judge)
