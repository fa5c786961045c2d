"""Toxicity by a chain of linear classifiers.

The categories have an order. The model of each is a logistic regression on hashed words, and on the probabilities of
the categories before it. For training, those are out-of-fold: each labelled text gets them from models that have not
seen it, so a later model learns from probabilities as good as those it will get.

Training takes a bounded sample of the labelled rows, ``SAMPLE`` of them, those with the smallest hash; only their
hashed words reach the driver. Scoring is one pass over all whole texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import bounded_batches, col, require_free

SAMPLE = 24_000
FOLDS = 3
BUCKETS = 1 << 18
ROUNDS = 200
DECAY = 1e-4
# A bucket is used if its share among the rows of either answer differs by so many standard errors: words that tell
# nothing would let a model learn its rows by heart.
LEAST_Z = 4.0


@dataclass(frozen=True)
class Chain:
    categories: list[str]
    weights: list[np.ndarray]  # by category: words, then the categories before it, then the constant


def sampled(labels: DataFrame, categories: list[str], key: str = "doc_id", most: int = SAMPLE, seed: int = 42) -> DataFrame:
    """Up to ``most`` rows of ``labels`` with a key and a label (0 or 1) for every category, one per key.

    Those with the smallest hash of key and seed. Where a key repeats, a label is the greatest one given.
    """
    whole = labels.dropna(subset=[key, *categories]).groupBy(col(key).alias("id")).agg(
        *(F.max(col(c).cast("int")).alias(c) for c in categories)
    )
    return whole.orderBy(F.xxhash64(F.lit(seed), F.col("id")), "id").limit(most)


def trained(df: DataFrame, labels: DataFrame, categories: list[str], text: str = "text", key: str = "doc_id") -> Chain:
    """A chain in the order of ``categories``, from the texts of ``labels`` (``id`` and one column per category).

    ``labels`` must be bounded, as ``sampled`` is. Without any rows all probabilities are one half.
    """
    bounded_batches(df)
    rows = df.select(col(key).alias("id"), col(text).alias("text")).join(F.broadcast(labels), "id")
    rows = rows.select("id", *map(col, categories), F.arrow_udf(_hashing, "binary")(F.col("text")).alias("cells"))
    found = rows.orderBy("id", "cells").collect()
    cells = [np.frombuffer(r.cells, "<u4").astype(np.int64) for r in found]
    truth = np.array([[r[c] for c in categories] for r in found], float).reshape(len(found), len(categories))
    fold = np.arange(len(found)) % FOLDS
    weights, before = [], np.empty((len(found), 0))
    for at in range(len(categories)):
        out = np.empty(len(found))
        for k in range(FOLDS):
            seen = fold != k
            out[~seen] = _probabilities(_fitted(cells, before, truth[:, at], seen), cells, before, ~seen)
        weights.append(_fitted(cells, before, truth[:, at], np.ones(len(found), bool)).astype(np.float32))
        before = np.column_stack([before, out])
    return Chain(list(categories), weights)


def scored(df: DataFrame, chain: Chain, text: str = "text", prefix: str = "p_") -> DataFrame:
    """``df`` with the probability of each category (``p_`` and its name); of an empty or null text, that of no words."""
    names = [prefix + c for c in chain.categories]
    require_free(df, *names)
    bounded_batches(df)
    found = F.arrow_udf(_scoring(chain), "array<double>")(col(text))
    (hidden,) = [x for x in ("_p", "_p_", "_p__") if x not in df.columns][:1]
    return df.withColumn(hidden, found).select(
        *map(col, df.columns), *(F.get(col(hidden), F.lit(k)).alias(n) for k, n in enumerate(names))
    )


def _cells(text: str | None) -> np.ndarray:
    """Buckets of the different words of a text."""
    import re
    from zlib import crc32

    words = set(re.findall(r"[^\W\d_]+", text.lower())) if text else ()
    return np.unique(np.fromiter((crc32(w.encode()) % BUCKETS for w in words), np.int64))


def _hashing(texts: pa.Array) -> pa.Array:
    return pa.array([_cells(x.as_py()).astype("<u4").tobytes() for x in texts], pa.binary())


def _joined(cells: list[np.ndarray], mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chosen = [c for c, m in zip(cells, mask) if m]
    lengths = np.array([len(c) for c in chosen], np.int64)
    return np.concatenate([*chosen, np.empty(0, np.int64)]), np.repeat(np.arange(len(chosen)), lengths)


def _linear(weights: np.ndarray, flat: np.ndarray, owner: np.ndarray, before: np.ndarray) -> np.ndarray:
    extra = before.shape[1]
    sums = np.bincount(owner, weights[flat], len(before))
    return sums + before @ weights[BUCKETS : BUCKETS + extra] + weights[-1]


def _fitted(cells: list[np.ndarray], before: np.ndarray, truth: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression, by a fixed number of Adam steps over all rows, with equal weight for both
    answers."""
    flat, owner = _joined(cells, mask)
    before, truth = before[mask], truth[mask]
    telling = _telling(flat, owner, truth)
    flat, owner = flat[telling[flat]], owner[telling[flat]]
    size = BUCKETS + before.shape[1] + 1
    weights, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    if len(truth) == 0:
        return weights
    share = np.clip(truth.mean(), 0.5 / len(truth), 1 - 0.5 / len(truth))
    balance = np.where(truth > 0.5, 0.5 / share, 0.5 / (1 - share)) / len(truth)
    for step in range(1, ROUNDS + 1):
        error = (1 / (1 + np.exp(-np.clip(_linear(weights, flat, owner, before), -30, 30))) - truth) * balance
        slope = np.concatenate([np.bincount(flat, error[owner], BUCKETS), before.T @ error, [error.sum()]])
        slope += DECAY * weights
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        rate = 0.1 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weights -= rate * mean / (np.sqrt(square) + 1e-4)
    return weights


def _telling(flat: np.ndarray, owner: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Buckets whose share of rows differs between the two answers beyond chance."""
    n, n_yes = len(truth), truth.sum()
    rows = np.bincount(flat, minlength=BUCKETS)
    yes = np.bincount(flat, truth[owner], BUCKETS)
    share = rows / n
    error = np.sqrt(share * (1 - share) * (1 / max(n_yes, 1) + 1 / max(n - n_yes, 1)))
    return np.abs(yes / max(n_yes, 1) - (rows - yes) / max(n - n_yes, 1)) >= LEAST_Z * error + 1e-12


def _probabilities(weights: np.ndarray, cells: list[np.ndarray], before: np.ndarray, mask: np.ndarray) -> np.ndarray:
    flat, owner = _joined(cells, mask)
    return 1 / (1 + np.exp(-np.clip(_linear(weights, flat, owner, before[mask]), -30, 30)))


def _scoring(chain: Chain):
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows: list[list[float]] = []
            for at in range(0, len(texts), 128):
                cells = [_cells(x.as_py()) for x in texts.slice(at, 128)]
                mask, before = np.ones(len(cells), bool), np.empty((len(cells), 0))
                for weights in chain.weights:
                    before = np.column_stack([before, _probabilities(weights, cells, before, mask)])
                rows += before.tolist()
            yield pa.array(rows, pa.list_(pa.float64()))

    return score
