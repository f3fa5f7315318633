"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of letters and digits in lower case; features are the distinct words, pairs of neighbours and pairs with one
word between. Every coordinate has its own rate, and an L1 penalty keeps most weights at exactly zero, so the model is
the few cells that are not, which are small enough to send to every task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import common, flat, labelled

CELLS = 1 << 22
FOLD, HELD, THRESHOLD = 3, 1, 0.7
#: POSITIVE: how much a toxic row counts; they are few.
ALPHA, BETA, L1, L2, POSITIVE = 3.0, 1.0, 20.0, 0.0, 4.0


def grams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and row of every word, pair of neighbours and pair over one word, repeats included."""
    word, row = flat.word_hashes(data, at, flat.MARKS)
    parts, rows = [word], [row]
    for gap in (1, 2):
        if len(word) > gap:
            pair = row[gap:] == row[:-gap]
            parts.append((flat.mix(word[:-gap] * flat.PLACES[70 + gap] + word[gap:] * flat.PLACES[80 + gap]))[pair])
            rows.append(row[gap:][pair])
    return (np.concatenate(parts) >> np.uint64(42)).astype(np.int64), np.concatenate(rows)


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cells of each row; their value is 1 throughout and not read."""
    cell, row = grams(data, at)
    packed = np.unique(row * CELLS + cell)
    begin = np.searchsorted(packed, np.arange(len(at)) * CELLS)
    return packed % CELLS, np.zeros(len(packed), np.float32), begin


@dataclass(frozen=True)
class Weights:
    """The cells whose weight is not zero, ascending."""

    bias: float
    cells: np.ndarray
    values: np.ndarray

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        cell, row = grams(data, at)
        used = np.zeros(CELLS, bool)
        used[self.cells] = True
        hit = used[cell]
        packed = np.unique(row[hit] * CELLS + cell[hit])
        value = self.values[np.searchsorted(self.cells, packed % CELLS)] if len(packed) else np.zeros(0)
        return labelled.sigmoid(self.bias + np.bincount(packed // CELLS, weights=value, minlength=len(at) - 1))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], rounds: int = 4, seed: int = 3) -> Weights:
    """FTRL-proximal, one row after another; the bias is a coordinate of its own without penalty."""
    z, n = np.zeros(CELLS), np.zeros(CELLS)
    bias_z = bias_n = 0.0
    random = np.random.default_rng(seed)

    def weight(z_at: np.ndarray, n_at: np.ndarray) -> np.ndarray:
        out = (np.sign(z_at) * L1 - z_at) / ((BETA + np.sqrt(n_at)) / ALPHA + L2)
        return np.where(np.abs(z_at) <= L1, 0.0, out)

    def bias() -> float:
        return -bias_z / ((BETA + bias_n**0.5) / ALPHA)

    for _ in range(rounds):
        for i in random.permutation(len(rows)):
            label, cells, _ = rows[i]
            now = weight(z[cells], n[cells])
            gap = float(labelled.sigmoid(np.float64(bias() + now.sum()))) - label
            gap *= POSITIVE if label else 1.0
            step = (np.sqrt(n[cells] + gap * gap) - np.sqrt(n[cells])) / ALPHA
            z[cells] += gap - step * now
            n[cells] += gap * gap
            step = ((bias_n + gap * gap) ** 0.5 - bias_n**0.5) / ALPHA
            bias_z += gap - step * bias()
            bias_n += gap * gap
    kept = np.flatnonzero(np.abs(z) > L1)
    return Weights(bias(), kept, weight(z[kept], n[kept]))


def held_out() -> F.Column:
    return common.crc_share(F.col("doc_id"), FOLD) == HELD


def fit(documents: DataFrame, labels: DataFrame, sample: int = labelled.SAMPLE) -> Weights:
    """Weights from at most `sample` labelled rows outside the held-out fold."""
    rows = labelled.sample_of(labels, "toxic", ~held_out(), sample)
    return train(labelled.gathered(documents, rows, features))


def toxicity(documents: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of `documents` (doc_id, text; no other column is read).

    score is the probability of a toxic text. A null or empty text scores as the bias alone. Repeated rows and rows without
    doc_id are scored like any other; the latter are not held out. An empty table gives an empty result; without labelled rows
    every score is one half.
    """
    return labelled.scored(documents, held_out(), weights.score, threshold)
