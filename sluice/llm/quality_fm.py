"""Text quality by a factorisation machine over hashed words, structure statistics and size.

Features are cells: each distinct word by hash, with 1 / sqrt(number of distinct words); each structure statistic (shares of
capitals, digits, punctuation, bars, repeated words, ...) and the size of the text as one of a few steps, with value 1.
All pairs of features interact through vectors of `RANK` numbers, summed in linear time, since the sum over pairs is
half of (square of the sum - sum of the squares).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import common, flat, labelled

WORDS, STEPS, RANK = 1 << 16, 16, 8
FOLD, THRESHOLD = 5, 0.3

CLASSES = np.zeros((256, 8), np.float32)
CLASSES[65:91, 0] = 1  # capitals
CLASSES[97:123, 1] = 1
CLASSES[128:, 1] = 1
CLASSES[48:58, 2] = 1  # digits
CLASSES[[32, 9, 11, 12, 13], 3] = 1
CLASSES[10, 4] = 1  # line ends
CLASSES[[33, 35, 36, 37, 38, 42, 60, 61, 62, 64, 94, 95, 123, 125, 126, 92], 5] = 1  # marks that prose has few of
CLASSES[[34, 39, 40, 41, 44, 45, 46, 47, 58, 59, 63], 6] = 1  # punctuation of prose
CLASSES[[124, 91, 93, 96, 43], 7] = 1  # bars and brackets
KIND = CLASSES.argmax(1) + 1
KIND[CLASSES.sum(1) == 0] = 0

#: Statistics that are shares take steps of a root scale; sizes take steps of a log scale.
SHARES, SIZES = 10, 4
CELLS = WORDS + (SHARES + SIZES) * STEPS


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells, values and row borders: distinct words, then one step of each statistic."""
    rows = len(at) - 1
    word, row = flat.word_hashes(data, at)
    count = np.bincount(row, minlength=rows)
    cell = (word >> np.uint64(48)).astype(np.int64) % WORDS
    again = np.zeros(len(row), bool)
    again[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    packed = np.sort(row * WORDS + cell)
    fresh = np.ones(len(packed), bool)
    fresh[1:] = packed[1:] != packed[:-1]
    packed = packed[fresh]
    owner, cell = packed // WORDS, packed % WORDS
    distinct = np.bincount(owner, minlength=rows)

    size = np.diff(at)
    of = np.repeat(np.arange(rows), size)
    kinds = np.bincount(of * 9 + KIND[data], minlength=rows * 9).reshape(rows, 9).astype(float)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)
    solid = np.maximum(size - kinds[:, 4] - kinds[:, 5], 1)
    words = np.maximum(count, 1)
    shares = [
        kinds[:, 1] / letters, kinds[:, 3] / solid, kinds[:, 6] / solid, kinds[:, 7] / solid, kinds[:, 8] / solid, kinds[:, 5] / words,
        np.bincount(row[again], minlength=rows) / words, distinct / words, letters / solid, kinds[:, 4] / np.maximum(size, 1),
    ]
    steps = [np.minimum((np.sqrt(np.clip(s, 0, 1)) * STEPS).astype(int), STEPS - 1) for s in shares]
    sizes = [size, count, distinct, np.minimum(size / words, 1000) * 16]
    steps += [np.minimum(np.log2(np.maximum(s, 1)).astype(int), STEPS - 1) for s in sizes]
    statistic = np.stack([WORDS + k * STEPS + s for k, s in enumerate(steps)], axis=1)

    width = statistic.shape[1]
    begin = np.concatenate([[0], np.cumsum(distinct + width)])
    cells, values = np.empty(begin[-1], np.int64), np.ones(begin[-1], np.float32)
    word_at = np.arange(len(cell)) + owner * width
    cells[word_at] = cell
    values[word_at] = 1 / np.sqrt(np.maximum(distinct, 1))[owner]
    cells[(begin[1:, None] - width + np.arange(width)).ravel()] = statistic.ravel()
    return cells, values, begin


@dataclass(frozen=True)
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        cells, values, begin = features(data, at)
        vectors = self.factors[cells] * values[:, None]
        total, square = labelled.sums(vectors, begin), labelled.sums((vectors**2).sum(1), begin)
        pairs = ((total**2).sum(1) - square) / 2
        return labelled.sigmoid(self.bias + labelled.sums(self.linear[cells] * values, begin) + pairs)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], rounds: int = 4, rate: float = 0.1, shrink: float = 1e-4, seed: int = 7) -> Machine:
    """Logistic loss by adaptive gradient steps, one row after another; the cells of a row are distinct."""
    random = np.random.default_rng(seed)
    linear, factors = np.zeros(CELLS, np.float32), random.normal(0, 0.01, (CELLS, RANK)).astype(np.float32)
    linear_sum, factor_sum = np.full(CELLS, 1e-3, np.float32), np.full((CELLS, RANK), 1e-3, np.float32)
    share = (sum(r[0] for r in rows) + 1) / (len(rows) + 2)
    bias = float(np.log(share / (1 - share)))
    for _ in range(rounds):
        for i in random.permutation(len(rows)):
            label, cells, values = rows[i]
            own = factors[cells] * values[:, None]
            total = own.sum(0)
            odds = bias + linear[cells] @ values + (total @ total - (own**2).sum()) / 2
            gap = float(labelled.sigmoid(np.float64(odds))) - label
            slope = gap * values + shrink * linear[cells]
            linear_sum[cells] += slope**2
            linear[cells] -= rate * slope / np.sqrt(linear_sum[cells])
            slope = gap * values[:, None] * (total - own) + shrink * factors[cells]
            factor_sum[cells] += slope**2
            factors[cells] -= 0.3 * rate * slope / np.sqrt(factor_sum[cells])
            bias -= 0.01 * gap
    return Machine(bias, linear, factors)


def held_out() -> F.Column:
    return common.crc_share(F.col("doc_id"), FOLD) == 0


def fit(documents: DataFrame, labels: DataFrame, sample: int = labelled.SAMPLE) -> Machine:
    """A machine from at most `sample` labelled rows outside the held-out fold."""
    rows = labelled.sample_of(labels, "quality", ~held_out(), sample)
    return train(labelled.gathered(documents, rows, features))


def quality(documents: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of `documents` (doc_id, text; no other column is read).

    score is the probability of a good text. A null or empty text has no words and the first step of each statistic, and a
    score like any other. Repeated rows and rows without doc_id are scored like any other; the latter are held out. An
    empty table gives an empty result; without labelled rows every score is near one half.
    """
    return labelled.scored(documents, held_out(), machine.score, threshold)


def good(documents: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    return labelled.kept(documents, machine.score, threshold, above=True)
