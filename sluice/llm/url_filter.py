"""URL filters: rules first, then logistic regression on hashed character n-grams of host and path.

Host, path and rules are plain columns. The model is fitted on a small table of labelled URLs; where none is given, on a
bounded sample of the URLs that the rules judge, so that it carries the rules over to hosts they do not name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import common, flat, labelled

CELLS, LENGTHS = 1 << 18, (2, 3, 4, 5)
#: Labelled URLs used at most: those first by a hash of the URL.
SAMPLE = 10_000

#: Host, start of the path, verdict.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Between the first :// and /, ?, # or the end, A-Z lower-cased; from there to ?, # or the end; empty without ://."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    place = F.locate("://", url)
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*+)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*+([^?#]*+)", 1)


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """The pages with host, path, rule and the rule's verdict; the longest rule that fits wins."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rows.select("*", rule.alias("rule"), verdict.alias("by_rule"))


def features(host: pa.Array, path: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells of each row's n-grams of bytes, host and path apart, and where each row's begin."""
    parts = []
    for k, column in enumerate((host, path)):
        data, at = flat.buffers(column)
        # A mark stands before and after each string, so that n-grams know its ends.
        spread = np.zeros(len(data) + 2 * (len(at) - 1), np.uint8)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        spread[np.arange(len(data)) + 2 * row + 1] = data
        borders = at + 2 * np.arange(len(at))
        owner = np.repeat(np.arange(len(at) - 1), np.diff(borders))
        sums = flat.prefix_hash(spread, flat.FOLDED)
        for n in LENGTHS:
            first = np.arange(max(0, len(spread) - n + 1))
            first = first[owner[first] == owner[first + n - 1]] if len(first) else first
            cell = (flat.range_hash(sums, first, first + n) ^ flat.PLACES[90 + k]) >> np.uint64(46)
            parts.append(owner[first] * CELLS + cell.astype(np.int64) % CELLS)
    packed = np.unique(np.concatenate(parts))
    return packed % CELLS, np.searchsorted(packed, np.arange(len(host) + 1) * CELLS)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray

    def score(self, host: pa.Array, path: pa.Array) -> np.ndarray:
        """Probability that a URL is to be blocked."""
        cells, begin = features(host, path)
        size = np.sqrt(np.maximum(np.diff(begin), 1))
        return labelled.sigmoid(self.bias + labelled.sums(self.weights[cells], begin) / size)


def train(labels: np.ndarray, host: pa.Array, path: pa.Array, rounds: int = 8, rate: float = 0.3, seed: int = 5) -> Model:
    """Logistic loss by adaptive gradient steps; the cells of a row are distinct."""
    weights, squares = np.zeros(CELLS, np.float32), np.full(CELLS, 1e-2, np.float32)
    if not len(labels):
        return Model(0.0, weights)
    cells, begin = features(host, path)
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in random.permutation(len(labels)):
            own = cells[begin[i] : begin[i + 1]]
            scale = 1 / max(len(own), 1) ** 0.5
            slope = (float(labelled.sigmoid(np.float64(bias + weights[own].sum() * scale))) - labels[i]) * scale
            squares[own] += slope * slope
            weights[own] -= rate * slope / np.sqrt(squares[own])
    return Model(bias, weights)


def fit(labelled_urls: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from (host, path, label), label 1 for block; at most `sample` rows, first by hash."""
    rows = labelled_urls.select("host", "path", F.col("label").cast("int").alias("label")).where("label is not null").distinct()
    rows = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(sample).collect()
    return train(np.array([r["label"] for r in rows]), pa.array([r["host"] for r in rows], pa.string()), pa.array([r["path"] for r in rows], pa.string()))


JUDGED = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("score", pa.float64())])


def filtered(pages: DataFrame, labelled_urls: DataFrame | None = None, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict and score of each row of `pages` (page_id, url; no other column is read).

    The verdict is the rule's where one fits, else block where the model's probability of it is one half or more. A
    null url, or one without ://, has an empty host and path, fits no rule and is judged by the model. Repeated rows and rows without
    page_id are judged like any other. An empty table gives an empty result; without labelled URLs the model allows none.
    """
    rows = judged(pages, rules)
    known = labelled_urls
    if known is None:
        known = rows.where("by_rule is not null").select("host", "path", (F.col("by_rule") == "block").cast("int").alias("label"))
    model = fit(known, sample)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 4096):
                batch = whole.slice(at, 4096)
                score = model.score(batch.column("host"), batch.column("path"))
                verdict = np.where(score >= 0.5, "block", "allow")
                verdict = [r or m for r, m in zip(batch.column("by_rule").to_pylist(), verdict.tolist(), strict=True)]
                yield common.record(JUDGED, **{c: batch.column(c) for c in ("page_id", "host", "path", "rule")}, verdict=verdict, score=score)

    return rows.mapInArrow(work, "page_id bigint, host string, path string, rule string, verdict string, score double")
