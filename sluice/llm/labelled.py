"""Bounded, documented samples of labelled rows, and sparse features as they travel between tasks and the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import common, flat

#: Labelled rows that a model is fitted on at most: those first by a hash of their id.
SAMPLE = 12_000

ROWS = pa.schema([("label", pa.int32()), ("cells", pa.binary()), ("values", pa.binary())])

#: From bytes and row borders: cells, values, and where each row's begin.
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def sample_of(labels: DataFrame, label: str, wanted: Column, most: int = SAMPLE) -> DataFrame:
    """doc_id and label of at most `most` labelled rows, the first by a hash of the id; rows of one id with both labels count twice."""
    rows = labels.where(wanted & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col(label) > 0).cast("int").alias("label")).distinct()
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)


def gathered(documents: DataFrame, sample: DataFrame, features: Features) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Features of the sampled rows, on the driver: as many rows as the sample has, once for each text of an id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat.buffers(batch.column("text"))
            label = batch.column("label").to_numpy()
            for a, b in flat.slices(at):
                cells, values, begin = features(data[at[a] : at[b]], at[a : b + 1] - at[a])
                parts = range(b - a)
                yield common.record(
                    ROWS, label=label[a:b],
                    cells=[cells[begin[i] : begin[i + 1]].astype(np.int32).tobytes() for i in parts],
                    values=[values[begin[i] : begin[i + 1]].astype(np.float32).tobytes() for i in parts],
                )

    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The sample is bounded, so it may be broadcast.
    joined = texts.join(F.broadcast(sample), "doc_id").select("text", "label")
    rows = joined.mapInArrow(work, "label int, cells binary, values binary").collect()
    found = [(r["label"], np.frombuffer(r["cells"], np.int32), np.frombuffer(r["values"], np.float32)) for r in rows]
    # One order whatever the partitions.
    return sorted(found, key=lambda r: (r[1].tobytes(), r[0]))


SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def scored(documents: DataFrame, held_out: Column, score: Callable[[np.ndarray, np.ndarray], np.ndarray], threshold: float) -> DataFrame:
    """doc_id, held_out, score and predicted of each row, from its whole text; a null text is an empty one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat.buffers(batch.column("text"))
            values = [score(data[at[a] : at[b]], at[a : b + 1] - at[a]) for a, b in flat.slices(at)]
            values = np.concatenate(values) if values else np.zeros(0)
            yield common.record(SCORED, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), score=values, predicted=(values >= threshold).astype(np.int32))

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    return rows.mapInArrow(work, "doc_id bigint, held_out boolean, score double, predicted int")


def kept(documents: DataFrame, score: Callable[[np.ndarray, np.ndarray], np.ndarray], threshold: float, above: bool) -> DataFrame:
    """The documents, all columns as they are, whose score is at or above the threshold, or those below it."""
    at_text = documents.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat.buffers(batch.column(at_text))
            values = [score(data[at[a] : at[b]], at[a : b + 1] - at[a]) for a, b in flat.slices(at)]
            good = (np.concatenate(values) >= threshold) == above if values else np.zeros(0, bool)
            yield batch.take(pa.array(np.flatnonzero(good)))

    return documents.mapInArrow(work, documents.schema)


def sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sum of each row's values, in double precision."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[begin[1:]] - total[begin[:-1]]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
