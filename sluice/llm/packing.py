"""Best-fit packing planned over a histogram of lengths.

Texts become ids once. Longer ones are cut into full sequences and a shorter first piece, so at most `room` lengths remain,
whatever the number of documents. Best fit, longest first, then runs over the counts: groups of sequences with equal contents take as many
pieces of a length as fit, and a group is split where a count ends. The plan is a short list of groups; each piece
finds its place by its rank within its length.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm import common

ROOM, END = 1024, 2
TOKENIZER = "byte_bpe_50k.json"
#: Ranks within a length are counted in this many shares of it.
SHARES = 64
SPECIAL = "<|endoftext|>"
_encoders: dict = {}


def encoder():
    """Ids of a text. The plain vocabulary file gives the same ids faster for texts of common letters; others, and texts that
    hold the special token, go to the tokenizer itself."""
    if "ids" not in _encoders:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
        lines = open(public_tokenizers.path(TOKENIZER.replace(".json", ".tiktoken")), "rb").read().split()
        ranks = {base64.b64decode(a): int(b) for a, b in zip(lines[::2], lines[1::2], strict=True)}
        fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def ids(text: str) -> np.ndarray:
            if SPECIAL in text or (not text.isascii() and max(text) > "ɏ"):
                found = whole.encode(text, add_special_tokens=False).ids
            else:
                found = fast.encode_ordinary(text)
            found.append(END)
            return np.array(found, np.uint32)

        _encoders["ids"] = ids
    return _encoders["ids"]


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
PIECES_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut(room: int, with_ids: bool):
    """Pieces of each text's ids; only a text of more than `room` ids has more than one, and only its first may be shorter."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder()
        for batch in batches:
            for at in range(0, len(batch), 256):
                out: list[tuple] = []
                for doc_id, text in zip(batch.column("doc_id")[at : at + 256].to_pylist(), batch.column("text")[at : at + 256].to_pylist(), strict=True):
                    ids = ids_of(text or "")
                    first = len(ids) % room or room
                    edges = [0, *range(min(first, len(ids)), len(ids) + 1, room)]
                    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                        raw = ids[a:b].astype("<u4").tobytes()
                        out.append((doc_id, k, a, b - a, zlib.crc32(raw), raw if with_ids else None))
                rows = common.record(PIECES, **dict(zip(PIECES.names, zip(*out, strict=True), strict=True)))
                yield rows if with_ids else rows.drop_columns(["ids"])

    return work


def plan(histogram: dict[int, int], room: int = ROOM) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first sequence, offset) of runs of places: rank r of a length goes to sequence first + r.

    Best fit, longest first. Sequences with equal contents are one group (first sequence, number, filled), kept by the
    room left; `open_` holds the amounts of room of which there are groups, ascending.
    """
    places: list[tuple[int, int, int, int, int]] = []
    groups: dict[int, list[tuple[int, int]]] = {}
    open_: list[int] = []
    sequences = 0

    def put(left: int, first: int, number: int) -> None:
        if left not in groups:
            groups[left] = []
            insort(open_, left)
        groups[left].append((first, number))

    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while rank < count:
            at = bisect_left(open_, length)
            if at == len(open_):
                # As many fresh sequences as the rest needs, each as full of this length as it can be.
                number = max(1, (count - rank) // (room // length))
                put(room, sequences, number)
                sequences += number
                at = bisect_left(open_, room)
            left = open_[at]
            first, number = groups[left].pop()
            if not groups[left]:
                del groups[left]
                open_.pop(at)
            taken = min(number, count - rank)
            places.append((length, rank, taken, first, room - left))
            rank += taken
            put(left - length, first, taken)
            if taken < number:
                put(left, first + taken, number - taken)
    return places


def packed(documents: DataFrame, room: int = ROOM, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of each piece of `documents` (doc_id, text), and `ids` if asked for.

    A null or empty text is the end id alone. Rows without doc_id and repeated rows are packed like any other. An empty
    table gives an empty result. Columns beside doc_id and text are not read.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = docs.mapInArrow(cut(room, with_ids), PIECES_DDL + (", ids binary" if with_ids else ""))
    # Ranks need an order that a lost task gives again: the written rows, by share, id, piece and contents.
    share = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SHARES)).cast("int")
    pieces = common.keep(pieces.withColumn("share", share), "packing-pieces")
    counts = pieces.groupBy("length", "share").count().collect()  # at most room * SHARES rows
    histogram: dict[int, int] = {}
    before: list[tuple[int, int, int]] = []
    for length, part, n in sorted((r["length"], r["share"], r["count"]) for r in counts):
        before.append((length, part, histogram.get(length, 0)))
        histogram[length] = histogram.get(length, 0) + n
    runs = plan(histogram, room)
    spark = documents.sparkSession
    # Both tables are bounded by the number of lengths and shares, not by the documents.
    begun = spark.createDataFrame(before, "length bigint, share int, before bigint")
    places = spark.createDataFrame(runs, "length bigint, first_rank bigint, number bigint, first_sequence bigint, offset bigint")

    order = Window.partitionBy("length", "share").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.withColumn("row", F.row_number().over(order) - 1).join(F.broadcast(begun), ["length", "share"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("row")).drop("row", "before", "share")
    slots = places.select("length", "first_rank", "number", "first_sequence", "offset")
    inside = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("number"))
    out = ranked.join(F.broadcast(slots.withColumnRenamed("length", "of")), (F.col("length") == F.col("of")) & inside)
    sequence = F.col("first_sequence") + F.col("rank") - F.col("first_rank")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset"]
    return out.select(*columns, *(["ids"] if with_ids else []))
