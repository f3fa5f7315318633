"""Merkle manifest of a dataset as a persistent tree: a tampered leaf makes a version that copies only its ancestors.

Leaves stand in the order of their ids within their source, sixteen to a node. Nodes are worked on in aligned blocks of
`SPAN` places: a task holds the levels of one block, and a version of it is the list of the copied ancestors of one leaf,
which shares every other node with the untampered tree. What stands above a block is the path of its root, found the same
way over the roots of all blocks, and over those of the sources; each version goes on along that path where its block is.
No source, however large, is in one task.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm import common

ARITY, LEVELS = 16, 3
#: Places of a block.
SPAN = ARITY**LEVELS
#: Bytes of one part of the range exchange that gives leaves their places.
PART = 32 << 20

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(total: int) -> int:
    """Levels above `total` nodes until one is left."""
    levels = 0
    while total > 1:
        total, levels = -(-total // ARITY), levels + 1
    return levels


def grown(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and the levels above them."""
    tree = [nodes]
    for _ in range(levels):
        below = tree[-1]
        tree.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return tree


def path(tree: list[list[str]], place: int) -> list[tuple[str, str]]:
    """For each level what stands left and right of the node's run, digests one after the other."""
    steps = []
    for level in tree[:-1]:
        run = place - place % ARITY
        steps.append(("".join(level[run:place]), "".join(level[place + 1 : run + ARITY])))
        place //= ARITY
    return steps


def version(node: str, steps: Iterable[tuple[str, str]]) -> list[str]:
    """The nodes that a version copies when a leaf becomes `node`: itself and its ancestors. All others are shared."""
    copied = [node]
    for left, right in steps:
        copied.append(digest(left + copied[-1] + right))
    return copied


def spelled(steps: Iterable[tuple[str, str]]) -> str:
    return "/".join(f"{left}:{right}" for left, right in steps)


def steps_of(spelled_path: str) -> list[tuple[str, str]]:
    return [tuple(step.split(":")) for step in spelled_path.split("/")] if spelled_path else []


def ranked(rows: DataFrame, purpose: str, key: str, *order: str) -> DataFrame:
    """The rows with `place`, from 0 in this order within their key, and `total`, the rows of the key.

    Rows are laid out by range, so a large key spans many parts; places follow from counts per key and part. The order
    must tell all rows apart.
    """
    laid = rows.repartitionByRange(common.parts(rows, PART), key, *order).sortWithinPartitions(key, *order)
    laid = common.keep(laid.withColumn("spot", F.monotonically_increasing_id()), purpose)
    laid = laid.withColumn("part", F.shiftright("spot", 33))
    counts = laid.groupBy(key, "part").agg(F.count("*").alias("rows"), F.min("spot").alias("first"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("rows").over(before), F.lit(0))
    offsets = counts.select(key, "part", (ahead - F.col("first")).alias("shift"), F.sum("rows").over(Window.partitionBy(key)).alias("total"))
    placed = laid.join(offsets, [key, "part"])
    return placed.select(*rows.columns, (F.col("spot") + F.col("shift")).alias("place"), "total")


def blocks(frame: DataFrame) -> DataFrame:
    """Rows of a block (key, block) side by side, by place. A block has at most `SPAN` places."""
    return frame.repartition("key", "block").sortWithinPartitions("key", "block", "place")


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of all batches, one after the other, grouped by their first two columns."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns), strict=True))
    return itertools.groupby(rows, key=itemgetter(0, 1))


def batched(rows: Iterable[tuple], schema: pa.Schema, most: int = SPAN) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while some := list(itertools.islice(rows, most)):
        yield common.record(schema, **dict(zip(schema.names, zip(*some, strict=True), strict=True)))


ROOTS = pa.schema([("key", pa.string()), ("place", pa.int64()), ("total", pa.int64()), ("digest", pa.string())])


def roots_of(nodes: DataFrame) -> DataFrame:
    """From nodes (key, place, total, digest) the roots of all blocks, as nodes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def roots() -> Iterator[tuple]:
            for (key, block), rows in rows_of(batches):
                rows = list(rows)
                total = rows[0][3]
                tree = grown([row[4] for row in rows], min(LEVELS, height(total)))
                yield key, block, -(-total // SPAN), tree[-1][0]

        yield from batched(roots(), ROOTS)

    rows = nodes.select("key", F.floor(F.col("place") / SPAN).alias("block"), "place", "total", "digest")
    return blocks(rows).mapInArrow(work, "key string, place bigint, total bigint, digest string")


PATHS = pa.schema([("key", pa.string()), ("place", pa.int64()), ("top", pa.string()), ("path", pa.string())])


def climbed(nodes: DataFrame, purpose: str) -> DataFrame:
    """For each node (key, place, total, digest) the one node left of its key, `top`, and the path there.

    One round for each `LEVELS` levels, each with `SPAN` times fewer nodes.
    """
    if (nodes.agg(F.max("total")).first()[0] or 0) <= 1:
        return nodes.select("key", "place", F.col("digest").alias("top"), F.lit("").alias("path"))
    upper = climbed(common.keep(roots_of(nodes), purpose), purpose)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def paths() -> Iterator[tuple]:
            for (key, _), rows in rows_of(batches):
                (_, _, _, _, _, top, above), *rows = rows
                tree = grown([row[4] for row in rows], min(LEVELS, height(rows[0][3])))
                for i, row in enumerate(rows):
                    yield key, row[2], top, spelled(path(tree, i) + steps_of(above))

        yield from batched(paths(), PATHS)

    block = F.floor(F.col("place") / SPAN).alias("block")
    none = F.lit(None).cast("string")
    rows = nodes.select("key", block, "place", "total", "digest", none.alias("top"), none.alias("path"))
    # The path of a block goes before its nodes.
    heads = upper.select("key", F.col("place").alias("block"), F.lit(-1).cast("bigint"), F.lit(0).cast("bigint"), none, "top", "path")
    return common.keep(blocks(rows.union(heads)).mapInArrow(work, "key string, place bigint, top string, path string"), purpose)


def spelled_field(value: Column) -> Column:
    """Length in UTF-8 bytes, a colon and the value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    fields = [spelled_field(F.col(name)) for name in FIELDS[:-1]]
    return F.sha2(F.concat(*fields, spelled_field(text)).cast("binary"), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fifth(doc_id: Column) -> Column:
    """Whether 5 divides the crc32 of the id in decimal digits; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


PROVEN = pa.schema([
    ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
    ("folded_root", pa.string()), ("verified", pa.bool_()), ("copied", pa.list_(pa.string())),
])


def manifest(documents: DataFrame, tampered: Column | None = None, text: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified and copied of each document.

    `tampered` says which rows become `text` (by default: where 5 divides the crc32 of the id, with A-Z lower-cased);
    `copied` has the new nodes of the row's version, from the leaf to the root, or is null where nothing is tampered.
    `verified` is whether the version still ends in the root: a text without A-Z stays what it was.

    Nulls in any column are spelled as a dash; rows without a source are one source, the first; rows without doc_id
    come first in their source and are not tampered. Rows of one id are ordered by their leaf, equal rows each have a
    leaf of their own. A source of one row has that leaf as its subroot. Other columns are not read. An empty table gives
    an empty result.
    """
    spoilt = fifth(F.col("doc_id").cast("bigint")) if tampered is None else F.coalesce(tampered, F.lit(False))
    changed = leaf(lowered(F.col("text").cast("string")) if text is None else text)
    docs = documents.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    # In this order a null is before all texts, and texts go by their bytes.
    key = F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit(""))
    leaves = docs.select(
        key.alias("key"), F.col("doc_id"), leaf(F.col("text")).alias("digest"),
        F.when(spoilt, changed).alias("tampered"), F.monotonically_increasing_id().alias("row"),
    )
    leaves = ranked(common.keep(leaves, "merkle-leaves"), "merkle-placed", "key", "doc_id", "digest", "row")
    upper = climbed(common.keep(roots_of(leaves), "merkle-roots"), "merkle-paths")

    subroots = upper.where("place = 0").select(F.lit("").alias("key"), F.col("key").alias("source_key"), F.col("top").alias("digest"))
    subroots = common.keep(ranked(subroots, "merkle-sources", "key", "source_key"), "merkle-sources")
    whole = climbed(subroots.select("key", "place", "total", "digest"), "merkle-root")
    ends = subroots.join(whole, ["key", "place"]).select(F.col("source_key").alias("key"), F.col("top").alias("root"), F.col("path").alias("last"))
    upper = upper.join(ends, "key").withColumn("path", F.concat_ws("/", *[F.when(F.col(c) != "", F.col(c)) for c in ("path", "last")]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def proven() -> Iterator[tuple]:
            for _, rows in rows_of(batches):
                (*_, subroot, root, above), *rows = rows
                above = steps_of(above)
                tree = grown([row[5] for row in rows], min(LEVELS, height(rows[0][3])))
                tail = "".join(left + right for left, right in above)
                for i, (_, _, _, _, doc_id, own, spoilt, *_) in enumerate(rows):
                    steps = path(tree, i)
                    proof = digest("".join(left + right for left, right in steps) + tail)
                    copied = None if spoilt is None else version(spoilt, steps + above)
                    # Untampered, the fold along shared nodes ends where the tree does.
                    folded = version(own, steps + above)[-1] if copied is None else copied[-1]
                    yield doc_id, own, subroot, root, proof, folded, folded == root, copied

        yield from batched(proven(), PROVEN)

    block = F.floor(F.col("place") / SPAN).alias("block")
    none = F.lit(None).cast("string")
    rows = leaves.select("key", block, "place", "total", "doc_id", "digest", "tampered", none.alias("subroot"), none.alias("root"), none.alias("path"))
    zero = F.lit(0).cast("bigint")
    heads = upper.select("key", F.col("place").alias("block"), F.lit(-1).cast("bigint"), zero, zero, none, none, "top", "root", "path")
    return blocks(rows.union(heads)).mapInArrow(
        work,
        "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, copied array<string>",
    )
