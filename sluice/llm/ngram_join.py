"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence, with size-derived bounds.

Texts with the same set of n-grams are one class, so copies cost nothing further. The product runs in two steps:

1. Incidence in column blocks. Every class sends its n-grams to the block of their hash. A block accumulates, for each
   class, how many of its n-grams any other class has. A class of n n-grams can only be in a pair of similarity t if
   at least t * n of them are shared; all others are discarded here, which leaves a small part of the corpus.
2. Pairs of the classes that are left. Stars around the smallest class of a min-hash bucket connect most copies
   cheaply. Then every n-gram among the first n - ceil(t * n) + 1 of a class (in hash order; two similar sets share one of
   these) is a block of rows; pairs of a block that are not yet connected are held against the size bound of
   their symmetric difference, with a parity sketch that never overstates it, and the rest are counted exactly. Some rounds
   draw only trees over the parts of a block, so a group of near copies is connected without its pairs; the last
   round takes every pair that is left.

Links inside what is already connected are not listed, since they change no component; no other link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import common, flat

STARS = 6
#: Cells of the table of n-gram frequencies, a byte each.
FREQUENCIES = 1 << 20
#: Cells of a sketch for each n-gram, in the first rounds and in the last one, which has few rows left. More cells pass fewer
#: pairs below the bound, but every row of a block carries its sketch.
CELLS, FINE = 2, 16
#: Postings that a task gathers before it sends them, members of one block of a large bucket, bytes of input a block.
POSTINGS, MEMBERS, BLOCK_BYTES = 1_500_000, 4096, 8 << 20
#: Classes of one block whose numbers fit beside an n-gram in 64 bits; with more, the two are sorted apart.
OWNERS = 1 << 24

INCIDENCE = pa.schema(
    [("kind", pa.int32()), ("block", pa.int32()), ("doc_id", pa.int64()), ("name", pa.int64()), ("key", pa.int64()), ("n", pa.int64()),
     ("shared", pa.int64()), ("grams", pa.binary()), ("owners", pa.binary()), ("counts", pa.binary())]
)
INCIDENCE_DDL = "kind int, block int, doc_id bigint, name bigint, key bigint, n bigint, shared bigint, grams binary, owners binary, counts binary"
DOC, POSTED, REPEATED, SHARED = 0, 1, 2, 3
COUNTED = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("name", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("shared", pa.int64())])
COUNTED_DDL = "kind int, doc_id bigint, name bigint, key bigint, n bigint, shared bigint"


def set_keys(grams: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 64-bit name of each row's set."""
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(flat.mix(grams ^ np.uint64(0xD6E8FEB86659FD93)), out=sums[1:])
    size = np.diff(begin).astype(np.uint64)
    return flat.mix((sums[begin[1:]] - sums[begin[:-1]]) * np.uint64(0xFF51AFD7ED558CCD) + size)


def first_of_each(owner: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(owner), bool)
    fresh[1:] = owner[1:] != owner[:-1]
    return np.flatnonzero(fresh)


def concat_ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... for size[i] places, one range after another."""
    if not len(size) or not size.sum():
        return np.zeros(0, np.int64)
    ends = np.cumsum(size)
    return np.arange(ends[-1]) + np.repeat(first - (ends - size), size)


def incidence(width: int, blocks: int):
    """Rows of documents and, for each block, the postings of a part of the corpus."""

    def rows(kind: int, count: int, **columns) -> pa.RecordBatch:
        given = {"kind": [kind] * count} | columns
        return common.record(INCIDENCE, **{f.name: given.get(f.name, [None] * count) for f in INCIDENCE})

    def flush(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, sizes, grams = (np.concatenate(x) for x in zip(*held, strict=True))
        begin = np.cumsum(sizes) - sizes
        keys, one = np.unique(keys, return_index=True)
        sizes, begin = sizes[one], begin[one]
        grams = grams[concat_ranges(begin, sizes)]
        held.clear()
        owner = np.repeat(np.arange(len(keys), dtype=np.int32), sizes)
        order = np.argsort(grams, kind="stable")
        grams, owner = grams[order], owner[order]
        starts = first_of_each(grams)
        often = np.diff(np.append(starts, len(grams))) > 1
        repeated = np.repeat(often, np.diff(np.append(starts, len(grams))))
        shared = np.bincount(owner[repeated], minlength=len(keys))
        has = np.flatnonzero(shared)
        yield rows(SHARED, len(has), block=(keys[has] % np.uint64(blocks)).astype(np.int32), key=keys[has].view(np.int64), shared=shared[has])
        many, grams, owner = grams[starts][often], grams[~repeated], owner[~repeated]
        for kind, values in ((REPEATED, many), (POSTED, grams)):
            of = ((values >> np.uint64(40)) % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(of, kind="stable") if kind == REPEATED else np.lexsort((owner, of))
            edges = np.searchsorted(of[order], np.arange(blocks + 1))
            for block in range(blocks):
                part = order[edges[block] : edges[block + 1]]
                if not len(part):
                    continue
                low = np.ascontiguousarray(values[part]).view(np.uint8).reshape(-1, 8)[:, :5]
                more = {}
                if kind == POSTED:
                    at = first_of_each(owner[part])
                    more = {"owners": [keys[owner[part][at]].tobytes()], "counts": [np.diff(np.append(at, len(part))).astype(np.uint32).tobytes()]}
                yield rows(kind, 1, block=[block], grams=[low.tobytes()], **more)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, postings = [], 0
        for batch in batches:
            data, at = flat.buffers(batch.column("text"))
            ids, names = batch.column("doc_id"), batch.column("name")
            for a, b in flat.slices(at):
                grams, begin = flat.shingles(data[at[a] : at[b]], at[a : b + 1] - at[a], width)
                keys, sizes = set_keys(grams, begin), np.diff(begin)
                yield rows(DOC, b - a, block=(keys % np.uint64(blocks)).astype(np.int32), doc_id=ids[a:b], name=names[a:b], key=keys.view(np.int64), n=sizes)
                full = sizes > 0
                held.append((keys[full], sizes[full], grams))
                postings += len(grams)
                if postings >= POSTINGS:
                    yield from flush(held)
                    held, postings = [], 0
        if postings:
            yield from flush(held)

    return work


def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block in turn: how many n-grams of each class another class has. Documents pass."""
    held: list[tuple[bytes, np.ndarray, np.ndarray]] = []
    often: list[np.ndarray] = []
    now = None

    def grams_of(raw: bytes) -> np.ndarray:
        wide = np.zeros((len(raw) // 5, 8), np.uint8)
        wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
        return wide.view(np.uint64).ravel()

    def counted() -> Iterator[pa.RecordBatch]:
        if held:
            keys, code = np.unique(np.concatenate([owners for _, owners, _ in held]), return_inverse=True)
            code = np.repeat(code.astype(np.uint32), np.concatenate([counts for _, _, counts in held]))
            gram, at = np.zeros(len(code), np.uint64), 0
            for raw, _, _ in held:
                gram[at : at + len(raw) // 5] = grams_of(raw)
                at += len(raw) // 5
            held.clear()
            if len(keys) <= OWNERS:
                # An n-gram has 40 bits here, so its owner fits beside it and both are sorted in place.
                gram <<= np.uint64(24)
                gram |= code
                gram.sort()
                fresh = np.ones(len(gram), bool)
                fresh[1:] = gram[1:] != gram[:-1]
                code = (gram & np.uint64((1 << 24) - 1)).astype(np.uint32)[fresh]
                gram = gram[fresh]
                gram >>= np.uint64(24)
            else:
                order = np.lexsort((code, gram))
                gram, code = gram[order], code[order]
                fresh = np.ones(len(gram), bool)
                fresh[1:] = (gram[1:] != gram[:-1]) | (code[1:] != code[:-1])
                gram, code = gram[fresh], code[fresh]
            same = gram[1:] == gram[:-1]
            more = np.zeros(len(gram), bool)
            more[1:] |= same
            more[:-1] |= same
            if often:
                known = np.unique(np.concatenate(often))
                first = np.searchsorted(gram, known, "left")
                more[concat_ranges(first, np.searchsorted(gram, known, "right") - first)] = True
            shared = np.bincount(code[more], minlength=len(keys))
            has = np.flatnonzero(shared)
            none = [None] * len(has)
            yield common.record(COUNTED, kind=[SHARED] * len(has), doc_id=none, name=none, key=keys[has].view(np.int64), n=none, shared=shared[has])
        held.clear()
        often.clear()

    for batch in batches:
        kinds, blocks = batch.column("kind").to_numpy(), batch.column("block").to_numpy()
        through = np.flatnonzero((kinds == DOC) | (kinds == SHARED))
        if len(through):
            yield pa.RecordBatch.from_arrays([batch.column(f.name).take(pa.array(through)) for f in COUNTED], schema=COUNTED)
        for i in np.flatnonzero((kinds == POSTED) | (kinds == REPEATED)):
            if blocks[i] != now:
                yield from counted()
                now = blocks[i]
            raw = batch.column("grams")[i].as_py()
            if kinds[i] == REPEATED:
                often.append(grams_of(raw))
            else:
                owners, counts = (np.frombuffer(batch.column(c)[i].as_py(), kind) for c, kind in (("owners", np.uint64), ("counts", np.uint32)))
                held.append((raw, owners, counts))
    yield from counted()


SETS = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("grams", pa.binary())])


def sets_of(width: int):
    """The n-gram set of each text whose class is the wanted one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat.buffers(batch.column("text"))
            wanted = batch.column("key").to_numpy()
            for a, b in flat.slices(at):
                grams, begin = flat.shingles(data[at[a] : at[b]], at[a : b + 1] - at[a], width)
                keys = set_keys(grams, begin).view(np.int64)
                rows = np.flatnonzero(keys == wanted[a:b])
                yield common.record(SETS, key=keys[rows], n=np.diff(begin)[rows], grams=[grams[begin[i] : begin[i + 1]].tobytes() for i in rows])

    return work


MARKS = pa.schema([("mark", pa.int64()), ("key", pa.int64()), ("n", pa.int64())])


def min_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least value of `STARS` permutations of each set."""
    for batch in batches:
        keys, sizes = batch.column("key").to_numpy(), batch.column("n").to_numpy()
        for i, raw in enumerate(batch.column("grams")):
            grams = np.frombuffer(raw.as_buffer(), np.uint64)
            marks = [int(flat.mix(grams ^ flat.PLACES[100 + k]).min() ^ flat.PLACES[110 + k]) for k in range(STARS)]
            yield common.record(MARKS, mark=np.array(marks, np.uint64).view(np.int64), key=[keys[i]] * STARS, n=[sizes[i]] * STARS)


def cell_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(17)).astype(np.int64) % FREQUENCIES


def frequencies(sets: DataFrame) -> np.ndarray:
    """How many sets hold the n-grams of each of `FREQUENCIES` cells, as powers of two: one byte a cell, at any size of the corpus."""
    width = 1 << 12
    schema = pa.schema([("part", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FREQUENCIES, np.int64)
        for batch in batches:
            for raw in batch.column("grams"):
                np.add.at(total, cell_of(np.frombuffer(raw.as_buffer(), np.uint64)), 1)
        parts = total.reshape(-1, width)
        some = np.flatnonzero(parts.any(1))
        yield common.record(schema, part=some.astype(np.int32), counts=[parts[i].tobytes() for i in some])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(raw.as_buffer(), np.int64)
        yield common.record(schema, part=np.array(list(total), np.int32), counts=[np.ceil(np.log2(c + 1)).astype(np.uint8).tobytes() for c in total.values()])

    counted = sets.select("grams").mapInArrow(count, "part int, counts binary").repartition("part").mapInArrow(add, "part int, counts binary")
    out = np.zeros((FREQUENCIES // width, width), np.uint8)
    for row in counted.collect():
        out[row["part"]] = np.frombuffer(row["counts"], np.uint8)
    return out.ravel()


def prefix_rows(percent: int, often: np.ndarray):
    """The n-grams of which two similar sets share one: the first n - ceil(t n) + 1, rare ones first.

    The order is the same for all sets, which is all that the bound needs; that it begins with rare n-grams keeps blocks small.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = batch.column("key").to_numpy(), batch.column("n").to_numpy()
            for i, raw in enumerate(batch.column("grams")):
                grams, n = np.frombuffer(raw.as_buffer(), np.uint64), int(sizes[i])
                # Sets are in the order of their hashes, which decides between equally frequent ones.
                first = grams[np.argsort(often[cell_of(grams)], kind="stable")[: n - -(-n * percent // 100) + 1]].view(np.int64)
                yield common.record(MARKS, mark=first, key=np.full(len(first), keys[i]), n=np.full(len(first), n))

    return work


SKETCHES = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())])


def sketches(each: int):
    """Parities of the counts of n-grams in a power of two of cells, `each` to twice as many for every n-gram."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in batch.column("grams"):
                grams = np.frombuffer(raw.as_buffer(), np.uint64)
                cells = max(64, 1 << int(each * len(grams) - 1).bit_length())
                odd = np.bincount(((grams >> np.uint64(13)) % np.uint64(cells)).astype(np.int64), minlength=cells) & 1
                out.append(np.packbits(odd.astype(bool), bitorder="little").tobytes())
            yield common.record(SKETCHES, key=batch.column("key"), n=batch.column("n"), sketch=out)

    return work


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: What a block gives: pairs, or (n-gram, set) of those that are not connected with all sets they may be similar to.
FOUND = pa.schema([("open", pa.bool_()), ("a", pa.int64()), ("b", pa.int64())])
TREE, NEAREST, ALL = "tree", "nearest", "all"


def block_pairs(percent: int, mode: str):
    """Pairs of one (n-gram, block pair) that are not connected and whose sketches allow the similarity.

    `ALL` gives every pair. `NEAREST` gives each set the likeliest partner that it is not connected with. `TREE` gives the
    likeliest pairs that would connect the parts, as if each pair held: a tree over the parts, and no more than one for
    all blocks of a task; it also tells which sets have any such partner, as others need not be looked at again.
    """

    def folded(sketch: np.ndarray, words: int) -> np.ndarray:
        return np.bitwise_xor.reduce(sketch.reshape(len(sketch), -1, words), axis=1)

    def within(rows: list[tuple], part: dict[int, int], suspects: set[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        key, root, n, side = (np.array([r[k] for r in rows]) for k in (0, 1, 2, 4))
        guess = np.array([part.get(r, r) for r in root.tolist()]) if mode == TREE else root
        nearest = {}
        words = np.array([len(r[3]) // 8 for r in rows])
        for size in np.unique(words):
            mine = np.flatnonzero(words == size)
            other = np.flatnonzero((words == size) | (words == 2 * size))
            left = np.frombuffer(b"".join(rows[i][3] for i in mine), np.uint64).reshape(-1, size)
            right = np.concatenate([folded(np.frombuffer(rows[i][3], np.uint64).reshape(1, -1), int(size)) for i in other])
            step = max(1, (8 << 20) // (len(other) * int(size) * 8))
            for at in range(0, len(mine), step):
                i = mine[at : at + step]
                apart = root[i][:, None] != root[other][None]
                # of two rows of one size, one order is enough; of two sizes, only the smaller row meets the larger
                before = (side[i][:, None] < side[other][None]) | ((side[i][:, None] == side[other][None]) & (i[:, None] < other[None]))
                apart &= before | (words[i][:, None] != words[other][None])
                if not apart.any():
                    continue
                least = np.bitwise_count(left[at : at + step, None] ^ right[None]).sum(-1, dtype=np.int64)
                both = n[i][:, None] + n[other][None]
                allowed = apart & (least * (100 + percent) <= both * (100 - percent))
                if mode == ALL:
                    x, y = np.nonzero(allowed)
                    yield key[i][x], key[other][y]
                    continue
                far = np.where(allowed, least / both, np.inf)
                if mode == NEAREST:
                    for mine_of, theirs, gaps in ((i, other, far), (other, i, far.T)):
                        best = gaps.argmin(1)
                        for x in np.flatnonzero(np.isfinite(gaps.min(1))):
                            found = (gaps[x, best[x]], key[theirs[best[x]]])
                            nearest[key[mine_of[x]]] = min(found, nearest.get(key[mine_of[x]], found))
                    continue
                suspects.update(key[i[allowed.any(1)]].tolist(), key[other[allowed.any(0)]].tolist())
                for x in np.flatnonzero(allowed.any(1)):
                    y = np.flatnonzero(allowed[x] & (guess[other] != guess[i[x]]))
                    if len(y):
                        y = y[np.argsort(far[x, y], kind="stable")]
                        parts, first = np.unique(guess[other[y]], return_index=True)
                        yield np.full(len(first), key[i[x]]), key[other[y[first]]]
                        guess[np.isin(guess, parts)] = guess[i[x]]
        if nearest:
            yield np.array(list(nearest)), np.array([found[1] for found in nearest.values()])
        if mode == TREE:
            part.update(zip((r[1] for r in rows), guess.tolist(), strict=True))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, part = None, {}

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal part
            suspects: set[int] = set()
            if len(held) > 1:
                for a, b in within(held, part, suspects):
                    if len(a):
                        yield common.record(FOUND, open=[False] * len(a), a=np.minimum(a, b), b=np.maximum(a, b))
            if suspects:
                yield common.record(FOUND, open=[True] * len(suspects), a=[now[0]] * len(suspects), b=list(suspects))
            held.clear()
            # Only a memory of what was given before; to forget it costs repeats.
            part = part if len(part) < 500_000 else {}

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("mark", "low", "high", "key", "root", "n", "sketch", "side")]
            for mark, low, high, *row in zip(*columns, strict=True):
                if (mark, low, high) != now:
                    yield from done()
                    now = (mark, low, high)
                held.append(tuple(row))
        yield from done()

    return work


def exact_links(percent: int):
    """Pairs whose sets are similar enough, counted in full."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(batch.column("left"), batch.column("right"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    kept.append(i)
            yield common.record(PAIRS, a=batch.column("a").take(pa.array(kept, pa.int64())), b=batch.column("b").take(pa.array(kept, pa.int64())))

    return work


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    sets, _ = common.split(sets, "key", pairs.select("a").union(pairs.select("b")))
    right = sets.select(F.col("key").alias("b"), F.col("grams").alias("right"))
    left = sets.select(F.col("key").alias("a"), F.col("grams").alias("left"))
    return pairs.join(right, "b").join(left, "a").mapInArrow(exact_links(percent), "a bigint, b bigint")


def open_marks(marks: DataFrame, roots: DataFrame) -> DataFrame:
    """(mark, key, root, size) of the n-grams whose sets are not all connected."""
    root = F.coalesce("root", "key")
    rows = marks.join(roots.withColumnRenamed("id", "key"), "key", "left").select("mark", "key", root.alias("root"))
    # Read twice below, so the join is not made and planned twice.
    rows = common.keep(rows, "ngram-rooted")
    several = rows.groupBy("mark").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("size")).where("least <> most")
    return rows.join(several.select("mark", "size"), "mark")


def candidates_of(rows: DataFrame, drawn: DataFrame, percent: int, mode: str) -> DataFrame:
    """What the blocks of n-grams give: (open, a, b), see `block_pairs`."""
    blocks = F.ceil(F.col("size") / MEMBERS)
    own = F.pmod(F.xxhash64("key"), blocks)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    rows = rows.select("mark", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "key", "root", (F.col("own") > F.col("other")).cast("int").alias("side"))
    rows = rows.join(drawn, "key").repartition("mark", "low", "high").sortWithinPartitions("mark", "low", "high")
    return rows.mapInArrow(block_pairs(percent, mode), "open boolean, a bigint, b bigint").distinct()


def connected(sets: DataFrame, percent: int) -> DataFrame:
    """(id, root) of the classes that are linked to any other, root being the least of their component."""
    marks = sets.mapInArrow(min_hashes, "mark bigint, key bigint, n bigint")
    pivots = marks.groupBy("mark").agg(F.min("key").alias("a"))
    stars = common.keep(marks.join(pivots, "mark").where("a <> key").select("a", F.col("key").alias("b")).distinct(), "ngram-stars")
    roots = common.components(verified(stars, sets, percent), "ngram-links")
    often = frequencies(sets)
    marks = common.keep(sets.mapInArrow(prefix_rows(percent, often), "mark bigint, key bigint, n bigint").drop("n"), "ngram-marks")
    # Trees connect what the stars have left of large groups, then each set its nearest one, as long as that finds links;
    # at last every pair that is still apart and may be similar is counted.
    mode, rows = TREE, None
    while True:
        if rows is None:
            rows = common.keep(open_marks(marks, roots), "ngram-open")
            if rows.isEmpty():
                return roots
        drawn, _ = common.split(sets, "key", rows.select("key"))
        drawn = drawn.mapInArrow(sketches(FINE if mode == ALL else CELLS), "key bigint, n bigint, sketch binary")
        given = common.keep(candidates_of(rows, drawn, percent, mode), "ngram-pairs")
        if mode == TREE:
            marks = given.where("open").select(F.col("a").alias("mark"), F.col("b").alias("key"))
        # Apart from the open rows, so that their own size tells how to meet the sets.
        pairs = common.keep(given.where("NOT open").select("a", "b"), "ngram-links")
        more = common.keep(verified(pairs, sets, percent), "ngram-more")
        found = not more.isEmpty()
        if found:
            edges = more.union(roots.select(F.col("root").alias("a"), F.col("id").alias("b")))
            roots = common.components(edges, "ngram-roots")
        if mode == ALL:
            return roots
        # What is open changes only with the roots or the marks.
        rows = None if found or mode == TREE else rows
        mode = NEAREST if found or mode == TREE else ALL


def labelled(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, name, n, key, root) of each row; name is a hash of its text, root one of the classes of its component."""
    text = F.col("text").cast("string")
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("name"))
    blocks = common.parts(docs, BLOCK_BYTES)
    posted = docs.mapInArrow(incidence(width, blocks), INCIDENCE_DDL)
    dealt = posted.repartition(blocks, "block").sortWithinPartitions("block")
    with common.small_batches(docs.sparkSession):
        counted = common.keep(dealt.mapInArrow(accumulate, COUNTED_DDL), "ngram-incidence", "kind")
    rows = counted.where(F.col("kind") == DOC).select("doc_id", "name", "key", "n")
    # A class is told by one of its rows, whether that has an id or not.
    one = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), F.col("doc_id").isNull().alias("none"), "name"))
    classes = rows.where("n > 0").groupBy("key").agg(one.alias("row"), F.max("n").alias("n"))
    shared = counted.where(F.col("kind") == SHARED).groupBy("key").agg(F.sum("shared").alias("shared"))
    left = shared.join(classes, "key").where(F.col("shared") * 100 >= F.col("n") * percent)
    left = common.keep(left.select("key", F.when(~F.col("row.none"), F.col("row.doc_id")).alias("doc_id"), "row.name"), "ngram-left")
    if left.isEmpty():
        return rows.withColumn("root", F.col("key"))
    known = left.select(F.col("doc_id").alias("left_id"), F.col("name").alias("left_name"), "key")
    # Texts of no such class are not exchanged for the join.
    wanted, _ = common.split(docs, "name", known.select("left_name"))
    wanted = wanted.join(known, (F.col("name") == F.col("left_name")) & F.col("doc_id").eqNullSafe(F.col("left_id")))
    sets = wanted.select("doc_id", "text", "key").mapInArrow(sets_of(width), "key bigint, n bigint, grams binary").dropDuplicates(["key"])
    with common.small_batches(docs.sparkSession):
        sets = common.keep(sets, "ngram-sets")
        roots = connected(sets, percent)
    return rows.join(roots.withColumnRenamed("id", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))


def ngram_join(documents: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of `documents` (doc_id, text; other columns are not read).

    Two rows are linked when their sets of `width`-word shingles have a Jaccard similarity of `percent` / 100 or more.
    A null, empty or blank text has an empty set and no link. Each row is judged by its own text: repeated rows are
    returned as often as they came, and the component of a row is the smallest doc_id in it. A row without doc_id
    links others like any row; where no row of a component has an id, component_id is null. An empty table gives an empty result.
    """
    rows = common.keep(labelled(documents, width, percent), "ngram-rows")
    label = rows.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(label, "root", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(documents: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """The documents without near copies, all columns as they are: of each component one row stays.

    It is the row of the smallest doc_id, of several texts with that id the first by a hash; of equal rows any one. A
    component without an id keeps the row with the first hash. Rows without words are linked with nothing: they all stay.
    Columns of any name are returned as they came. An empty table gives an empty result.
    """
    rows = common.keep(labelled(documents.select("doc_id", "text"), width, percent), "ngram-rows")
    last = F.lit(2**63 - 1)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", last).alias("doc_id"), "name")
    parts = common.keep(rows.where("n > 0").groupBy("root").agg(F.min(order).alias("first"), F.count("*").alias("size")), "ngram-parts")
    chosen = parts.select("first.*").select(F.when(~F.col("none"), F.col("doc_id")).alias("kept_id"), F.col("name").alias("kept_name"))
    blank = rows.where("n = 0").select("doc_id", "name").distinct().select(F.col("doc_id").alias("kept_id"), F.col("name").alias("kept_name"), F.lit(True).alias("blank"))
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    held = documents.select(whole, F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("name"))
    same = (F.col("name") == F.col("kept_name")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    # A text that stands in no component of several rows stays where it is: its row is not exchanged.
    held, alone = common.split(held, "name", rows.join(parts.where("size > 1"), "root", "left_semi").select("name"))
    found = held.join(chosen, same).groupBy("doc_id", "name").agg(F.first("row").alias("row"))
    return alone.select("row.*").unionByName(found.select("row.*")).unionByName(held.join(blank, same).select("row.*"))
