"""Nearest vectors by inner product: one vantage-point tree for each shard, with relaxed pruning.

Vectors are dealt into shards of bounded size. A block of queries visits every shard: a stated set of queries against all
rows, in blocks. With one more component, sqrt(M^2 - |x|^2) for the largest norm M of the shard and 0 for the query, the largest
inner product is the least distance, so the triangle inequality may prune: a subtree at distance gap or more from a
query is skipped if factor * gap exceeds the distance of its k-th best so far. Factor 1 is exact search; larger
factors skip more and may miss some.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import common, flat

SHARD, BLOCK, LEAF = 16384, 2048, 512
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


class Tree:
    """A balanced vantage-point tree over the rows of a matrix; leaves are ranges of `order`."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.order = vectors, np.arange(len(vectors))
        self.nodes: list[tuple] = []
        self._build(0, len(vectors))

    def _build(self, first: int, last: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if last - first <= LEAF:
            self.nodes[at] = (first, last, None, 0.0, 0.0, -1, -1)
            return at
        own = self.order[first:last]
        # The row farthest from the first one spreads distances widest.
        start = self.vectors[own[0]]
        vantage = self.vectors[own[int(np.argmin(self.vectors[own] @ start))]]
        far = np.sqrt(np.maximum(((self.vectors[own] - vantage) ** 2).sum(1), 0))
        half = (last - first) // 2
        part = np.argpartition(far, half)
        self.order[first:last] = own[part]
        inner, outer = far[part[:half]].max(), far[part[half:]].min()
        left = self._build(first, first + half)
        right = self._build(first + half, last)
        self.nodes[at] = (first, last, vantage, float(inner), float(outer), left, right)
        return at


def search(tree: Tree, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """For each query: places of its k nearest rows in the order of the tree's matrix, and inner products; -1 where none."""
    n = len(queries)
    best = np.full((n, k), -np.inf)
    place = np.full((n, k), -1, np.int64)
    norms = (queries**2).sum(1)
    square = (tree.vectors[0] ** 2).sum() if len(tree.vectors) else 0.0

    def visit(node: int, rows: np.ndarray) -> None:
        first, last, vantage, inner, outer, left, right = tree.nodes[node]
        if vantage is None:
            own = tree.order[first:last]
            products = queries[rows] @ tree.vectors[own].T
            better = np.flatnonzero(products.max(1) > best[rows, -1])
            if len(better):
                at = rows[better]
                joined = np.concatenate([best[at], products[better]], axis=1)
                ids = np.concatenate([place[at], np.broadcast_to(own, (len(at), len(own)))], axis=1)
                top = np.argpartition(-joined, k - 1, axis=1)[:, :k]
                values = np.take_along_axis(joined, top, 1)
                rank = np.argsort(-values, axis=1, kind="stable")
                best[at] = np.take_along_axis(values, rank, 1)
                place[at] = np.take_along_axis(np.take_along_axis(ids, top, 1), rank, 1)
            return
        away = np.sqrt(np.maximum(norms[rows] + square - 2 * queries[rows] @ vantage, 0))
        near_left = np.abs(away - inner) * (away <= inner) >= np.abs(outer - away) * (away < outer)

        def reach(of: np.ndarray, gap: np.ndarray) -> np.ndarray:
            limit = np.sqrt(np.maximum(norms[of] + square - 2 * best[of, -1], 0))
            return of[~(factor * gap > limit)]

        for side in (True, False):
            own = near_left == side
            if own.any():
                now, far = rows[own], away[own]
                to_left, to_right = np.maximum(far - inner, 0), np.maximum(outer - far, 0)
                for child, gap in ((left, to_left), (right, to_right)) if side else ((right, to_right), (left, to_left)):
                    if len(go := reach(now, gap)):
                        visit(child, go)

    if len(tree.vectors) and n:
        visit(0, np.arange(n))
    return place, best


def near_floor(tree: Tree, queries: np.ndarray, floor: np.ndarray, factor: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, row of the tree) whose product reaches the query's floor, leaf by leaf; equal products all come.

    The floor is lowered by what rounding may take, so the caller decides by exact scores.
    """
    norms = (queries**2).sum(1)
    square = (tree.vectors[0] ** 2).sum()
    size = np.sqrt(np.maximum(norms, 0)) * np.sqrt(square)
    low = floor - 1e-9 * size
    limit = np.sqrt(np.maximum(norms + square - 2 * low, 0)) + 1e-6 * np.sqrt(norms + square)
    stack = [(0, np.arange(len(queries)))]
    while stack:
        node, rows = stack.pop()
        first, last, vantage, inner, outer, left, right = tree.nodes[node]
        if vantage is None:
            own = tree.order[first:last]
            row, at = np.nonzero(queries[rows] @ tree.vectors[own].T >= low[rows][:, None])
            yield rows[row], own[at]
            continue
        away = np.sqrt(np.maximum(norms[rows] + square - 2 * queries[rows] @ vantage, 0))
        for child, gap in ((left, np.maximum(away - inner, 0)), (right, np.maximum(outer - away, 0))):
            go = rows[factor * gap <= limit[rows]]
            if len(go):
                stack.append((child, go))


def firsts(rows: np.ndarray, forms: np.ndarray, score: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Of each row the k highest scores, equal ones by the least id of their form."""
    order = np.lexsort((least[forms], -score, rows))
    rows = rows[order]
    return order[np.arange(len(rows)) - np.searchsorted(rows, rows, "left") < k]


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, added component by component in double precision."""
    total = np.zeros(len(left))
    for d in range(left.shape[1]):
        total += left[:, d] * right[:, d]
    return total


def nearest_in_shards(k: int, factor: float):
    """Rows in the order of shard, queries last in each; equal vectors of a shard are one vector with many ids."""

    def answers(ids, vectors, asked, asked_vectors) -> Iterator[pa.RecordBatch]:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        distinct, group = np.unique(vectors, axis=0, return_inverse=True)
        group = group.ravel()
        by_group = np.argsort(group, kind="stable")
        begin = np.searchsorted(group[by_group], np.arange(len(distinct) + 1))
        least = ids[by_group[begin[:-1]]]
        most = (distinct**2).sum(1).max()
        lifted = np.concatenate([distinct, np.sqrt(np.maximum(most - (distinct**2).sum(1), 0))[:, None]], axis=1)
        tree = Tree(lifted)
        for at in range(0, len(asked), BLOCK):
            q = asked_vectors[at : at + BLOCK]
            lifted_queries = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
            _, best = search(tree, lifted_queries, k + 1, factor)
            # Every form as near as the last one of these is held against it by exact score and least id.
            row, form, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            for rows, forms in near_floor(tree, lifted_queries, best[:, -1], factor):
                row, form, score = np.append(row, rows), np.append(form, forms), np.append(score, products(q[rows], distinct[forms]))
                if len(row) > 4 * (k + 1) * BLOCK:
                    kept = firsts(row, form, score, least, k + 1)
                    row, form, score = row[kept], form[kept], score[kept]
            kept = firsts(row, form, score, least, k + 1)
            row, form, score = row[kept], form[kept], score[kept]
            count = np.minimum(begin[form + 1] - begin[form], k + 1)
            each = np.repeat(np.arange(len(row)), count)
            inside = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
            found = ids[by_group[begin[form][each] + inside]]
            query, score = asked[at : at + BLOCK][row[each]], score[each]
            rows = row[each]
            other = found != query
            query, found, score, rows = query[other], found[other], score[other], rows[other]
            rank = np.lexsort((found, -score, rows))
            rows = rows[rank]
            first = np.searchsorted(rows, rows, "left")
            keep = rank[np.arange(len(rows)) - first < k]
            yield common.record(FOUND, query_id=query[keep], vec_id=found[keep], score=score[keep])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            ids, vectors, asked = (np.concatenate(x) for x in zip(*held, strict=True))
            if asked.any() and not asked.all():
                yield from answers(ids[~asked], vectors[~asked], ids[asked], vectors[asked])

        for batch in batches:
            shard, ids = batch.column("shard").to_numpy(), batch.column("vec_id").to_numpy()
            asked = batch.column("asked").to_numpy(zero_copy_only=False)
            vectors = batch.column("vector").flatten().to_numpy().reshape(len(batch), -1).astype(np.float64)
            edges = np.append(np.flatnonzero(np.diff(shard, prepend=shard[0] - 1)), len(shard)) if len(shard) else [0]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if shard[a] != now:
                    if held:
                        yield from done()
                    now, held = shard[a], []
                held.append((ids[a:b], vectors[a:b], asked[a:b]))
        if held:
            yield from done()

    return work


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not all zero."""
    x = vector.cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & fine & F.exists(x, lambda v: v != 0), F.lit(False))


def nearest(embeddings: DataFrame, queries: Column, k: int = 20, factor: float = 1.0) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for each row of `embeddings` where `queries` holds.

    `embeddings` has vec_id and embedding; score is the inner product of the original vectors in double precision, equal
    scores go to the smaller vec_id. Vectors that are null, zero, or hold a null or non-finite component take no part, nor do
    rows without vec_id; vectors of another length than most are never candidates of each other, as each length is searched apart.
    A query is no candidate of itself, nor are other rows of its vec_id; repeated rows count once.
    """
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), queries.alias("asked"))
    rows = rows.where(usable(F.col("vector")) & F.col("vec_id").isNotNull()).withColumn("asked", F.coalesce("asked", F.lit(False)))
    rows = rows.dropDuplicates(["vec_id", "vector"])
    total = rows.count()
    shards = max(1, -(-total // SHARD))
    size = F.size("vector")
    own = rows.select("vec_id", "vector", F.lit(False).alias("asked"), size.alias("length"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("place"), F.lit(0).alias("block"))
    # A block of queries meets every shard; shards are visited by as many tasks as there are blocks of queries.
    blocks = max(1, -(-total // (BLOCK * 64)))
    asked = rows.where("asked").select("vec_id", "vector", "asked", size.alias("length"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("place"), F.pmod(F.hash("vec_id"), F.lit(blocks)).alias("block"))
    own = own.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = own.unionByName(asked).withColumn("shard", F.xxhash64("length", "place", "block"))
    dealt = both.select("shard", "vec_id", "vector", "asked").repartition(max(shards * blocks, 8), "shard").sortWithinPartitions("shard", "vec_id")
    found = dealt.mapInArrow(nearest_in_shards(k, factor), "query_id bigint, vec_id bigint, score double")
    # Of a query's best of each shard, the best of all: pre-aggregated before one sort of k rows for each shard.
    best = F.expr("struct(-score as low, vec_id)")
    top = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_set(best)), 1, k).alias("top"))
    out = top.select("query_id", F.posexplode("top").alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.low")).alias("score"))
