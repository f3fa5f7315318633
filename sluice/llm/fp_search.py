"""Ranked lexical search by document FP-trees with branch and bound.

Items are taken in blocks of a bounded vocabulary. A document keeps only the terms that some item of the block has, in
the order of how many documents hold them, so documents with equal beginnings share a path of a trie. Each task cuts its
documents into trees; a tree's nodes carry for each term the largest count in their subtree, and the smallest m. From
these, and the item's weights, follows a bound on every score below a node: depth first, best bound first, an item leaves
out each subtree whose bound is under its tenth score so far.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm import common, flat

#: Distinct terms of all items of a block, about; an item with more has a block of its own.
VOCABULARY = 1 << 17
#: Documents of a tree, and of a leaf.
TREE, LEAF = 1 << 13, 64
SCALE = 1_000_000_000


@dataclass(frozen=True)
class Items:
    """A block of items: their ids, the sorted hashes of their terms, and each item's terms as places there."""

    ids: list[int | None]
    terms: np.ndarray
    places: list[np.ndarray]


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term, A-Z lower-cased, and its row. Terms are told apart by 64 bits of hash."""
    return flat.word_hashes(data, at, flat.MARKS)


def blocks_of(items: DataFrame, most: int) -> Iterator[Items]:
    """The items with terms, in blocks of at most `most` terms; the driver holds one block and one part of the table."""
    ids, own, size = [], [], 0

    def block() -> Items:
        terms = np.unique(np.concatenate(own))
        return Items(list(ids), terms, [np.searchsorted(terms, o) for o in own])

    for row in items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).where("text is not null").toLocalIterator():
        raw = np.frombuffer(row[1].encode(), np.uint8)
        terms = np.unique(words_of(raw, np.array([0, len(raw)]))[0])
        if not len(terms):
            continue
        if own and size + len(terms) > most:
            yield block()
            ids, own, size = [], [], 0
        ids.append(row[0])
        own.append(terms)
        size += len(terms)
    if own:
        yield block()


VECTORS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tfs", pa.binary())])


def vectors(documents: DataFrame, terms: np.ndarray) -> DataFrame:
    """doc_id, n and the counts of the given terms of each document with any term; which they are as int32 places."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat.buffers(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b in flat.slices(at):
                word, row = words_of(data[at[a] : at[b]], at[a : b + 1] - at[a])
                n = np.bincount(row, minlength=b - a)
                place = np.searchsorted(terms, word)
                known = terms[np.minimum(place, len(terms) - 1)] == word
                key, tf = np.unique(row[known] * len(terms) + place[known], return_counts=True)
                begin = np.searchsorted(key, np.arange(b - a + 1) * len(terms))
                own, tf = (key % len(terms)).astype(np.int32), tf.astype(np.int32)
                full = np.flatnonzero(n)
                yield common.record(
                    VECTORS, doc_id=ids.slice(a, b - a).take(pa.array(full)), n=n[full],
                    terms=[own[begin[i] : begin[i + 1]].tobytes() for i in full], tfs=[tf[begin[i] : begin[i + 1]].tobytes() for i in full],
                )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id bigint, n bigint, terms binary, tfs binary")


def ints(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The int32 values of all binary rows, and where each row's begin."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(np.int32), (at - at[0]) // 4


def frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term is."""
    schema = pa.schema([("term", pa.int64()), ("df", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch in batches:
            count += np.bincount(ints(batch.column("terms"))[0], minlength=size)
        held = np.flatnonzero(count)
        yield common.record(schema, term=held, df=count[held])

    found = rows.select("terms").mapInArrow(work, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(size, np.int64)
    # As many rows as the block has terms, at most.
    for row in found.collect():
        df[row["term"]] = row["df"]
    return df


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one unit of weight brings; it grows with tf and falls with m."""
    return (SCALE * tf) // (1000 * tf + 8 * m)


class Tree:
    """Documents as paths of a trie, with bounds for every subtree.

    `ids`, `known` (whether there is an id) and `m` are of the documents; `begin`, `term`, `tf` their restricted
    vectors, each in the order of the trie's levels.
    """

    def __init__(self, ids: np.ndarray, known: np.ndarray, m: np.ndarray, begin: np.ndarray, term: np.ndarray, tf: np.ndarray, size: int):
        paths = [term[begin[i] : begin[i + 1]].astype(">u4").tobytes() for i in range(len(ids))]
        order = np.array(sorted(range(len(ids)), key=lambda i: (paths[i], m[i], ids[i])), np.int64)
        self.paths = [paths[i] for i in order]
        length = np.diff(begin)[order]
        self.begin = np.concatenate([[0], np.cumsum(length)])
        entry = np.repeat(begin[:-1][order] - self.begin[:-1], length) + np.arange(self.begin[-1])
        self.ids, self.known, self.m, self.term = ids[order], known[order], m[order], term[entry]
        tf = tf[entry].astype(np.int64)
        self.gain = gain(tf, np.repeat(self.m, length))
        self.first, self.last, self.children = [], [], []
        self.grow(0, len(ids), 0)
        self.bounds(tf, size)

    def grow(self, first: int, last: int, depth: int) -> None:
        """Nodes in depth-first order: a range of documents each, split by the term at which their paths part."""
        stack = [(first, last, depth, -1)]
        while stack:
            first, last, depth, parent = stack.pop()
            node = len(self.first)
            self.first.append(first)
            self.last.append(last)
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if last - first <= LEAF:
                continue
            a, b = (np.frombuffer(self.paths[i], ">u4") for i in (first, last - 1))
            common_part = min(len(a), len(b))
            apart = np.flatnonzero(a[depth:common_part] != b[depth:common_part])
            depth = depth + int(apart[0]) if len(apart) else common_part
            if len(a) == len(b) == depth:
                # One path: its documents go on in the order of m.
                cuts = range(first, last, LEAF)
            else:
                at = depth * 4
                cuts, step = [first], None
                for i in range(first, last):
                    here = self.paths[i][at : at + 4]
                    # Branches of few documents share a leaf.
                    if here != step and i > cuts[-1] and (i - cuts[-1] >= LEAF or self.wide(i, last, at)):
                        cuts.append(i)
                    step = here
            ends = [*cuts[1:], last]
            if len(ends) == 1:
                # Many branches of few documents each: plain runs.
                cuts = range(first, last, LEAF)
                ends = [*cuts[1:], last]
            stack.extend((f, e, depth, node) for f, e in zip(cuts, ends, strict=True))

    def wide(self, first: int, last: int, at: int) -> bool:
        """Whether the branch that begins here has more documents than a leaf."""
        return first + LEAF < last and self.paths[first + LEAF][at : at + 4] == self.paths[first][at : at + 4]

    def bounds(self, tf: np.ndarray, size: int) -> None:
        """For each term the nodes whose subtree holds it, with what it can bring there at most."""
        first, last = np.array(self.first), np.array(self.last)
        self.least_m = np.array([self.m[f:e].min() for f, e in zip(first, last, strict=True)])
        self.least_id = np.array([self.ids[f:e].min() for f, e in zip(first, last, strict=True)])
        nodes, terms, tops = [], [], []
        largest = np.zeros(size, np.int64)
        for node, (f, e) in enumerate(zip(first, last, strict=True)):
            some = slice(self.begin[f], self.begin[e])
            own = self.term[some]
            np.maximum.at(largest, own, tf[some])
            held = np.flatnonzero(largest) if len(own) > size else np.unique(own)
            nodes.append(np.full(len(held), node))
            terms.append(held)
            tops.append(gain(largest[held], self.least_m[node]))
            largest[held] = 0
        term, node, top = np.concatenate(terms), np.concatenate(nodes), np.concatenate(tops)
        order = np.argsort(term, kind="stable")
        self.node, self.top = node[order], top[order]
        self.at = np.searchsorted(term[order], np.arange(size + 1))

    def search(self, terms: np.ndarray, weight: np.ndarray, best: Best) -> None:
        """Offer to `best` all documents that could be among an item's best."""
        bound = np.zeros(len(self.first), np.int64)
        for t in terms:
            some = slice(self.at[t], self.at[t + 1])
            # A node has one entry a term.
            bound[self.node[some]] += weight[t] * self.top[some]
        own = np.zeros(len(weight), np.int64)
        own[terms] = weight[terms]
        stack = [0]
        while stack:
            node = stack.pop()
            if not best.may_take(bound[node], self.least_id[node]):
                continue
            if self.children[node]:
                stack.extend(sorted(self.children[node], key=lambda c: bound[c]))
                continue
            f, e = self.first[node], self.last[node]
            begin = self.begin[f : e + 1]
            sums = np.concatenate([[0], np.cumsum(own[self.term[begin[0] : begin[-1]]] * self.gain[begin[0] : begin[-1]])])
            score = sums[begin[1:] - begin[0]] - sums[begin[:-1] - begin[0]]
            best.offer(score, self.ids[f:e], self.known[f:e])


class Best:
    """The highest scores above 0 so far, equal ones by ascending id, documents without an id last."""

    def __init__(self, most: int):
        self.most = most
        self.score, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def may_take(self, score: int, least_id: int) -> bool:
        if score <= 0 or len(self.score) < self.most:
            return score > 0
        return score > self.score[-1] or (score == self.score[-1] and least_id <= self.ids[-1])

    def offer(self, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        good = np.flatnonzero(score > (self.score[-1] - 1 if len(self.score) == self.most else 0))
        if not len(good):
            return
        score, ids, known = (np.concatenate([a, b[good]]) for a, b in ((self.score, score), (self.ids, ids), (self.known, known)))
        first = np.lexsort((ids, ~known, -score))[: self.most]
        self.score, self.ids, self.known = score[first], ids[first], known[first]


FOUND = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def found(rows: DataFrame, items: Items, df: np.ndarray, documents: int, all_terms: int, most: int) -> DataFrame:
    """Of every part of the documents, each item's `most` best."""
    weight = weights(df, documents)
    # The most frequent term is nearest to the root.
    level = np.empty(len(df), np.int64)
    level[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    by_level = np.empty_like(weight)
    by_level[level] = weight
    asked, ids = [np.sort(level[p]) for p in items.places], items.ids

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[Tree]:
        for batch in batches:
            for at in range(0, len(batch), TREE):
                part = batch.slice(at, TREE)
                term, begin = ints(part.column("terms"))
                tf, _ = ints(part.column("tfs"))
                row = np.repeat(np.arange(len(part)), np.diff(begin))
                term = level[term]
                order = np.lexsort((term, row))
                doc_id = part.column("doc_id")
                known = np.asarray(doc_id.is_valid())
                numbers = doc_id.fill_null(2**63 - 1).to_numpy()
                m = 10 + (90 * part.column("n").to_numpy() * documents) // all_terms
                yield Tree(numbers, known, m, begin, term[order], tf[order], len(by_level))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(most) for _ in asked]
        for tree in trees(batches):
            for terms, own in zip(asked, best, strict=True):
                tree.search(terms, by_level, own)
        for item, own in enumerate(best):
            numbers = [i if k else None for i, k in zip(own.ids.tolist(), own.known.tolist(), strict=True)]
            yield common.record(FOUND, item=[item] * len(numbers), item_id=[ids[item]] * len(numbers), doc_id=numbers, score=own.score)

    return rows.mapInArrow(work, "item bigint, item_id bigint, doc_id bigint, score bigint")


def search(documents: DataFrame, items: DataFrame, most: int = 10, vocabulary: int = VOCABULARY) -> DataFrame:
    """item_id, rank, doc_id and score of the `most` documents with the highest scores above 0 for each row of `items`.

    Reads `documents` (doc_id, text) and `items` (item_id, text). Equal scores go by ascending doc_id, rows without doc_id
    last. A null text, or one without terms, counts nowhere and has no score; an item of that kind has no rows. Each
    row of a repeated document or item stands for itself. Empty tables give an empty result. Other columns are not read.
    The documents are read once for each block of items.
    """
    spark = documents.sparkSession
    result = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for items_of_block in blocks_of(items, vocabulary):
        rows = common.keep(vectors(documents, items_of_block.terms), "fp-vectors")
        count, all_terms = rows.agg(F.count("*"), F.sum("n")).first()
        if not count:
            continue
        df = frequencies(rows, len(items_of_block.terms))
        near = found(rows, items_of_block, df, count, all_terms, most)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
        result = result.unionByName(ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return result
