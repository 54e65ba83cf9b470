"""Ranked lexical search by a dual tree over documents and items.

Every document is first reduced to its length and the counts of the terms that
items ask for. A task then arranges its documents, and all items, in hierarchies
whose nodes hold coordinate maxima: of the terms' contributions for documents,
of the terms' counts for items. The product of two nodes bounds the score of
every pair below them. Where it is under the weakest kth score of the items below,
no document there can enter any of their lists, and the pair of nodes is left with
all its pairs; this is exact. A first search of one document in 64 gives each item
a kth score to start from, which the true one can't be below.

Items are taken in blocks of bounded size, so that what is sent with tasks and
kept by the driver (terms, document frequencies, starting scores) is bounded too.

Cases: null and empty texts have no terms; scores of 0 give no row, so an item may
have fewer than ``k`` or none; ties go by ascending doc_id, a null one last, then
by place in the files; items that repeat whole count once, items that share an id
but differ are items of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cratewise.llm.common import file_backed, located, saved, text_of

#: Fixed value: a term, in lower-cased UTF-8 bytes: letters, digits and all that isn't ASCII.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TOP = 10
#: Items, and terms of theirs, of one block.
ITEMS_AT_ONCE, TERMS_AT_ONCE = 4096, 100_000
#: Children of a node over documents; documents of a task's tree, and figures that its lowest nodes may hold.
FAN, TREE_DOCS, TREE_FIGURES = 8, 4096, 4_000_000
#: Children of a node over items.
ITEM_FAN = 4
#: One document in so many gives the starting scores.
SEED_SHARE = 64
DOC = "doc_id long, file long, row long, n long, terms array<int>, times array<long>"
HIT = "item int, doc_id long, file long, row long, score long"
FOUND = "item_id long, rank int, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text; only A-Z are lower-cased."""
    return TERM.findall(text.encode("utf-8", "replace").lower())


def blocks_of(items: DataFrame) -> Iterator[list[tuple]]:
    """Blocks of (item_id, counts of terms), each within its bounds; items pass the driver one at a time."""
    block, known = [], set()
    rows = items.select(F.col("item_id").cast("long"), text_of().alias("text")).distinct()
    for item_id, text in rows.orderBy(F.col("item_id").asc_nulls_last(), "text").toLocalIterator():
        counts = Counter(terms_of(text))
        if block and (len(block) >= ITEMS_AT_ONCE or len(known | counts.keys()) > TERMS_AT_ONCE):
            yield block
            block, known = [], set()
        if counts:
            block.append((item_id, counts))
            known |= counts.keys()
    if block:
        yield block


def reduced(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """Documents with a term at all: length ``n`` and counts of the terms that ``number`` numbers."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, terms, times = [], [0], [], []
            for text in batch.column("text").to_pylist():
                found = terms_of(text)
                counts = Counter(map(number.get, found))
                counts.pop(None, None)
                terms.extend(counts.keys())
                times.extend(counts.values())
                sizes.append(len(found))
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, k)) for v, k in ((terms, pa.int32()), (times, pa.int64()))]
            named = [batch.column(c) for c in ("doc_id", "file", "row")]
            done = pa.RecordBatch.from_arrays([*named, pa.array(sizes, pa.int64()), *lists], ["doc_id", "file", "row", "n", "terms", "times"])
            yield done.filter(pa.array([n > 0 for n in sizes], pa.bool_()))

    rows = located(docs.select("doc_id", "text"))
    place = [F.col("_file").alias("file"), F.col("_row").alias("row")]
    return rows.select(F.col("doc_id").cast("long"), *place, text_of().alias("text")).mapInArrow(of, DOC)


def weights(documents: int, holders: np.ndarray) -> np.ndarray:
    """Weight of each term from the number of documents and of those that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(h) + 1))) for h in holders], np.int64)


class Level:
    """Sparse vectors, one per node: columns and figures of all nodes, end to end."""

    def __init__(self, vectors: list[dict[int, int]]):
        self.columns = [np.fromiter(v.keys(), np.int64, len(v)) for v in vectors]
        self.figures = [np.fromiter(v.values(), np.int64, len(v)) for v in vectors]
        self.all_columns, self.all_figures = np.concatenate(self.columns), np.concatenate(self.figures)
        self.starts = np.cumsum([0, *map(len, self.columns[:-1])])

    def products(self, nodes: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Product of ``vector`` with each of the nodes."""
        if 8 * len(nodes) < len(self.columns):
            return np.array([vector[self.columns[i]] @ self.figures[i] for i in nodes], np.int64)
        return np.add.reduceat(vector[self.all_columns] * self.all_figures, self.starts)[nodes]


class Items:
    """The hierarchy over the items of a block, coarse level first; a node's children lie side by side."""

    def __init__(self, vectors: list[dict[int, int]], weight: np.ndarray, starting: np.ndarray):
        # Items that share their weightiest terms are neighbours.
        by_weight = [sorted(v, key=lambda t: (-weight[t], t)) for v in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=by_weight.__getitem__), np.int64)
        layer = [vectors[i] for i in self.order]
        self.levels, self.starting = [Level(layer)], starting[self.order]
        while len(layer) > 1:
            layer = [self.maxima(layer[i : i + ITEM_FAN]) for i in range(0, len(layer), ITEM_FAN)]
            self.levels.insert(0, Level(layer))

    @staticmethod
    def maxima(vectors: list[dict[int, int]]) -> dict[int, int]:
        top: dict[int, int] = {}
        for vector in vectors:
            for column, figure in vector.items():
                top[column] = max(figure, top.get(column, 0))
        return top

    def weakest(self, kth: np.ndarray) -> list[np.ndarray]:
        """For each level the least kth score below each node; the last level is ``kth`` itself."""
        out = [kth]
        while len(out[0]) > 1:
            out.insert(0, np.minimum.reduceat(out[0], np.arange(0, len(out[0]), ITEM_FAN)))
        return out

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        below = (ITEM_FAN * nodes[:, None] + np.arange(ITEM_FAN)).ravel()
        return below[below < len(self.levels[level + 1].columns)]


class Search:
    """The k best documents of every item, over the documents handed to ``add``."""

    def __init__(self, items: Items, weight: np.ndarray, documents: int, length: int, k: int):
        self.items, self.weight, self.k = items, weight, k
        self.documents, self.length = documents, length
        #: The best pairs of each item in tree order, and some more: (-score, no id, doc_id, file, row).
        self.best: list[list[tuple]] = [[] for _ in items.starting]
        self.kth = items.starting.copy()
        self.tree_docs = max(FAN, min(TREE_DOCS, FAN * (TREE_FIGURES // len(weight))))
        #: Pairs of a document and an item that were scored.
        self.scored = 0

    def contributions(self, n: int, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """What each term adds to a score for each occurrence in the item; 64-bit integers throughout."""
        m = 25 + (75 * n * self.documents) // self.length
        return self.weight[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * m))

    def tree(self, rows: list[tuple]) -> list[np.ndarray]:
        """Coordinate maxima of the nodes over ``rows``, coarse level first."""
        lowest = np.zeros((-(-len(rows) // FAN), len(self.weight)), np.int64)
        for i, (*_, terms, added) in enumerate(rows):
            node = lowest[i // FAN]
            node[terms] = np.maximum(node[terms], added)
        levels = [lowest]
        while len(levels[0]) > 1:
            levels.insert(0, np.maximum.reduceat(levels[0], np.arange(0, len(levels[0]), FAN), axis=0))
        return levels

    def add(self, rows: list[tuple]) -> None:
        """Searches ``rows``: (doc_id, file, row, terms, contributions)."""
        # Documents led by the same terms share their lowest nodes.
        rows = sorted(rows, key=lambda r: r[3][np.argsort(-r[4], kind="stable")[:3]].tolist())
        levels, vector = self.tree(rows), np.zeros(len(self.weight), np.int64)
        weakest, last, since = self.items.weakest(self.kth), len(self.items.levels) - 1, 0
        pairs = [(0, 0, 0, np.array([0]))]
        while pairs:
            depth, node, level, active = pairs.pop()
            single = depth == len(levels)
            here = levels[depth][node] if not single else vector
            if single:
                vector[rows[node][3]] = rows[node][4]
            # Nodes go down one level of items; a document goes down to the items themselves.
            while True:
                bound = self.items.levels[level].products(active, here)
                alive = (bound > 0) & (bound >= weakest[level][active])
                active, bound = active[alive], bound[alive]
                if not len(active) or level == last or not single:
                    break
                active = self.items.children(level, active)
                level += 1
            if single:
                self.keep(rows[node], active, bound)
                vector[rows[node][3]] = 0
                since += 1
            elif len(active):
                if level < last:
                    active = self.items.children(level, active)
                    level += 1
                below = len(levels[depth + 1]) if depth + 1 < len(levels) else len(rows)
                pairs.extend((depth + 1, c, level, active) for c in range(FAN * node, min(FAN * node + FAN, below)))
            if since == 64:
                weakest, since = self.items.weakest(self.kth), 0

    def keep(self, row: tuple, items: np.ndarray, scores: np.ndarray) -> None:
        self.scored += len(items)
        doc_id, file, number = row[:3]
        for i, score in zip(items.tolist(), scores.tolist(), strict=True):
            best = self.best[i]
            best.append((-score, doc_id is None, doc_id or 0, file, number))
            if len(best) >= 3 * self.k:
                best.sort()
                del best[self.k :]
                self.kth[i] = max(self.kth[i], -best[-1][0])

    def hits(self) -> pa.RecordBatch:
        rows = [
            (item, None if no_id else doc_id, file, row, -minus)
            for item, best in zip(self.items.order.tolist(), self.best, strict=True)
            for minus, no_id, doc_id, file, row in sorted(best)[: self.k]
        ]
        columns = zip(*rows, strict=True) if rows else [()] * 5
        kinds = [pa.int32(), *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["item", "doc_id", "file", "row", "score"])


def best_of_tasks(rows: DataFrame, search: Search) -> DataFrame:
    """Each task's best documents of every item."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = []
        for batch in batches:
            plain = [batch.column(c).to_pylist() for c in ("doc_id", "file", "row", "n")]
            lists = [batch.column(c) for c in ("terms", "times")]
            terms, times = [c.flatten().to_numpy() for c in lists]
            ends = np.cumsum([0, *lists[0].value_lengths().to_pylist()])
            for i, (doc_id, file, row, n) in enumerate(zip(*plain, strict=True)):
                some = slice(ends[i], ends[i + 1])
                waiting.append((doc_id, file, row, terms[some].astype(np.int64), search.contributions(n, terms[some], times[some])))
                if len(waiting) == search.tree_docs:
                    search.add(waiting)
                    waiting = []
        if waiting:
            search.add(waiting)
        yield search.hits()

    return rows.filter("size(terms) > 0").mapInArrow(of, HIT)


def best_of_all(hits: DataFrame, k: int) -> DataFrame:
    """The k best of every item with their rank; Spark cuts each task's rows to k before they are shuffled."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "file", "row"]
    ranked = hits.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def seeds() -> Column:
    """The documents that give the starting scores, spread by hash."""
    return F.pmod(F.xxhash64("file", "row"), F.lit(SEED_SHARE)) == 0


def found_in_block(docs: DataFrame, block: list[tuple], k: int) -> DataFrame | None:
    """FOUND of one block of items; None where no document has any of their terms."""
    names = sorted(set(chain.from_iterable(counts for _, counts in block)))
    number = {name: i for i, name in enumerate(names)}
    rows = saved(reduced(docs, number), "search-terms")
    documents, length = rows.agg(F.count("*"), F.sum("n")).first()
    holders = np.zeros(len(names), np.int64)
    for term, count in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holders[term] = count
    vectors = [(item_id, {number[t]: n for t, n in counts.items() if holders[number[t]]}) for item_id, counts in block]
    vectors = [(item_id, vector) for item_id, vector in vectors if vector]
    if not vectors:
        return None
    weight, starting = weights(documents, holders), np.zeros(len(vectors), np.int64)

    def best(some: DataFrame) -> DataFrame:
        items = Items([vector for _, vector in vectors], weight, starting)
        return best_of_all(best_of_tasks(some, Search(items, weight, documents, length, k)), k)

    for item, score in best(rows.filter(seeds())).filter(F.col("rank") == k).select("item", "score").collect():
        starting[item] = score
    ids = docs.sparkSession.createDataFrame([(n, item_id) for n, (item_id, _) in enumerate(vectors)], "item int, item_id long")
    # One row per item of a block, so the broadcast is bounded.
    found = best(rows).join(F.broadcast(ids), "item")
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best documents of every item (see FOUND)."""
    docs, found = file_backed(docs), spark.createDataFrame([], FOUND)
    for block in blocks_of(items):
        part = found_in_block(docs, block, k)
        if part is not None:
            found = found.unionByName(saved(part, "search-found"))
    return found
