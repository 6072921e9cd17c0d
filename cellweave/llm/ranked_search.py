"""Ranked lexical search by ball trees over sparse document vectors; results are exact.

A document is a sparse vector with one whole number per term: what the term adds to the score of any item that has it. An item's
score is the inner product with the item's 0/1 vector. Tasks read the vectors of all documents in turn and build a ball tree of each
bounded run of them: nodes have a centroid, a radius and the largest value per term. For an item, a node's scores are at most
``<item, centroid> + |item| * radius``, rounded up so that floating point can't lose a document, and at most the sum of its largest
values. The smaller of both bounds a subtree. Subtrees are searched best first, until the bound falls below the item's k-th score so far;
in leaves scores are sums of whole numbers. Each task gives its k best per item, and a window the k best of all.

Only terms of items matter, so vectors hold no others. Items are taken in blocks of bounded size; documents, counts and statistics are not
sampled. A bounded sample of documents is scored first: an item's k-th score there is one that its results reach or pass.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm import tables

BEST = 10
# Documents and values of one tree at most, and documents of a leaf.
TREE_ROWS = 8192
TREE_VALUES = 1 << 20
LEAF = 32
# Items, and bytes of their distinct terms, that are searched for together; a single item may be larger.
BLOCK_ITEMS = 1024
BLOCK_BYTES = 4 << 20
# Documents scored first, to know from the start what a result must reach. It changes the work, not the results.
FIRST = 4096
# Bytes of a text that are split into terms at a time.
SPLIT = 1 << 20
# Relative error allowed for sums in floating point; double precision stays below it for trees of this size.
SLACK = 1e-9

# Terms are runs of ASCII letters and digits and of everything beyond ASCII; only A-Z become lower case.
_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size unless one term is longer."""
    data, at = text.translate(_TERM), 0
    while at < len(data):
        end = at + SPLIT
        if end < len(data):
            cut = data.rfind(b" ", at, end)
            end = cut if cut > at else data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def count_terms(text: bytes, known: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of all terms; numbers of the ``known`` ones among them, ascending, and how often each occurs."""
    n, counts = 0, Counter()
    for part in term_lists(text):
        n += len(part)
        counts.update(filter(known.__contains__, part))
    found = sorted((known[t], c) for t, c in counts.items())
    both = np.array(found, np.int64).reshape(-1, 2)
    return n, both[:, 0].astype(np.int32), both[:, 1]


def item_terms(items: DataFrame) -> DataFrame:
    """``uid, item_id, terms``: the distinct terms of each row (item_id, text), joined by spaces; rows without terms go."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        terms = [b" ".join(sorted({t for part in term_lists(x) for t in part})) for x in tables.utf8(batch["text"])]
        out = pa.table({"uid": batch["uid"], "item_id": batch["item_id"], "terms": pa.array(terms, pa.binary())})
        return out.filter(pa.array([bool(x) for x in terms], pa.bool_()))

    picked = items.select(
        F.monotonically_increasing_id().alias("uid"), F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    return tables.settle(tables.map_batches(picked, run, "uid long, item_id long, terms binary"), "items")


def _dealt(items: DataFrame) -> list[DataFrame]:
    """``items`` in blocks within BLOCK_ITEMS and BLOCK_BYTES, or of one item."""
    n, size = items.agg(F.count("*"), F.sum(F.length("terms"))).first()
    blocks = max(1, ceil(n / BLOCK_ITEMS), ceil((size or 0) / BLOCK_BYTES))
    while True:
        block = F.pmod(F.xxhash64("uid"), F.lit(blocks))
        sizes = items.groupBy(block.alias("block")).agg(F.count("*").alias("n"), F.sum(F.length("terms")).alias("size"))
        if not sizes.where(f"n > 1 AND (n > {2 * BLOCK_ITEMS} OR size > {2 * BLOCK_BYTES})").limit(1).count():
            return [items.where(block == i) for i in range(blocks)]
        blocks *= 2


@dataclass(frozen=True)
class Items:
    """A block of items: ids, and the numbers of each one's terms."""

    uids: list[int]
    ids: list[int | None]
    terms: list[np.ndarray]


def term_counts(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, counts`` of documents with terms: numbers (int32) and counts (int64) of the known ones, as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batch: pa.RecordBatch) -> pa.Table:
        found = [count_terms(x, shared.value) for x in tables.utf8(batch["text"])]
        out = pa.table({
            "doc_id": batch["doc_id"], "n": pa.array([x[0] for x in found], pa.int64()),
            "terms": pa.array([x[1].tobytes() for x in found], pa.binary()), "counts": pa.array([x[2].tobytes() for x in found], pa.binary()),
        })
        return out.filter(pa.array([x[0] > 0 for x in found], pa.bool_()))

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return tables.settle(tables.map_batches(picked, run, "doc_id long, n long, terms binary, counts binary"), "counts")


def frequencies(counts: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each term occurs; tasks sum up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, tables.SLICE_ROWS):
                held = b"".join(batch["terms"].slice(i, tables.SLICE_ROWS).to_pylist())
                total += np.bincount(np.frombuffer(held, np.int32), minlength=terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["term", "df"])

    out = np.zeros(terms, np.int64)
    for term, df in counts.mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_part(n: int, n_docs: int, total: int) -> int:
    return 100 - 90 + (90 * n * n_docs) // total


@dataclass(frozen=True)
class Vectors:
    """Sparse rows: row i has ``terms[ptr[i]:ptr[i + 1]]`` with ``values`` above 0; no row is empty."""

    ids: list[int | None]
    ptr: np.ndarray
    terms: np.ndarray
    values: np.ndarray


def vectors(rows: list[tuple], weights: np.ndarray, n_docs: int, total: int) -> Vectors:
    """What each known term of each row (doc_id, n, terms, counts) adds to a score."""
    ids, ends, terms, values = [], [0], [], []
    for doc, n, at, often in rows:
        at, often = np.frombuffer(at, np.int32), np.frombuffer(often, np.int64)
        value = weights[at] * ((1_000_000_000 * often) // (1000 * often + 8 * length_part(n, n_docs, total)))
        kept = value > 0
        if kept.any():
            ids.append(doc), terms.append(at[kept]), values.append(value[kept])
            ends.append(ends[-1] + len(terms[-1]))
    none = np.zeros(0, np.int64)
    return Vectors(ids, np.array(ends), np.concatenate([*terms, none.astype(np.int32)]), np.concatenate([*values, none]))


class BallTree:
    """Node 0 is the root; nodes split at the documents farthest apart, in halves, until a leaf has LEAF documents at most."""

    def __init__(self, rows: Vectors, n_terms: int):
        self.n = len(rows.ids)
        self.order = np.arange(self.n)
        self.ptr, self.terms, self.values = rows.ptr.copy(), rows.terms.copy(), rows.values.copy()
        self.place = np.zeros(n_terms)
        self.squares = np.add.reduceat(self.values.astype(float) ** 2, self.ptr[:-1]) if self.n else np.zeros(0)
        self.ranges: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self.radius: list[float] = []
        at, centre, most = [], [], []
        todo = [(0, self.n)] if self.n else []
        done = 0
        # nodes in breadth-first order: the children of a node get the next two numbers
        while done < len(todo):
            a, b = todo[done]
            lo, hi = self.ptr[a], self.ptr[b]
            terms, values = self.terms[lo:hi], self.values[lo:hi]
            c = np.bincount(terms, values, n_terms) / (b - a)
            high = np.zeros(n_terms, np.int64)
            np.maximum.at(high, terms, values)
            used = np.flatnonzero(high)
            at.append(used), centre.append(c[used]), most.append(high[used])
            far = self._distances(a, b, c)
            self.radius.append(math.sqrt(float(far.max())) * (1 + SLACK))
            self.ranges.append((a, b))
            if b - a > LEAF:
                middle = self._halve(a, b, int(far.argmax()))
                self.children.append((len(todo), len(todo) + 1))
                todo += [(a, middle), (middle, b)]
            else:
                self.children.append(None)
            done += 1
        del self.place
        # postings: for each term the nodes that have it
        node = np.repeat(np.arange(done), [len(x) for x in at])
        key = np.concatenate([*at, np.zeros(0, np.int64)])
        order = np.argsort(key, kind="stable")
        self.node, self.centre = node[order], np.concatenate([*centre, np.zeros(0)])[order]
        self.most = np.concatenate([*most, np.zeros(0, np.int64)])[order]
        self.posting = np.searchsorted(key[order], np.arange(n_terms + 1))
        self.radius = np.array(self.radius)

    def _dots(self, a: int, b: int, dense: np.ndarray) -> np.ndarray:
        lo, hi = self.ptr[a], self.ptr[b]
        return np.add.reduceat(self.values[lo:hi] * dense[self.terms[lo:hi]], self.ptr[a:b] - lo)

    def _distances(self, a: int, b: int, dense: np.ndarray, square: float | None = None) -> np.ndarray:
        """Squared distances of the rows a to b from ``dense``, never below the true ones."""
        square = float(dense @ dense) if square is None else square
        own = self.squares[a:b]
        return np.maximum(own - 2 * self._dots(a, b, dense) + square, 0) + SLACK * (own + square)

    def _from_row(self, a: int, b: int, row: int) -> np.ndarray:
        lo, hi = self.ptr[a + row], self.ptr[a + row + 1]
        self.place[self.terms[lo:hi]] = self.values[lo:hi]
        found = self._distances(a, b, self.place, float(self.squares[a + row]))
        self.place[self.terms[lo:hi]] = 0
        return found

    def _halve(self, a: int, b: int, first: int) -> int:
        """Rows nearer to ``first`` come before those nearer to the row farthest from it; both halves are equally large."""
        near = self._from_row(a, b, first)
        side = near - self._from_row(a, b, int(near.argmax()))
        order = np.argsort(side, kind="stable")
        size = np.diff(self.ptr[a : b + 1])[order]
        ends = np.cumsum(size)
        lo, hi = self.ptr[a], self.ptr[b]
        take = np.repeat(self.ptr[a:b][order] - (ends - size), size) + np.arange(hi - lo)
        self.terms[lo:hi], self.values[lo:hi] = self.terms[take], self.values[take]
        self.order[a:b], self.squares[a:b] = self.order[a:b][order], self.squares[a:b][order]
        self.ptr[a + 1 : b + 1] = lo + ends
        return (a + b) // 2

    def bounds(self, item: np.ndarray) -> np.ndarray:
        """For each node a number that no score in it passes."""
        ball, box = np.zeros(len(self.radius)), np.zeros(len(self.radius), np.int64)
        for t in item.tolist():
            lo, hi = self.posting[t], self.posting[t + 1]
            ball[self.node[lo:hi]] += self.centre[lo:hi]
            box[self.node[lo:hi]] += self.most[lo:hi]
        ball = (ball + math.sqrt(len(item)) * self.radius) * (1 + SLACK) + 1
        return np.minimum(ball, box)

    def search(self, item: np.ndarray, mark: np.ndarray, least: int, offer) -> int:
        """Offers (scores, rows) of leaves, best bound first, until no other reaches ``least`` or what ``offer`` returns.

        ``mark`` is 1 at the item's terms. Returns the number of documents scored.
        """
        if not self.n:
            return 0
        bounds = self.bounds(item).tolist()
        heap, scored = [(-bounds[0], 0)], 0
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least or bound == 0:
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            a, b = self.ranges[node]
            lo, hi = self.ptr[a], self.ptr[b]
            scores = np.add.reduceat(self.values[lo:hi] * mark[self.terms[lo:hi]], self.ptr[a:b] - lo)
            scored += b - a
            found = np.flatnonzero(scores >= max(least, 1))
            if len(found):
                least = offer(scores[found].tolist(), self.order[a:b][found].tolist())
        return scored


class Best:
    """The k best (score, smaller doc_id first, null last) of each item, over all trees of a task."""

    def __init__(self, items: Items, k: int, floors: list[int]):
        self.k, self.floors, self.heaps = k, floors, [[] for _ in items.uids]

    def least(self, item: int) -> int:
        heap = self.heaps[item]
        return max(self.floors[item], heap[0][0]) if len(heap) == self.k else self.floors[item]

    def offer(self, item: int, scores: list[int], docs: list[int | None]) -> int:
        heap = self.heaps[item]
        for score, doc in zip(scores, docs, strict=True):
            entry = (score, -(1 << 64) if doc is None else -doc)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        return self.least(item)


_FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def best_of_tasks(counts: DataFrame, items: Items, weights: np.ndarray, n_docs: int, total: int, floors: list[int], k: int) -> DataFrame:
    """``item, doc_id, score``: the k best documents of each item in each task, ``item`` being a place in ``items``."""
    shared = counts.sparkSession.sparkContext.broadcast((items, weights, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, floors = shared.value
        best, mark = Best(items, k, floors), np.zeros(len(weights), np.int64)

        def search(rows: list[tuple]) -> None:
            found = vectors(rows, weights, n_docs, total)
            tree = BallTree(found, len(weights))
            for i, item in enumerate(items.terms):
                mark[item] = 1
                tree.search(item, mark, best.least(i), lambda s, at, i=i: best.offer(i, s, [found.ids[x] for x in at]))
                mark[item] = 0

        rows, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, tables.SLICE_ROWS):
                for row in zip(*(c.to_pylist() for c in batch.slice(start, tables.SLICE_ROWS).columns), strict=True):
                    rows.append(row)
                    size += len(row[2]) // 4
                    if len(rows) >= TREE_ROWS or size >= TREE_VALUES:
                        search(rows)
                        rows, size = [], 0
        search(rows)
        out = [(i, None if -d == 1 << 64 else -d, s) for i, heap in enumerate(best.heaps) for s, d in heap]
        tables.give_back()
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else ([],) * 3, _FOUND, strict=True)], schema=_FOUND)

    return counts.mapInArrow(run, "item int, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents (doc_id, text) of each row of ``items`` (item_id, text).

    Null texts have no terms; such items have no results and such documents count nowhere. Scores are above 0; equal ones are in order
    of doc_id, nulls last. Repeated rows count and come as often as they are there, items as well.
    """
    spark = docs.sparkSession
    tables.workers_find_package(spark)
    out = [spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")]
    for block in _dealt(item_terms(items)):
        rows = sorted(block.collect(), key=lambda x: x["uid"])
        if not rows:
            continue
        lists = [bytes(x["terms"]).split(b" ") for x in rows]
        known = {t: i for i, t in enumerate(sorted({t for terms in lists for t in terms}))}
        own = Items([x["uid"] for x in rows], [x["item_id"] for x in rows], [np.array([known[t] for t in terms]) for terms in lists])
        counts = term_counts(docs, known)
        n_docs, total = counts.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        weights = np.array([weight(n_docs, df) for df in frequencies(counts, len(known)).tolist()], np.int64)
        share = ceil(n_docs / FIRST)
        first = counts.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(share)) == 0).limit(FIRST)
        floors = [0] * len(rows)
        for x in _ranked(best_of_tasks(first, own, weights, n_docs, total, floors, k), k).where(F.col("rank") == k).collect():
            floors[x["item"]] = x["score"]
        found = _ranked(best_of_tasks(counts, own, weights, n_docs, total, floors, k), k)
        names = F.broadcast(spark.createDataFrame([*enumerate(own.ids)], "item int, item_id long"))
        out.append(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, out)
