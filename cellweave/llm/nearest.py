"""Nearest neighbours by inner product, found through randomly rotated one-bit codes and scored exactly.

A vector's difference from a centroid is padded, rotated at random and kept as the signs of its coordinates, with two scalars: one that
turns the inner product of signs and a rotated query into an unbiased estimate, and one that bounds its error. With b bits the estimate
lies within ``CONFIDENCE * sqrt(1 - a * a) / a / sqrt(b - 1)`` of the truth, in lengths of both vectors, but for a small share of pairs
that CONFIDENCE sets; a is the cosine of the rotated vector and its signs. Only vectors whose estimate and error together reach
the query's k-th best score so far are scored by their original components.

Queries and vectors are dealt into blocks, and each cell of that grid is read by one task as a stream: its queries first, then its
vectors. Queries start from the score that they reach in a bounded sample of vectors, from which the centroid comes as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm import tables

BEST = 20
# Bits of a code at least, and standard deviations of an estimate's error that are allowed for.
BITS = 256
CONFIDENCE = 3.5
# Vectors that the centroid and the queries' first scores come from, by rows and by bytes.
SAMPLE_ROWS = 4096
SAMPLE_BYTES = 8 << 20
# Queries of a block, vectors of a block, and blocks of vectors at most (a block may then be larger: it is a stream).
QUERY_ROWS = 512
BLOCK_ROWS = 8192
BLOCKS = 256
# Vectors of a stream that are compared with a block of queries at a time, and pairs that are scored at a time.
SLICE = 2048
PAIRS = 1 << 14
ROUNDS = 3


@dataclass(frozen=True)
class Coder:
    """Codes of vectors of ``size`` components around ``centre``."""

    size: int
    centre: np.ndarray
    bits: int
    signs: np.ndarray  # ROUNDS x bits

    def rotate(self, x: np.ndarray) -> np.ndarray:
        """Rows of ``x``, padded with zeros to ``bits`` coordinates and rotated: signs are flipped and a Hadamard transform mixes all."""
        out = np.zeros((len(x), self.bits))
        out[:, : x.shape[1]] = x
        for flip in self.signs:
            out *= flip
            step = 1
            while step < self.bits:
                pairs = out.reshape(len(out), -1, 2, step)
                out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(out), self.bits)
                step *= 2
            out /= np.sqrt(self.bits)
        return out

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed signs, scale and error of each row: the inner product with q is ``q @ centre + scale * (signs @ rotate(q))``,
        within ``CONFIDENCE * error * |q|``."""
        rest = x - self.centre
        turned = self.rotate(rest)
        norm, total = np.linalg.norm(rest, axis=1), np.abs(turned).sum(1)
        some = total > 0
        scale = np.divide(norm**2, total, out=np.zeros(len(x)), where=some)
        cosine = np.divide(total, np.sqrt(self.bits) * norm, out=np.ones(len(x)), where=some)
        error = norm * np.sqrt(np.maximum(1 - cosine**2, 0)) / cosine / np.sqrt(self.bits - 1)
        # what sums in single precision may add
        return np.packbits(turned > 0, axis=1), scale, error + 1e-5 * (norm + np.linalg.norm(self.centre))


def coder(sample: np.ndarray, size: int, bits: int = BITS, seed: int = 5) -> Coder:
    """A coder around the mean of ``sample``; the number of bits is the power of two that holds ``size``, or ``bits``."""
    bits = max(bits, 1 << max(size - 1, 1).bit_length())
    centre = sample.mean(0) if len(sample) else np.zeros(size)
    return Coder(size, centre, bits, np.random.default_rng(seed).choice([-1.0, 1.0], (ROUNDS, bits)))


def _matrix(column: pa.Array, size: int, kind: str) -> np.ndarray:
    """Vectors of a binary column as rows in double precision; shorter ones end in zeros."""
    width = size * np.dtype(kind).itemsize
    held = b"".join(x.ljust(width, b"\0") for x in column.to_pylist())
    return np.frombuffer(held, kind).reshape(-1, size).astype(float)


def usable(vectors: DataFrame) -> tuple[DataFrame, str]:
    """``uid, vec_id, vector`` of the rows that take part, components as bytes, and the components' type.

    Not those that are null, hold nulls, infinities or NaN, or are empty or zero.
    """
    kind = "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"

    def run(batch: pa.RecordBatch) -> pa.Table:
        kept, found = [], []
        for x in batch["embedding"]:
            ok = x.is_valid and x.values.null_count == 0 and len(x.values)
            row = np.asarray(x.values, float) if ok else None
            kept.append(bool(ok and np.isfinite(row).all() and row.any()))
            found.append(row.astype(kind).tobytes() if kept[-1] else None)
        out = pa.table({"uid": batch["uid"], "vec_id": batch["vec_id"], "vector": pa.array(found, pa.binary())})
        return out.filter(pa.array(kept, pa.bool_()))

    picked = vectors.select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    return tables.settle(tables.map_batches(picked, run, "uid long, vec_id long, vector binary"), "vectors"), kind


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, in double precision; equal rows give equal results wherever they stand."""
    return np.concatenate([(x[i : i + PAIRS] * y[i : i + PAIRS]).sum(1) for i in range(0, len(x), PAIRS)] or [np.zeros(0)])


CELL = "cell long, side int, uid long, vec_id long, vector binary, code binary, scale double, error double"
_CELL = pa.schema([
    ("side", pa.int32()), ("uid", pa.int64()), ("vec_id", pa.int64()), ("vector", pa.binary()), ("code", pa.binary()), ("scale", pa.float64()),
    ("error", pa.float64()),
])
_SIDE = CELL.removeprefix("cell long, ")


def coded(rows: DataFrame, made: Coder, kind: str) -> DataFrame:
    """Vectors with code, scale and error."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        code, scale, error = made.encode(_matrix(batch["vector"], made.size, kind))
        codes = pa.array([x.tobytes() for x in code], pa.binary())
        side = pa.array(np.ones(batch.num_rows, np.int32))
        return pa.table([side, batch["uid"], batch["vec_id"], batch["vector"], codes, pa.array(scale), pa.array(error)], schema=_CELL)

    return tables.map_batches(rows, run, _SIDE)


def opened(rows: DataFrame, sample: np.ndarray, uids: np.ndarray, size: int, kind: str, k: int) -> DataFrame:
    """Queries with the k-th best score that they reach in ``sample``, themselves left out, as scale."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        x = _matrix(batch["vector"], size, kind)
        least = np.full(len(x), -np.inf)
        if len(sample) > k:
            scores = x @ sample.T
            scores[uids == np.asarray(batch["uid"])[:, None]] = -np.inf
            least = np.partition(scores, -k, axis=1)[:, -k]
            least -= 1e-9 * np.abs(least)
        side, none = pa.array(np.zeros(len(x), np.int32)), pa.nulls(len(x))
        return pa.table([side, batch["uid"], batch["vec_id"], batch["vector"], none.cast(pa.binary()), pa.array(least), none.cast(pa.float64())], schema=_CELL)

    return tables.map_batches(rows, run, _SIDE)


_FOUND = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("uid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


class Cell:
    """The best vectors found so far for a block of queries."""

    def __init__(self, made: Coder, kind: str, k: int):
        self.made, self.kind, self.k = made, kind, k
        self.parts: list[pa.RecordBatch] = []
        self.best: list[np.ndarray] | None = None
        self.scored = 0

    def ask(self, part: pa.RecordBatch) -> None:
        self.parts.append(part)

    def _ready(self) -> None:
        rows = pa.Table.from_batches(self.parts).combine_chunks()
        self.uid, self.ids = np.asarray(rows["uid"]), rows["vec_id"].to_pylist()
        self.x = _matrix(rows["vector"], self.made.size, self.kind)
        self.least = np.asarray(rows["scale"]).copy()
        self.norm, self.middle = np.linalg.norm(self.x, axis=1), self.x @ self.made.centre
        self.turned = self.made.rotate(self.x).astype(np.float32).T.copy()
        # per query: score, id missing, id, uid
        self.best = [np.zeros((0, 3)) for _ in self.ids]
        self.keys = [np.zeros((0, 2), np.int64) for _ in self.ids]

    def read(self, part: pa.RecordBatch) -> None:
        """Compare a slice of vectors with all queries."""
        if self.best is None:
            self._ready()
        x = _matrix(part["vector"], self.made.size, self.kind)
        uid, missing = np.asarray(part["uid"]), np.asarray(part["vec_id"].is_null())
        ids = np.asarray(part["vec_id"].fill_null(0))
        codes = np.frombuffer(b"".join(part["code"].to_pylist()), np.uint8).reshape(len(x), -1)
        signs = np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1
        likely = (signs @ self.turned) * np.asarray(part["scale"])[:, None] + self.middle
        likely[uid[:, None] == self.uid] = -np.inf
        done = np.zeros(likely.shape, bool)
        # the likeliest first, so that the others have more to reach
        top = min(2 * self.k, len(x))
        rows = np.argpartition(-likely, top - 1, axis=0)[:top].T.ravel()
        self._score(x, uid, ids, missing, rows, np.repeat(np.arange(len(self.x)), top), done, likely)
        reach = likely + CONFIDENCE * np.asarray(part["error"])[:, None] * self.norm
        queries, rows = np.nonzero(((reach >= self.least) & ~done).T)
        self._score(x, uid, ids, missing, rows, queries, done, likely)

    def _score(self, x, uid, ids, missing, rows, queries, done, likely) -> None:
        own = np.isneginf(likely[rows, queries])
        rows, queries = rows[~own], queries[~own]
        done[rows, queries] = True
        self.scored += len(rows)
        scores = np.concatenate([exact(x[rows[i : i + PAIRS]], self.x[queries[i : i + PAIRS]]) for i in range(0, len(rows), PAIRS)] or [np.zeros(0)])
        good = scores >= self.least[queries]
        rows, queries, scores = rows[good], queries[good], scores[good]
        order = np.argsort(queries, kind="stable")
        rows, queries, scores = rows[order], queries[order], scores[order]
        starts = np.flatnonzero(np.diff(queries, prepend=-1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(queries)]):
            q, at = int(queries[a]), rows[a:b]
            held = np.concatenate([self.best[q], np.stack([scores[a:b], missing[at], np.zeros(b - a)], 1)])
            keys = np.concatenate([self.keys[q], np.stack([ids[at], uid[at]], 1)])
            order = np.lexsort((keys[:, 1], keys[:, 0], held[:, 1], -held[:, 0]))[: self.k]
            self.best[q], self.keys[q] = held[order], keys[order]
            if len(order) == self.k:
                self.least[q] = max(self.least[q], held[order[-1], 0])

    def found(self) -> pa.RecordBatch | None:
        if self.best is None:
            return None
        sizes = [len(x) for x in self.best]
        held, keys = np.concatenate(self.best), np.concatenate(self.keys)
        queries = np.repeat(np.arange(len(sizes)), sizes)
        ids = pa.array(self.ids, pa.int64()).take(pa.array(queries))
        vec_id = pa.array(keys[:, 0], mask=held[:, 1] > 0)
        return pa.RecordBatch.from_arrays([pa.array(self.uid[queries]), ids, pa.array(keys[:, 1]), vec_id, pa.array(held[:, 0])], schema=_FOUND)


def candidates(grid: DataFrame, made: Coder, kind: str, k: int) -> DataFrame:
    """``query, query_id, uid, vec_id, score``: the k best of each cell for each of its queries. ``grid`` is in order inside partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, now = None, None
        for batch in batches:
            numbers, side = np.asarray(batch["cell"]), np.asarray(batch["side"])
            edges = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(side) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(numbers)]):
                if now is None or numbers[a] != cell:
                    if now is not None and (out := now.found()) is not None:
                        yield out
                    cell, now = numbers[a], Cell(made, kind, k)
                if side[a] == 0:
                    now.ask(batch.slice(a, b - a))
                elif now.parts:
                    for i in range(a, b, SLICE):
                        now.read(batch.slice(i, min(SLICE, b - i)))
        if now is not None and (out := now.found()) is not None:
            yield out
        tables.give_back()

    ddl = "query long, query_id long, uid long, vec_id long, score double"
    return grid.mapInArrow(run, ddl)


def search(vectors: DataFrame, is_query: Column, k: int = BEST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest other rows of each row of ``vectors`` (vec_id, embedding) that ``is_query`` picks.

    Nearest is the largest inner product; equal ones are in order of vec_id, nulls last. ``is_query`` may use vec_id; null is no.
    Vectors that are null, empty, zero or hold null or non-finite components take no part; shorter ones count as ended by zeros.
    Repeated rows are rows of their own, neighbours of each other. All candidates come back where they are fewer than ``k``.
    """
    spark = vectors.sparkSession
    tables.workers_find_package(spark)
    rows, kind = usable(vectors)
    width = np.dtype(kind).itemsize
    n, size, asked = rows.agg(F.count("*"), F.max(F.length("vector")), F.count_if(F.coalesce(is_query, F.lit(False)))).first()
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size //= width
    take = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
    picked = rows.where(F.pmod(F.xxhash64("uid"), F.lit(ceil(n / take))) == 0).limit(take).select("uid", "vector").toArrow()
    sample = _matrix(picked["vector"].combine_chunks(), size, kind)
    made = coder(sample, size)

    blocks, groups = max(1, min(BLOCKS, ceil(n / BLOCK_ROWS))), ceil(asked / QUERY_ROWS)
    queries = opened(rows.where(F.coalesce(is_query, F.lit(False))), sample, np.asarray(picked["uid"]), size, kind, k)
    group = F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(groups)) * blocks
    block = F.pmod(F.xxhash64("uid", F.lit(2)), F.lit(blocks))
    columns = ["side", "uid", "vec_id", "vector", "code", "scale", "error"]
    asking = queries.select(F.explode(F.sequence(group, group + (blocks - 1))).alias("cell"), *columns)
    there = coded(rows, made, kind).select(F.explode(F.sequence(block, block + (groups - 1) * blocks, F.lit(blocks).cast("long"))).alias("cell"), *columns)
    grid = asking.unionByName(there).repartition("cell").sortWithinPartitions("cell", "side")
    found = candidates(grid, made, kind, k)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "uid")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
