"""Packing of documents into sequences by a grouping genetic algorithm.

A solution is a set of bins. Crossover injects whole well-filled bins of one parent into the other, takes out the bins that hold
any of the same pieces, and best-fits what that displaced. Pieces are dealt into shards of bounded size; on each shard
several islands evolve solutions of their own, each in one task, and after each epoch an island receives the elite of its
neighbour. Pieces in bins that stay poorly filled are pooled over all shards and packed again.
"""

from __future__ import annotations

import zlib
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm import tables
from cellweave.llm.encode import DroppedSpaces, Remembering

CAPACITY = 2048
SHARD_ROWS = 16_384
ISLANDS = 2
EPOCHS = 2
POPULATION = 3
GENERATIONS = 4
# Bins filled less than this are pooled over shards and packed again.
POOR = 0.985
SEPARATOR = 0


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document (doc_id, text): its ids and a separator, cut at ``capacity``.

    Null and empty texts have the separator only. Only documents longer than ``capacity`` are cut.
    """
    encoders: list[Remembering] = []
    end = np.array([SEPARATOR], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.Table:
        if not encoders:
            encoders.append(Remembering(DroppedSpaces(tokenizer)))
        rows = []
        for doc, words in zip(batch["doc_id"].to_pylist(), encoders[0].encode(tables.texts(batch["text"])), strict=True):
            ids = b"".join(words) + end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return tables.map_batches(picked, run, "doc_id long, piece int, start long, length long, ids_crc32 long", encoders)


class Bins:
    """Bins under construction; an item goes where it leaves the least room."""

    def __init__(self, capacity: int):
        self.capacity, self.members = capacity, []
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r: some bin has room r

    def add(self, members: list[int], used: int) -> None:
        self._put(len(self.members), self.capacity - used)
        self.members.append(members)

    def _put(self, b: int, room: int) -> None:
        if room:
            self.by_room[room].append(b)
            self.rooms |= 1 << room

    def best_fit(self, items: list[int], sizes: list[int]) -> None:
        for i in items:
            size = sizes[i]
            fits = self.rooms >> size
            if not fits:
                self.add([i], size)
                continue
            room = size + (fits & -fits).bit_length() - 1
            stack = self.by_room[room]
            b = stack.pop()
            if not stack:
                self.rooms ^= 1 << room
            self.members[b].append(i)
            self._put(b, room - size)


class Island:
    """Evolves solutions for one shard; a solution is a list of bins, each a list of item numbers."""

    def __init__(self, sizes: np.ndarray, capacity: int, seed: int):
        self.sizes, self.capacity = sizes.tolist(), capacity
        self.random = np.random.default_rng(seed)
        self.least = ceil(int(sizes.sum()) / capacity)

    def used(self, solution: list[list[int]]) -> np.ndarray:
        flat = np.fromiter((i for b in solution for i in b), np.int64)
        ends = np.cumsum([len(b) for b in solution])
        total = np.concatenate([[0], np.cumsum(np.asarray(self.sizes)[flat])])
        return total[ends] - total[np.concatenate([[0], ends[:-1]])]

    def fitness(self, solution: list[list[int]]) -> tuple[int, float]:
        """Smaller is better: the number of bins, then how evenly room is spread over them."""
        fill = self.used(solution) / self.capacity
        return len(solution), -float((fill * fill).sum())

    def fresh(self, noise: float) -> list[list[int]]:
        """Best fit in falling order of size, blurred by ``noise``."""
        order = np.argsort(-np.asarray(self.sizes) * self.random.uniform(1 - noise, 1 + noise, len(self.sizes)), kind="stable")
        bins = Bins(self.capacity)
        bins.best_fit(order.tolist(), self.sizes)
        return bins.members

    def _refit(self, kept: list[list[int]], displaced: list[int]) -> list[list[int]]:
        bins = Bins(self.capacity)
        if kept:
            for members, used in zip(kept, self.used(kept).tolist(), strict=True):
                bins.add(list(members), used)
        displaced.sort(key=lambda i: -self.sizes[i])
        bins.best_fit(displaced, self.sizes)
        return bins.members

    def cross(self, a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
        """Inject a tenth to a quarter of b's bins, drawn from its better filled half, into a."""
        used = self.used(b)
        good = np.argsort(-used, kind="stable")[: max(1, len(b) // 2)]
        n = max(1, int(len(b) * self.random.uniform(0.1, 0.25)))
        injected = [b[i] for i in self.random.permutation(good)[:n]]
        inside = {i for x in injected for i in x}
        kept, displaced = [], []
        for x in a:
            if inside.isdisjoint(x):
                kept.append(x)
            else:
                displaced += [i for i in x if i not in inside]
        return self._refit(kept + [list(x) for x in injected], displaced)

    def mutate(self, a: list[list[int]]) -> list[list[int]]:
        """Dissolve the worst filled bins and a few others, and best-fit their items."""
        drop = set(np.argsort(self.used(a), kind="stable")[: max(1, len(a) // 50)].tolist())
        drop.update(self.random.choice(len(a), max(1, len(a) // 50)).tolist())
        return self._refit([x for i, x in enumerate(a) if i not in drop], [i for d in drop for i in a[d]])

    def evolve(self, given: list[list[list[int]]]) -> list[list[int]]:
        """The elite after GENERATIONS; ends early at the least number of bins that the sum of sizes allows."""
        people = [*given, *(self.fresh(0.0 if not given and k == 0 else 0.25) for k in range(max(0, POPULATION - len(given))))]
        ranked = sorted(((self.fitness(p), k, p) for k, p in enumerate(people)), key=lambda x: x[:2])
        for g in range(GENERATIONS):
            if ranked[0][0][0] <= self.least:
                break
            people = [x[2] for x in ranked[:POPULATION]]
            children = []
            for k in range(1, len(people)):
                children += [self.cross(people[0], people[k]), self.cross(people[k], people[0])]
            children.append(self.mutate(people[0]))
            ranked += [(self.fitness(c), len(ranked) + k + 100 * g, c) for k, c in enumerate(children)]
            ranked.sort(key=lambda x: x[:2])
        return ranked[0][2]


def _solutions(bins: pd.Series) -> list[list[int]]:
    """Bins of row numbers from a bin number per row."""
    order = np.argsort(bins.to_numpy(), kind="stable")
    edges = np.flatnonzero(np.diff(bins.to_numpy()[order])) + 1
    return [x.tolist() for x in np.split(order, edges)]


def _epoch(items: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Evolve each (shard, island) of ``items`` (shard, island, uid, length, own, migrant): the elite's bin of each item."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("uid", kind="stable").reset_index(drop=True)
        island = Island(part["length"].to_numpy(), capacity, int(part["shard"][0]) * 1009 + int(part["island"][0]) * 31 + epoch)
        given = [_solutions(part[c]) for c in ("own", "migrant") if part[c].notna().all()]
        best = island.evolve(given)
        count, spread = island.fitness(best)
        rows = np.concatenate([np.asarray(b, np.int64) for b in best])
        out = part.iloc[rows][["shard", "island", "uid", "length"]].copy()
        out["bin"] = np.repeat(np.arange(len(best)), [len(b) for b in best])
        ends = np.cumsum(out["length"].to_numpy()) - out["length"].to_numpy()
        first = np.concatenate([[True], np.diff(out["bin"].to_numpy()) != 0])
        out["offset"] = ends - np.maximum.accumulate(np.where(first, ends, 0))
        used = out.groupby("bin")["length"].transform("sum")
        out["used"], out["bins"], out["spread"] = used, count, spread
        tables.give_back()
        return out

    schema = "shard long, island int, uid long, length long, bin long, offset long, used long, bins long, spread double"
    tables.workers_find_package(items.sparkSession)
    return items.groupBy("shard", "island").applyInPandas(run, schema)


def evolve(items: DataFrame, capacity: int, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``shard, uid, length, bin, offset, used``: the best island's solution of each shard of ``items`` (shard, uid, length)."""
    none = F.lit(None).cast("long")
    state = items.select("shard", "uid", "length", F.explode(F.array(*map(F.lit, range(islands)))).alias("island"))
    state = state.select("shard", "island", "uid", "length", none.alias("own"), none.alias("migrant"))
    for epoch in range(epochs):
        elite = tables.settle(_epoch(state, capacity, epoch), "elite")
        if epoch < epochs - 1 and islands > 1:
            moved = elite.select("shard", ((F.col("island") + 1) % islands).alias("island"), "uid", F.col("bin").alias("migrant"))
            state = elite.join(moved, ["shard", "island", "uid"]).select("shard", "island", "uid", "length", F.col("bin").alias("own"), "migrant")
    best = elite.groupBy("shard").agg(F.min(F.struct("bins", "spread", "island")).alias("_best")).select("shard", F.col("_best.island").alias("island"))
    return elite.join(best, ["shard", "island"]).select("shard", "uid", "length", "bin", "offset", "used")


def _dealt(items: DataFrame, salt: int) -> DataFrame:
    """``items`` with a shard by hash; as many shards as rows need, so that a shard stays near SHARD_ROWS."""
    shards = ceil(items.count() / SHARD_ROWS) or 1
    return items.withColumn("shard", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(shards)))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (from ``pieces``) with ``sequence_id`` and ``offset``; sequences are gapless from 0 and hold at most ``capacity``.

    Repeated rows are packed as often as they come. An empty table gives no sequences.
    """
    cut = tables.settle(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    whole = cut.where(F.col("length") == capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    first = tables.settle(evolve(_dealt(cut.where(F.col("length") < capacity).select("uid", "length"), 0), capacity), "packed")
    good = first.where(F.col("used") >= POOR * capacity)
    again = evolve(_dealt(first.where(F.col("used") < POOR * capacity).select("uid", "length"), 1), capacity, epochs=1)

    def named(part: DataFrame, level: int) -> DataFrame:
        return part.select("uid", ((F.col("shard") * (1 << 24) + F.col("bin")) * 2 + level).alias("sequence_id"), "offset")

    placed = whole.unionByName(named(good, 0)).unionByName(named(again, 1))
    return cut.join(placed, "uid").drop("uid")
