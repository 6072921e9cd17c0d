"""Quality rules: exact counts per text, and an isolation forest over the rates that follow from them.

Trees split the box of all rates at random places; a text whose rates lie where few texts are ends in a small cell after a
short path. The forest is grown from a bounded sample of documents, without those labelled bad; the threshold on its score comes from labelled rows:
the lowest one that loses at most a share of ``LOSS`` (rounded up to a row) of those labelled good.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm import tables, words

LEAST_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"

TREES = 128
DEPTH = 8
SUBSAMPLE = 256
# Documents the forest is grown from, at most about this many, chosen by a hash of id and text over all documents.
SAMPLE = 8192
# Share of labelled good documents that the threshold may reject.
LOSS = 0.001
SCORE_STEPS = 2000

RATES = ["symbols", "word_length", "capitals"]
# Rates are those of the text with so many usual words added, which draws short texts towards the middle.
PRIOR_WORDS, PRIOR_LENGTH, PRIOR_CAPITALS = 30, 5.0, 0.1
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
REST = "n_capitals long"

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_STARTS = (np.arange(256) & 0xC0) != 0x80
_IS_CAPITAL = np.isin(np.arange(256), np.arange(65, 91))


def count_rules(text: bytes) -> tuple[int, ...]:
    """The counts in the order of COUNTS and REST. A text without words has zeros but for its symbols."""
    data = np.frombuffer(text, np.uint8)
    h, starts, ends = words.word_hashes(text)
    per_byte = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_STARTS[data], out=per_byte[1:])
    lines = Counter(x for x in text.split(b"\n") if x.strip())
    return (
        len(h), int((per_byte[ends] - per_byte[starts]).sum()), int(_IS_SYMBOL[data].sum()), lines.total() - len(lines),
        repeated_words(h), int(_IS_CAPITAL[data].sum()),
    )


def repeated_words(h: np.ndarray, size: int = WINDOW) -> int:
    """Words in windows of ``size`` words that the text has twice or more."""
    runs = words.runs(h, size)
    if len(runs) < 2:
        return 0
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(runs), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    cover[: len(runs)] += again
    cover[size : size + len(runs)] -= again
    return int((np.cumsum(cover)[:-1] > 0).sum())


def rule_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of COUNTS and REST and ``base_failed``; null text counts as empty."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        found = np.array([count_rules(x) for x in tables.utf8(batch["text"])], np.int64).reshape(-1, 6)
        names = [x.split()[0] for x in f"{COUNTS}, {REST}".split(", ")]
        return pa.table({"doc_id": batch["doc_id"]} | {name: pa.array(found[:, i]) for i, name in enumerate(names)})

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return tables.map_batches(picked, run, f"doc_id long, {COUNTS}, {REST}").withColumn("base_failed", failed)


def with_rates(counts: DataFrame) -> DataFrame:
    n = (F.col("n_words") + PRIOR_WORDS).cast("double")
    rates = [
        F.sqrt(F.col("n_symbols") / n), (F.col("word_chars") + PRIOR_LENGTH * PRIOR_WORDS) / n,
        F.sqrt((F.col("n_capitals") + PRIOR_CAPITALS * PRIOR_WORDS) / n),
    ]
    return counts.withColumn("rates", F.array(*rates))


@dataclass(frozen=True)
class Forest:
    """Complete trees of DEPTH levels: node k has children 2k + 1 and 2k + 2."""

    feature: np.ndarray  # trees x inner nodes
    at: np.ndarray
    length: np.ndarray  # trees x leaves: path length expected from the leaf's depth and size
    usual: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / usual length): towards 1 for texts unlike the others."""
        rows, total = np.arange(len(x)), np.zeros(len(x))
        for feature, at, length in zip(self.feature, self.at, self.length, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] >= at[node])
            total += length[node - len(feature)]
        return 2.0 ** (-total / len(self.feature) / self.usual)


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a random tree of n points."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow(sample: np.ndarray, others: np.ndarray | None = None, seed: int = 7) -> Forest | None:
    """A forest over rows of rates; None without rows.

    Splits are uniform over each cell of the bounding box of ``sample`` and ``others``. Only rows of ``sample`` make paths longer, so
    that rows known to be bad, given as ``others``, leave their part of the box empty however many they are.
    """
    if not len(sample):
        return None
    box = sample if others is None else np.concatenate([sample, others])
    r = np.random.default_rng(seed)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feature, at, length = [], [], []
    for _ in range(TREES):
        part = sample[r.choice(len(sample), min(SUBSAMPLE, len(sample)), replace=False)]
        f, a = r.integers(0, sample.shape[1], inner), np.zeros(inner)
        low, high = np.zeros((inner + leaves, sample.shape[1])), np.zeros((inner + leaves, sample.shape[1]))
        low[0], high[0] = box.min(0), box.max(0)
        for k in range(inner):
            a[k] = r.uniform(low[k, f[k]], high[k, f[k]])
            for child in (2 * k + 1, 2 * k + 2):
                low[child], high[child] = low[k], high[k]
            high[2 * k + 1, f[k]] = low[2 * k + 2, f[k]] = a[k]
        node, depth = np.zeros(len(part), np.int64), np.zeros((inner + leaves, 2))
        depth[0] = len(part), 0
        for _ in range(DEPTH):
            node = 2 * node + 1 + (part[np.arange(len(part)), f[node]] >= a[node])
            np.add.at(depth[:, 0], node, 1)
        for k in range(1, inner + leaves):
            parent = depth[(k - 1) // 2]
            # a cell with one text or none ends the path
            depth[k, 1] = parent[1] + (parent[0] > 1)
        feature.append(f), at.append(a)
        length.append(depth[inner:, 1] + _average_path(depth[inner:, 0]))
    return Forest(np.array(feature), np.array(at), np.array(length), float(max(_average_path(min(SUBSAMPLE, len(sample))), 1.0)))


def sample_rates(rated: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Rates of about ``size`` documents that pass the base rules, the same ones in every run: those not labelled bad, and those that are."""
    n = rated.where("NOT base_failed").count()
    share = min(1.0, size / max(n, 1))
    picked = rated.where("NOT base_failed").where(F.pmod(F.xxhash64("doc_id", "rates"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    rows = picked.select("rates", "doc_id").collect()
    ids = F.broadcast(picked.select("doc_id").distinct())
    bad = {x[0] for x in labels.where("quality = 0").select(F.col("doc_id").cast("long").alias("doc_id")).join(ids, "doc_id", "left_semi").distinct().collect()}
    found = [np.array(sorted(x["rates"] for x in rows if (x["doc_id"] in bad) == wanted), float).reshape(-1, len(RATES)) for wanted in (False, True)]
    return found[0], found[1]


def score(rated: DataFrame, forest: Forest | None) -> DataFrame:
    """``rated`` with ``anomaly`` from 0 to 1."""
    if forest is None:
        return rated.withColumn("anomaly", F.lit(0.0))

    tables.workers_find_package(rated.sparkSession)

    def run(batches):
        for batch in batches:
            x = np.array(batch["rates"].to_pylist(), float).reshape(-1, len(RATES))
            yield batch.append_column("anomaly", pa.array(forest.scores(x)))

    return rated.mapInArrow(run, T.StructType([*rated.schema, T.StructField("anomaly", T.DoubleType())]))


def threshold(scored: DataFrame, labels: DataFrame, loss: float = LOSS) -> float:
    """The lowest score that rejects at most ``loss`` of the labelled good documents; 1 (none rejected) without such rows.

    Only a histogram of SCORE_STEPS steps comes to the driver.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    step = F.ceil(F.col("anomaly") * SCORE_STEPS).cast("int")
    rows = scored.where("NOT base_failed").join(good, "doc_id").groupBy(step.alias("step")).count().collect()
    left = math.ceil(loss * sum(x["count"] for x in rows))
    limit = SCORE_STEPS
    for x in sorted(rows, key=lambda x: -x["step"]):
        if (left := left - x["count"]) < 0:
            return x["step"] / SCORE_STEPS
        limit = x["step"] - 1
    return limit / SCORE_STEPS


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``anomaly`` and ``kept`` for each row of ``docs`` (doc_id, text).

    Null and empty texts have no words and fail. Repeated rows are judged alike. Labels (doc_id, quality) with nulls do not
    count. Without labels or without documents that pass the base rules, only the base rules reject.
    """
    rated = tables.settle(with_rates(rule_counts(docs)), "rates")
    scored = tables.settle(score(rated, grow(*sample_rates(rated, labels))), "scores")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= threshold(scored, labels)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs``, with all their columns, that ``judge`` keeps. Texts are counted again, so that rows need no join."""
    rated = tables.settle(with_rates(rule_counts(docs)), "rates")
    forest = grow(*sample_rates(rated, labels))
    limit = threshold(score(rated, forest), labels)
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([count_rules(x) for x in tables.utf8(batch["text"])], float).reshape(-1, 6)
        n_words, chars, symbols, _, repeats, capitals = found.T
        n = n_words + PRIOR_WORDS
        rates = [np.sqrt(symbols / n), (chars + PRIOR_LENGTH * PRIOR_WORDS) / n, np.sqrt((capitals + PRIOR_CAPITALS * PRIOR_WORDS) / n)]
        kept = (n_words >= LEAST_WORDS) & (100 * repeats <= REPEAT_PERCENT * n_words)
        if forest is not None:
            kept &= forest.scores(np.stack(rates, 1)) <= limit
        return batch.filter(pa.array(kept)).select(["row"])

    kept = tables.map_batches(rows, run, T.StructType([rows.schema["row"]]))
    return kept.select("row.*")
