"""Token counts by an exact histogram of encoded lengths.

Documents are counted by length; suffix sums over the histogram then answer totals, quantiles and truncated totals for every
context limit, without another look at the texts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm import encode, tables

# Lengths of a bucket; sums are made within buckets first, so that no task has to order all lengths.
BUCKET = 1024


def lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``length`` in tokens of each row of ``docs`` (text); null and empty texts have none."""
    memory: list[encode.Remembering] = []

    def run(batch: pa.RecordBatch) -> pa.Table:
        if not memory:
            memory.append(encode.Remembering(encode.KeptSpaces(tokenizer), value=lambda ids: len(ids) // 4))
        return pa.table({"length": pa.array([sum(x) for x in memory[0].encode(tables.texts(batch["text"]))], pa.int64())})

    return tables.map_batches(docs.select(F.col("text").cast("string").alias("text")), run, "length long", memory)


def histogram(counted: DataFrame) -> DataFrame:
    """From rows with ``length``, one row per distinct length L:

    ``length, n_docs, n_tokens``; ``docs_at_least`` and ``tokens_at_least`` over documents of L and more; ``docs_total``;
    ``truncated_tokens``: all tokens if each document is cut at L; ``rank``: documents shorter than L or equal. A null length
    counts as 0. An empty table has no rows.
    """
    rows = counted.groupBy(F.coalesce("length", F.lit(0)).alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))
    rows = tables.settle(rows.withColumns({"n_tokens": F.col("length") * F.col("n_docs"), "_bucket": F.floor(F.col("length") / BUCKET)}), "lengths")
    buckets = rows.groupBy("_bucket").agg(F.sum("n_docs").alias("_docs"), F.sum("n_tokens").alias("_tokens"))
    # one row per thousand lengths: as many as the longest document has thousands of tokens
    above = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    buckets = buckets.select(
        "_bucket", F.coalesce(F.sum("_docs").over(above), F.lit(0)).alias("_docs"), F.coalesce(F.sum("_tokens").over(above), F.lit(0)).alias("_tokens"),
        F.sum("_docs").over(everything).alias("docs_total"), F.sum("_tokens").over(everything).alias("_all"),
    )
    inside = Window.partitionBy("_bucket").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns({"docs_at_least": F.sum("n_docs").over(inside), "tokens_at_least": F.sum("n_tokens").over(inside)}).join(buckets, "_bucket")
    out = out.withColumns({"docs_at_least": F.col("docs_at_least") + F.col("_docs"), "tokens_at_least": F.col("tokens_at_least") + F.col("_tokens")})
    return out.select(
        "length", "n_docs", "n_tokens", "docs_at_least", "tokens_at_least", "docs_total",
        (F.col("_all") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
        (F.col("docs_total") - F.col("docs_at_least") + F.col("n_docs")).alias("rank"),
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """``context, docs_over, truncated_tokens`` for any context limits, from the histogram alone."""
    over = lambda n, what: F.coalesce(F.sum(F.when(F.col("length") > n, what)), F.lit(0))
    sums = hist.agg(
        F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("_all"),
        *[c for n in limits for c in (over(n, F.col("n_docs")).alias(f"d{n}"), over(n, F.col("n_tokens")).alias(f"t{n}"))],
    )
    each = [
        F.struct(F.lit(n).cast("long").alias("context"), F.col(f"d{n}").alias("docs_over"),
                 (F.col("_all") - F.col(f"t{n}") + n * F.col(f"d{n}")).alias("truncated_tokens"))
        for n in limits
    ]
    return sums.select(F.inline(F.array(*each)))


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """``share, length``: the least length that this share of all documents does not exceed."""
    each = [F.struct(F.lit(s).alias("share"), F.min(F.when(F.col("rank") >= F.ceil(F.lit(s) * F.col("docs_total")), F.col("length"))).alias("length")) for s in shares]
    return hist.agg(F.array(*each).alias("_q")).select(F.inline("_q"))
