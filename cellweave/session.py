"""Session helpers: where checkpoints go, and joins with a side of checked size."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import reduce

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest size of a broadcast table, as Spark keeps rows of a few fixed-width columns.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, as the cluster configured it.

    Only where the session names none (single machine, tests) a temporary folder is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="cellweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def pinned(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` as they are now. Files read by it are split in one way whenever a plan is made,
    whatever is set later in ``spark`` and however many cores come or go."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    least = ("spark.sql.files.minPartitionNum", "spark.sql.leafNodeDefaultParallelism")
    known = [x for x in (spark.conf.get(k, None) for k in least) if x]
    own.conf.set(least[0], known[0] if known else str(spark.sparkContext.defaultParallelism))
    return own


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder, so that all later uses read the same rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, row_bytes: int = ROW_BYTES) -> DataFrame:
    """Broadcast ``df`` if a count proves it small; otherwise leave the join strategy to Spark.

    ``row_bytes`` is what a row takes at most. The count stops early beyond the bound. Use on a side that is cheap to compute or
    already settled.
    """
    rows = BROADCAST_BYTES // row_bytes
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def look_up(df: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Left join of ``df`` with a settled ``side`` of fixed-width rows by a whole-number ``key``; rows of ``df`` never move.

    A side beyond the broadcast bound is cut by its keys into pieces within the bound, each joined with its part of ``df``:
    reading ``df`` once more for each piece costs less than shuffling it.
    """
    pieces = max(1, -(-side.count() * ROW_BYTES // BROADCAST_BYTES))
    parts = [
        df.filter(F.pmod(F.xxhash64(key), F.lit(pieces)) == i).join(
            F.broadcast(side.filter(F.pmod(F.xxhash64(key), F.lit(pieces)) == i)), key, "left"
        )
        for i in range(pieces)
    ] if pieces > 1 else [df.join(F.broadcast(side), key, "left")]
    return reduce(DataFrame.unionAll, parts)


def at_least(df: DataFrame, partitions: int | None, *by: Column) -> DataFrame:
    """``df``, a scan, shuffled into ``partitions`` if fewer tasks than that have rows or one of them has most; without such a wish
    it stays as it is.

    Splits without the beginning of a row group have no rows, so rows are counted by task where there are not many more
    splits than asked for; Parquet does that from its footers.
    """
    if partitions is None:
        return df
    splits = df.rdd.getNumPartitions()
    if splits >= 4 * partitions:
        return df
    if splits >= partitions:
        rows = df.groupBy(F.spark_partition_id().alias("_task")).agg(F.count("*").alias("_rows"))
        tasks, most, total = rows.agg(F.count("*"), F.max("_rows"), F.sum("_rows")).first()
        if tasks >= partitions and most * partitions <= 2 * total:
            return df
    return df.repartition(partitions, *by)


def at_most(df: DataFrame, scan: DataFrame, rows: int, *by: Column) -> DataFrame:
    """``df``, made of the rows of ``scan`` where they are, shuffled if a task has more than ``rows`` of them.

    For rows that each become many, so that a task's memory does not grow with the input.
    """
    counted = scan.groupBy(F.spark_partition_id().alias("_task")).agg(F.count("*").alias("_rows"))
    total, most = counted.agg(F.sum("_rows"), F.max("_rows")).first()
    return df if (most or 0) <= rows else df.repartition(-(-total // rows), *by)


def ship_package(spark: SparkSession) -> None:
    """Hand this package to Python workers on other machines, once per application."""
    context = spark.sparkContext
    here = os.path.dirname(os.path.abspath(__file__))
    name = f"{os.path.basename(here)}-{context.applicationId}.zip"
    path = os.path.join(SparkFiles.getRootDirectory(), "made", name)
    if not os.path.isdir(here) or os.path.exists(path):
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(here):
            for file in files:
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    context.addPyFile(path)
