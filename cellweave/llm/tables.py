"""Tables between the steps of an operator, and record batches in tasks of bounded memory."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellweave import session

# Where this package lies; Python workers started elsewhere need it in their path unless the package was shipped to them.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# A side is broadcast only after its rows were counted, and up to this many bytes.
BROADCAST_BYTES = 32 << 20
# Rows of a batch that are handled at a time, so that what a task derives from texts stays small.
SLICE_ROWS = 256
# Rows of the batches that go to Python workers and back, where the session does not say how many: both sides hold several batches
# of whole texts, and what the JVM once took for them it keeps.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1024


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share."""
    return f"{session.shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: a lost executor loses nothing of it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast a settled ``df`` of fixed-width rows if its exact row count proves it small; else leave it as it is."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def workers_find_package(spark: SparkSession) -> None:
    """What Python workers need: this package, and batches of a size for whole texts."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(BATCH_ROWS))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [ROOT])


def give_back() -> None:
    """Return freed memory to the machine at the end of a task: Python workers live on and would keep it for themselves."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
    if trim:
        trim(0)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.Table | pa.RecordBatch], schema: str | StructType, remembered: list | None = None
) -> DataFrame:
    """Apply ``function`` to slices of record batches; each slice has at most SLICE_ROWS rows.

    ``remembered`` is a list in which ``function`` keeps what one task remembers; it is cleared at the task's end.
    """
    workers_find_package(df.sparkSession)
    kept = [] if remembered is None else remembered

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE_ROWS):
                    out = function(batch.slice(start, SLICE_ROWS))
                    yield from out.to_batches() if isinstance(out, pa.Table) else [out]
        finally:
            kept.clear()
            give_back()

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Texts; null is empty."""
    return [x or "" for x in column.to_pylist()]
