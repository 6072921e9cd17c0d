"""Incremental conversion: files that arrive in a folder are appended to the graph.

Row positions continue over batches. A ledger keeps, by batch id, how many rows there were up to the end of each batch: the latest entry
before a batch tells where it begins, however many there are. A batch that runs again gets the same positions and replaces its own output.
Lines are written compressed, as they repeat most of each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import vocab as V
from ..functions import terms
from ..operators import cells as C
from ..operators import emit as E
from ..operators.index import number_by_blocks
from ..operators.summary import part_number
from ..sinks.graph import COMPRESSION
from ..sources.table import ROW_INDEX, source_table
from ..vocab import Profile

# Rows that a task converts, about.
TASK_ROWS = 1 << 15

_LEDGER = "batch_id bigint, rows bigint, total bigint"


def _entry(ledger: str, batch_id: int) -> str:
    return f"{ledger}/batch={batch_id:09d}"


def _rows_before(spark: SparkSession, ledger: str, batch_id: int) -> int:
    """Rows of all earlier batches, from one entry; only where the batch before has none (it had no files), others are looked for."""
    if batch_id == 0:
        return 0
    try:
        entry = spark.read.schema(_LEDGER).json(_entry(ledger, batch_id - 1)).first()
    except AnalysisException:
        entry = None
    if entry is None:
        return _latest(spark, ledger, batch_id)
    return entry["total"]


def _latest(spark: SparkSession, ledger: str, batch_id: int) -> int:
    """The total of the latest entry before ``batch_id``, if there is any."""
    try:
        entries = spark.read.schema(_LEDGER).option("recursiveFileLookup", True).json(ledger)
    except AnalysisException:  # no batch has been written
        return 0
    return entries.filter(F.col("batch_id") < batch_id).agg(F.coalesce(F.max_by("total", "batch_id"), F.lit(0))).first()[0]


def _numbered(batch: DataFrame, first: int) -> DataFrame:
    numbered = number_by_blocks(batch, "_file", "_block")
    return numbered.withColumn(ROW_INDEX, F.col(ROW_INDEX) + F.lit(first)).drop("_file", "_block")


def append_batches(
    stream: DataFrame,
    name: str,
    out: str,
    names: list[str] | None = None,
    profile: Profile = V.TYPED,
    rows_per_chunk: int = V.ROWS_PER_PART,
) -> Callable[[DataFrame, int], None]:
    """The function for ``foreachBatch``: number, melt and emit a batch, write it below its batch id."""
    columns = [c for c in stream.columns if not c.startswith("_")]
    ledger = f"{out}/ledger"

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"batch={batch_id:09d}"
        first = _rows_before(spark, ledger, batch_id)
        numbered = _numbered(batch, first)
        # rows become many: neighbours that make a chunk stay together, and tasks are many and small
        tasks = max(spark.sparkContext.defaultParallelism, -(-batch.count() // TASK_ROWS))
        numbered = numbered.repartition(tasks, part_number(rows_per_chunk))
        table = source_table(numbered, name, columns=columns, names=names or columns)
        cells = C.type_cells(C.melt(table), table) if profile.typed else C.plain_cells(C.melt(table))
        rows = E.row_triples(table, profile, ROW_INDEX, lines=True)
        data = rows.unionByName(E.cell_triples(cells, table, profile, ROW_INDEX, lines=True))
        chunk = terms.chunk_name(part_number(rows_per_chunk)).alias("chunk")
        lines = data.select("value", chunk)
        lines.write.mode("overwrite").option("compression", COMPRESSION).partitionBy("chunk").text(f"{out}/data/{folder}")
        rows = F.count("*")
        count = table.frame.agg(F.lit(batch_id).cast("long").alias("batch_id"), rows.alias("rows"), (rows + first).alias("total"))
        count.write.mode("overwrite").json(_entry(ledger, batch_id))

    return append


def with_source(stream: DataFrame) -> DataFrame:
    """Add where each row of a file stream comes from, as numbering needs it."""
    return stream.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def start(
    stream: DataFrame,
    name: str,
    out: str,
    checkpoint: str,
    names: list[str] | None = None,
    profile: Profile = V.TYPED,
    rows_per_chunk: int = V.ROWS_PER_PART,
) -> StreamingQuery:
    """Convert all files that a stream (of CSV, Parquet, ...) has not converted yet, then stop."""
    source = with_source(stream)
    write = append_batches(source, name, out, names, profile, rows_per_chunk)
    return (
        source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
