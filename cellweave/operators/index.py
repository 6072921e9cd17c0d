"""Row positions and row limits.

A row's index is part of its identifier, so it has to be the exact 0-based position. Positions come from
the files where there are files (no shuffle), else from a sort over all partitions; never from one task.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import session
from ..sources.table import ROW_INDEX, SourceTable, source_table

# Neighbouring rows that stay together when a caller asks for more partitions than a table has.
SPREAD_ROWS = 1024


def read_parquet_table(
    spark: SparkSession,
    path: str,
    name: str,
    columns: list[str] | None = None,
    max_rows: int | None = None,
    partitions: int | None = None,
    task_rows: int | None = None,
) -> SourceTable:
    """A Parquet file or folder, rows numbered by position in the file, files in path order.

    The position inside a file is the reader's own, so nothing is shuffled or sorted. Only with several files
    are their row counts needed, which are read from the footers. A caller whose rows each become many records may ask for
    ``partitions``, or for tasks of ``task_rows`` rows at most; only then, and only if the scan's are fewer or larger, are rows
    shuffled, in runs.
    """
    df = scan = spark.read.parquet(path)
    columns = columns if columns is not None else df.columns
    position, file = F.col("_metadata.row_index"), F.col("_metadata.file_path")
    file_name = path.rstrip("/").rsplit("/", 1)[-1]
    locate = None
    if len(df.inputFiles()) > 1:
        counts = df.select(file.alias("_file")).groupBy("_file").agg(F.count("*").alias("_rows"))
        starts = session.settle(_running_start(counts, "_file", "_rows"))

        def locate(row: int) -> DataFrame:
            """The file in which the row lies, by the first rows of files; the other files are not read."""
            place = starts.filter((F.col("_start") <= row) & (F.col("_start") + F.col("_rows") > row)).first()
            one = scan.filter(F.lit(False) if place is None else file == place["_file"])
            index = position + F.lit(0 if place is None else place["_start"])
            return source_table(one.select("*", index.alias(ROW_INDEX)), name, columns=columns, file_name=file_name).frame

        if max_rows:
            needed = starts.filter(F.col("_start") < max_rows).agg(F.max("_file")).first()[0]
            df = df.filter(file <= (needed or ""))
        df = df.select("*", position.alias("_position"), F.xxhash64(file).alias("_key"))
        df = _placed(df, starts.select(_unique_key("_file"), "_start", "_rows"))
        df = df.withColumn(ROW_INDEX, F.col("_start") + _inside(F.col("_position")))
    else:
        df = df.select("*", position.alias(ROW_INDEX))
    run = F.floor(F.col(ROW_INDEX) / SPREAD_ROWS)
    df = session.at_most(df, scan, task_rows, run) if task_rows else session.at_least(df, partitions, run)
    table = source_table(df, name, columns=columns, file_name=file_name)
    return limit_rows(replace(table, locate=locate), max_rows)


def _unique_key(*of: str) -> Column:
    """Hash of a file or block. Two of one hash cannot be told apart, which ``_placed`` reports."""
    return F.xxhash64(*of).alias("_key")


def _placed(df: DataFrame, places: DataFrame) -> DataFrame:
    """``df`` with what ``places`` (one row per ``_key``) says; the rows of ``df`` are not shuffled."""
    places = session.settle(places)
    if places.groupBy("_key").count().filter("count > 1").limit(1).count():
        raise ValueError("Two files or blocks have one hash")
    return session.look_up(df, places, "_key")


def _inside(position: Column) -> Column:
    """``position`` if it lies within the rows counted for its file or block; else the files have changed."""
    counted = position.between(0, F.col("_rows") - 1)
    changed = F.raise_error(F.lit("The files changed while they were read")).cast("long")
    return F.when(F.coalesce(counted, F.lit(False)), position).otherwise(changed)


def _running_start(counts: DataFrame, order: str | list[str], rows: str) -> DataFrame:
    """Start offset of each file or block: one row per file or block goes through this window, not rows of data."""
    before = Window.orderBy(*([order] if isinstance(order, str) else order)).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_start", F.coalesce(F.sum(rows).over(before), F.lit(0)))


def number_by_blocks(df: DataFrame, file: str, block: str, table: str | None = None) -> DataFrame:
    """Number rows of a file scan by (file, block, position), in each ``table`` from 0 if there are several.

    ``monotonically_increasing_id`` grows inside a partition but jumps between partitions; the rows before each
    block turn it into a position. Both uses of the scan split the files in the same way; a row outside the rows counted for
    its block is an error, not a lost or misplaced row.
    """
    marked = df.withColumn("_id", F.monotonically_increasing_id())
    keys = [*dict.fromkeys([table, file, block])] if table else [file, block]
    blocks = marked.groupBy(*keys).agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    grouped = Window.partitionBy(table) if table else Window.partitionBy()
    before = grouped.orderBy(file, block).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    places = blocks.select(_unique_key(file, block), start.alias("_start"), "_first", "_rows")
    numbered = _placed(marked.withColumn("_key", F.xxhash64(file, block)), places)
    inside = _inside(F.col("_id") - F.col("_first"))
    return numbered.withColumn(ROW_INDEX, F.col("_start") + inside).drop("_id", "_key", "_start", "_first", "_rows")


def with_row_index(df: DataFrame, order_by: list[str | Column], name: str = ROW_INDEX) -> DataFrame:
    """Number the rows of any DataFrame by a total order.

    Rows are range-partitioned and sorted by all order columns and written once; the row counts of the
    partitions before give each partition its first index. ``order_by`` must identify a row, or equal rows
    get their indexes in any order.
    """
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    marked = session.settle(ordered.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    counts = marked.groupBy(part.alias("_part")).agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    shifts = _running_start(counts, "_part", "_rows").select(
        "_part", (F.col("_start") - F.col("_first")).alias("_shift")
    )
    # One row per partition of the sort.
    numbered = marked.withColumn("_part", part).join(F.broadcast(shifts), "_part")
    return numbered.withColumn(name, F.col("_id") + F.col("_shift")).drop("_id", "_part", "_shift")


def limit_rows(table: SourceTable, max_rows: int | None) -> SourceTable:
    """The first ``max_rows`` rows by input position; None or 0 keeps all."""
    if not max_rows:
        return table
    # a row beyond the limit is looked for among the rows that are left
    return replace(table, frame=table.frame.filter(F.col(ROW_INDEX) < max_rows), locate=None)


def limit_report(table: SourceTable, max_rows: int | None) -> DataFrame:
    """Rows there are, rows that the limit lets through, and whether it cuts."""
    available = F.count("*")
    processed = F.least(available, F.lit(max_rows).cast("long")) if max_rows else available
    keys = [] if table.name is not None else ["table_name"]
    report = table.frame.groupBy(*keys).agg(available.alias("rows_available"), processed.alias("rows_processed"))
    return report.withColumn("is_cut", F.col("rows_processed") < F.col("rows_available"))
