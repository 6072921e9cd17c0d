"""Delimited text files: every value a string, header names by position."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import session
from ..functions import terms
from ..operators.index import limit_rows
from .records import entry_stem, read_records, stem
from .table import ROW_INDEX, TABLE_NAME, SourceTable, source_table

# Files whose name ends in .csv, in any case.
CSV_GLOB = "*.[cC][sS][vV]"


@dataclass(frozen=True)
class Picked:
    """The input that was chosen, or why there is none."""

    path: str | None
    alerts: tuple[str, ...] = ()


def pick_input(paths: list[str]) -> Picked:
    """The first path that ends in ``.csv``, whatever the case."""
    for path in paths:
        if path.lower().endswith(".csv"):
            return Picked(path)
    return Picked(None, ("No CSV file found in input",))


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Header names in order, repeated names included; empty for an empty file. Of several files, those of the first in path order."""
    found = read_records(spark, path, max_rows=1)
    return [] if found is None else found.files.orderBy("file_no").first()["header"]


def read_csv_table(
    spark: SparkSession, path: str, name: str | None = None, header: list[str] | None = None, max_rows: int | None = None
) -> SourceTable | None:
    """One table from a CSV file, or from a folder of files that continue each other in path order.

    Files are read in splits, quoted line ends included. ``header`` gives other names to the positions; without it, files
    with unlike headers are an error (see :func:`read_csv_tables`). An empty file gives None. With ``max_rows``, files that come
    after those rows are not read.
    """
    found = read_records(spark, path, max_rows=max_rows)
    if found is None:
        return None
    headers = [x[0] for x in found.files.select("header").distinct().limit(2).collect()]
    if header is None and len(headers) > 1:
        raise ValueError("The files' headers differ; they are tables of their own")
    header = header if header is not None else headers[0]
    before = found.files.select("file_no", "before")
    rows = found.rows.join(session.broadcast_if_small(before), "file_no")
    columns = [f"c{i}" for i in range(len(header))]
    frame = rows.select((F.col("record") + F.col("before")).alias(ROW_INDEX), *_cells(len(header)))
    table = source_table(frame, name or stem(path), columns=columns, names=header, file_name=path.rstrip("/").rsplit("/", 1)[-1])
    return limit_rows(table, max_rows)


def _cells(width: int) -> list[Column]:
    """Values by position; what a short record lacks is null, what a long one has more is left out."""
    return [F.get("values", F.lit(i)).alias(f"c{i}") for i in range(width)]


def read_csv_tables(spark: SparkSession, folder: str) -> SourceTable | None:
    """Every ``.csv`` entry of a folder as a table of its own, named by its stem, in one job.

    An entry is a file or a folder of part files, which share a header. Headers of tables may differ: the result's ``headers`` tell
    each table's columns. Rows are numbered from 0 in each table.
    """
    found = read_records(spark, folder, CSV_GLOB)
    if found is None:
        return None
    files = found.files.withColumn(TABLE_NAME, entry_stem(F.col("file")))
    tables = session.settle(files.groupBy(TABLE_NAME).agg(F.min("header").alias("header"), F.max("header").alias("_other")))
    unlike = tables.filter("header <> _other").agg(F.min(TABLE_NAME)).first()[0]
    if unlike is not None:
        raise ValueError(f"The headers of the files of {unlike} differ")
    width = tables.agg(F.max(F.size("header"))).first()[0]
    earlier = Window.partitionBy(TABLE_NAME).orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file_no", TABLE_NAME, F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("_start"))
    rows = found.rows.join(session.broadcast_if_small(session.settle(starts), 512), "file_no")
    frame = rows.select(TABLE_NAME, (F.col("record") + F.col("_start")).alias(ROW_INDEX), *_cells(width))
    headers = session.settle(tables.select(TABLE_NAME, F.posexplode("header").alias("column_index", "column_name")))
    columns = [f"c{i}" for i in range(width)]
    return replace(source_table(frame, None, columns=columns, file_name=".csv"), headers=headers)


def list_csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, file_name, table_name, bytes`` of a folder's CSV files, without reading them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB).load(folder)
    return files.select(
        "path", terms.file_name("path").alias("file_name"), terms.file_stem("path").alias("table_name"),
        F.col("length").alias("bytes"),
    )
