"""Counts, pages, chunks and manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import terms
from ..sources.table import SourceTable
from ..vocab import Profile
from .emit import table_iri


def table_counts(table: SourceTable) -> DataFrame:
    """Rows and non-blank cells of a table: ``table_name, rows_processed, cells``.

    Cells are counted in the wide rows; nothing is melted.
    """
    flags = [table.present(i).cast("long") for i in range(len(table.names))]
    per_row = reduce(Column.__add__, flags) if flags else F.lit(0).cast("long")
    keyed = table.frame.select(table.table_key().alias("table_name"), per_row.alias("_cells"))
    grouped = keyed.groupBy("table_name") if table.name is None else keyed.groupBy()
    counts = grouped.agg(F.count("*").alias("rows_processed"), F.coalesce(F.sum("_cells"), F.lit(0)).alias("cells"))
    return counts.select(table.table_key().alias("table_name"), "rows_processed", "cells")


def _whole_parts(number: Column, size: int) -> Column:
    """Integer division."""
    return ((number - number % size) / size).cast("long")


def parts(rows: Column, rows_per_part: int = V.ROWS_PER_PART) -> Column:
    """Pages or chunks that so many rows fill."""
    return _whole_parts(rows + F.lit(rows_per_part - 1), rows_per_part)


def conversion_summary(
    table: SourceTable, profile: Profile, linked: int = 0, copied: int = 0, rows_per_part: int = V.ROWS_PER_PART
) -> DataFrame:
    """Table IRI, rows, cells, exact triple count and parts of a conversion.

    ``linked`` and ``copied`` are the numbers of annotation links and copied annotation triples.
    """
    fixed = profile.metadata_count(len(table.names)) + linked + copied
    rows = F.col("rows_processed")
    return table_counts(table).select(
        "table_name",
        table_iri(profile, F.col("table_name")).alias("table_uri"),
        "rows_processed",
        "cells",
        (F.lit(fixed) + profile.data_count(rows, F.col("cells"))).alias("triples_generated"),
        parts(rows, rows_per_part).alias("parts"),
    )


def triple_counts(table: SourceTable, profile: Profile) -> DataFrame:
    """Triples by what they describe: ``table_name, kind, triples`` for table, column, row and cell."""
    rows, cells = F.col("rows_processed"), F.col("cells")
    kinds = [
        ("table", F.lit(3).cast("long")),
        ("column", F.lit(4 * len(table.names)).cast("long")),
        ("row", rows * profile.triples_per_row),
        ("cell", cells * profile.triples_per_cell),
    ]
    entries = F.array(*[F.struct(F.lit(k).alias("kind"), n.alias("triples")) for k, n in kinds])
    return table_counts(table).select("table_name", F.inline(entries))


def estimate_vs_actual(table: SourceTable, profile: Profile) -> DataFrame:
    """The fixed estimate of triples per row beside the exact count."""
    summary = conversion_summary(table, profile)
    estimate = F.col("rows_processed") * V.ESTIMATED_TRIPLES_PER_ROW
    error = F.round(F.lit(100) * (estimate - F.col("triples_generated")) / F.col("triples_generated"), 2)
    return summary.select(
        "table_name", estimate.alias("estimated_triples"), "triples_generated", error.alias("error_percent")
    )


def part_number(rows_per_part: int = V.ROWS_PER_PART) -> Column:
    """Page or chunk of a row."""
    return _whole_parts(F.col("row_index"), rows_per_part)


def part_index(
    table: SourceTable, rows_per_part: int = V.ROWS_PER_PART, name=terms.page_name
) -> DataFrame:
    """One row per page or chunk: ``table_name, part, part_name, start_row, end_row, rows``; none is empty."""
    keyed = table.frame.select(
        table.table_key().alias("table_name"), "row_index", part_number(rows_per_part).alias("part")
    )
    grouped = keyed.groupBy("table_name", "part").agg(
        F.min("row_index").alias("start_row"), F.max("row_index").alias("end_row"), F.count("*").alias("rows")
    )
    return grouped.withColumn("part_name", name("part"))


def columns_mapped(linked: DataFrame) -> DataFrame:
    """Columns with and without an annotation, per table."""
    return linked.groupBy("table_name").agg(
        F.count("annotation_iri").alias("columns_mapped"), F.count("*").alias("columns")
    )


def class_census(triples: DataFrame, unique: bool = False) -> DataFrame:
    """Distinct instances per class. ``unique`` says that no type triple occurs twice, which saves a shuffle."""
    typed = triples.filter(F.col("p") == V.RDF_TYPE).select("s", F.col("o").alias("class"))
    typed = typed if unique else typed.distinct()
    return typed.groupBy("class").agg(F.count("*").alias("instances"))


def reference_census(triples: DataFrame) -> DataFrame:
    """seeAlso links per subject and how many different nodes they lead to."""
    links = triples.filter(F.col("p") == V.SEE_ALSO).groupBy("s", "o").agg(F.count("*").alias("_n"))
    return links.groupBy("s").agg(F.sum("_n").alias("links"), F.count("*").alias("targets"))


def reference_totals(triples: DataFrame) -> DataFrame:
    """All seeAlso links, the subjects that have any, and the different targets.

    Each count is over groups that were reduced before, so no single task meets all links.
    """
    links = triples.filter(F.col("p") == V.SEE_ALSO)
    sides = links.select(F.explode(F.array(
        F.struct(F.lit("subject").alias("side"), F.col("s").alias("node")),
        F.struct(F.lit("target").alias("side"), F.col("o").alias("node")),
    )).alias("e")).select("e.*")
    nodes = sides.groupBy("side", "node").agg(F.count("*").alias("_n"))
    is_subject, is_target = F.col("side") == "subject", F.col("side") == "target"
    return nodes.agg(
        F.sum(F.when(is_subject, F.col("_n"))).alias("links"),
        F.count(F.when(is_subject, F.lit(1))).alias("subjects"),
        F.count(F.when(is_target, F.lit(1))).alias("targets"),
    )


def preview(table: SourceTable, rows: int = V.PREVIEW_ROWS, width: int = V.PREVIEW_WIDTH) -> DataFrame:
    """The first rows, long values cut and marked with ``...``."""
    def cut(i: int) -> Column:
        text = table.text(i)
        return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)

    first = table.frame.filter(F.col("row_index") < rows)
    return first.select(*table.keys, *[cut(i).alias(n) for i, n in enumerate(table.names)])
