"""Identifiers, and triples of tables, columns, rows and cells."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import terms
from ..model import IRI, Statement, lay_out, select_statements
from ..sources.table import SourceTable
from ..vocab import Profile


def _part(value, profile: Profile) -> Column:
    return terms.percent_encode(value) if profile.encode else value


def table_iri(profile: Profile, table_name: Column) -> Column:
    return F.concat(F.lit(profile.base + "table/"), _part(table_name, profile))


def column_iri(profile: Profile, table_name: Column, column_index: Column) -> Column:
    prefix = F.concat(F.lit(profile.base + "column/"), _part(table_name, profile), F.lit("/"))
    return F.concat(prefix, column_index.cast("string"))


def row_iri(profile: Profile, table_name: Column, row_index: Column) -> Column:
    prefix = F.concat(F.lit(profile.base + "row/"), _part(table_name, profile), F.lit("/"))
    return F.concat(prefix, row_index.cast("string"))


def cell_iri(profile: Profile, table_name: Column, row_index: Column, column_index: Column) -> Column:
    prefix = F.concat(F.lit(profile.base + "cell/"), _part(table_name, profile), F.lit("/"))
    return F.concat(prefix, row_index.cast("string"), F.lit("/"), column_index.cast("string"))


def tables_dim(spark: SparkSession, table: SourceTable) -> DataFrame:
    """One row per table: ``table_name, file_name``."""
    if table.name is None:
        names = (table.frame if table.headers is None else table.headers).select("table_name").distinct()
        return names.withColumn("file_name", F.concat("table_name", F.lit(table.file_name or "")))
    one = spark.range(1)
    return one.select(F.lit(table.name).alias("table_name"), F.lit(table.file_name or table.name).alias("file_name"))


def columns_dim(tables: DataFrame, names: tuple[str, ...] | list[str], profile: Profile) -> DataFrame:
    """One row per table and header position: ``table_name, column_index, column_name, column_iri``."""
    header = F.array(*[F.lit(n) for n in names])
    columns = tables.select("table_name", F.posexplode(header).alias("column_index", "column_name"))
    return columns.withColumn("column_iri", column_iri(profile, F.col("table_name"), F.col("column_index")))


def table_columns(tables: DataFrame, table: SourceTable, profile: Profile) -> DataFrame:
    """:func:`columns_dim` of a table, or of many tables by their own headers."""
    if table.headers is None:
        return columns_dim(tables, table.names, profile)
    iri = column_iri(profile, F.col("table_name"), F.col("column_index"))
    return table.headers.select("table_name", "column_index", "column_name", iri.alias("column_iri"))


def table_triples(tables: DataFrame, profile: Profile, created: Column | str) -> DataFrame:
    """Type, title and creation time of each table. ``created`` is text or a timestamp column."""
    created = terms.timestamp_text(created) if isinstance(created, Column) else F.lit(created)
    subject = table_iri(profile, F.col("table_name"))
    title = F.concat(F.lit(profile.title_prefix), F.col("file_name"))
    return lay_out(tables, [
        Statement(subject, V.RDF_TYPE, profile.term("Table"), IRI),
        Statement(subject, V.DCTERMS + "title", title),
        Statement(subject, V.DCTERMS + "created", created, datatype=V.XSD + "dateTime"),
    ])


def column_triples(columns: DataFrame, profile: Profile) -> DataFrame:
    """Type, name and index of each column, and the table's link to it."""
    column, index = F.col("column_iri"), F.col("column_index").cast("string")
    return lay_out(columns, [
        Statement(column, V.RDF_TYPE, profile.term("Column"), IRI),
        Statement(column, profile.term("columnName"), F.col("column_name")),
        Statement(column, profile.term("columnIndex"), index, datatype=V.XSD + "integer"),
        Statement(table_iri(profile, F.col("table_name")), profile.term("column"), column, IRI),
    ])


def row_triples(
    table: SourceTable, profile: Profile, *keep: str, predicates: Collection[str] | None = None, lines: bool = False
) -> DataFrame:
    """Type of each row, and in the plain profile its index and the table's link to it.

    ``predicates`` leaves out all other triples; ``lines`` gives text lines in place of triples.
    """
    row, index = F.col("row_iri"), F.col("row_index").cast("string")
    statements = [Statement(row, V.RDF_TYPE, profile.term("Row"), IRI)]
    if profile.indexed_rows:
        statements += [
            Statement(row, profile.term("rowIndex"), index, datatype=V.XSD + "integer"),
            Statement(table_iri(profile, table.table_key()), profile.term("row"), row, IRI),
        ]
    rows = table.frame.select(*table.keys, row_iri(profile, table.table_key(), F.col("row_index")).alias("row_iri"))
    return lay_out(rows, select_statements(statements, predicates), *keep, lines=lines)


def with_iris(cells: DataFrame, table: SourceTable, profile: Profile) -> DataFrame:
    """Add the identifiers ``row_iri``, ``column_iri`` and ``cell_iri`` to melted cells."""
    name, row, column = table.table_key(), F.col("row_index"), F.col("column_index")
    return cells.select(
        "*",
        row_iri(profile, name, row).alias("row_iri"),
        column_iri(profile, name, column).alias("column_iri"),
        cell_iri(profile, name, row, column).alias("cell_iri"),
    )


def cell_triples(
    cells: DataFrame, table: SourceTable, profile: Profile, *keep: str,
    predicates: Collection[str] | None = None, lines: bool = False,
) -> DataFrame:
    """Type, value and links of each cell; cells have ``lexical`` and ``datatype``.

    ``predicates`` leaves out all other triples before they are made; ``lines`` gives text lines.
    """
    cell, row, column = F.col("cell_iri"), F.col("row_iri"), F.col("column_iri")
    datatype = F.col("datatype") if profile.typed else None
    statements = [
        Statement(cell, V.RDF_TYPE, profile.term("Cell"), IRI),
        Statement(cell, profile.term(profile.cell_row), row, IRI),
        Statement(cell, profile.term(profile.cell_column), column, IRI),
        Statement(cell, profile.term("value"), F.col("lexical"), datatype=datatype),
    ]
    if profile.row_to_cell:
        statements.append(Statement(row, profile.term("cell"), cell, IRI))
    chosen = select_statements(statements, predicates)
    return lay_out(with_iris(cells, table, profile), chosen, *keep, lines=lines)
