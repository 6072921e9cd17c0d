"""Rows as nested records, and pages of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..sources.table import SourceTable
from ..vocab import Profile
from .emit import cell_iri, column_iri, row_iri
from .summary import part_number


def page_rows(table: SourceTable, profile: Profile, cell_type: str = "fdic:Cell") -> DataFrame:
    """One record per row: index, IRI, and maps by header name of cell values, IRIs and details.

    Built inside the row, so nothing moves. Blank cells are absent; of equal header names the last counts.
    """
    last = {name: i for i, name in enumerate(table.names)}
    name, row = table.table_key(), row_iri(profile, table.table_key(), F.col("row_index"))

    def entry(i: int, header: str) -> Column:
        uri = cell_iri(profile, name, F.col("row_index"), F.lit(i))
        detail = F.struct(
            uri.alias("uri"), F.lit(cell_type).alias("type"), table.text(i).alias("value"), row.alias("inRow"),
            column_iri(profile, name, F.lit(i)).alias("inColumn"), F.lit(header).alias("columnName"),
        )
        present = table.present(i)
        return F.when(present, F.struct(F.lit(header).alias("key"), detail.alias("value")))

    entries = F.array_compact(F.array(*[entry(i, header) for header, i in sorted(last.items(), key=lambda e: e[1])]))
    rows = table.frame.select(*table.keys, row.alias("row_uri"), F.map_from_entries(entries).alias("cell_rdf"))
    return rows.select(
        *table.keys,
        "row_uri",
        F.transform_values("cell_rdf", lambda _, c: c["value"]).alias("cells"),
        F.transform_values("cell_rdf", lambda _, c: c["uri"]).alias("cell_uris"),
        "cell_rdf",
    )


def pages(rows: DataFrame, rows_per_page: int = V.ROWS_PER_PART) -> DataFrame:
    """Page documents ``page, start_row, end_row, rows``; a page gathers at most ``rows_per_page`` rows."""
    keys = [c for c in rows.columns if c == "table_name"]
    record = F.struct(*[c for c in rows.columns if c not in keys])
    paged = rows.select(*keys, part_number(rows_per_page).alias("page"), "row_index", record.alias("_record"))
    return paged.groupBy(*keys, "page").agg(
        F.min("row_index").alias("start_row"),
        F.max("row_index").alias("end_row"),
        # Rows differ in their first field, the index, which is what they are sorted by.
        F.array_sort(F.collect_list("_record"), lambda a, b: (a["row_index"] - b["row_index"]).cast("int")).alias("rows"),
    )
