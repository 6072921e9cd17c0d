"""Conversion of a table to a graph: one lazy plan per output, and a job that writes them all."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass, replace
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import session
from .. import vocab as V
from ..functions import terms
from ..model import TRIPLE_FIELDS
from ..operators import annotations as A
from ..operators import cells as C
from ..operators import emit as E
from ..operators import graph as G
from ..operators import pages as P
from ..operators import summary as S
from ..operators.index import limit_rows
from ..sinks import graph as sinks
from ..sources.table import SourceTable
from ..vocab import Profile

# Names of chunks or pages on one page of their list. A manifest holds the first page, and the name of the list that holds all of them.
LISTED = 1000


@dataclass(frozen=True)
class Conversion:
    """The graph of one table (or of many tables with one header), read when they are used."""

    table: SourceTable
    profile: Profile
    linked: DataFrame
    metadata: DataFrame
    declared: dict[str, str] | None = None

    def row_triples(self, predicates: Collection[str] | None = None, lines: bool = False) -> DataFrame:
        """Row triples with their ``row_index``, only those of the given predicates."""
        return E.row_triples(self.table, self.profile, *self.table.keys, predicates=predicates, lines=lines)

    def cell_triples(
        self, predicates: Collection[str] | None = None, lines: bool = False, columns: list[int] | None = None
    ) -> DataFrame:
        """Cell triples with their ``row_index``, only those of the given predicates and columns."""
        cells = C.melt(self.table, columns)
        cells = C.type_cells(cells, self.table, self.declared) if self.profile.typed else C.plain_cells(cells)
        return E.cell_triples(
            cells, self.table, self.profile, *self.table.keys, predicates=predicates, lines=lines
        )

    def data(self, predicates: Collection[str] | None = None, lines: bool = False) -> DataFrame:
        """Row and cell triples; unique as they are."""
        return self.row_triples(predicates, lines).unionByName(self.cell_triples(predicates, lines))

    def triples(self, predicates: Collection[str] | None = None) -> DataFrame:
        """The whole graph, or its triples with some predicates; only metadata can repeat itself, and is unique."""
        metadata = self.metadata
        if predicates is not None:
            metadata = metadata.filter(F.col("p").isin(list(predicates)))
        return metadata.unionByName(self.data(predicates).select(*TRIPLE_FIELDS))

    def match(self, s: str | None = None, p: str | None = None, o: str | None = None) -> DataFrame:
        """Triples that agree with the given parts.

        A predicate decides which triples are made at all, and a row's or cell's identifier which rows and
        columns are looked at, so that little of the graph comes into being.
        """
        predicates = None if p is None else [p]
        found, columns = self, None
        place = self._place(s)
        if place is not None:
            row, column = place
            found = replace(self, table=self.table.at(row))
            columns = None if column is None else [column] if column < len(self.table.names) else []
        parts = [self.metadata, found.row_triples(predicates).select(*TRIPLE_FIELDS)]
        if columns != []:
            parts.append(found.cell_triples(predicates, columns=columns).select(*TRIPLE_FIELDS))
        return G.match(reduce(DataFrame.unionByName, parts), s, p, o)

    def _place(self, s: str | None) -> tuple[int, int | None] | None:
        """Row and column that an identifier of this table names."""
        if s is None or self.table.name is None:
            return None
        name = quote(self.table.name, safe="") if self.profile.encode else self.table.name
        for kind, parts in (("row", 1), ("cell", 2)):
            prefix = f"{self.profile.base}{kind}/{name}/"
            numbers = s.removeprefix(prefix).split("/") if s.startswith(prefix) else []
            if len(numbers) == parts and all(n.isascii() and n.isdigit() and len(n) < 19 for n in numbers):
                return int(numbers[0]), int(numbers[1]) if parts == 2 else None
        return None


def convert(
    table: SourceTable,
    profile: Profile = V.TYPED,
    annotations: DataFrame | None = None,
    created: Column | str = "1970-01-01T00:00:00",
    max_rows: int | None = None,
    declared: dict[str, str] | None = None,
    follow_bnodes: bool = False,
) -> Conversion:
    """Plan the conversion of a table.

    ``annotations`` are catalogue triples; without any, columns are just not linked. They are searched for the
    table's header names at once; all else is read when it is used. ``created`` is a parameter so that the same
    input gives the same graph.
    """
    table = limit_rows(table, max_rows)
    tables = E.tables_dim(table.frame.sparkSession, table)
    columns = E.table_columns(tables, table, profile)
    metadata = [E.table_triples(tables, profile, created), E.column_triples(columns, profile)]
    if annotations is None:
        linked = columns.withColumn("annotation_iri", F.lit(None).cast("string"))
    elif table.headers is not None:
        # As many names as all headers have: looked up and copied by joins.
        names = table.headers.select("column_name").distinct()
        wanted = annotations.filter(F.col("p") == V.CATALOGUE_BASE + "columnName").join(names, F.col("o") == F.col("column_name"), "left_semi")
        linked = A.link_columns(columns, session.settle(A.annotation_lookup(wanted)))
        metadata += [A.link_triples(linked, profile), A.copy_used(annotations, linked, follow_bnodes)]
    else:
        # At most one annotation per header name, so the names and identifiers found fit into the plan.
        found = A.annotation_lookup(annotations, table.names).collect()
        lookup = table.frame.sparkSession.createDataFrame(found, "column_name string, annotation_iri string")
        linked = A.link_columns(columns, lookup, bounded=True)
        used = sorted({row.annotation_iri for row in found})
        metadata += [A.link_triples(linked, profile), A.copy_named(annotations, used, follow_bnodes)]
    return Conversion(table, profile, linked, G.union(*metadata), declared)


def summarise(conversion: Conversion, rows_per_part: int = V.ROWS_PER_PART) -> DataFrame:
    """Rows, cells, parts, mapped columns and the exact triple count of a single table, without emitting data."""
    profile, name = conversion.profile, F.lit(conversion.table.name).alias("table_name")
    zero = F.lit(0).cast("long")
    counts = S.table_counts(conversion.table).select(
        name, "rows_processed", "cells", zero.alias("metadata"), zero.alias("columns_mapped")
    )
    # Metadata triples are counted as they are: several columns may share an annotation.
    metadata = conversion.metadata.agg(F.count("*").alias("metadata")).select(
        name, zero.alias("rows_processed"), zero.alias("cells"), "metadata", zero.alias("columns_mapped")
    )
    mapped = conversion.linked.agg(F.count("annotation_iri").alias("columns_mapped")).select(
        name, zero.alias("rows_processed"), zero.alias("cells"), zero.alias("metadata"), "columns_mapped"
    )
    sums = [F.sum(c).alias(c) for c in ("rows_processed", "cells", "metadata", "columns_mapped")]
    merged = counts.unionByName(metadata).unionByName(mapped).groupBy("table_name").agg(*sums)
    rows, cells = F.col("rows_processed"), F.col("cells")
    return merged.select(
        "table_name",
        E.table_iri(profile, F.col("table_name")).alias("table_uri"),
        "rows_processed",
        "cells",
        "columns_mapped",
        (F.col("metadata") + profile.data_count(rows, cells)).alias("triples_generated"),
        S.parts(rows, rows_per_part).alias("parts"),
    )


def _chunk(i: Column) -> Column:
    return terms.chunk_name(i)


def _page(i: Column) -> Column:
    return F.concat(F.lit("./"), terms.page_name(i))


def _names(parts: Column, page: Column, listed: int, name: Callable[[Column], Column]) -> Column:
    """The names on one page of a list of so many parts."""
    first = page * listed
    last = F.least(first + listed, parts) - 1
    none = F.array().cast("array<bigint>")
    return F.transform(F.when(last >= first, F.sequence(first, last)).otherwise(none), name)


def name_list(summary: DataFrame, listed: int = LISTED, name: Callable[[Column], Column] = _chunk) -> DataFrame:
    """A table's list of chunks or pages: ``table_name, page, names, next``, ``next`` being null on the last page.

    One row per page, whatever the number of parts; tables without parts have one empty page.
    """
    parts, zero = F.col("parts"), F.lit(0).cast("long")
    pages = summary.select("table_name", "parts", F.explode(F.sequence(zero, F.greatest(S.parts(parts, listed) - 1, zero))).alias("page"))
    more = F.when((F.col("page") + 1) * listed < parts, F.col("page") + 1)
    return pages.select("table_name", "page", _names(parts, F.col("page"), listed, name).alias("names"), more.alias("next"))


def manifest(summary: DataFrame, created: str, rows_per_chunk: int = V.ROWS_PER_PART, listed: int = LISTED) -> DataFrame:
    """The manifest document of a converted table from its summary."""
    files = F.struct(
        F.lit("table").alias("metadata"),
        F.lit("full").alias("full"),
        _names(F.col("parts"), F.lit(0).cast("long"), listed, _chunk).alias("chunks"),
        F.lit("chunk_list").alias("chunk_list"),
        F.lit("chunk_index").alias("chunk_index"),
    )
    return summary.select(
        "table_name",
        "table_uri",
        F.col("table_uri").alias("dataset_uri"),
        F.lit(created).alias("created"),
        F.col("rows_processed").alias("row_count"),
        F.col("triples_generated").alias("triple_count"),
        "columns_mapped",
        F.lit(rows_per_chunk).cast("long").alias("chunk_size"),
        F.col("parts").alias("chunk_count"),
        files.alias("files"),
    )


def page_manifest(summary: DataFrame, file_name: str, profile: Profile, rows_per_page: int, listed: int = LISTED) -> DataFrame:
    """The manifest of page documents."""
    context = F.struct(
        F.lit(profile.ontology).alias("@vocab"), F.lit(profile.ontology).alias("fdic"), F.lit(V.CSVW).alias("csvw")
    )
    return summary.select(
        context.alias("@context"),
        F.lit("csvw:Table").alias("@type"),
        F.col("table_uri").alias("@id"),
        F.lit(profile.title_prefix + file_name).alias("title"),
        F.lit("./table").alias("metadata"),
        F.col("rows_processed").alias("total_rows"),
        F.lit(rows_per_page).alias("rows_per_page"),
        F.col("parts").alias("page_count"),
        _names(F.col("parts"), F.lit(0).cast("long"), listed, _page).alias("pages"),
        F.lit("./page_list").alias("page_list"),
    )


def run(
    conversion: Conversion,
    out: str,
    created: str,
    rows_per_part: int = V.ROWS_PER_PART,
    with_pages: bool = False,
    chunk_folders: bool = False,
    listed: int = LISTED,
) -> dict:
    """Write a single table's outputs below ``out`` and return its counts.

    ``table`` holds the metadata, ``full`` metadata and data in compressed files, ``chunks`` the data by row position: files with an index of chunks, or
    with ``chunk_folders`` a folder with one file per chunk. Without the chunks the data plan has no shuffle, so making it twice costs
    less than keeping it. Counts are observed while ``full``
    is written.
    """
    profile = conversion.profile
    metadata = conversion.metadata.persist()
    sinks.write_lines(metadata, f"{out}/table", single_file=True)
    seen = Observation("full")

    def kind(lines: DataFrame, name: str) -> DataFrame:
        return lines.select("value", F.lit(name).alias("kind"))

    is_link = F.col("p") == profile.term("hasAnnotation")
    about = metadata.select(
        terms.triple_line().alias("value"), F.when(is_link, F.lit("link")).otherwise(F.lit("metadata")).alias("kind")
    )
    everything = about.unionByName(kind(conversion.row_triples(lines=True), "row")).unionByName(
        kind(conversion.cell_triples(lines=True), "cell")
    )
    observed = everything.observe(
        seen, F.count("*").alias("triples"),
        *[F.count(F.when(F.col("kind") == name, F.lit(1))).alias(name) for name in ("row", "cell", "link")],
    )
    observed.select("value").write.mode("overwrite").option("compression", sinks.COMPRESSION).text(f"{out}/full")
    write_chunks = sinks.write_chunks if chunk_folders else sinks.write_chunk_files
    write_chunks(conversion.data(lines=True), f"{out}/chunks", rows_per_part)
    counts = seen.get
    rows, cells = counts["row"] // profile.triples_per_row, counts["cell"] // profile.triples_per_cell
    metadata.unpersist()

    spark = conversion.table.frame.sparkSession
    summary = spark.range(1).select(
        F.lit(conversion.table.name).alias("table_name"),
        E.table_iri(profile, F.lit(conversion.table.name)).alias("table_uri"),
        F.lit(rows).cast("long").alias("rows_processed"),
        F.lit(cells).cast("long").alias("cells"),
        F.lit(counts["link"]).cast("long").alias("columns_mapped"),
        F.lit(counts["triples"]).cast("long").alias("triples_generated"),
        S.parts(F.lit(rows), rows_per_part).alias("parts"),
    )
    index = S.part_index(conversion.table, rows_per_part, terms.chunk_name)
    index.write.mode("overwrite").json(f"{out}/chunk_index")
    name_list(summary, listed).write.mode("overwrite").json(f"{out}/chunk_list")
    if with_pages:
        sinks.write_pages(P.pages(P.page_rows(conversion.table, profile), rows_per_part), f"{out}/pages")
        document = page_manifest(summary, conversion.table.file_name or conversion.table.name, profile, rows_per_part, listed)
        sinks.write_document(document, f"{out}/page_manifest")
        name_list(summary, listed, _page).write.mode("overwrite").json(f"{out}/page_list")
    sinks.write_document(manifest(summary, created, rows_per_part, listed), f"{out}/table_manifest")
    results = summary.select(F.struct("table_uri", "rows_processed", "triples_generated").alias("processing_results"))
    sinks.write_document(results, f"{out}/processing_results")
    return summary.first().asDict()
