"""JSON documents: nested catalogues, and the manifests of finished conversions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..model import CATALOGUE_DOCUMENT
from ..operators.catalogue import read_document

MANIFEST = (
    "table_name string, table_uri string, created string, row_count bigint, triple_count bigint, "
    "columns_mapped bigint, chunk_size bigint, chunk_count bigint, "
    "files struct<metadata: string, full: string, chunks: array<string>, chunk_list: string, chunk_index: string>"
)
PAGE_MANIFEST = (
    "`@id` string, title string, metadata string, total_rows bigint, rows_per_page bigint, page_count bigint, pages array<string>, page_list string"
)
NAME_LIST = "table_name string, page bigint, names array<string>, next bigint"
_MAP = "map<string, string>"
_CELL = "struct<uri: string, type: string, value: string, inRow: string, inColumn: string, columnName: string>"
PAGE = (
    "page bigint, start_row bigint, end_row bigint, "
    f"rows array<struct<row_index: bigint, row_uri: string, cells: {_MAP}, cell_uris: {_MAP}, cell_rdf: map<string, {_CELL}>>>"
)
RESULTS = "processing_results struct<table_uri: string, rows_processed: bigint, triples_generated: bigint>"


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Records ``ordinal, column_id, record, prefixes`` of a nested catalogue, one document per file.

    Absent fields are null. References may be plain urls or have ``url`` or ``wikidata``; comments may be single
    or a list; all further fields are extras.
    """
    return read_document(spark.read.schema(CATALOGUE_DOCUMENT).option("multiLine", True).json(path))


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """One row per converted table from all manifests below ``path`` (a glob or folder)."""
    return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(path)


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    """``table_name, ordinal, name``: the chunks or pages of all tables whose lists lie at ``path`` (a glob or folder), in order.

    Lists come in pages; a page that is missing is an error.
    """
    pages = spark.read.schema(NAME_LIST).json(path)
    last = pages.groupBy("table_name").agg(F.max("page").alias("_last"), F.count("*").alias("_pages"), F.count("next").alias("_links"))
    whole = (F.col("_pages") == F.col("_last") + 1) & (F.col("_links") == F.col("_last"))
    missing = F.raise_error(F.concat(F.lit("The list has a gap: "), F.col("table_name"))).cast("boolean")
    known = pages.join(last.filter(F.when(whole, True).otherwise(missing)), "table_name")
    # all pages but the last are full
    full = Window.partitionBy("table_name")
    rows = known.withColumn("_size", F.max(F.size("names")).over(full)).select("table_name", "page", "_size", F.posexplode("names").alias("_at", "name"))
    return rows.select("table_name", (F.col("page") * F.col("_size") + F.col("_at")).alias("ordinal"), "name")


def read_page_manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_MANIFEST).option("recursiveFileLookup", True).json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page documents as they were written, with their ``page_name``."""
    return spark.read.schema(PAGE).json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """``table_uri, rows_processed, triples_generated`` of finished conversions below ``path``."""
    return spark.read.schema(RESULTS).option("recursiveFileLookup", True).json(path).select("processing_results.*")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The documents' ``dataset_metadata`` and ``file_metadata`` maps."""
    documents = spark.read.schema(CATALOGUE_DOCUMENT).option("multiLine", True).json(path)
    return documents.select("dataset_metadata", "file_metadata")
