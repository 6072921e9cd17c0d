"""Rows, cells, identifiers, literal types and triples of tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cellweave import vocab as V
from cellweave.functions import numbers, terms
from cellweave.operators import cells as C
from cellweave.operators import emit as E
from cellweave.operators import index as I
from cellweave.operators import summary as S
from cellweave.sources.table import source_table

from .base import (
    COLUMNS, derive, duck, q, query, sql_cell_triples, sql_cells, sql_datatype, sql_row_triples, sql_triple, table,
)


@query("row_index", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index FROM orders
""")
def row_index(spark, folder):
    """Positions in an order that is not the files' own."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_orderdate")
    return I.with_row_index(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_index")


@query("file_row_index", """
SELECT row_number() OVER () - 1 AS row_index, l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
""")
def file_row_index(spark, folder):
    """Positions of a table without a unique key: those in the file."""
    lineitem = table(spark, folder, "lineitem")
    return lineitem.frame.select(
        "row_index", *[F.col(f"c{i}").alias(lineitem.names[i]) for i in range(4)]
    )


@query("row_limit", f"SELECT * FROM ({sql_cells('customer')}) WHERE row_index < 100")
def row_limit(spark, folder):
    return C.melt(table(spark, folder, "customer", max_rows=100))


@query("limit_report", """
SELECT t AS table_name, n AS rows_available, least(n, 1000) AS rows_processed, n > 1000 AS is_cut
FROM (SELECT 'orders' AS t, count(*) AS n FROM orders UNION ALL SELECT 'nation', count(*) FROM nation)
""")
def limit_report(spark, folder):
    reports = [
        I.limit_report(table(spark, folder, name), 1000).withColumn("table_name", F.lit(name))
        for name in ("orders", "nation")
    ]
    return reports[0].unionByName(reports[1])


@query("melt_cells", sql_cells("orders"))
def melt_cells(spark, folder):
    return C.melt(table(spark, folder, "orders"))


@query("melt_columns", f"SELECT * FROM ({sql_cells('events')}) WHERE column_index IN (3, 5)")
def melt_columns(spark, folder):
    return C.melt(table(spark, folder, "events"), columns=[3, 5])


BLANKS = """
SELECT c_custkey, c_name, CASE WHEN c_nationkey < 5 THEN NULL ELSE c_nationkey END AS c_nationkey,
       CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '  ' WHEN 'MACHINERY' THEN '' WHEN 'BUILDING' THEN chr(160) || chr(9)
            WHEN 'FURNITURE' THEN ' ' || c_mktsegment || ' ' ELSE c_mktsegment END AS c_mktsegment
FROM {customer}
"""


def _blank_rows() -> str:
    return f"(SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_index, * FROM ({duck(BLANKS)}))"


@query("drop_blank_cells", sql_cells(
    "customer", _blank_rows(), "value IS NOT NULL AND trim(replace(replace(value, chr(160), ''), chr(9), '')) <> ''"
))
def drop_blank_cells(spark, folder):
    """Null, empty, white and non-breaking white values leave no cell; others keep their spaces."""
    customers = derive(spark, folder, BLANKS).withColumn("row_index", F.col("c_custkey"))
    return C.melt(source_table(customers, "customer"))


@query("mint_iris", f"""
SELECT row_index, column_index,
       '{V.PLAIN.base}table/' || url_encode('part list/é') AS table_iri,
       '{V.PLAIN.base}column/' || url_encode('part list/é') || '/' || column_index AS column_iri,
       '{V.PLAIN.base}row/' || url_encode('part list/é') || '/' || row_index AS row_iri,
       '{V.PLAIN.base}cell/' || url_encode('part list/é') || '/' || row_index || '/' || column_index AS cell_iri
FROM ({sql_cells('part')})
""")
def mint_iris(spark, folder):
    part = replace(table(spark, folder, "part"), name="part list/é")
    cells = E.with_iris(C.melt(part), part, V.PLAIN)
    return cells.select(
        "row_index", "column_index", E.table_iri(V.PLAIN, part.table_key()).alias("table_iri"),
        "column_iri", "row_iri", "cell_iri",
    )


@query("columns_dim", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {i} AS column_index, '{c}' AS column_name, "
    f"'{V.TYPED.base}column/{t}/{i}' AS column_iri, count({c}) AS cells FROM {t}"
    for t in ("orders", "customer") for i, c in enumerate(COLUMNS[t])
))
def columns_dim(spark, folder):
    """Columns by position with the number of cells in each."""
    def one(name):
        source = table(spark, folder, name)
        columns = E.columns_dim(E.tables_dim(spark, source), source.names, V.TYPED)
        filled = C.melt(source).groupBy("column_index").agg(F.count("*").alias("cells"))
        return columns.join(filled, "column_index", "left").select(
            "table_name", "column_index", "column_name", "column_iri", F.coalesce("cells", F.lit(0)).alias("cells")
        )

    return one("orders").unionByName(one("customer"))


# Every host of the pages is a table of its own; ports and paths make their names need encoding.
HOSTS = """
SELECT DISTINCT regexp_extract(url, '^[a-z]+://[^/?#]+', 0) AS table_name FROM {pages}
"""
SITE_COLUMNS = ["url", "html title"]


def _hosts(spark, folder):
    hosts = derive(spark, folder, HOSTS)
    return hosts.withColumn("file_name", F.concat("table_name", F.lit(".csv")))


@query("table_metadata", " UNION ALL ".join(
    f"SELECT {arm} FROM ({duck(HOSTS)}) AS h{i}" for i, arm in enumerate([
        sql_triple(f"'{V.PLAIN.base}table/' || url_encode(table_name)", q(V.RDF_TYPE), q(V.PLAIN.ontology + "Table"), "iri"),
        sql_triple(f"'{V.PLAIN.base}table/' || url_encode(table_name)", q(V.DCTERMS + "title"),
                   f"'{V.PLAIN.title_prefix}' || table_name || '.csv'"),
        sql_triple(f"'{V.PLAIN.base}table/' || url_encode(table_name)", q(V.DCTERMS + "created"), "'2024-05-06T07:08:09.000010'",
                   "literal", q(V.XSD + "dateTime")),
    ])
))
def table_metadata(spark, folder):
    created = F.lit("2024-05-06 07:08:09.00001").cast("timestamp_ntz")
    return E.table_triples(_hosts(spark, folder), V.PLAIN, created)


_COLUMN = f"'{V.PLAIN.base}column/' || url_encode(table_name) || '/' || column_index"


@query("column_triples", f"WITH c AS (SELECT * FROM ({duck(HOSTS)}) AS h, "
       "(VALUES (0, 'url'), (1, 'html title')) AS v(column_index, column_name)) " + " UNION ALL ".join(
    f"SELECT {arm} FROM c" for arm in [
        sql_triple(_COLUMN, q(V.RDF_TYPE), q(V.PLAIN.ontology + "Column"), "iri"),
        sql_triple(_COLUMN, q(V.PLAIN.ontology + "columnName"), "column_name"),
        sql_triple(_COLUMN, q(V.PLAIN.ontology + "columnIndex"), "CAST(column_index AS VARCHAR)", "literal", q(V.XSD + "integer")),
        sql_triple(f"'{V.PLAIN.base}table/' || url_encode(table_name)", q(V.PLAIN.ontology + "column"), _COLUMN, "iri"),
    ]
))
def column_triples(spark, folder):
    return E.column_triples(E.columns_dim(_hosts(spark, folder), SITE_COLUMNS, V.PLAIN), V.PLAIN)


@query("row_triples", f"{sql_row_triples('orders', V.PLAIN)} UNION ALL {sql_row_triples('customer', V.TYPED)}")
def row_triples(spark, folder):
    plain = E.row_triples(table(spark, folder, "orders"), V.PLAIN)
    return plain.unionByName(E.row_triples(table(spark, folder, "customer"), V.TYPED))


@query("cell_triples_plain", sql_cell_triples("customer", V.PLAIN))
def cell_triples_plain(spark, folder):
    customer = table(spark, folder, "customer")
    return E.cell_triples(C.plain_cells(C.melt(customer)), customer, V.PLAIN)


@query("cell_triples_typed", sql_cell_triples("customer", V.TYPED))
def cell_triples_typed(spark, folder):
    customer = table(spark, folder, "customer")
    return E.cell_triples(C.type_cells(C.melt(customer), customer), customer, V.TYPED)


@query("typed_cells_from_text", f"""
SELECT row_index, column_index, value, {sql_datatype('orders')} AS datatype, value AS lexical
FROM ({sql_cells('orders')})
""")
def typed_cells_from_text(spark, folder):
    """The same types when all columns come as text and each cell has to be looked at."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    texts = orders.select(F.col("o_orderkey").alias("row_index"), *[F.col(c).cast("string") for c in orders.columns])
    source = source_table(texts, "orders")
    return C.type_cells(C.melt(source), source).select("row_index", "column_index", "value", "datatype", "lexical")


# Spellings of numbers and near-numbers, made from the columns of part.
_SPELLINGS = [
    "p_name", "CAST(p_size AS STRING)", "'00' || p_size", "' +' || p_size || ' '", "p_size || 'e3'", "p_size || '_000'",
    "p_size || '__0'", "'-' || p_size || '.50'", "'.' || p_size", "p_size || '.'", "p_size || 'f'", "'-0' || p_size",
    "p_size || ',5'", "CAST(p_retailprice AS STRING)", "p_size || 'E-2'", "p_brand", "chr(160) || p_size", "'0x' || p_size",
]
SPELLINGS = " UNION ALL ".join(
    f"SELECT p_partkey, {i} AS spelling, {text} AS value FROM {{part}}" for i, text in enumerate(_SPELLINGS)
)


@query("typed_literals", f"""
WITH t AS (SELECT *, replace(replace(trim(replace(value, chr(160), ' ')), '_', ''), '+', '') AS bare FROM ({duck(SPELLINGS)})),
u AS (SELECT *, CASE
  WHEN regexp_full_match(trim(replace(value, chr(160), ' ')), '[+-]?[0-9]+(_[0-9]+)*') THEN 'integer'
  WHEN regexp_full_match(trim(replace(value, chr(160), ' ')), '[+-]?([0-9]+[.]?([0-9]+)?|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN 'decimal'
  END AS code FROM t)
SELECT p_partkey, spelling, value, '{V.XSD}' || code AS datatype,
       CASE code WHEN 'integer' THEN CAST(TRY_CAST(bare AS BIGINT) AS VARCHAR)
                 WHEN 'decimal' THEN CAST(TRY_CAST(bare AS DOUBLE) AS VARCHAR) ELSE value END AS lexical
FROM u
""")
def typed_literals(spark, folder):
    texts = derive(spark, folder, SPELLINGS).repartition("p_partkey")
    typed = texts.withColumn("datatype", numbers.infer_datatype("value"))
    return typed.withColumn("lexical", numbers.lexical_form("value", "datatype"))


@query("percent_encode", """
SELECT page_id, url_encode(url) AS encoded_url, url_encode(html) AS encoded_html FROM pages
""")
def percent_encode(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return pages.select(
        "page_id", terms.percent_encode("url").alias("encoded_url"), terms.percent_encode("html").alias("encoded_html")
    )


_ESCAPED = "replace(replace(replace(replace({0}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r')"
ODD_TEXT = "SELECT doc_id, text || ' C:' || chr(92) || lang || chr(13) || '\"' || source || '\"' || chr(9) AS text FROM {documents}"


@query("escape_literals", f"""
SELECT doc_id, {_ESCAPED.format('text')} AS escaped, text AS unescaped FROM ({duck(ODD_TEXT)})
""")
def escape_literals(spark, folder):
    texts = derive(spark, folder, ODD_TEXT)
    escaped = texts.select("doc_id", terms.escape_literal("text").alias("escaped"))
    return escaped.withColumn("unescaped", terms.unescape_literal("escaped"))


@query("format_terms", f"""
SELECT doc_id, '"' || {_ESCAPED.format('text')} || '"@' || lang AS tagged, '"' || n_chars || '"^^<{V.XSD}integer>' AS typed,
       '<https://sources.example/' || source || '>' AS iri, '_:d' || doc_id AS bnode, '"' || source || '"' AS plain
FROM documents
""")
def format_terms(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    none = F.lit(None).cast("string")

    def term(o, kind, datatype=none, lang=none):
        return terms.format_term(o, F.lit(kind), datatype, lang)

    return documents.select(
        "doc_id",
        term(F.col("text"), "literal", lang=F.col("lang")).alias("tagged"),
        term(F.col("n_chars").cast("string"), "literal", F.lit(V.XSD + "integer")).alias("typed"),
        term(F.concat(F.lit("https://sources.example/"), "source"), "iri").alias("iri"),
        term(F.concat(F.lit("_:d"), "doc_id"), "bnode").alias("bnode"),
        term(F.col("source"), "literal").alias("plain"),
    )


@query("node_urls", """
SELECT page_id, '?node=' || replace(url_encode('<' || url || '>'), '%2F', '/') AS node_url FROM pages
""")
def node_urls(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return pages.select("page_id", terms.node_url("url").alias("node_url"))


@query("file_names", """
SELECT page_id, regexp_extract(url, '[^/]*$') AS file_name,
       regexp_replace(regexp_extract(url, '[^/]*$'), '^(.+)[.][^.]*$', '\\1') AS file_stem
FROM pages
""")
def file_names(spark, folder):
    """File name and stem of paths; here the paths are the pages' addresses."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return pages.select("page_id", terms.file_name("url").alias("file_name"), terms.file_stem("url").alias("file_stem"))


@query("preview_rows", """
SELECT row_index, CAST(doc_id AS VARCHAR) AS doc_id,
       CASE WHEN length(text) > 50 THEN left(text, 50) || '...' ELSE text END AS text, lang, source,
       CAST(n_chars AS VARCHAR) AS n_chars
FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_index, * FROM documents) WHERE row_index < 20
""")
def preview_rows(spark, folder):
    return S.preview(table(spark, folder, "documents"))
