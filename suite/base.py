"""Registration of queries, and the inputs that both engines derive from the tables by the same SQL text."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave import session
from cellweave import vocab as V
from cellweave.functions import terms
from cellweave.operators.index import read_parquet_table
from cellweave.sources.table import SourceTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

CREATED = "2024-01-01T00:00:00"

# Key columns in file order; all are unique and dense.
KEYS = {
    "nation": "n_nationkey", "supplier": "s_suppkey", "customer": "c_custkey", "part": "p_partkey",
    "orders": "o_orderkey", "events": "event_id", "documents": "doc_id", "pages": "page_id",
}
COLUMNS = {
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "pages": ["page_id", "url", "html"],
}
NUMBERS = {
    "integer": {
        "n_nationkey", "n_regionkey", "s_suppkey", "s_nationkey", "c_custkey", "c_nationkey", "p_partkey", "p_size",
        "o_orderkey", "o_custkey", "event_id", "user_id", "doc_id", "n_chars", "page_id",
    },
    "decimal": {"s_acctbal", "c_acctbal", "p_retailprice", "o_totalprice", "value"},
}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) and, where there is one, its check."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


# Rows of a table that a task melts at most: each becomes some dozens of triples.
MELTED_ROWS = 1 << 15


def table(spark: SparkSession, folder: str, name: str, max_rows: int | None = None, task_rows: int | None = None) -> SourceTable:
    return read_parquet_table(spark, f"{folder}/{name}.parquet", name, max_rows=max_rows, task_rows=task_rows)


def derive(spark: SparkSession, folder: str, text: str, wide: bool = True) -> DataFrame:
    """Run SQL text in which ``{name}`` stands for a table; rows become many, so they are dealt to all cores, and no task has
    more than a bounded number of them."""
    names = [n for n in (*KEYS, "lineitem", "region", "labels", "benchmark", "conversations") if f"{{{n}}}" in text]
    tables = {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
    if wide:
        cores = spark.sparkContext.defaultParallelism
        tables = {n: session.at_least(df, max(cores, -(-df.count() // MELTED_ROWS))) for n, df in tables.items()}
    return spark.sql(text, **tables)


def duck(text: str) -> str:
    """The same SQL text for a database where the tables are views."""
    for n in (*KEYS, "lineitem", "region", "labels", "benchmark", "conversations"):
        text = text.replace(f"{{{n}}}", n)
    return text


def scratch(spark: SparkSession) -> str:
    """A new folder below the session's checkpoint folder, which driver and executors share."""
    return f"{session.shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"


# --- SQL building blocks for the checks -------------------------------------------------------------------------


def sql_rows(name: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {KEYS[name]}) - 1 AS row_index, * FROM {name}"


def sql_cells(name: str, source: str | None = None, where: str = "value IS NOT NULL AND trim(value) <> ''") -> str:
    """Cells ``row_index, column_index, column_name, value`` of a table (or of ``source`` with row_index)."""
    source = source or f"({sql_rows(name)})"
    arms = [
        f"SELECT row_index, {i} AS column_index, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {source} AS t{i}"
        for i, c in enumerate(COLUMNS[name])
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(arms)}) AS cells WHERE {where}"


def sql_datatype(name: str) -> str:
    """XSD type of a cell, by column."""
    integers = ", ".join(f"'{c}'" for c in COLUMNS[name] if c in NUMBERS["integer"])
    decimals = ", ".join(f"'{c}'" for c in COLUMNS[name] if c in NUMBERS["decimal"]) or "''"
    return (
        f"CASE WHEN column_name IN ({integers}) THEN '{V.XSD}integer' "
        f"WHEN column_name IN ({decimals}) THEN '{V.XSD}decimal' END"
    )


def sql_triple(s: str, p: str, o: str, kind: str = "literal", dt: str = "NULL", lang: str = "NULL") -> str:
    """Select list of one triple; arguments are SQL expressions except kind."""
    return (
        f"{s} AS s, {p} AS p, {o} AS o, '{kind}' AS o_kind, CAST({dt} AS VARCHAR) AS o_datatype, "
        f"CAST({lang} AS VARCHAR) AS o_lang"
    )


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_cell_triples(name: str, profile=V.TYPED, cells: str | None = None) -> str:
    base, ont = profile.base, profile.ontology
    cells = cells or sql_cells(name)
    cell = f"'{base}cell/{name}/' || row_index || '/' || column_index"
    row = f"'{base}row/{name}/' || row_index"
    column = f"'{base}column/{name}/' || column_index"
    dt = sql_datatype(name) if profile.typed else "NULL"
    arms = [
        sql_triple(cell, q(V.RDF_TYPE), q(ont + "Cell"), "iri"),
        sql_triple(cell, q(ont + profile.cell_row), row, "iri"),
        sql_triple(cell, q(ont + profile.cell_column), column, "iri"),
        sql_triple(cell, q(ont + "value"), "value", "literal", dt),
    ]
    if profile.row_to_cell:
        arms.append(sql_triple(row, q(ont + "cell"), cell, "iri"))
    return " UNION ALL ".join(f"SELECT {arm} FROM ({cells}) AS c{i}" for i, arm in enumerate(arms))


def sql_row_triples(name: str, profile=V.TYPED) -> str:
    base, ont = profile.base, profile.ontology
    row = f"'{base}row/{name}/' || row_index"
    arms = [sql_triple(row, q(V.RDF_TYPE), q(ont + "Row"), "iri")]
    if profile.indexed_rows:
        arms.append(sql_triple(row, q(ont + "rowIndex"), "CAST(row_index AS VARCHAR)", "literal", q(V.XSD + "integer")))
        arms.append(sql_triple(q(f"{base}table/{name}"), q(ont + "row"), row, "iri"))
    return " UNION ALL ".join(f"SELECT {arm} FROM ({sql_rows(name)}) AS r{i}" for i, arm in enumerate(arms))


def sql_metadata_triples(name: str, profile=V.TYPED) -> str:
    """Table and column triples, as a VALUES list."""
    base, ont = profile.base, profile.ontology
    table_iri = f"{base}table/{name}"
    rows = [
        (table_iri, V.RDF_TYPE, ont + "Table", "iri", None),
        (table_iri, V.DCTERMS + "title", f"{profile.title_prefix}{name}.parquet", "literal", None),
        (table_iri, V.DCTERMS + "created", CREATED, "literal", V.XSD + "dateTime"),
    ]
    for i, c in enumerate(COLUMNS[name]):
        column = f"{base}column/{name}/{i}"
        rows += [
            (column, V.RDF_TYPE, ont + "Column", "iri", None),
            (column, ont + "columnName", c, "literal", None),
            (column, ont + "columnIndex", str(i), "literal", V.XSD + "integer"),
            (table_iri, ont + "column", column, "iri", None),
        ]
    values = ", ".join(
        "(" + ", ".join("CAST(NULL AS VARCHAR)" if v is None else q(v) for v in (*r, None)) + ")" for r in rows
    )
    return f"SELECT * FROM (VALUES {values}) AS m(s, p, o, o_kind, o_datatype, o_lang)"


# --- catalogues derived from the part table ---------------------------------------------------------------------

B = V.CATALOGUE_BASE

# Annotations of customer columns: every part is an annotation, so each column has many claimants.
ANNOTATIONS_BASE = f"""
SELECT '{B}part_' || p_partkey AS s, p_partkey, p_name, p_brand, p_type, p_size,
       CASE p_type WHEN 'ECONOMY' THEN 'c_custkey' WHEN 'SMALL' THEN 'c_name' WHEN 'MEDIUM' THEN 'c_acctbal'
                   WHEN 'PROMO' THEN 'C_NAME' WHEN 'STANDARD' THEN 'c_mktsegment' ELSE 'c_phone' END AS column_name,
       CASE WHEN p_size <= 15 THEN 'integer' WHEN p_size <= 35 THEN 'decimal' ELSE 'money' END AS code
FROM {{part}}
"""


# Triples of each annotation: predicate, object, kind, and where it holds, its language and another subject.
_ANNOTATION_ARMS = [
    (V.RDF_TYPE, f"'{B}ColumnAnnotation'", "iri", "TRUE", "NULL", "s"),
    (f"{B}columnName", "column_name", "literal", "TRUE", "NULL", "s"),
    (V.LABEL, "p_name", "literal", "TRUE", "'en'", "s"),
    (V.DESCRIPTION, "p_type || ' item'", "literal", "p_size > 5", "NULL", "s"),
    (f"{B}dataType", f"'{V.XSD}' || code", "iri", "TRUE", "NULL", "s"),
    (V.SEE_ALSO, "'https://brand.example/' || replace(p_brand, '#', '/')", "iri", "TRUE", "NULL", "s"),
    (V.SEE_ALSO, "'https://schema.org/' || p_type", "iri", "TRUE", "NULL", "s"),
    (V.SEE_ALSO, f"'{V.WIKIDATA_ENTITY}Q' || p_size", "iri", "p_size < 4", "NULL", "s"),
    (V.SAME_AS, f"'{V.WIKIDATA_ENTITY}Q' || p_partkey", "iri", "p_size < 10", "NULL", "s"),
    (V.OWL + "equivalentProperty", "'http://www.opengis.net/ont/geosparql#' || p_type", "iri", "p_size > 40", "NULL", "s"),
    (V.SKOS + "broader", "'https://schema.org/Thing'", "iri", "p_size = 30", "NULL", "s"),
    (V.COMMENT, "p_name || ' of ' || p_brand", "literal", "TRUE", "'en'", "s"),
    (V.COMMENT, "'size ' || p_size", "literal", "p_size > 20", "NULL", "s"),
    (f"{B}unit", "'piece ' || p_size", "literal", "TRUE", "NULL", "s"),
    (f"{B}unit", "'box'", "literal", "p_size > 25", "NULL", "s"),
    (V.DCTERMS + "conformsTo", "'_:b' || p_partkey", "bnode", "p_size = 50", "NULL", "s"),
    (V.LABEL, "'rule ' || p_partkey", "literal", "p_size = 50", "NULL", "'_:b' || p_partkey"),
]

# One pass over the parts for the one engine, a union of selections for the other.
_STRUCTS = ", ".join(
    f"CASE WHEN {where} THEN named_struct('s', {s}, 'p', '{p}', 'o', {o}, 'o_kind', '{kind}', "
    f"'o_datatype', CAST(NULL AS STRING), 'o_lang', CAST({lang} AS STRING)) END"
    for p, o, kind, where, lang, s in _ANNOTATION_ARMS
)
ANNOTATIONS_SPARK = f"SELECT inline(array_compact(array({_STRUCTS}))) FROM ({ANNOTATIONS_BASE})"
ANNOTATIONS = f"WITH base AS ({ANNOTATIONS_BASE}) " + " UNION ALL ".join(
    f"SELECT {s} AS s, '{p}' AS p, {o} AS o, '{kind}' AS o_kind, CAST(NULL AS STRING) AS o_datatype, "
    f"CAST({lang} AS STRING) AS o_lang FROM base WHERE {where}"
    for p, o, kind, where, lang, s in _ANNOTATION_ARMS
)

PREFIXES = {
    "schema": "https://schema.org/",
    "geo": "http://www.opengis.net/ont/geosparql#",
    "brand": "https://brand.example/",
    "brand-x": "https://brand.example/Brand/",
}


def annotations(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, ANNOTATIONS_SPARK)


# Nested records: one annotated column per part. Absent fields, unknown codes and mixed references occur.
RECORD_FIELDS = """
SELECT p_partkey AS ordinal, p_name || ' ' || p_partkey AS column_id, p_name AS label,
       CASE WHEN p_size > 10 THEN p_type || ' of ' || p_brand END AS description,
       CASE WHEN p_size <= 10 THEN 'integer' WHEN p_size <= 20 THEN 'dateTime' WHEN p_size <= 30 THEN 'money' END AS data_type,
       CASE p_type WHEN 'ECONOMY' THEN 'schema:' || p_name WHEN 'SMALL' THEN 'geo:' || p_size
                   WHEN 'MEDIUM' THEN 'http://example.net/' || p_size WHEN 'PROMO' THEN 'unknown:' || p_size
                   ELSE 'plain' END AS property,
       CASE WHEN p_size <= 5 THEN 'equivalent' WHEN p_size <= 10 THEN 'similar' WHEN p_size <= 15 THEN 'narrower'
            WHEN p_size <= 20 THEN 'instance_of' WHEN p_size <= 25 THEN 'odd' END AS relation,
       'https://brand.example/' || replace(p_brand, '#', '/') AS url,
       CASE WHEN p_size > 25 THEN 'Q' || p_size END AS wikidata,
       'see ' || p_type AS note, 'size ' || p_size AS unit
FROM {part}
"""

RECORDS = f"""
SELECT ordinal, column_id,
       named_struct(
         'label', label, 'description', description, 'data_type', data_type,
         'mappings', array(named_struct('property', property, 'relation', relation),
                           named_struct('property', 'geo:hasGeometry', 'relation', 'related'),
                           named_struct('property', CAST(NULL AS STRING), 'relation', 'exact')),
         'references', array(named_struct('url', url, 'wikidata', wikidata),
                             named_struct('url', CAST(NULL AS STRING), 'wikidata', 'Q1')),
         'comments', array(note, 'checked'),
         'extras', map('unit', array(unit, 'each'), 'semantic_type', array('skipped'))
       ) AS record
FROM ({RECORD_FIELDS})
"""


def records(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, RECORDS)


SUBJECT = f"'{B}column_' || regexp_replace(column_id, '[^a-zA-Z0-9_-]', '_', 'g')"


def with_subject(df: DataFrame) -> DataFrame:
    """Subjects of the derived records; their names end in a key, so no two collide."""
    return df.withColumn("subject", F.concat(F.lit(B), terms.safe_identifier("column_id")))

