"""Catalogues of annotated columns: nested to triples, triples to nested, prefixes, relations, identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave import vocab as V
from cellweave.functions import terms
from cellweave.operators import annotations as A
from cellweave.operators import catalogue as K
from cellweave.operators import prefixes as X
from cellweave.operators import summary as S
from cellweave.operators.identifiers import unique_identifiers
from cellweave.operators.index import read_parquet_table
from cellweave.plans.convert import convert
from cellweave.sources import documents
from cellweave.sources.bank_catalogue import BASE as DEFAULT_BASE
from cellweave.sources.bank_catalogue import catalogue_or_default
from cellweave.sources.table import source_table

from .base import (
    ANNOTATIONS, B, CREATED, PREFIXES, RECORD_FIELDS, SUBJECT, annotations, derive, duck, q, query, records, scratch, sql_triple,
    with_subject,
)

ONT = V.TYPED.ontology

_FIELDS = f"(SELECT *, {SUBJECT} AS subject FROM ({duck(RECORD_FIELDS)}))"
_CODES = ", ".join(q(c) for c in V.DATATYPE_CODES)
_EXPANDED = f"""CASE WHEN property LIKE 'schema:%' THEN '{PREFIXES['schema']}' || substring(property, 8)
  WHEN property LIKE 'geo:%' THEN '{PREFIXES['geo']}' || substring(property, 5) ELSE property END"""
_PREDICATE = "CASE coalesce(relation, 'related') " + " ".join(
    f"WHEN {q(r)} THEN {q(p)}" for r, p in V.RELATION_PREDICATES.items()
) + " END"

_CORE = " UNION ALL ".join(f"SELECT {arm} FROM {_FIELDS} AS f{i} WHERE {where}" for i, (arm, where) in enumerate([
    (sql_triple("subject", q(V.RDF_TYPE), q(B + "ColumnAnnotation"), "iri"), "TRUE"),
    (sql_triple("subject", q(B + "columnName"), "column_id"), "TRUE"),
    (sql_triple("subject", q(V.LABEL), "label"), "label IS NOT NULL"),
    (sql_triple("subject", q(V.DESCRIPTION), "description"), "description IS NOT NULL"),
    (sql_triple("subject", q(B + "dataType"),
                f"'{V.XSD}' || CASE WHEN data_type IN ({_CODES}) THEN data_type ELSE 'string' END", "iri"),
     "data_type IS NOT NULL"),
]))
_MAPPINGS = f"""SELECT {sql_triple('subject', _PREDICATE, _EXPANDED, 'iri')} FROM {_FIELDS} AS m0 WHERE {_PREDICATE} IS NOT NULL
UNION SELECT {sql_triple('subject', q(V.SEE_ALSO), q(PREFIXES['geo'] + 'hasGeometry'), 'iri')} FROM {_FIELDS} AS m1"""
_REFERENCES = f"""SELECT {sql_triple('subject', q(V.SEE_ALSO), 'url', 'iri')} FROM {_FIELDS} AS r0
UNION SELECT {sql_triple('subject', q(V.SAME_AS), f"'{V.WIKIDATA_ENTITY}' || wikidata", 'iri')} FROM {_FIELDS} AS r1 WHERE wikidata IS NOT NULL
UNION SELECT {sql_triple('subject', q(V.SAME_AS), q(V.WIKIDATA_ENTITY + 'Q1'), 'iri')} FROM {_FIELDS} AS r2"""
_COMMENTS = f"""SELECT {sql_triple('subject', q(V.COMMENT), 'note')} FROM {_FIELDS} AS c0
UNION SELECT {sql_triple('subject', q(V.COMMENT), q('checked'))} FROM {_FIELDS} AS c1"""
_EXTRAS = f"""SELECT {sql_triple('subject', q(B + 'unit'), 'unit')} FROM {_FIELDS} AS e0
UNION SELECT {sql_triple('subject', q(B + 'unit'), q('each'))} FROM {_FIELDS} AS e1"""


def _part(spark, folder, part):
    return K.record_triples(with_subject(records(spark, folder)), PREFIXES, (part,))


@query("annotation_core_triples", _CORE)
def annotation_core_triples(spark, folder):
    return _part(spark, folder, "core")


@query("mapping_triples", _MAPPINGS)
def mapping_triples(spark, folder):
    return _part(spark, folder, "mappings")


@query("reference_triples", _REFERENCES)
def reference_triples(spark, folder):
    return _part(spark, folder, "references")


@query("comment_triples", _COMMENTS)
def comment_triples(spark, folder):
    return _part(spark, folder, "comments")


@query("extra_triples", _EXTRAS)
def extra_triples(spark, folder):
    return _part(spark, folder, "extras")


@query("catalogue_triples", f"SELECT * FROM ({_CORE}) UNION SELECT * FROM ({_MAPPINGS}) UNION SELECT * FROM ({_REFERENCES}) "
       f"UNION SELECT * FROM ({_COMMENTS}) UNION SELECT * FROM ({_EXTRAS})")
def catalogue_triples(spark, folder):
    """The whole catalogue in one pass over its records."""
    return K.record_triples(with_subject(records(spark, folder)), PREFIXES)


_VOCABULARY = [
    (B + "ColumnAnnotation", V.RDF_TYPE, V.RDFS + "Class", "iri"),
    (B + "ColumnAnnotation", V.LABEL, "Column Annotation", "literal"),
    (B + "ColumnAnnotation", V.COMMENT, V.CLASS_COMMENT, "literal"),
    (B + "columnName", V.RDF_TYPE, V.RDF + "Property", "iri"),
    (B + "columnName", V.LABEL, "column name", "literal"),
    (B + "columnName", V.RDFS + "domain", B + "ColumnAnnotation", "iri"),
    (B + "dataType", V.RDF_TYPE, V.RDF + "Property", "iri"),
    (B + "dataType", V.LABEL, "data type", "literal"),
    (B + "dataType", V.RDFS + "domain", B + "ColumnAnnotation", "iri"),
]


@query("vocabulary_triples", f"""
WITH cat AS ({_CORE}), v AS (SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(q, r)) + ')' for r in _VOCABULARY)}) AS v(s, p, o, o_kind))
SELECT s, p, o, o_kind, (SELECT count(*) FROM cat WHERE cat.p = v.s OR cat.o = v.s) AS uses FROM v
""")
def vocabulary_triples(spark, folder):
    """The definitions, and how often the catalogue uses what they define."""
    used = K.record_triples(with_subject(records(spark, folder)), PREFIXES, ("core",))
    used = used.select(F.explode(F.array("p", F.when(F.col("o_kind") == "iri", F.col("o")))).alias("s"))
    uses = used.groupBy("s").agg(F.count("*").alias("uses"))
    definitions = K.vocabulary_triples(spark).select("s", "p", "o", "o_kind")
    # Nine definitions.
    return uses.join(F.broadcast(definitions), "s", "right").select(
        "s", "p", "o", "o_kind", F.coalesce("uses", F.lit(0)).alias("uses")
    )


DATASETS = """
SELECT 'https://example.org/brand/' || replace(p_brand, '#', '/') AS dataset, count(*) AS n, max(p_size) AS top FROM {part}
GROUP BY p_brand
"""
_SETS = f"({duck(DATASETS)})"


def _dataset_triples(spark, folder):
    sets = derive(spark, folder, DATASETS)
    fields = {
        "title": F.concat(F.lit("Parts "), "n"), "description": F.concat(F.lit("up to "), "top"),
        "publisher": F.lit("Parts Ltd"), "source": F.concat("dataset", F.lit("/source")),
        "license": F.when(F.col("top") > 49, F.lit("https://licenses.example/by")), "contact": F.lit("desk"),
    }
    metadata = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v)])
    described = K.dataset_triples(sets.withColumn("metadata", metadata), F.col("dataset"))
    dates = F.create_map(F.lit("created"), F.lit("2024-01-01"), F.lit("version"), F.concat(F.lit("v"), "n"), F.lit("x"), F.lit("y"))
    return described, K.file_triples(sets.withColumn("metadata", dates), F.concat("dataset", F.lit("/file")))


@query("dataset_triples", " UNION ALL ".join(f"SELECT {arm} FROM {_SETS} AS d{i} WHERE {where}" for i, (arm, where) in enumerate([
    (sql_triple("dataset", q(V.RDF_TYPE), q(V.DCAT + "Dataset"), "iri"), "TRUE"),
    (sql_triple("dataset", q(V.DCTERMS + "title"), "'Parts ' || n"), "TRUE"),
    (sql_triple("dataset", q(V.DCTERMS + "description"), "'up to ' || top"), "TRUE"),
    (sql_triple("dataset", q(V.DCTERMS + "publisher"), "'Parts Ltd'"), "TRUE"),
    (sql_triple("dataset", q(V.DCTERMS + "source"), "dataset || '/source'", "iri"), "TRUE"),
    (sql_triple("dataset", q(V.DCTERMS + "license"), "'https://licenses.example/by'", "iri"), "top > 49"),
    (sql_triple("dataset", q(B + "contact"), "'desk'"), "TRUE"),
    (sql_triple("dataset || '/file'", q(V.DCTERMS + "created"), "'2024-01-01'", "literal", q(V.XSD + "date")), "TRUE"),
    (sql_triple("dataset || '/file'", q(B + "version"), "'v' || n"), "TRUE"),
])))
def dataset_triples(spark, folder):
    described, files = _dataset_triples(spark, folder)
    return described.unionByName(files)


@query("dataset_metadata", " UNION ALL ".join(f"SELECT dataset, {q(k)} AS key, {v} AS value FROM {_SETS} AS d{i} WHERE {w}" for i, (k, v, w) in enumerate([
    ("title", "'Parts ' || n", "TRUE"), ("description", "'up to ' || top", "TRUE"), ("publisher", "'Parts Ltd'", "TRUE"),
    ("source", "dataset || '/source'", "TRUE"), ("license", "'https://licenses.example/by'", "top > 49"),
    ("contact", "'desk'", "TRUE"),
])))
def dataset_metadata(spark, folder):
    """Metadata read back from triples; those of files and other nodes are left out."""
    described, files = _dataset_triples(spark, folder)
    return K.dataset_metadata(described.unionByName(files))


_ANN = f"({duck(ANNOTATIONS)})"
_LOOKUP = f"(SELECT o AS column_name, max(s) AS annotation_iri FROM {_ANN} AS a WHERE p = '{B}columnName' GROUP BY o)"


@query("annotation_lookup", f"SELECT * FROM {_LOOKUP}")
def annotation_lookup(spark, folder):
    return A.annotation_lookup(annotations(spark, folder))


# Columns of many tables: a table per brand, a column per part.
MANY_COLUMNS = f"""
SELECT p_brand AS table_name, CAST(p_partkey AS INT) AS column_index, p_name || ' ' || p_type AS column_name,
       '{V.TYPED.base}column/' || p_brand || '/' || p_partkey AS column_iri
FROM {{part}}
"""
# Annotations for about half of their names, most of them claimed several times.
CLAIMS = f"""
SELECT '{B}claim_' || p_partkey AS s, '{B}columnName' AS p, p_name || ' ' || p_type AS o, 'literal' AS o_kind,
       CAST(NULL AS STRING) AS o_datatype, CAST(NULL AS STRING) AS o_lang
FROM {{part}} WHERE p_name > 'm'
UNION ALL
SELECT '{B}claim_' || p_partkey, '{V.SEE_ALSO}', 'https://claims.example/' || p_size, 'iri', CAST(NULL AS STRING), CAST(NULL AS STRING)
FROM {{part}}
"""
_LINKED = f"""(SELECT c.*, l.annotation_iri FROM ({duck(MANY_COLUMNS)}) AS c LEFT JOIN (
  SELECT o AS column_name, max(s) AS annotation_iri FROM ({duck(CLAIMS)}) AS x WHERE p = '{B}columnName' GROUP BY o) AS l
  USING (column_name))"""


def _linked(spark, folder):
    claims = derive(spark, folder, CLAIMS)
    return A.link_columns(derive(spark, folder, MANY_COLUMNS), A.annotation_lookup(claims)), claims


@query("column_annotation_link", f"SELECT * FROM {_LINKED}")
def column_annotation_link(spark, folder):
    return _linked(spark, folder)[0]


@query("columns_unannotated", f"SELECT table_name, column_index, column_name, column_iri FROM {_LINKED} WHERE annotation_iri IS NULL")
def columns_unannotated(spark, folder):
    return A.unannotated(_linked(spark, folder)[0])


@query("link_triples", f"SELECT {sql_triple('column_iri', q(V.TYPED.ontology + 'hasAnnotation'), 'annotation_iri', 'iri')} FROM {_LINKED} WHERE annotation_iri IS NOT NULL")
def link_triples(spark, folder):
    return A.link_triples(_linked(spark, folder)[0], V.TYPED)


@query("columns_mapped", f"SELECT table_name, count(annotation_iri) AS columns_mapped, count(*) AS columns FROM {_LINKED} GROUP BY table_name")
def columns_mapped(spark, folder):
    return S.columns_mapped(_linked(spark, folder)[0])


@query("copied_annotations", f"""
SELECT DISTINCT s, p, o, o_kind, o_datatype, o_lang FROM ({duck(CLAIMS)}) AS x
WHERE s IN (SELECT annotation_iri FROM {_LINKED} WHERE annotation_iri IS NOT NULL)
""")
def copied_annotations(spark, folder):
    linked, claims = _linked(spark, folder)
    return A.copy_used(claims, linked)


CURIES = """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'schema:' || p_name WHEN 'SMALL' THEN 'geo:a:' || p_size
  WHEN 'MEDIUM' THEN 'http://x.example/' || p_size WHEN 'PROMO' THEN 'nope:' || p_size WHEN 'LARGE' THEN 'httpx:' || p_size
  ELSE p_name END AS name FROM {part}
"""
_EXPAND = f"""CASE WHEN name LIKE 'schema:%' THEN '{PREFIXES['schema']}' || substring(name, 8)
  WHEN name LIKE 'geo:%' THEN '{PREFIXES['geo']}' || substring(name, 5) ELSE name END"""


@query("curie_expand", f"SELECT p_partkey, name, {_EXPAND} AS iri, {_EXPAND} AS iri_by_table FROM ({duck(CURIES)})")
def curie_expand(spark, folder):
    """With prefixes from a configuration and, the same, from a table."""
    names = derive(spark, folder, CURIES).withColumn("iri", X.expand(F.col("name"), PREFIXES))
    table = spark.createDataFrame([(i, p, n) for i, (p, n) in enumerate(PREFIXES.items())], "ordinal int, prefix string, namespace string")
    return X.expand_by_table(names, "name", table, "iri_by_table")


# Prefixes as many as there are hosts; the general ones come between and hide later, longer ones.
SITE_PREFIXES = """
SELECT dense_rank() OVER (ORDER BY namespace) AS ordinal, 'h' || length(namespace) || '-' || namespace AS prefix, namespace FROM (
  SELECT DISTINCT regexp_extract(url, '^[a-z]+://[^/?#]+/', 0) AS namespace FROM {pages}
  UNION SELECT DISTINCT regexp_extract(url, '^[a-z]+://[^/?#]+/[a-z]+/', 0) FROM {pages}
  UNION SELECT 'https://m.'
) AS n WHERE namespace <> '' AND namespace NOT LIKE 'http://a%'
"""


@query("curie_compact", f"""
SELECT page_id, url, coalesce((SELECT min_by(prefix || ':' || substring(url, length(namespace) + 1), ordinal)
  FROM ({duck(SITE_PREFIXES)}) AS n WHERE starts_with(url, namespace)), url) AS short FROM pages
""")
def curie_compact(spark, folder):
    urls = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return X.compact_by_table(urls, "url", derive(spark, folder, SITE_PREFIXES), "short")


# Catalogue documents of five hundred columns each, written as one text: single values and lists, plain and nested references.
# Angled marks stand for braces, which have a meaning of their own in such a text.
_DOCUMENTS = f"""
SELECT p_partkey DIV 500 AS doc, concat('‹"prefixes": ‹"schema": "https://schema.org/"›, "columns": ‹', array_join(transform(array_sort(collect_list(struct(p_partkey, field))), x -> x.field), ', '), '››') AS value
FROM (
  SELECT ordinal AS p_partkey, concat('"', column_id, '": ‹"label": "', label, '"',
    coalesce(concat(', "description": "', description, '"'), ''), coalesce(concat(', "data_type": "', data_type, '"'), ''),
    ', "mappings": [‹"property": "', property, '"', coalesce(concat(', "relation": "', relation, '"'), ''), '›]',
    ', "references": ["', url, '"', coalesce(concat(', ‹"wikidata": "', wikidata, '"›'), ''), ']',
    ', "comments": ', CASE WHEN ordinal % 2 = 0 THEN concat('"', note, '"') ELSE concat('["', note, '", "checked"]') END,
    ', "unit": ', CASE WHEN ordinal % 3 = 0 THEN concat('"', unit, '"') ELSE concat('["', unit, '", "each"]') END, '›') AS field
  FROM ({RECORD_FIELDS})
) GROUP BY p_partkey DIV 500
"""


@query("nested_catalogue", f"""
SELECT row_number() OVER (PARTITION BY ordinal // 500 ORDER BY ordinal) - 1 AS ordinal, column_id, label, description, data_type, property, relation, url,
  wikidata, CASE WHEN ordinal % 2 = 0 THEN note ELSE note || '|checked' END AS comments, CASE WHEN ordinal % 3 = 0 THEN unit ELSE unit || '|each' END AS unit,
  'https://schema.org/' AS namespace
FROM ({duck(RECORD_FIELDS)})
""")
def nested_catalogue(spark, folder):
    """Catalogue documents of files, each a nested record per column, read in the order of the document."""
    place = scratch(spark)
    texts = derive(spark, folder, _DOCUMENTS, wide=False).withColumn("value", F.translate("value", "‹›", "{}"))
    texts.write.partitionBy("doc").text(place)
    found = documents.read_catalogue(spark, f"{place}/*")
    record = F.col("record")
    items = F.array_compact(F.transform(record["references"], lambda r: r["wikidata"]))
    return found.select(
        "ordinal", "column_id", *[record[c].alias(c) for c in ("label", "description", "data_type")],
        record["mappings"][0]["property"].alias("property"), record["mappings"][0]["relation"].alias("relation"), record["references"][0]["url"].alias("url"),
        F.get(items, F.lit(0)).alias("wikidata"), F.array_join(record["comments"], "|").alias("comments"),
        F.array_join(record["extras"]["unit"], "|").alias("unit"), F.col("prefixes")["schema"].alias("namespace"),
    )


_FILES = "SELECT s_suppkey, s_name, '2024-01-' || lpad(CAST(s_suppkey % 28 + 1 AS {text}), 2, '0') AS created, CASE WHEN s_suppkey % 3 > 0 THEN '2025-02-' || lpad(CAST(s_suppkey % 28 + 1 AS {text}), 2, '0') END AS modified, CASE WHEN s_suppkey % 2 = 0 THEN '1.' || s_suppkey END AS version FROM {supplier}"
_FILES_SQL = _FILES.format(text="VARCHAR", supplier="supplier")


@query("file_metadata", f"""
SELECT 'http://file/' || s_suppkey AS subject, 'created' AS key, created AS value FROM ({_FILES_SQL})
UNION ALL SELECT 'http://file/' || s_suppkey, 'modified', modified FROM ({_FILES_SQL}) WHERE modified IS NOT NULL
UNION ALL SELECT 'http://file/' || s_suppkey, 'version', version FROM ({_FILES_SQL}) WHERE version IS NOT NULL
""")
def file_metadata(spark, folder):
    """Metadata of catalogue files: from documents to triples and back."""
    place = scratch(spark)
    files = derive(spark, folder, _FILES.format(text="STRING", supplier="{supplier}"), wide=False)
    about = F.struct(F.struct(F.col("s_suppkey").cast("string").alias("title")).alias("dataset_metadata"), F.struct("created", "modified", "version", F.lit("x").alias("other")).alias("file_metadata"))
    files.select((F.col("s_suppkey") % 5).alias("lot"), F.to_json(about).alias("value")).write.partitionBy("lot").text(place)
    metadata = spark.read.schema("dataset_metadata map<string,string>, file_metadata map<string,string>").json(f"{place}/*")
    subject = F.concat(F.lit("http://file/"), F.col("dataset_metadata")["title"])
    return K.file_metadata(K.file_triples(metadata, subject, "file_metadata"), None)


# A table under names of which the default catalogue knows all but one.
_BANKS = "SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_index, c_custkey AS Y, c_name AS NAME, c_nationkey AS ZIP, c_mktsegment AS ODDITY, c_acctbal AS X FROM customer"


@query("fallback_catalogue", f"""
SELECT column_name, CASE WHEN column_name <> 'ODDITY' THEN '{DEFAULT_BASE}column_' || column_name END AS annotation_iri, label, cells FROM (
  SELECT 'Y' AS column_name, 'Y Coordinate' AS label, count(Y) AS cells FROM ({_BANKS}) UNION ALL SELECT 'NAME', 'Institution Name', count(NAME) FROM ({_BANKS})
  UNION ALL SELECT 'ZIP', 'ZIP Code', count(ZIP) FROM ({_BANKS}) UNION ALL SELECT 'ODDITY', NULL, count(ODDITY) FROM ({_BANKS})
  UNION ALL SELECT 'X', 'X Coordinate', count(X) FROM ({_BANKS}))
""")
def fallback_catalogue(spark, folder):
    """Without a catalogue of its own, a table's columns are looked up in the default one; cells are counted by their column."""
    customer = read_parquet_table(spark, f"{folder}/customer.parquet", "customer")
    names = {"c_custkey": "Y", "c_name": "NAME", "c_nationkey": "ZIP", "c_mktsegment": "ODDITY", "c_acctbal": "X"}
    places = [customer.names.index(c) for c in names]
    banks = source_table(customer.frame.select("row_index", *[f"c{i}" for i in places]), "banks", columns=[f"c{i}" for i in places], names=[*names.values()])
    conversion = convert(banks, V.TYPED, catalogue_or_default(spark, None), CREATED)
    labels = conversion.metadata.filter(F.col("p") == V.LABEL).select(F.col("s").alias("annotation_iri"), F.col("o").alias("label"))
    cells = conversion.cell_triples([ONT + V.TYPED.cell_column]).groupBy(F.col("o").alias("column_iri")).agg(F.count("*").alias("cells"))
    linked = conversion.linked.select("column_name", "column_iri", "annotation_iri").join(labels, "annotation_iri", "left")
    return linked.join(cells, "column_iri").select("column_name", "annotation_iri", "label", "cells")


_RELATIONS = [(r, p) for r, p in V.RELATION_PREDICATES.items()]
_REL_VALUES = ", ".join(f"({q(r)}, {q(p)})" for r, p in _RELATIONS)


@query("relation_inverse", f"""
SELECT a.s, r.relation, a.o FROM {_ANN} AS a JOIN (VALUES {_REL_VALUES}) AS r(relation, predicate) ON a.p = r.predicate
WHERE a.o_kind = 'iri'
""")
def relation_inverse(spark, folder):
    return K.relations_of(annotations(spark, folder))


@query("datatype_codes", f"""
SELECT s, o, CASE WHEN o LIKE '{V.XSD}%' AND substring(o, {len(V.XSD) + 1}) IN ({_CODES}) THEN substring(o, {len(V.XSD) + 1}) END AS code,
  '{V.XSD}' || CASE WHEN substring(o, {len(V.XSD) + 1}) IN ({_CODES}) THEN substring(o, {len(V.XSD) + 1}) ELSE 'string' END AS iri
FROM {_ANN} AS a WHERE p = '{B}dataType'
""")
def datatype_codes(spark, folder):
    """XSD type to code (none for unknown types) and code to XSD type (string for unknown codes)."""
    types = annotations(spark, folder).filter(F.col("p") == B + "dataType")
    code = F.substring_index("o", "#", -1)
    return types.select("s", "o", terms.datatype_code("o").alias("code"), terms.datatype_iri(code).alias("iri"))


_PREDICATES = ", ".join(q(p) for p in sorted(set(V.RELATION_PREDICATES.values()) | {V.SAME_AS}))
_REFS = f"""SELECT DISTINCT s, CAST(NULL AS VARCHAR) AS url, substring(o, {len(V.WIKIDATA_ENTITY) + 1}) AS wikidata
FROM {_ANN} AS a WHERE o_kind = 'iri' AND p IN ({_PREDICATES}) AND starts_with(o, '{V.WIKIDATA_ENTITY}')
UNION SELECT DISTINCT s, o, NULL FROM {_ANN} AS b WHERE o_kind = 'iri' AND p = '{V.SEE_ALSO}'"""


@query("annotation_references", _REFS)
def annotation_references(spark, folder):
    return K.references_of(annotations(spark, folder))


@query("first_value_per_property", f"SELECT s, p, min(o) AS first_o, max(o) AS last_o FROM {_ANN} AS a GROUP BY s, p")
def first_value_per_property(spark, folder):
    return K.first_values(annotations(spark, folder))


def _compact_sql(o: str) -> str:
    arms = " ".join(f"WHEN starts_with({o}, {q(n)}) THEN {q(p + ':')} || substring({o}, {len(n) + 1})" for p, n in PREFIXES.items())
    return f"CASE {arms} ELSE {o} END"


def _refs_sql(source: str) -> str:
    return f"""SELECT DISTINCT s, CAST(NULL AS VARCHAR) AS url, substring(o, {len(V.WIKIDATA_ENTITY) + 1}) AS wikidata
FROM {source} AS a WHERE o_kind = 'iri' AND p IN ({_PREDICATES}) AND starts_with(o, '{V.WIKIDATA_ENTITY}')
UNION SELECT DISTINCT s, o, NULL FROM {source} AS b WHERE o_kind = 'iri' AND p = '{V.SEE_ALSO}'"""


def _entries_sql(source: str) -> str:
    """Annotation records in long form, from triples."""
    return f"""
WITH a AS (SELECT * FROM {source}), n AS (SELECT DISTINCT s FROM a WHERE p = '{V.RDF_TYPE}' AND o = '{B}ColumnAnnotation'),
t AS (SELECT a.* FROM a JOIN n USING (s))
SELECT s, 'name' AS field, CAST(NULL AS VARCHAR) AS key, min(o) AS value FROM t WHERE p = '{B}columnName' GROUP BY s
UNION ALL SELECT s, 'label', NULL, max(o) FROM t WHERE p = '{V.LABEL}' GROUP BY s
UNION ALL SELECT s, 'description', NULL, max(o) FROM t WHERE p = '{V.DESCRIPTION}' GROUP BY s
UNION ALL SELECT s, 'data_type', NULL, max(substring(o, {len(V.XSD) + 1})) FROM t WHERE p = '{B}dataType' AND substring(o, {len(V.XSD) + 1}) IN ({_CODES}) GROUP BY s
UNION ALL SELECT s, 'extra', 'unit', min(o) FROM t WHERE p = '{B}unit' GROUP BY s
UNION ALL SELECT DISTINCT s, 'mapping', relation, {_compact_sql('o')} FROM t JOIN (VALUES {_REL_VALUES}) AS r(relation, predicate) ON t.p = r.predicate
  WHERE o_kind = 'iri' AND NOT starts_with(o, '{V.WIKIDATA_ENTITY}')
UNION ALL SELECT s, CASE WHEN url IS NULL THEN 'wikidata' ELSE 'url' END, NULL, coalesce(url, wikidata) FROM ({_refs_sql(source)}) AS refs
UNION ALL SELECT DISTINCT s, 'comment', NULL, o FROM t WHERE p = '{V.COMMENT}' AND o <> '{V.CLASS_COMMENT}'
"""


def _records_sql(source: str) -> str:
    """Nested records, their lists shown as text."""
    return f"""
WITH e AS ({_entries_sql(source)})
SELECT s AS subject, max(value) FILTER (field = 'name') AS column_name, max(value) FILTER (field = 'label') AS label,
  max(value) FILTER (field = 'description') AS description, max(value) FILTER (field = 'data_type') AS data_type,
  count(*) FILTER (field = 'mapping') AS mappings,
  string_agg(key || '=' || value, ' ' ORDER BY value, key) FILTER (field = 'mapping') AS mapping_text,
  string_agg(value, ' ' ORDER BY value) FILTER (field = 'url') AS urls,
  string_agg(value, ' ' ORDER BY value) FILTER (field = 'wikidata') AS wikidata,
  string_agg(value, '|' ORDER BY value) FILTER (field = 'comment') AS comments,
  max(value) FILTER (field = 'extra' AND key = 'unit') AS unit
FROM e GROUP BY s
"""


_ENTRIES = _entries_sql(_ANN)


@query("annotation_entries", _ENTRIES)
def annotation_entries(spark, folder):
    """Annotation records in long form."""
    return K.annotation_entries(annotations(spark, folder), PREFIXES)


def _shown(regrouped):
    """Nested records, their lists shown as text."""
    record = F.col("record")
    urls = F.array_compact(F.transform(record["references"], lambda r: r["url"]))
    items = F.array_compact(F.transform(record["references"], lambda r: r["wikidata"]))
    texts = F.transform(record["mappings"], lambda m: F.concat(m["relation"], F.lit("="), m["property"]))

    def joined(values, separator=" "):
        return F.when(F.size(values) > 0, F.array_join(values, separator))

    return regrouped.select(
        "subject", "column_name", record["label"].alias("label"), record["description"].alias("description"),
        record["data_type"].alias("data_type"), F.coalesce(F.size(record["mappings"]), F.lit(0)).alias("mappings"),
        joined(texts).alias("mapping_text"), joined(urls).alias("urls"), joined(items).alias("wikidata"),
        joined(record["comments"], "|").alias("comments"), F.array_join(record["extras"]["unit"], "|").alias("unit"),
    )


@query("annotation_regroup", _records_sql(_ANN))
def annotation_regroup(spark, folder):
    return _shown(K.regroup(K.annotation_entries(annotations(spark, folder), PREFIXES)))


@query("annotation_regroup_of_threes", _records_sql(_ANN))
def annotation_regroup_of_threes(spark, folder):
    """The same, put together from parts of some three entries."""
    return _shown(K.regroup(K.annotation_entries(annotations(spark, folder), PREFIXES), limit=3))


_CATALOGUE = (
    f"(SELECT * FROM ({_CORE}) UNION SELECT * FROM ({_MAPPINGS}) UNION SELECT * FROM ({_REFERENCES}) UNION SELECT * FROM ({_COMMENTS}) UNION SELECT * FROM ({_EXTRAS}))"
)


@query("catalogue_roundtrip", _records_sql(_CATALOGUE))
def catalogue_roundtrip(spark, folder):
    """Whole records, all seven fields, on their way to triples and back."""
    return _shown(K.regroup(K.annotation_entries(K.record_triples(with_subject(records(spark, folder)), PREFIXES), PREFIXES)))


@query("unique_column_ids", """
SELECT p_partkey, p_name, safe || CASE WHEN n > 0 THEN '_' || n ELSE '' END AS identifier FROM (
  SELECT p_partkey, p_name, safe, row_number() OVER (PARTITION BY safe ORDER BY p_partkey) - 1 AS n FROM (
    SELECT p_partkey, p_name, 'column_' || regexp_replace(p_name, '[^a-zA-Z0-9_-]', '_', 'g') AS safe FROM part))
""")
def unique_column_ids(spark, folder):
    """Every part's name as an identifier of its own; each name occurs many times."""
    part = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_name")
    return unique_identifiers(part, "p_name", "p_partkey")
