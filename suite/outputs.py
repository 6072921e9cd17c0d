"""Summaries, pages, chunks and manifests; writing and reading back; incremental conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave import vocab as V
from cellweave.functions import terms
from cellweave.operators import cells as C
from cellweave.operators import emit as E
from cellweave.operators import pages as P
from cellweave.operators import summary as S
from cellweave.plans import convert as plans
from cellweave.sinks import graph as sinks
from cellweave.sources import delimited, documents, statements, triples
from cellweave.streaming import ingest

from .base import (
    COLUMNS, CREATED, MELTED_ROWS, annotations, derive, duck, query, scratch, sql_cell_triples, sql_cells, sql_metadata_triples, sql_row_triples, table,
)
from .graphs import _GRAPH, _METADATA

ONT, BASE = V.TYPED.ontology, V.TYPED.base
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINE_CELLS = " + ".join(f"count({c})" for c in LINE_COLUMNS)


@query("chunk_assignment", """
SELECT l_orderkey, l_linenumber, rn - 1 AS row_index, printf('chunk_%04d', (rn - 1) // 1000) AS chunk
FROM (SELECT row_number() OVER () AS rn, l_orderkey, l_linenumber FROM lineitem)
""")
def chunk_assignment(spark, folder):
    frame = table(spark, folder, "lineitem").frame
    return frame.select(
        F.col("c0").alias("l_orderkey"), F.col("c3").alias("l_linenumber"), "row_index",
        terms.chunk_name(S.part_number(1000)).alias("chunk"),
    )


@query("page_index", """
SELECT 'lineitem' AS table_name, (rn - 1) // 1000 AS part, 'page_' || ((rn - 1) // 1000) AS part_name,
  min(rn) - 1 AS start_row, max(rn) - 1 AS end_row, count(*) AS rows
FROM (SELECT row_number() OVER () AS rn FROM lineitem) GROUP BY (rn - 1) // 1000
""")
def page_index(spark, folder):
    return S.part_index(table(spark, folder, "lineitem"))


@query("conversion_summary", f"""
SELECT 'lineitem' AS table_name, '{V.PLAIN.base}table/lineitem' AS table_uri, count(*) AS rows_processed, {_LINE_CELLS} AS cells,
  3 + 4 * 11 + 3 * count(*) + 4 * ({_LINE_CELLS}) AS triples_generated, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS parts
FROM lineitem
""")
def conversion_summary(spark, folder):
    """Counts of a conversion from one pass over the wide rows."""
    return S.conversion_summary(table(spark, folder, "lineitem"), V.PLAIN)


@query("annotated_summary", f"""
SELECT 'customer' AS table_name, '{BASE}table/customer' AS table_uri, (SELECT count(*) FROM customer) AS rows_processed,
  (SELECT count(*) FROM ({sql_cells('customer')})) AS cells, (SELECT count(*) FROM ({_METADATA}) WHERE p = '{ONT}hasAnnotation') AS columns_mapped,
  (SELECT count(*) FROM {_GRAPH} AS g) AS triples_generated, CAST(ceil((SELECT count(*) FROM customer) / 100.0) AS BIGINT) AS parts
""")
def annotated_summary(spark, folder):
    """Counts without emitting data agree with the graph that is emitted."""
    conversion = plans.convert(table(spark, folder, "customer"), V.TYPED, annotations(spark, folder), CREATED)
    return plans.summarise(conversion, 100)


@query("triple_counts", f"""
SELECT 'orders' AS table_name, 'table' AS kind, 3 AS triples UNION ALL SELECT 'orders', 'column', 24
UNION ALL SELECT 'orders', 'row', count(*) FROM ({sql_row_triples('orders', V.PLAIN)})
UNION ALL SELECT 'orders', 'cell', count(*) FROM ({sql_cell_triples('orders', V.PLAIN)})
""")
def triple_counts(spark, folder):
    return S.triple_counts(table(spark, folder, "orders"), V.PLAIN)


@query("estimate_vs_actual", f"""
SELECT 'lineitem' AS table_name, count(*) * 50 AS estimated_triples, 3 + 44 + count(*) + 5 * ({_LINE_CELLS}) AS triples_generated,
  round(100.0 * (count(*) * 50 - (3 + 44 + count(*) + 5 * ({_LINE_CELLS}))) / (3 + 44 + count(*) + 5 * ({_LINE_CELLS})), 2) AS error_percent
FROM lineitem
""")
def estimate_vs_actual(spark, folder):
    return S.estimate_vs_actual(table(spark, folder, "lineitem"), V.TYPED)


@query("manifest_summary", f"""
WITH n AS (SELECT count(*) AS row_count, {_LINE_CELLS} AS cells FROM lineitem),
p AS (SELECT unnest(range(CAST(ceil(row_count / 1000.0) AS BIGINT))) AS ordinal FROM n)
SELECT 'lineitem' AS table_name, '{BASE}table/lineitem' AS table_uri, row_count, 47 + row_count + 5 * cells AS triple_count,
  0 AS columns_mapped, 1000 AS chunk_size, CAST(ceil(row_count / 1000.0) AS BIGINT) AS chunk_count, ordinal, printf('chunk_%04d', ordinal) AS chunk
FROM n, p
""")
def manifest_summary(spark, folder):
    """The manifest, with one row per chunk on its list."""
    summary = plans.summarise(plans.convert(table(spark, folder, "lineitem"), V.TYPED, created=CREATED))
    document = plans.manifest(summary, CREATED).drop("files")
    names = plans.name_list(summary).select("table_name", "page", F.posexplode("names").alias("at", "chunk"))
    return document.join(names, "table_name").select(
        "table_name", "table_uri", "row_count", "triple_count", "columns_mapped", "chunk_size", "chunk_count",
        (F.col("page") * plans.LISTED + F.col("at")).alias("ordinal"), "chunk",
    )


_LISTED_SQL = "SELECT 'orders' AS table_name, ordinal, printf('chunk_%04d', ordinal) AS name, manifest FROM (SELECT unnest(range(CAST(ceil(count(*) / 100.0) AS BIGINT))) AS ordinal, printf('chunk_%04d', 0) AS manifest FROM orders)"


def _listed(spark, folder, listed):
    place = scratch(spark)
    conversion = plans.convert(table(spark, folder, "orders"), V.PLAIN, created=CREATED)
    summary = plans.summarise(conversion, 100)
    plans.name_list(summary, listed).write.json(f"{place}/chunk_list")
    sinks.write_document(plans.manifest(summary, CREATED, 100, listed), f"{place}/table_manifest")
    first = documents.read_manifests(spark, f"{place}/table_manifest").select("table_name", F.get("files.chunks", F.lit(0)).alias("manifest"))
    return documents.read_name_list(spark, f"{place}/chunk_list").join(first, "table_name")


@query("manifest_list", _LISTED_SQL)
def manifest_list(spark, folder):
    """The chunks of a table from its list beside the manifest."""
    return _listed(spark, folder, plans.LISTED)


@query("manifest_list_of_threes", _LISTED_SQL)
def manifest_list_of_threes(spark, folder):
    """The same where a page of the list holds three names."""
    return _listed(spark, folder, 3)


def _ran(spark, folder, name):
    place = scratch(spark)
    conversion = plans.convert(table(spark, folder, name, task_rows=MELTED_ROWS), V.TYPED, created=CREATED)
    plans.run(conversion, place, CREATED, 30, with_pages=True, listed=3)
    return place


@query("run_metadata", sql_metadata_triples("supplier"))
def run_metadata(spark, folder):
    """The metadata that a conversion writes beside its data, read back."""
    return triples.read_triples(spark, _ran(spark, folder, "supplier") + "/table")


_SUPPLIER_CELLS = " + ".join(f"count({c})" for c in COLUMNS["supplier"])


@query("run_results", f"""
SELECT '{BASE}table/supplier' AS table_uri, count(*) AS rows_processed, {3 + 4 * len(COLUMNS['supplier'])} + count(*) + 5 * ({_SUPPLIER_CELLS}) AS triples_generated
FROM supplier
""")
def run_results(spark, folder):
    """The result document of a conversion, read back."""
    return documents.read_results(spark, _ran(spark, folder, "supplier") + "/processing_results")


@query("run_pages", f"""
SELECT 'page_' || row_index // 30 AS page_name, row_index // 30 AS ordinal, row_index, column_name, value, (SELECT CAST(ceil(count(*) / 30.0) AS BIGINT) FROM supplier) AS page_count
FROM ({sql_cells('supplier')})
""")
def run_pages(spark, folder):
    """Pages as they were written, found by their manifest and its list, cell by cell."""
    place = _ran(spark, folder, "supplier")
    names = documents.read_name_list(spark, f"{place}/page_list").select("ordinal", F.substring("name", 3, 100).alias("page_name"))
    rows = documents.read_pages(spark, f"{place}/pages").join(names, "page_name").select("page_name", "ordinal", F.explode("rows").alias("r"))
    manifest = documents.read_page_manifests(spark, f"{place}/page_manifest").first()
    cells = rows.select("page_name", "ordinal", "r.row_index", F.explode("r.cells").alias("column_name", "value"))
    return cells.withColumn("page_count", F.lit(manifest["page_count"]).cast("long"))


@query("page_cells", f"""
SELECT row_index // 100 AS page, row_index, '{V.PLAIN.base}row/supplier/' || row_index AS row_uri, column_name, value,
  '{V.PLAIN.base}cell/supplier/' || row_index || '/' || column_index AS uri, '{V.PLAIN.base}column/supplier/' || column_index AS in_column
FROM ({sql_cells('supplier')})
""")
def page_cells(spark, folder):
    """Nested page documents, opened again."""
    pages = P.pages(P.page_rows(table(spark, folder, "supplier"), V.PLAIN), 100)
    rows = pages.select("page", F.explode("rows").alias("r"))
    cells = rows.select("page", "r.row_index", "r.row_uri", F.explode("r.cell_rdf").alias("column_name", "c"), "r.cells", "r.cell_uris")
    # The three maps of a row tell the same cells.
    agree = (F.col("cells")[F.col("column_name")] == F.col("c.value")) & (F.col("cell_uris")[F.col("column_name")] == F.col("c.uri"))
    return cells.filter(agree).select(
        "page", "row_index", "row_uri", "column_name", F.col("c.value").alias("value"), F.col("c.uri").alias("uri"),
        F.col("c.inColumn").alias("in_column"),
    )


@query("graph_roundtrip", f"SELECT * FROM {_GRAPH} AS g")
def graph_roundtrip(spark, folder):
    """The whole graph written as lines and read again."""
    conversion = plans.convert(table(spark, folder, "customer", task_rows=MELTED_ROWS), V.TYPED, annotations(spark, folder), CREATED)
    place = scratch(spark) + "/full"
    sinks.write_lines(conversion.triples(), place)
    return triples.read_triples(spark, place)


@query("text_roundtrip", f"""
SELECT '{V.PLAIN.base}cell/documents/' || row_index || '/' || column_index AS s, value AS o, printf('chunk_%04d', row_index // 64) AS chunk
FROM ({sql_cells('documents')})
""")
def text_roundtrip(spark, folder):
    """Long texts with line ends and quotes, written in files of chunks and read again with their chunk."""
    source = table(spark, folder, "documents", task_rows=MELTED_ROWS)
    cells = E.cell_triples(C.plain_cells(C.melt(source)), source, V.PLAIN, "row_index")
    place = scratch(spark) + "/chunks"
    sinks.write_chunk_files(cells.filter(F.col("p") == V.PLAIN.ontology + "value"), place, 64)
    return triples.read_chunks(spark, place).select("s", "o", "chunk")


@query("chunk_files", f"""
SELECT printf('chunk_%04d', row_index // 64) AS chunk, count(*) AS lines, TRUE AS few_files FROM ({sql_cells('documents')}) GROUP BY row_index // 64
""")
def chunk_files(spark, folder):
    """The index of chunks, read off the files; there are no more files than tasks."""
    source = table(spark, folder, "documents", task_rows=MELTED_ROWS)
    cells = E.cell_triples(C.plain_cells(C.melt(source)), source, V.PLAIN, "row_index")
    place = scratch(spark) + "/chunks"
    sinks.write_chunk_files(cells.filter(F.col("p") == V.PLAIN.ontology + "value"), place, 64)
    index = spark.read.schema(triples.INDEX).json(f"{place}/index")
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return index.select("chunk", "lines", F.lit(len(spark.read.text(f"{place}/lines").inputFiles()) <= most).alias("few_files"))


@query("one_chunk", f"""
SELECT '{V.PLAIN.base}cell/documents/' || row_index || '/' || column_index AS s, value AS o FROM ({sql_cells('documents')}) WHERE row_index // 16 = 5
""")
def one_chunk(spark, folder):
    """One chunk, found by the index."""
    source = table(spark, folder, "documents", task_rows=MELTED_ROWS)
    cells = E.cell_triples(C.plain_cells(C.melt(source)), source, V.PLAIN, "row_index")
    place = scratch(spark) + "/chunks"
    sinks.write_chunk_files(cells.filter(F.col("p") == V.PLAIN.ontology + "value"), place, 16)
    return triples.read_chunk(spark, place, "chunk_0005").select("s", "o")


# Parts as statements over several lines; every thirteenth text has a line that is none. Lines end in one of two ways.
_STATEMENTS = """
SELECT p_partkey, concat(
  'x:part_', p_partkey, ' a x:Part ;', chr(10), '    x:name "', p_name, '"@en , ', repeat(chr(39), 3), p_type, chr(10), ' . of "', p_brand, '"',
  repeat(chr(39), 3), ' ; # not; the "end" .', chr(10), '    x:size ', p_size, ' ; y:near <part_', p_size, '> .', chr(10),
  CASE WHEN p_partkey % 13 = 0 THEN concat('broken ', p_partkey, ' here .', chr(10)) ELSE '' END) AS value
FROM {part}
"""
_STATEMENT_ROWS = f"""
SELECT 'http://x/part_' || p_partkey AS s, '{V.RDF_TYPE}' AS p, 'http://x/Part' AS o, 'iri' AS o_kind, NULL AS o_datatype, NULL AS o_lang FROM part
UNION ALL SELECT 'http://x/part_' || p_partkey, 'http://x/name', p_name, 'literal', NULL, 'en' FROM part
UNION ALL SELECT 'http://x/part_' || p_partkey, 'http://x/name', p_type || chr(10) || ' . of "' || p_brand || '"', 'literal', NULL, NULL FROM part
UNION ALL SELECT 'http://x/part_' || p_partkey, 'http://x/size', CAST(p_size AS VARCHAR), 'literal', '{V.XSD}integer', NULL FROM part
UNION ALL SELECT 'http://x/part_' || p_partkey, 'http://y/near', 'http://base/at/part_' || p_size, 'iri', NULL, NULL FROM part
"""


def _statements(spark, folder):
    """One file per range of parts, each with its prefixes at the top, read in small splits."""
    place = scratch(spark)
    head = "@prefix x: <http://x/> .\nPREFIX y: <http://y/>\n@base <http://base/at/file> .\n"
    texts = derive(spark, folder, _STATEMENTS, wide=False).filter("value IS NOT NULL")
    ordered = texts.repartitionByRange(3, "p_partkey").sortWithinPartitions("p_partkey")
    # rows of a partition are counted from 0 in the lower bits
    is_first = F.monotonically_increasing_id() % (1 << 33) == 0
    # the writer adds the last line end again
    text = F.expr("substring(value, 1, length(value) - 1)")
    ordered.select(F.concat(F.when(is_first, F.lit(head)).otherwise(""), text).alias("value")).write.option("lineSep", "\n").text(place)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k in names:
            spark.conf.set(k, str(1 << 14))
        return statements.read_statements(spark, place)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@query("statement_triples", _STATEMENT_ROWS)
def statement_triples(spark, folder):
    """Statements over several lines with prefixes, a base, lists and long texts."""
    return _statements(spark, folder).triples


@query("triples_rejects", """
SELECT 'broken ' || p_partkey || ' here .' AS text, 1 AS times FROM part WHERE p_partkey % 13 = 0
""")
def triples_rejects(spark, folder):
    """What could not be read is told, by file and line; no two rejects are of one place."""
    rejects = _statements(spark, folder).rejects
    return rejects.groupBy("file", "line", "text").agg(F.count("*").cast("int").alias("times")).select("text", "times")


@query("unreadable_lines", """
SELECT CAST(3 * s_suppkey - 3 * min(s_suppkey) OVER () + 2 AS BIGINT) AS line, 'no triple of ' || s_name AS text FROM supplier
""")
def unreadable_lines(spark, folder):
    """Lines of a file with one triple per line that are none, by their number."""
    place = scratch(spark)
    lines = derive(spark, folder, """
        SELECT s_suppkey, explode(array(concat('<http://x/', s_suppkey, '> <http://x/name> "', s_name, '" .'), concat('no triple of ', s_name), '# note')) AS value
        FROM {supplier}
    """, wide=False)
    lines.coalesce(1).sortWithinPartitions("s_suppkey", F.col("value").startswith("#"), ~F.col("value").startswith("<")).select("value").write.text(place)
    return triples.unreadable_lines(spark, place).select("line", "text")


CSV_TEXT = """
SELECT doc_id, text || ' "quoted", with commas' AS text, CASE WHEN lang = 'en' THEN '' ELSE lang END AS lang,
  ' ' || source || ' ' AS source, n_chars FROM {documents}
"""


@query("csv_cells", sql_cells("documents", f"(SELECT doc_id AS row_index, * FROM ({duck(CSV_TEXT)}))"))
def csv_cells(spark, folder):
    """A delimited file with quotes, commas and line ends inside values: read, numbered and melted."""
    place = scratch(spark) + "/documents"
    texts = derive(spark, folder, CSV_TEXT)
    ordered = texts.repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id")
    ordered.write.option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(place)
    source = delimited.read_csv_table(spark, place, "documents")
    return C.melt(source)


@query("csv_cells_in_splits", sql_cells("documents", f"(SELECT doc_id AS row_index, * FROM ({duck(CSV_TEXT)}))"))
def csv_cells_in_splits(spark, folder):
    """The same in one file, read in many splits: line ends inside quotes lie on both sides of their borders."""
    place = scratch(spark) + "/documents"
    texts = derive(spark, folder, CSV_TEXT, wide=False).coalesce(1).sortWithinPartitions("doc_id")
    texts.write.option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(place)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k in names:
            spark.conf.set(k, str(1 << 16))
        cells = C.melt(delimited.read_csv_table(spark, place, "documents"))
        # splits are made when the plan is
        cells.rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return cells


@query("csv_tables", """
SELECT event_type AS table_name, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS row_index, event_id, user_id, props
FROM events
""")
def csv_tables(spark, folder):
    """A folder of delimited files, each a table of its own with its own row positions."""
    place = scratch(spark)
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "user_id", "props", "event_type")
    # one folder per type, then a table of that name per folder
    kinds = [x[0] for x in events.select("event_type").distinct().collect()]
    for kind in kinds:
        one = events.filter(F.col("event_type") == kind).drop("event_type")
        one = one.repartitionByRange(2, "event_id").sortWithinPartitions("event_id")
        one.write.option("header", True).option("escape", '"').csv(f"{place}/{kind}.CSV")
    source = delimited.read_csv_tables(spark, place)
    return source.frame.select(
        "table_name", "row_index", F.col("c0").cast("bigint").alias("event_id"), F.col("c1").cast("bigint").alias("user_id"),
        F.col("c2").alias("props"),
    )


_UNLIKE = {
    "customer": ["c_custkey", "c_name", "c_nationkey"], "supplier": ["s_name", "s_suppkey"],
    "part": ["p_brand", "p_partkey", "p_name", "p_type", "p_size"],
}
_UNLIKE_CELLS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, row_number() OVER (ORDER BY {key}) - 1 AS row_index, {i} AS column_index, '{c}' AS column_name, "
    f"CAST({c} AS VARCHAR) AS value FROM {t}"
    for t, key in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey")) for i, c in enumerate(_UNLIKE[t])
)


def _unlike_tables(spark, folder):
    place = scratch(spark)
    for name, columns in _UNLIKE.items():
        key = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}[name]
        rows = spark.read.parquet(f"{folder}/{name}.parquet").repartitionByRange(3, key).sortWithinPartitions(key)
        rows.select(*columns).write.option("header", True).option("escape", '"').csv(f"{place}/{name}.csv")
    return delimited.read_csv_tables(spark, place)


@query("csv_unlike_headers", _UNLIKE_CELLS)
def csv_unlike_headers(spark, folder):
    """Tables with headers of their own in one folder: every cell under its own column's name."""
    return C.melt(_unlike_tables(spark, folder))


@query("csv_unlike_columns", " UNION ALL ".join(
    f"SELECT '{BASE}column/{t}/{i}' AS s, '{ONT}columnName' AS p, '{c}' AS o" for t in _UNLIKE for i, c in enumerate(_UNLIKE[t])
) + "".join(f" UNION ALL SELECT '{BASE}table/{t}', '{V.DCTERMS}title', '{V.TYPED.title_prefix}{t}.csv'" for t in _UNLIKE)
 + f" UNION ALL SELECT '{BASE}cell/' || table_name || '/' || row_index || '/' || column_index, '{ONT}{V.TYPED.cell_column}', "
   f"'{BASE}column/' || table_name || '/' || column_index FROM ({_UNLIKE_CELLS})")
def csv_unlike_columns(spark, folder):
    """The graph of such a folder: titles, column names, and each cell's link to a column of its own table."""
    conversion = plans.convert(_unlike_tables(spark, folder), V.TYPED, created=CREATED)
    cell_column = V.TYPED.term(V.TYPED.cell_column)
    found = conversion.triples([V.TYPED.term("columnName"), V.DCTERMS + "title", cell_column])
    # the same predicate leads from tables to columns
    return found.filter((F.col("p") != cell_column) | F.col("s").startswith(BASE + "cell/")).select("s", "p", "o")


@query("subject_nodes", f"SELECT s, p, o, o_datatype, o_lang FROM {_GRAPH} AS g")
def subject_nodes(spark, folder):
    """JSON objects per subject, opened again. A low bound makes the larger subjects come in parts."""
    conversion = plans.convert(table(spark, folder, "customer", task_rows=MELTED_ROWS), V.TYPED, annotations(spark, folder), CREATED)
    nodes = sinks.nodes(conversion.triples(), limit=4)
    value = "array<struct<`@id`: string, `@value`: string, `@type`: string, `@language`: string>>"
    subject = F.get_json_object("node", "$.@id")
    properties = F.from_json(F.regexp_replace("node", r'^\{"@id":"[^"]*",', "{"), f"map<string, {value}>")
    opened = nodes.select(subject.alias("s"), F.explode(properties).alias("p", "v")).select("s", "p", F.explode("v").alias("v"))
    return opened.select(
        "s", "p", F.coalesce("v.@id", "v.@value").alias("o"), F.col("v.@type").alias("o_datatype"),
        F.col("v.@language").alias("o_lang"),
    )


def _manifest_sql(name: str) -> str:
    cells = " + ".join(f"count({c})" for c in COLUMNS[name])
    width = len(COLUMNS[name])
    return (
        f"SELECT '{name}' AS table_name, '{BASE}table/{name}' AS table_uri, count(*) AS row_count, "
        f"{3 + 4 * width} + count(*) + 5 * ({cells}) AS triple_count, CAST(ceil(count(*) / 500.0) AS BIGINT) AS chunk_count, "
        f"printf('chunk_%04d', (count(*) - 1) // 500) AS last_chunk FROM {name}"
    )


@query("manifest_catalogue", " UNION ALL ".join(_manifest_sql(t) for t in ("customer", "supplier", "orders")))
def manifest_catalogue(spark, folder):
    """Three tables converted with all their outputs, then found by their manifests."""
    place = scratch(spark)
    for name in ("customer", "supplier", "orders"):
        conversion = plans.convert(table(spark, folder, name, task_rows=MELTED_ROWS), V.TYPED, created=CREATED)
        plans.run(conversion, f"{place}/{name}", CREATED, 500)
    found = documents.read_manifests(spark, f"{place}/*/table_manifest")
    names = documents.read_name_list(spark, f"{place}/*/chunk_list")
    last = names.groupBy("table_name").agg(F.max_by("name", "ordinal").alias("last_chunk"))
    return found.select("table_name", "table_uri", "row_count", "triple_count", "chunk_count").join(last, "table_name")


@query("stream_triples", f"{sql_row_triples('events')} UNION ALL {sql_cell_triples('events')}")
def stream_triples(spark, folder):
    """Events that arrive in three lots of files, converted as they come, give the graph of the whole table."""
    place = scratch(spark)
    events = spark.read.parquet(f"{folder}/events.parquet")
    last = events.agg(F.max("event_id")).first()[0]
    for lot in range(3):
        arrived = events.filter(F.floor(F.col("event_id") * 3 / F.lit(last + 1)) == lot)
        arrived.repartitionByRange(4, "event_id").sortWithinPartitions("event_id").write.mode("append").parquet(f"{place}/in/{lot}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(f"{place}/in")
        ingest.start(stream, "events", f"{place}/out", f"{place}/checkpoint").awaitTermination()
    return triples.read_triples(spark, f"{place}/out/data").drop("batch", "chunk")
