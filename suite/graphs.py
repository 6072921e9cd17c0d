"""Questions to graphs of converted tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave import vocab as V
from cellweave.operators import annotations as A
from cellweave.operators import cells as C
from cellweave.operators import emit as E
from cellweave.operators import graph as G
from cellweave.operators import summary as S
from cellweave.plans.convert import convert
from cellweave.sources.table import source_table

from .base import (
    ANNOTATIONS, B, COLUMNS, CREATED, MELTED_ROWS, annotations, derive, duck, q, query, sql_cell_triples, sql_cells, sql_datatype,
    sql_metadata_triples, sql_row_triples, sql_rows, sql_triple, table,
)

ONT, BASE = V.TYPED.ontology, V.TYPED.base
_ANN = f"({duck(ANNOTATIONS)})"
_NAMES = ", ".join(q(c) for c in COLUMNS["customer"])
# Columns of customer with the annotation that each is linked to.
_LINKS = f"""(SELECT i.column_index, i.column_name, '{BASE}column/customer/' || i.column_index AS column_iri, a.annotation_iri
FROM (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(COLUMNS['customer']))}) AS i(column_index, column_name)
LEFT JOIN (SELECT o AS column_name, max(s) AS annotation_iri FROM {_ANN} AS x WHERE p = '{B}columnName' GROUP BY o) AS a
USING (column_name))"""
_LINK_TRIPLES = (
    f"SELECT {sql_triple('column_iri', q(ONT + 'hasAnnotation'), 'annotation_iri', 'iri')} FROM {_LINKS} AS l "
    "WHERE annotation_iri IS NOT NULL"
)
_COPIED = f"SELECT DISTINCT * FROM {_ANN} AS c WHERE s IN (SELECT annotation_iri FROM {_LINKS} AS l WHERE annotation_iri IS NOT NULL)"
_METADATA = f"SELECT * FROM ({sql_metadata_triples('customer')}) UNION SELECT * FROM ({_LINK_TRIPLES}) UNION SELECT * FROM ({_COPIED})"
_GRAPH = f"(SELECT * FROM ({_METADATA}) UNION ALL {sql_row_triples('customer')} UNION ALL {sql_cell_triples('customer')})"


def _customer(spark, folder, annotated=True):
    catalogue = annotations(spark, folder) if annotated else None
    return convert(table(spark, folder, "customer", task_rows=MELTED_ROWS), V.TYPED, catalogue, CREATED)


@query("flagship", f"""
SELECT l.column_name, l.annotation_iri, count(*) AS cells, count(c.datatype) AS typed_cells, count(*) * 5 AS triples,
  (SELECT count(DISTINCT o) FROM {_ANN} AS a WHERE a.s = any_value(l.annotation_iri) AND p = '{V.SEE_ALSO}') AS cited
FROM (SELECT *, {sql_datatype('customer')} AS datatype FROM ({sql_cells('customer')})) AS c
JOIN {_LINKS} AS l USING (column_index) GROUP BY l.column_name, l.annotation_iri
""")
def flagship(spark, folder):
    """A table as a graph, its columns linked to a catalogue; counted per column from the triples."""
    conversion = _customer(spark, folder)
    cells = conversion.cell_triples()
    # All of a cell's triples end in or start with its identifier, whose last part is the column.
    cell = F.when(F.col("p") == ONT + "cell", F.col("o")).otherwise(F.col("s"))
    per_column = cells.groupBy(F.substring_index(cell, "/", -1).cast("int").alias("column_index")).agg(
        F.count(F.when(F.col("p") == V.RDF_TYPE, F.lit(1))).alias("cells"),
        F.count(F.when(F.col("p") == ONT + "value", F.col("o_datatype"))).alias("typed_cells"),
        F.count("*").alias("triples"),
    )
    cited = S.reference_census(conversion.metadata).select(F.col("s").alias("annotation_iri"), F.col("targets").alias("cited"))
    linked = conversion.linked.join(cited, "annotation_iri", "left")
    return per_column.join(linked, "column_index").select(
        "column_name", "annotation_iri", "cells", "typed_cells", "triples", F.coalesce("cited", F.lit(0)).alias("cited")
    )


@query("graph_union", f"SELECT * FROM ({_METADATA}) UNION {sql_row_triples('customer')}")
def graph_union(spark, folder):
    """The union of overlapping graphs holds each triple once."""
    conversion = _customer(spark, folder)
    rows = conversion.row_triples().drop("row_index")
    return G.union(conversion.metadata, rows, conversion.metadata, rows)


@query("full_graph", f"SELECT * FROM {_GRAPH} AS g")
def full_graph(spark, folder):
    """Everything a conversion emits: metadata, links, copied annotations, rows and cells."""
    return _customer(spark, folder).triples()


@query("copied_with_anonymous_nodes", f"""
WITH c AS ({_COPIED}) SELECT * FROM c UNION
SELECT a.* FROM {_ANN} AS a WHERE s IN (SELECT o FROM c WHERE o_kind = 'bnode')
""")
def copied_with_anonymous_nodes(spark, folder):
    catalogue = annotations(spark, folder)
    return A.copy_used(catalogue, _customer(spark, folder).linked, follow_bnodes=True)


@query("pattern_match", f"SELECT * FROM {_GRAPH} AS g WHERE p = '{ONT}value' AND o = 'HOUSEHOLD'")
def pattern_match(spark, folder):
    return _customer(spark, folder).match(p=ONT + "value", o="HOUSEHOLD")


@query("class_instances", f"SELECT DISTINCT s FROM {_GRAPH} AS g WHERE p = '{V.RDF_TYPE}' AND o = '{ONT}Row'")
def class_instances(spark, folder):
    return G.instances(_customer(spark, folder).triples([V.RDF_TYPE]), ONT + "Row")


@query("describe_node", f"SELECT * FROM {_GRAPH} AS g WHERE s = '{BASE}row/customer/42'")
def describe_node(spark, folder):
    return _customer(spark, folder).match(f"{BASE}row/customer/42")


NODES = f"SELECT '{BASE}row/customer/' || c_custkey AS node FROM {{customer}} WHERE c_acctbal < 0"


@query("describe_nodes", f"SELECT * FROM {_GRAPH} AS g WHERE s IN ({duck(NODES)})")
def describe_nodes(spark, folder):
    return G.describe_all(_customer(spark, folder).triples(), derive(spark, folder, NODES))


@query("multi_source_describe", f"""
WITH quads AS (SELECT 'metadata' AS source, * FROM ({_METADATA}) UNION ALL SELECT 'catalogue', * FROM {_ANN} AS a
  UNION ALL SELECT 'data', * FROM ({sql_row_triples('customer')} UNION ALL {sql_cell_triples('customer')}))
SELECT * FROM quads WHERE s IN (SELECT annotation_iri FROM {_LINKS} AS l UNION ALL ({duck(NODES)}))
""")
def multi_source_describe(spark, folder):
    """Nodes described from all sources; what several sources say stays apart."""
    conversion = _customer(spark, folder)
    data = conversion.data()
    quads = G.quads({"metadata": conversion.metadata, "catalogue": annotations(spark, folder), "data": data})
    linked = conversion.linked.filter(F.col("annotation_iri").isNotNull()).select(F.col("annotation_iri").alias("node"))
    return G.describe_all(quads, linked.unionByName(derive(spark, folder, NODES)))


CHANGED = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment
FROM {customer}
"""


@query("graph_diff", f"""
WITH l AS ({sql_cell_triples('customer')}),
r AS ({sql_cell_triples('customer', cells=sql_cells('customer', f"(SELECT c_custkey AS row_index, * FROM ({duck(CHANGED)}))"))})
SELECT *, 1 AS surplus FROM (SELECT * FROM l EXCEPT SELECT * FROM r)
UNION ALL SELECT *, -1 FROM (SELECT * FROM r EXCEPT SELECT * FROM l)
""")
def graph_diff(spark, folder):
    changed = derive(spark, folder, CHANGED).withColumn("row_index", F.col("c_custkey"))
    changed = source_table(changed, "customer")
    before = table(spark, folder, "customer", task_rows=MELTED_ROWS)

    def graph(source):
        return E.cell_triples(C.type_cells(C.melt(source), source), source, V.TYPED)

    return G.diff(graph(before), graph(changed))


@query("navigate_references", f"""
SELECT '{BASE}cell/customer/' || c.row_index || '/' || c.column_index AS cell, l.column_iri, l.annotation_iri AS annotation, a.o AS reference
FROM ({sql_cells('customer')}) AS c JOIN {_LINKS} AS l USING (column_index)
JOIN {_ANN} AS a ON a.s = l.annotation_iri AND a.p = '{V.SEE_ALSO}'
""")
def navigate_references(spark, folder):
    conversion = _customer(spark, folder)
    return G.navigate(conversion.cell_triples([ONT + "column"]), conversion.metadata, V.TYPED)


@query("rebuild_table", f"""
SELECT '{BASE}row/orders/' || row_index AS row_iri, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in COLUMNS['orders'])}
FROM ({sql_rows('orders')})
""")
def rebuild_table(spark, folder):
    conversion = convert(table(spark, folder, "orders", task_rows=MELTED_ROWS), V.TYPED, created=CREATED)
    cells = conversion.cell_triples(G.rebuild_predicates(V.TYPED))
    return G.rebuild(cells, conversion.table.names, V.TYPED, conversion.metadata)


@query("dangling_cells", f"""
WITH c AS (SELECT x.*, n.c_nationkey FROM ({sql_cells('customer')}) AS x JOIN customer AS n ON x.row_index = n.c_custkey)
SELECT '{BASE}cell/customer/' || row_index || '/' || column_index AS cell, '{ONT}row' AS link, '{BASE}row/customer/' || row_index AS target
FROM c WHERE c_nationkey = 3
UNION ALL SELECT '{BASE}cell/customer/' || row_index || '/' || column_index, '{ONT}column', '{BASE}column/customer/' || column_index
FROM c WHERE column_index = 1
""")
def dangling_cells(spark, folder):
    """Found where rows of one nation and one column were left out of the graph."""
    conversion = _customer(spark, folder, annotated=False)
    fewer = E.row_triples(conversion.table.where(F.col("c2") != 3), V.TYPED)
    metadata = conversion.metadata.filter(F.col("s") != f"{BASE}column/customer/1")
    return G.dangling(metadata.unionByName(fewer).unionByName(conversion.cell_triples().drop("row_index")), V.TYPED)


@query("class_census", f"""
SELECT '{ONT}Table' AS class, 1 AS instances UNION ALL SELECT '{ONT}Column', 11
UNION ALL SELECT '{ONT}Row', count(*) FROM lineitem
UNION ALL SELECT '{ONT}Cell', {' + '.join(f'count({c})' for c in ['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'l_returnflag', 'l_linestatus', 'l_shipdate'])} FROM lineitem
""")
def class_census(spark, folder):
    """Instances per class in the graph of the largest table."""
    conversion = convert(table(spark, folder, "lineitem"), V.TYPED, created=CREATED)
    return S.class_census(conversion.triples([V.RDF_TYPE]), unique=True)


@query("class_census_distinct", f"SELECT o AS class, count(DISTINCT s) AS instances FROM {_GRAPH} AS g WHERE p = '{V.RDF_TYPE}' GROUP BY o")
def class_census_distinct(spark, folder):
    """The same for a graph that may say things twice."""
    conversion = _customer(spark, folder)
    return S.class_census(conversion.triples().unionByName(conversion.metadata))


@query("reference_census", f"SELECT s, count(*) AS links, count(DISTINCT o) AS targets FROM {_ANN} AS a WHERE p = '{V.SEE_ALSO}' GROUP BY s")
def reference_census(spark, folder):
    return S.reference_census(annotations(spark, folder))


@query("reference_totals", f"SELECT count(*) AS links, count(DISTINCT s) AS subjects, count(DISTINCT o) AS targets FROM {_ANN} AS a WHERE p = '{V.SEE_ALSO}'")
def reference_totals(spark, folder):
    return S.reference_totals(annotations(spark, folder))
