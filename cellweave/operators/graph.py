"""Questions to a graph held as a DataFrame of triples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session
from .. import vocab as V
from ..model import TRIPLE_FIELDS
from ..vocab import Profile
from .hot import skew_join

# What a node's identifier takes at most, where it is broadcast.
NODE_BYTES = 512


def match(triples: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None) -> DataFrame:
    """Triples that agree with the given parts; what is None matches anything."""
    for column, wanted in (("s", s), ("p", p), ("o", o)):
        if wanted is not None:
            triples = triples.filter(F.col(column) == wanted)
    return triples


def instances(triples: DataFrame, class_iri: str) -> DataFrame:
    return match(triples, p=V.RDF_TYPE, o=class_iri).select("s").distinct()


def describe(triples: DataFrame, node: str) -> DataFrame:
    return match(triples, s=node)


def describe_all(triples: DataFrame, nodes: DataFrame, column: str = "node") -> DataFrame:
    """Triples about any of the given nodes; one of them may have most of the triples."""
    wanted = session.settle(nodes.select(F.col(column).alias("s")).distinct())
    return skew_join(triples, wanted, "s", "left_semi", NODE_BYTES).select(*triples.columns)


def union(*graphs: DataFrame) -> DataFrame:
    """Union with set semantics. Meant for metadata; rows and cells cannot repeat and need no such pass."""
    return reduce(DataFrame.unionByName, graphs).distinct()


def quads(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources' triples, each with the name of its source."""
    tagged = [graph.select(F.lit(name).alias("source"), *TRIPLE_FIELDS) for name, graph in sources.items()]
    return reduce(DataFrame.unionByName, tagged)


def diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Triples that one side has more often than the other: ``..., surplus`` (positive: left has more).

    One pass with partial sums instead of two set differences; no rows means that the graphs are equal.
    """
    sides = left.select(*TRIPLE_FIELDS, F.lit(1).alias("_n")).unionByName(
        right.select(*TRIPLE_FIELDS, F.lit(-1).alias("_n"))
    )
    return sides.groupBy(*TRIPLE_FIELDS).agg(F.sum("_n").alias("surplus")).filter(F.col("surplus") != 0)


def navigate(cells: DataFrame, metadata: DataFrame, profile: Profile) -> DataFrame:
    """Follow cell -> column -> annotation -> seeAlso: ``cell, column_iri, annotation, reference``.

    ``metadata`` holds the tables' own and the copied annotation triples. Its part of the path is worked out
    first; cells refer to few columns, so that they are only shuffled if that part is not small.
    """
    links = match(metadata, p=profile.term("hasAnnotation")).select(
        F.col("s").alias("column_iri"), F.col("o").alias("annotation")
    )
    references = match(metadata, p=V.SEE_ALSO).select(F.col("s").alias("annotation"), F.col("o").alias("reference"))
    path = session.settle(links.join(references, "annotation").distinct())
    columns = match(cells, p=profile.term(profile.cell_column)).select(
        F.col("s").alias("cell"), F.col("o").alias("column_iri")
    )
    if profile.cell_column == "column":
        # The same predicate leads from tables to columns.
        columns = columns.filter(F.col("cell").startswith(profile.base + "cell/"))
    joined = columns.join(session.broadcast_if_small(path), "column_iri")
    return joined.select("cell", "column_iri", "annotation", "reference")


def dangling(triples: DataFrame, profile: Profile) -> DataFrame:
    """Cells whose row or column is no node of that class: ``cell, link, target``."""
    wanted = {profile.term(profile.cell_row): profile.term("Row"), profile.term(profile.cell_column): profile.term("Column")}
    is_link = F.col("p").isin(list(wanted)) & F.col("s").startswith(profile.base + "cell/")
    links = triples.filter(is_link).select(F.col("s").alias("cell"), F.col("p").alias("link"), F.col("o").alias("target"))
    # Targets are compared once each: many cells share a column.
    expected = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])
    targets = links.select("link", "target").distinct().withColumn("_class", F.try_element_at(expected, F.col("link")))
    nodes = match(triples, p=V.RDF_TYPE).filter(F.col("o").isin(list(wanted.values())))
    nodes = nodes.select(F.col("s").alias("target"), F.col("o").alias("_class"))
    missing = session.settle(targets.join(nodes, ["target", "_class"], "left_anti").select("link", "target"))
    return links.join(session.broadcast_if_small(missing), ["link", "target"]).select("cell", "link", "target")


def rebuild_predicates(profile: Profile) -> list[str]:
    """Predicates of the cell triples from which :func:`rebuild` works."""
    return [profile.term(t) for t in (profile.cell_row, profile.cell_column, "value")]


def rebuild(
    triples: DataFrame, names: list[str] | tuple[str, ...], profile: Profile, metadata: DataFrame | None = None
) -> DataFrame:
    """The table again: ``row_iri`` and one column per header name, values as text.

    Triples are brought together by cell, then by row; a cell has four or five triples and a row as many
    cells as the table has columns. Column names come from the graph, or from ``metadata`` if that is apart.
    """
    row, column, value = profile.term(profile.cell_row), profile.term(profile.cell_column), profile.term("value")
    about = triples.filter(F.col("p").isin(row, column, value) & F.col("s").startswith(profile.base + "cell/"))

    def part(predicate: str, name: str):
        return F.max(F.when(F.col("p") == predicate, F.col("o"))).alias(name)

    cells = about.groupBy("s").agg(part(row, "row_iri"), part(column, "column_iri"), part(value, "value"))
    headers = match(metadata if metadata is not None else triples, p=profile.term("columnName")).select(
        F.col("s").alias("column_iri"), F.col("o").alias("_name")
    )
    headers = session.settle(headers.filter(F.col("_name").isin(list(names))))
    named = cells.join(session.broadcast_if_small(headers), "column_iri")
    columns = [F.max(F.when(F.col("_name") == n, F.col("value"))).alias(n) for n in names]
    return named.groupBy("row_iri").agg(*columns)
