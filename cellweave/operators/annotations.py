"""Linking columns to the catalogue of annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session
from .. import vocab as V
from ..model import BNODE, IRI, TRIPLE_FIELDS, Statement, lay_out
from ..vocab import Profile
from .hot import skew_join

# What a name and its annotation take at most, where they are broadcast.
NAME_BYTES = 1024


def annotation_lookup(
    triples: DataFrame, names: list[str] | tuple[str, ...] | None = None, base: str = V.CATALOGUE_BASE
) -> DataFrame:
    """``column_name, annotation_iri`` from the catalogue's triples, one annotation per name.

    Where several annotations claim a name, the greatest IRI wins (triples have no order of their own).
    ``names`` narrows the catalogue to the headers of one table while it is read.
    """
    named = triples.filter(F.col("p") == base + "columnName")
    if names is not None:
        named = named.filter(F.col("o").isin(list(names)))
    return named.groupBy(F.col("o").alias("column_name")).agg(F.max("s").alias("annotation_iri"))


def link_columns(columns: DataFrame, lookup: DataFrame, bounded: bool = False) -> DataFrame:
    """Every column with its annotation, if any; names match exactly, case included. Most columns may share a name.

    ``bounded`` says that the lookup was narrowed to the headers of a table, which bounds it by the schema.
    """
    if bounded:
        return columns.join(F.broadcast(lookup), "column_name", "left")
    return skew_join(columns, session.settle(lookup), "column_name", "left", NAME_BYTES)


def unannotated(linked: DataFrame) -> DataFrame:
    return linked.filter(F.col("annotation_iri").isNull()).drop("annotation_iri")


def link_triples(linked: DataFrame, profile: Profile) -> DataFrame:
    found = linked.filter(F.col("annotation_iri").isNotNull())
    return lay_out(
        found, [Statement(F.col("column_iri"), profile.term("hasAnnotation"), F.col("annotation_iri"), IRI)]
    )


def copy_used(triples: DataFrame, linked: DataFrame, follow_bnodes: bool = False) -> DataFrame:
    """Triples about the annotations that some column is linked to, each once.

    Only triples with the annotation itself as subject; ``follow_bnodes`` adds those of the anonymous nodes
    they point to.
    """
    used = linked.filter(F.col("annotation_iri").isNotNull()).select(F.col("annotation_iri").alias("s")).distinct()
    copied = triples.join(used, "s", "left_semi").select(*TRIPLE_FIELDS).distinct()
    return _with_bnodes(triples, copied) if follow_bnodes else copied


def copy_named(triples: DataFrame, annotations: list[str], follow_bnodes: bool = False) -> DataFrame:
    """:func:`copy_used` for a short list of annotations; a filter that the catalogue's scan can apply."""
    copied = triples.filter(F.col("s").isin(annotations)).select(*TRIPLE_FIELDS).distinct()
    return _with_bnodes(triples, copied) if follow_bnodes else copied


def _with_bnodes(triples: DataFrame, copied: DataFrame) -> DataFrame:
    nodes = copied.filter(F.col("o_kind") == BNODE).select(F.col("o").alias("s")).distinct()
    return copied.unionByName(triples.join(nodes, "s", "left_semi").select(*TRIPLE_FIELDS).distinct())


def declared_types(triples: DataFrame, lookup: DataFrame, base: str = V.CATALOGUE_BASE) -> DataFrame:
    """``column_name, annotation_iri, datatype`` as the catalogue declares them."""
    types = triples.filter(F.col("p") == base + "dataType").groupBy(F.col("s").alias("annotation_iri"))
    return lookup.join(types.agg(F.max("o").alias("datatype")), "annotation_iri")
