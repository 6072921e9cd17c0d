"""Schemas of the DataFrames that operators exchange."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import terms

_S = T.StringType()

TRIPLE_FIELDS = ("s", "p", "o", "o_kind", "o_datatype", "o_lang")
TRIPLES = T.StructType([T.StructField(name, _S) for name in TRIPLE_FIELDS])

MAPPING = T.StructType([T.StructField("property", _S), T.StructField("relation", _S)])
REFERENCE = T.StructType([T.StructField("url", _S), T.StructField("wikidata", _S)])

# One annotated column, nested. Single comments and references are lists of one, plain references have a url.
RECORD = T.StructType([
    T.StructField("label", _S),
    T.StructField("description", _S),
    T.StructField("data_type", _S),
    T.StructField("mappings", T.ArrayType(MAPPING)),
    T.StructField("references", T.ArrayType(REFERENCE)),
    T.StructField("comments", T.ArrayType(_S)),
    T.StructField("extras", T.MapType(_S, T.ArrayType(_S))),
])

# A catalogue document. A column's fields are kept as text first: they may be single values or lists, and
# there may be any others.
CATALOGUE_DOCUMENT = T.StructType([
    T.StructField("prefixes", T.MapType(_S, _S)),
    T.StructField("columns", T.MapType(_S, T.MapType(_S, _S))),
    T.StructField("dataset_metadata", T.MapType(_S, _S)),
    T.StructField("file_metadata", T.MapType(_S, _S)),
])

_LINES = T.StructType([T.StructField("value", _S)])

IRI, LITERAL, BNODE = "iri", "literal", "bnode"


def _text(value) -> Column:
    if value is None:
        return F.lit(None).cast("string")
    return value if isinstance(value, Column) else F.lit(value)


@dataclass(frozen=True)
class Statement:
    """A triple to emit per row of some DataFrame. Parts are columns or fixed texts; the kind is known."""

    s: Column | str
    p: Column | str
    o: Column | str
    kind: Column | str = LITERAL
    datatype: Column | str | None = None
    lang: Column | str | None = None

    def struct(self) -> Column:
        parts = (self.s, self.p, self.o, self.kind, self.datatype, self.lang)
        return F.struct(*[_text(part).alias(name) for part, name in zip(parts, TRIPLE_FIELDS)])

    def line(self) -> Column:
        """The statement about an IRI as one line of text."""
        o = _text(self.o)
        if self.kind == IRI:
            end = [o, F.lit("> .")]
        else:
            typed = F.concat(F.lit('"^^<'), _text(self.datatype), F.lit("> .")) if self.datatype is not None else None
            end = [terms.escape_literal(o), F.coalesce(typed, F.lit('" .')) if typed is not None else F.lit('" .')]
        opening = "> <" if self.kind == IRI else '> "'
        if isinstance(self.p, str):
            middle = [F.lit(f"> <{self.p}{opening}")]
        else:
            middle = [F.lit("> <"), self.p, F.lit(opening)]
        return F.concat(F.lit("<"), _text(self.s), *middle, *end)


def triple(s, p, o, kind=LITERAL, datatype=None, lang=None) -> Column:
    """A triple as a struct column."""
    return Statement(s, p, o, kind, datatype, lang).struct()


def select_statements(statements: list[Statement], predicates: Collection[str] | None) -> list[Statement]:
    return [t for t in statements if predicates is None or t.p in predicates]


def lay_out(df: DataFrame, statements: list[Statement], *keep: str, lines: bool = False) -> DataFrame:
    """One output row per row and statement (narrow): the triple's columns, or its line as ``value``."""
    if not statements:
        schema = T.StructType([df.schema[k] for k in keep] + (_LINES if lines else TRIPLES).fields)
        return df.sparkSession.createDataFrame([], schema)
    if lines:
        return df.select(*keep, F.explode(F.array(*[t.line() for t in statements])).alias("value"))
    return df.select(*keep, F.inline(F.array(*[t.struct() for t in statements])))


def empty_triples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TRIPLES)
