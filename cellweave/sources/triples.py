"""Triples from text with one triple per line, as the sinks write it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import terms
from ..model import BNODE, IRI, LITERAL
from ..operators.index import number_by_blocks


def _node(token: Column) -> Column:
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    return F.when(token.startswith("<"), inner).otherwise(token)


# A line that says nothing.
_NOTHING = r"^\s*(#.*)?$"
_HEAD = r"^\s*+(<[^>]*+>|_:\S++)\s++(<[^>]*+>)\s++"


def _marked(lines: DataFrame, line: str) -> DataFrame:
    """``lines`` with the parts of a triple and ``_ok``: whether the whole line is one.

    The object is cut at its last quote, so a literal's length does not matter.
    """
    rest = F.regexp_replace(F.expr(f"substring({line}, length(_head) + 1)"), r"\s*+\.\s*+$", "")
    df = lines.withColumn("_head", F.regexp_extract(line, _HEAD, 0)).withColumn("_object", rest)
    term = F.col("_object")
    is_literal = term.startswith('"')
    df = df.withColumn("_close", F.when(is_literal, F.length(term) - F.instr(F.reverse(term), '"') + 1))
    df = df.withColumn("_tail", F.substring(term, F.col("_close") + 1, F.length(term)))
    literal = is_literal & (F.col("_close") > 1) & F.col("_tail").rlike(r"^(\^\^<[^>]*+>|@[A-Za-z0-9-]++)?$")
    node = (term.startswith("<") & term.endswith(">")) | term.rlike(r"^_:\S++$")
    ended = F.col(line).rlike(r"\.\s*+$")
    ok = (F.length("_head") > 0) & ended & (literal | node)
    # Parts come out of a generator: a filter on them stays behind it, and does not work each out again wherever it uses one.
    parts = F.struct("_head", "_object", "_close", "_tail", ok.alias("_ok"))
    return df.select(*lines.columns, F.inline(F.array(parts)))


def parse_lines(lines: DataFrame, line: str = "value", *keep: str, strict: bool = False) -> DataFrame:
    """Triples from lines ``<s> <p> object .``; blank lines and comments are left out, and other text too unless ``strict``,
    which makes it an error."""
    ok = F.col("_ok")
    if strict:
        told = F.concat(F.lit("Not a triple: "), F.substring(F.col(line), 1, 200))
        ok = F.when(ok, True).when(F.col(line).rlike(_NOTHING), False).otherwise(F.raise_error(told).cast("boolean"))
    df = _marked(lines, line).filter(ok)
    for part, group in (("_s", 1), ("_p", 2)):
        df = df.withColumn(part, F.regexp_extract("_head", _HEAD, group))
    term, tail, is_literal = F.col("_object"), F.col("_tail"), F.col("_close").isNotNull()
    body = F.substring(term, F.lit(2), F.col("_close") - 2)
    return df.select(
        *keep,
        _node(F.col("_s")).alias("s"),
        _node(F.col("_p")).alias("p"),
        F.when(is_literal, terms.unescape_literal(body)).otherwise(_node(term)).alias("o"),
        F.when(is_literal, F.lit(LITERAL)).when(term.startswith("<"), F.lit(IRI)).otherwise(F.lit(BNODE)).alias("o_kind"),
        F.when(tail.startswith("^^<"), F.substring(tail, F.lit(4), F.length(tail) - 4)).alias("o_datatype"),
        F.when(tail.startswith("@"), F.substring(tail, F.lit(2), F.length(tail))).alias("o_lang"),
    )


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """Triples of a file or folder with one per line; a folder of chunks gives its ``chunk`` column as well.

    A line that is no triple, blank or comment is an error: see :func:`unreadable_lines`, and
    :func:`cellweave.sources.statements.read_statements` for statements that go over lines.
    """
    lines = spark.read.text(path)
    keep = [c for c in lines.columns if c != "value"]
    return parse_lines(lines, "value", *keep, strict=True)


def numbered_lines(spark: SparkSession, path: str, file: str | None = None, named_by: str = "file_name") -> DataFrame:
    """``file, line, value`` of the text files in the folder ``path``, or of one of them by its name; lines count from 0 in each file."""
    lines = spark.read.text(f"{path}/{file}" if file else path).select(
        "value", F.col(f"_metadata.{named_by}").alias("file"), F.col("_metadata.file_block_start").alias("_block")
    )
    numbered = number_by_blocks(lines, "file", "_block", "file")
    return numbered.select("file", F.col("row_index").alias("line"), "value")


INDEX = "chunk string, file string, first_line long, lines long"
# Lines that are looked up together when all chunks are read.
_BUCKET = 8192


def read_chunk(spark: SparkSession, path: str, chunk: str) -> DataFrame:
    """The triples of one chunk of what ``write_chunk_files`` wrote; only the file in which it lies is read."""
    place = spark.read.schema(INDEX).json(f"{path}/index").filter(F.col("chunk") == chunk).first()
    if place is None:
        raise KeyError(chunk)
    lines = numbered_lines(spark, f"{path}/lines", place["file"])
    last = place["first_line"] + place["lines"] - 1
    return parse_lines(lines.filter(F.col("line").between(place["first_line"], last)), strict=True)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The triples of all chunks, each with its ``chunk``.

    Lines are looked up in the index by bucket: a chunk is entered in each bucket of lines that it reaches into.
    """
    index = spark.read.schema(INDEX).json(f"{path}/index").filter("lines > 0")
    first, last = F.col("first_line"), F.col("first_line") + F.col("lines") - 1
    buckets = F.sequence(F.floor(first / _BUCKET), F.floor(last / _BUCKET))
    index = session.settle(index.select("file", "chunk", first.alias("_first"), last.alias("_last"), F.explode(buckets).alias("_bucket")))
    lines = numbered_lines(spark, f"{path}/lines").withColumn("_bucket", F.floor(F.col("line") / _BUCKET))
    found = lines.join(session.broadcast_if_small(index, 256), ["file", "_bucket"])
    return parse_lines(found.filter(F.col("line").between(F.col("_first"), F.col("_last"))), "value", "chunk", strict=True)


def unreadable_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, text`` of the lines of a file or folder that :func:`read_triples` cannot read; lines count from 1 in each file."""
    bad = _marked(numbered_lines(spark, path, named_by="file_path"), "value").filter(~F.col("_ok") & ~F.col("value").rlike(_NOTHING))
    return bad.select("file", (F.col("line") + 1).alias("line"), F.col("value").alias("text"))
