"""Writing graphs: lines of text, chunks, pages, nodes and manifests. Output places are folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import terms
from ..operators.hot import split_groups
from ..operators.summary import part_number
from ..sources.triples import numbered_lines

# Begins the comment before the lines of a chunk.
CHUNK_MARK = "# "
# Lines of data repeat most of each other; a task's file is read as a whole.
COMPRESSION = "gzip"
# Number of entries of one node that are put into one JSON object.
ENTRIES_PER_NODE = 10_000


def write_lines(triples: DataFrame, path: str, single_file: bool = False) -> None:
    """One ``s p o .`` line per triple. ``single_file`` is for metadata, which a table's width bounds."""
    lines = triples.select(terms.triple_line().alias("value"))
    (lines.coalesce(1) if single_file else lines).write.mode("overwrite").text(path)


def write_chunks(data: DataFrame, path: str, rows_per_chunk: int = V.ROWS_PER_PART) -> None:
    """Triples, or their lines as ``value``, in folders ``chunk=chunk_0000`` and so on by ``row_index``: one file per chunk.

    Meant for tables of few chunks; see :func:`write_chunk_files`. No chunk is empty.
    """
    part = part_number(rows_per_chunk)
    data = data.repartitionByRange(part).sortWithinPartitions("row_index")
    lines = data.select(_line(data), terms.chunk_name(part).alias("chunk"))
    lines.write.mode("overwrite").partitionBy("chunk").text(path)


def _line(data: DataFrame) -> Column:
    return F.col("value") if "value" in data.columns else terms.triple_line().alias("value")


def write_chunk_files(data: DataFrame, path: str, rows_per_chunk: int = V.ROWS_PER_PART) -> None:
    """Triples, or their lines as ``value``, in files by ``row_index``, and an index of the chunks that they hold.

    Each chunk lies in one compressed file of ``path/lines``, behind a comment with its name; there are as many files as tasks, however many chunks.
    ``path/index`` has one row per chunk, read off the files: ``chunk, file, first_line, lines`` (lines from 0, the comment not counted).
    """
    part = part_number(rows_per_chunk)
    lines = data.select(part.alias("_part"), "row_index", F.lit(1).alias("_order"), _line(data))
    name = F.concat(F.lit(CHUNK_MARK), terms.chunk_name("_part"))
    marks = lines.select("_part").distinct().select(
        "_part", F.lit(0).cast("long").alias("row_index"), F.lit(0).alias("_order"), name.alias("value")
    )
    placed = lines.unionByName(marks).repartitionByRange("_part").sortWithinPartitions("_part", "_order", "row_index")
    placed.select("value").write.mode("overwrite").option("compression", COMPRESSION).text(f"{path}/lines")
    index = _index(numbered_lines(data.sparkSession, f"{path}/lines"))
    index.write.mode("overwrite").json(f"{path}/index")


def _index(lines: DataFrame) -> DataFrame:
    """Where the chunks are, from the comments in numbered lines."""
    sizes = lines.groupBy("file").agg(F.count("*").alias("_size"))
    marks = lines.filter(F.col("value").startswith(CHUNK_MARK))
    marks = marks.select("file", F.substring("value", len(CHUNK_MARK) + 1, 2**31 - 1).alias("chunk"), (F.col("line") + 1).alias("first_line"))
    # one row per chunk goes through this window, the chunks of a file together
    after = F.lead("first_line").over(Window.partitionBy("file").orderBy("first_line")) - 1
    ends = F.coalesce(after, F.col("_size"))
    return marks.join(sizes, "file").select("chunk", "file", "first_line", (ends - F.col("first_line")).alias("lines"))


def write_pages(pages: DataFrame, path: str) -> None:
    """Page documents as JSON, one per folder ``page_name=page_0`` and so on."""
    keys = [c for c in pages.columns if c == "table_name"]
    named = pages.withColumn("page_name", terms.page_name("page"))
    named.write.mode("overwrite").partitionBy(*keys, "page_name").json(path)


def nodes(triples: DataFrame, limit: int = ENTRIES_PER_NODE) -> DataFrame:
    """``s, part, node``: a JSON object per subject with its properties.

    A subject of more than ``limit`` triples is told in several objects with the same ``@id``, which mean
    the same as one.
    """
    value = F.struct(
        F.when(F.col("o_kind") != "literal", F.col("o")).alias("@id"),
        F.when(F.col("o_kind") == "literal", F.col("o")).alias("@value"),
        F.col("o_datatype").alias("@type"),
        F.col("o_lang").alias("@language"),
    )
    parted = split_groups(triples, "s", ["p", "o", "o_kind", "o_datatype", "o_lang"], limit)
    # values by property, then properties by subject, where the rows have been brought together once
    # a count of partitions that is told is not lowered at run time: objects take far more memory than the rows they are made of
    tasks = int(triples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_value = parted.repartition(tasks, "s", "part").groupBy("s", "part", "p").agg(F.array_sort(F.collect_list(value)).alias("value"))
    entry = F.struct(F.col("p").alias("key"), "value")
    grouped = by_value.groupBy("s", "part").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("_properties"))
    by_property = F.col("_properties")
    inner = F.to_json(by_property)
    node = F.concat(F.lit('{"@id":'), F.to_json(F.array("s")).substr(F.lit(2), F.length(F.to_json(F.array("s"))) - 2))
    return grouped.select("s", "part", F.concat(node, F.lit(","), F.substring(inner, 2, 2**31 - 1)).alias("node"))


def write_nodes(triples: DataFrame, path: str, limit: int = ENTRIES_PER_NODE) -> None:
    nodes(triples, limit).select(F.col("node").alias("value")).write.mode("overwrite").text(path)


def write_document(document: DataFrame, path: str) -> None:
    """A one-row DataFrame as one JSON document."""
    text = document.select(F.to_json(F.struct(*document.columns)).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(path)
