"""Records of delimited text. Quotes count where Python's ``csv`` module takes them for quotes: at the start of a field."""

from __future__ import annotations

import csv
import re
import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .segments import Grammar, Segments, read_segments

OUTSIDE, INSIDE = 0, 1

# Whole fields up to the last comma, then a quoted one that the line does not close.
_OPENS = re.compile(r'(?:(?:"(?:[^"]|"")*+"[^,]*+|(?!")[^,]*+),)*+"(?:[^"]|"")*+\Z')
# The rest of a quoted field, its closing quote, and the comma after it.
_CLOSES = re.compile(r'(?:[^"]|"")*+("?)[^,]*+(,?)')


def after(line: str, state: int) -> int:
    """State at the end of a line that begins in ``state``."""
    if state == INSIDE:
        found = _CLOSES.match(line)
        if not found[1]:
            return INSIDE
        if not found[2]:
            return OUTSIDE
        line = line[found.end() :]
    return INSIDE if _OPENS.match(line) else OUTSIDE


def _without_quotes(lines: pa.Array) -> pa.Array:
    return pc.invert(pc.match_substring(lines, '"'))


def _empty(lines: pa.Array) -> pa.Array:
    return pc.equal(pc.binary_length(lines), 0)


DELIMITED = Grammar(2, after, _without_quotes, _empty)


def parse(texts: list[str]) -> list[list[str]]:
    """The values of each record."""
    csv.field_size_limit(sys.maxsize)
    return [*csv.reader(texts)]


_ROWS = pa.schema([("file_no", pa.int32()), ("record", pa.int64()), ("values", pa.list_(pa.string()))])


def _values(file: int, records: list[tuple[int, int, str]]) -> pa.RecordBatch:
    numbers, _, texts = zip(*records, strict=True)
    columns = [[file] * len(numbers), [n - 1 for n in numbers], parse([*texts])]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS, strict=True)], schema=_ROWS)


def read_records(spark: SparkSession, path: str, glob: str | None = None, max_rows: int | None = None) -> Segments | None:
    """Records of delimited files: ``rows`` are ``file_no, record, values`` numbered from 0 after the header of their file.

    ``files`` have ``header`` (its values), ``records`` (the header not counted) and ``before`` (records of earlier files) as well. Texts
    are UTF-8, a byte order mark is left out, empty lines are no records. A file that ends inside quotes is an error.
    """
    found = read_segments(spark, path, DELIMITED, _values, "file_no int, record long, values array<string>", glob, max_rows)
    if found is None:
        return None
    if found.files.filter("head IS NULL").limit(1).count():
        raise ValueError("A header is longer than a split of its file")
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    records = F.col("records") - 1
    files = _with_headers(found.files).select(
        "file_no", "file", "header", records.alias("records"), F.coalesce(F.sum(records).over(earlier), F.lit(0)).alias("before")
    )
    return Segments(files, found.rows.filter("record >= 0"))


def _with_headers(files: DataFrame) -> DataFrame:
    """One row per file goes through Python here."""

    def run(batches):
        for batch in batches:
            headers = [parse([x.removeprefix("\ufeff")])[0] for x in batch["head"].to_pylist()]
            yield batch.append_column("header", pa.array(headers, pa.list_(pa.string())))

    return files.mapInArrow(run, "file_no int, file string, head string, records long, header array<string>")


def entry_stem(path: Column) -> Column:
    """Name of the ``.csv`` file, or of the ``.csv`` folder it is a part of. Paths are URL-encoded."""
    stem = F.regexp_extract(path, r"/([^/]+)\.[cC][sS][vV](?:/[^/]*)?$", 1)
    return F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B")))


def stem(path: str) -> str:
    file = path.rstrip("/").rsplit("/", 1)[-1]
    return file.rsplit(".", 1)[0] if "." in file.lstrip(".") else file
