"""Melt: a wide table becomes one record per non-blank cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import session
from ..functions import numbers, terms
from ..sources.table import TABLE_NAME, SourceTable

# What a column of a header dictionary takes at most, names of tables and columns included.
HEADER_BYTES = 512


def melt(table: SourceTable, columns: list[int] | None = None, keep_blank: bool = False) -> DataFrame:
    """``row_index, column_index, column_name, value`` for every (row, column) that holds something.

    A narrow unpivot, so rows stay where they are. ``columns`` restricts positions before melting, which
    lets the scan leave out the others; a filter on the melted column could not do that.
    """
    chosen = table.pick(columns)
    wide = table.frame.select(*table.keys, *[table.text(i).alias(str(i)) for i in chosen])
    cells = wide.unpivot(table.keys, [str(i) for i in chosen], "_position", "value")
    position = F.col("_position").cast("int")
    if table.headers is None:
        header = F.array(*[F.lit(n) for n in table.names])
        cells = cells.select(
            *table.keys, position.alias("column_index"), F.get(header, position).alias("column_name"), "value"
        )
        return cells if keep_blank else drop_blank(cells, table)
    cells = cells.select(*table.keys, position.alias("column_index"), "value")
    cells = cells if keep_blank else drop_blank(cells, table)
    # positions that a table's own header lacks hold nothing of it
    named = cells.join(session.broadcast_if_small(table.headers, HEADER_BYTES), [TABLE_NAME, "column_index"])
    return named.select(*table.keys, "column_index", "column_name", "value")


def drop_blank(cells: DataFrame, table: SourceTable | None = None) -> DataFrame:
    """Leave out null, empty and white-space-only values; only text columns need the search."""
    present = terms.is_present("value")
    if table is not None:
        texts = table.positions("text")
        if len(texts) < len(table.names):
            is_text = F.col("column_index").isin(texts) if texts else F.lit(False)
            present = F.col("value").isNotNull() & (~is_text | terms.is_present("value"))
    return cells.filter(present)


def _known_type(table: SourceTable) -> Column:
    """Literal type by position where the schema already tells it, by inference for texts."""
    inferred = numbers.infer_datatype("value")
    index = F.col("column_index")
    branches = [
        (table.positions("integer"), F.lit(numbers.INTEGER_TYPE)),
        (table.positions("float"), F.lit(numbers.DECIMAL_TYPE)),
        (table.positions("other"), F.lit(None).cast("string")),
    ]
    known = None
    for positions, datatype in branches:
        if positions:
            test = index.isin(positions)
            known = F.when(test, datatype) if known is None else known.when(test, datatype)
    return inferred if known is None else known.otherwise(inferred)


def type_cells(cells: DataFrame, table: SourceTable, declared: dict[str, str] | None = None) -> DataFrame:
    """Add ``datatype`` and ``lexical``: integer, then decimal, then string.

    ``declared`` maps header names to datatype codes; given it, cells of columns declared as string keep
    their text (so that leading zeros survive). By default declarations are recorded but not applied.
    """
    datatype = _known_type(table)
    if declared:
        named = [n for n, code in declared.items() if code == "string"]
        as_text = [i for i, n in enumerate(table.names) if n in named]
        if table.headers is not None and named:
            datatype = F.when(~F.col("column_name").isin(named), datatype)
        elif as_text:
            datatype = F.when(~F.col("column_index").isin(as_text), datatype)
    typed = cells.withColumn("datatype", datatype)
    return typed.withColumn("lexical", numbers.lexical_form("value", "datatype"))


def plain_cells(cells: DataFrame) -> DataFrame:
    """Every cell a plain string, as it is."""
    return cells.withColumns({"datatype": F.lit(None).cast("string"), "lexical": F.col("value")})
