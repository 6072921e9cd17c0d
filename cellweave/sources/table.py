"""The table an operator works on: positional columns, their header names, and how rows are numbered."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import terms

ROW_INDEX = "row_index"
TABLE_NAME = "table_name"

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
_NEVER_NUMBERS = (T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)


@dataclass(frozen=True)
class SourceTable:
    """``frame`` has ``row_index`` and one column ``c<i>`` per position; ``names[i]`` is the header there.

    Header names may repeat. ``name`` is the table's name in identifiers; with ``name=None`` the frame
    holds many tables and carries a ``table_name`` column, rows being numbered per table; ``file_name`` is then the
    ending of their files' names. Tables with headers of their own have them in ``headers`` (table_name, column_index, column_name),
    and ``names`` only numbers the positions. ``locate`` gives the frame of one row by its index where that saves reading other files.
    """

    frame: DataFrame
    names: tuple[str, ...]
    name: str | None
    file_name: str | None = None
    kinds: tuple[str, ...] = field(default=())
    headers: DataFrame | None = None
    locate: Callable[[int], DataFrame] | None = None

    @property
    def keys(self) -> list[str]:
        return [ROW_INDEX] if self.name is not None else [TABLE_NAME, ROW_INDEX]

    def table_key(self) -> Column:
        return F.lit(self.name) if self.name is not None else F.col(TABLE_NAME)

    def positions(self, kind: str) -> list[int]:
        return [i for i, k in enumerate(self.kinds) if k == kind]

    def text(self, position: int) -> Column:
        return F.col(f"c{position}").cast("string")

    def present(self, position: int) -> Column:
        """Whether a row has a cell at this position; only texts can be blank without being null."""
        cell = F.col(f"c{position}")
        return terms.is_present(cell) if self.kinds[position] == "text" else cell.isNotNull()

    def where(self, condition: Column) -> "SourceTable":
        return replace(self, frame=self.frame.filter(condition))

    def at(self, row: int) -> "SourceTable":
        """The table with one of its rows."""
        frame = self.frame if self.locate is None else self.locate(row)
        return replace(self, frame=frame.filter(F.col(ROW_INDEX) == row))

    def pick(self, positions: Iterable[int]) -> list[int]:
        return sorted(set(positions)) if positions is not None else list(range(len(self.names)))


def _kind(data_type: T.DataType) -> str:
    if isinstance(data_type, _INTEGERS):
        return "integer"
    if isinstance(data_type, _FLOATS):
        return "float"
    if isinstance(data_type, _NEVER_NUMBERS):
        return "other"
    return "text"


def source_table(
    df: DataFrame,
    name: str | None,
    row_index: str = ROW_INDEX,
    columns: list[str] | None = None,
    names: list[str] | None = None,
    file_name: str | None = None,
) -> SourceTable:
    """Wrap any DataFrame that already has its row index (and ``table_name`` if ``name`` is None).

    Columns keep their Spark types, so that types known from the schema need no inference per cell; arrays,
    maps and structs are written as their Spark text.
    """
    keep = {row_index} | ({TABLE_NAME} if name is None else set())
    columns = columns if columns is not None else [c for c in df.columns if c not in keep]
    cells = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    keys = [F.col(row_index).cast("long").alias(ROW_INDEX)] + ([F.col(TABLE_NAME)] if name is None else [])
    frame = df.select(*keys, *cells)
    return SourceTable(
        frame=frame,
        names=tuple(names if names is not None else columns),
        name=name,
        file_name=file_name,
        kinds=tuple(_kind(frame.schema[f"c{i}"].dataType) for i in range(len(columns))),
    )
