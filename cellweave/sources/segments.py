"""Records that may go over several lines, found in every split of a text file.

Where records start depends on all of a file before: a line end inside quotes ends nothing. So each split is read from every
state that may hold at its start at once, which gives for each of them the state at its end and the number of records that start in
it. These functions from states to states are composed along each file (one row per split), after which every split knows its
state and the number of its first record; then all splits are read side by side. Only records that reach over the border of a split are
put together by a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import session

# Lines that a task holds as Python texts at a time.
SLICE_LINES = 2048
# Bytes up to which small splits are read by one task, and the tasks for each core that there are before.
TASK_BYTES = 32 << 20
TASKS_PER_CORE = 4


@dataclass(frozen=True)
class Grammar:
    """How lines make records. State 0 is between records; ``states`` are numbered from it.

    ``after(line, state)`` is the state behind a line. ``plain(lines)`` tells, for many lines, which ones keep every state as it is (in state
    0 they are records of their own), and ``blank(lines)`` which ones are nothing in state 0.
    """

    states: int
    after: Callable[[str, int], int]
    plain: Callable[[pa.Array], pa.Array]
    blank: Callable[[pa.Array], pa.Array]


def _slices(batches: Iterator[pa.RecordBatch], marks: tuple[str, ...], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Parts of batches in which ``marks`` do not change, with the values of ``keys`` there."""
    for batch in batches:
        changed = np.zeros(batch.num_rows, bool)
        for name in marks:
            column = batch.column(name)
            changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        edges = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            for i in range(a, b, SLICE_LINES):
                yield tuple(batch[k][a].as_py() for k in keys), batch.slice(i, min(SLICE_LINES, b - i))


class _Counted:
    """A split read from all states at once; ``head`` holds lines of a file's first record while that is open."""

    def __init__(self, grammar: Grammar, first: bool):
        self.grammar = grammar
        self.states, self.starts, self.lines = [*range(grammar.states)], [0] * grammar.states, 0
        self.head: list[str] | None = [] if first else None
        self.first: str | None = None

    def read(self, lines: pa.Array) -> None:
        grammar = self.grammar
        self.lines += len(lines)
        full = ~np.asarray(grammar.blank(lines).to_numpy(zero_copy_only=False), bool)
        before = np.concatenate([[0], np.cumsum(full)]).tolist()
        if self.head is not None:
            self._find_first(lines.to_pylist(), full)
        at = 0
        for q in np.flatnonzero(~np.asarray(grammar.plain(lines).to_numpy(zero_copy_only=False), bool)).tolist():
            line, known = lines[q].as_py(), {}
            for i, state in enumerate(self.states):
                if state == 0:
                    # the line itself starts a record, unless it is blank
                    self.starts[i] += before[q + 1] - before[at]
                if state or full[q]:
                    if state not in known:
                        known[state] = grammar.after(line, state)
                    self.states[i] = known[state]
            at = q + 1
        for i, state in enumerate(self.states):
            if state == 0:
                self.starts[i] += before[-1] - before[at]

    def _find_first(self, lines: list[str], full: np.ndarray) -> None:
        state = self.state_of_head if self.head else 0
        for line, some in zip(lines, full, strict=True):
            if not self.head and not some:
                continue
            state = self.state_of_head = self.grammar.after(line, state)
            self.head.append(line)
            if state == 0:
                self.first, self.head = "\n".join(self.head), None
                return

    state_of_head = 0


_COUNTED = pa.schema([
    ("_file", pa.string()), ("_block", pa.int64()), ("ends", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())), ("lines", pa.int64()),
    ("head", pa.string()),
])


def _count(lines: DataFrame, grammar: Grammar) -> DataFrame:
    """One row per split: its end's state and the records that start in it, by the state at its start; ``head``: a file's first record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            row = (*key, now.states, now.starts, now.lines, now.first)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _COUNTED, strict=True)], schema=_COUNTED)

        key, now = None, None
        for found, part in _slices(batches, ("_file", "_block"), ("_file", "_block")):
            if found != key:
                if now is not None:
                    yield told()
                key, now = found, _Counted(grammar, found[1] == 0)
            now.read(part["value"])
        if now is not None:
            yield told()

    return lines.mapInArrow(run, "_file string, _block long, ends array<int>, starts array<long>, lines long, head string")


_SPLITS = "_file string, _block long, state int, out int, rows long, first long, line long, head string"


def _composed(splits: DataFrame) -> DataFrame:
    """``_file, _block, state, out, rows, first, line, head``: splits with the states at their start and end, the records that start in
    them, and how many records and lines the file has before. A file has one row per split, which are put together in order."""

    def fold(part: pd.DataFrame) -> pd.DataFrame:
        state, first, line, out = 0, 0, 0, []
        for x in part.sort_values("_block").itertuples(index=False):
            row = dict(zip(part.columns, x, strict=True))
            end, rows = int(row["ends"][state]), int(row["starts"][state])
            out.append((row["_file"], row["_block"], state, end, rows, first, line, row["head"]))
            state, first, line = end, first + rows, line + int(row["lines"])
        return pd.DataFrame(out, columns=[x.split()[0] for x in _SPLITS.split(", ")])

    return splits.groupBy("_file").applyInPandas(fold, _SPLITS)


@dataclass(frozen=True)
class Segments:
    """Records of text files.

    ``files``: ``file_no`` (in path order), ``file``, ``head`` (text of the first record), ``records``. ``rows``: what ``convert`` made.
    """

    files: DataFrame
    rows: DataFrame


class Unclosed(ValueError):
    """A file ends inside a record."""


def _lines(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    # all readings have to split the files in one way
    reader = session.pinned(spark).read
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob) if glob else reader
    lines = reader.text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def _dealt(lines: DataFrame) -> DataFrame:
    """``lines`` with neighbouring small splits in one task, so that their number costs little; they stay splits of their own."""
    spark = lines.sparkSession
    size = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower())
    largest = int(size[1]) << 10 * " kmgtp".index(size[2] or " ")
    splits = lines.rdd.getNumPartitions()
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-splits * largest // TASK_BYTES))
    return lines.coalesce(tasks) if tasks < splits else lines


def read_segments(
    spark: SparkSession, path: str, grammar: Grammar, convert: Callable[[int, list[tuple[int, int, str]]], pa.RecordBatch], schema: str,
    glob: str | None = None, most: int | None = None, closed: bool = True,
) -> Segments | None:
    """Records of the file or folder at ``path``, or of files below it whose names fit ``glob``; None if there are none.

    ``convert(file_no, records)`` makes rows of ``schema`` from (record number, line number, text). Records and lines are
    numbered from 0 in each file; lines end with LF, CR LF or CR, which become LF inside records. With ``most``, files are looked at in
    path order only until they hold so many records beside their first ones, and others are not read. ``closed``: a file that ends inside
    a record is an error.
    """
    session.ship_package(spark)
    everything = _lines(spark, path, glob)
    # local paths are spelled in two ways
    names = sorted(re.sub("^file:/+", "file:/", x) for x in everything.inputFiles())
    look = 1 if most and len(names) > 1 else len(names)
    while True:
        lines = _dealt(everything.filter(F.col("_file") <= names[look - 1]) if look < len(names) else everything)
        splits = session.settle(_composed(_count(lines, grammar)))
        counted = splits.agg(F.sum("rows") - F.countDistinct("_file")).first()[0] or 0
        if look >= len(names) or counted >= most:
            break
        look *= 4
    ends = splits.groupBy("_file").agg(F.max_by("out", "_block").alias("out"), F.max("head").alias("head"), F.sum("rows").alias("records"))
    torn = ends.filter("out <> 0").agg(F.min("_file")).first()[0] if closed else None
    if torn is not None:
        raise Unclosed(f"The last record of {torn} is not closed")
    # one row per file goes through this window
    files = session.settle(ends.filter("records > 0").select(
        (F.row_number().over(Window.orderBy("_file")) - 1).alias("file_no"), F.col("_file").alias("file"), "head", "records",
    ))
    if not files.limit(1).count():
        return None
    places = splits.join(session.broadcast_if_small(files.select(F.col("file").alias("_file"), "file_no"), 512), "_file")
    places = session.settle(places.select(F.xxhash64("_file", "_block").alias("_key"), "file_no", "state", "out", "rows", "first", "line"))
    if places.groupBy("_key").count().filter("count > 1").limit(1).count():
        raise ValueError("Two splits have one hash")
    keyed = lines.select("value", "_block", F.xxhash64("_file", "_block").alias("_key"))
    rows = _whole(_placed(keyed, places), grammar, convert, schema)
    over = places.filter("state <> 0 OR out <> 0")
    if over.limit(1).count():
        rows = rows.unionByName(_over_borders(_placed(keyed, over), grammar, convert, schema))
    return Segments(files, rows)


def _placed(keyed: DataFrame, places: DataFrame) -> DataFrame:
    """Lines of the splits in ``places``, with what is known of their split; lines stay where they are, in order."""
    return session.look_up(keyed, places, "_key").filter("file_no IS NOT NULL")


_PLACE = ("_key", "_block", "file_no", "state", "rows", "first", "line")


class _Assembled:
    """The records of a split, given its state and the numbers of its first record and line.

    ``lead`` are lines of a record that started before the split; ``open`` those of one that may go on after it.
    """

    def __init__(self, grammar: Grammar, state: int, first: int, line: int):
        self.grammar, self.state, self.first, self.next, self.line = grammar, state, first, first, line
        self.lead: list[str] = []
        self.leads, self.open, self.opened = state != 0, [], 0
        self.whole: list[tuple[int, int, str]] = []

    def read(self, lines: pa.Array) -> None:
        plain, blank = (f(lines).to_pylist() for f in (self.grammar.plain, self.grammar.blank))
        for at, (line, same, nothing) in enumerate(zip(lines.to_pylist(), plain, blank, strict=True), self.line):
            before = self.state
            if before == 0 and nothing:
                continue
            if not same:
                self.state = self.grammar.after(line, before)
            if self.leads:
                self.lead.append(line)
                self.leads = self.state != 0
                continue
            if before == 0:
                self.next, self.opened = self.next + 1, at
            if before == self.state == 0:
                self.whole.append((self.next - 1, at, line))
                continue
            self.open.append(line)
            if self.state == 0:
                self.whole.append((self.next - 1, self.opened, "\n".join(self.open)))
                self.open = []
        self.line += len(lines)

    def take(self) -> list[tuple[int, int, str]]:
        """Whole records since the last call: number, line and text."""
        out, self.whole = self.whole, []
        return out

    def ends(self) -> list[tuple[int, int, str]]:
        """Parts of records that reach over the split's borders; the line is -1 where a record goes on."""
        lead = [(self.first - 1, -1, "\n".join(self.lead))] if self.lead else []
        return lead + ([(self.next - 1, self.opened, "\n".join(self.open))] if self.open else [])


def _streamed(batches: Iterator[pa.RecordBatch], grammar: Grammar) -> Iterator[tuple[dict, _Assembled, bool]]:
    """Splits as they are read: place, state of reading, and whether the split has ended."""
    key, now = None, None
    for found, part in _slices(batches, ("_key",), _PLACE):
        if key is None or found[0] != key["_key"]:
            if now is not None:
                yield key, now, True
            key = dict(zip(_PLACE, found, strict=True))
            now = _Assembled(grammar, key["state"], key["first"], key["line"])
        now.read(part["value"])
        yield key, now, False
    if now is not None:
        yield key, now, True


def _whole(lines: DataFrame, grammar: Grammar, convert: Callable, schema: str) -> DataFrame:
    """The records that lie in one split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, now, ended in _streamed(batches, grammar):
            if found := now.take():
                yield convert(place["file_no"], found)
            if ended and now.next != place["first"] + place["rows"]:
                raise ValueError("The files changed while they were read")

    return lines.select("value", *_PLACE).mapInArrow(run, schema)


_PARTS = pa.schema([("file_no", pa.int32()), ("record", pa.int64()), ("line", pa.int64()), ("at", pa.int64()), ("text", pa.string())])


def _over_borders(lines: DataFrame, grammar: Grammar, convert: Callable, schema: str) -> DataFrame:
    """The records that reach over borders; ``lines`` are those of splits at such borders."""

    def torn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, now, ended in _streamed(batches, grammar):
            now.take()
            if found := now.ends() if ended else []:
                rows = [(place["file_no"], n, line, place["_block"], text) for n, line, text in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARTS, strict=True)], schema=_PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, *record in zip(*(batch[c].to_pylist() for c in ("file_no", "record", "line", "text")), strict=True):
                yield convert(file, [tuple(record)])

    # a record's first part is told before its others: it has a line, and lies in the earliest split or opens after another's lead
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"])
    found = lines.select("value", *_PLACE).mapInArrow(torn, "file_no int, record long, line long, at long, text string")
    joined = found.groupBy("file_no", "record").agg(F.max("line").alias("line"), F.array_join(pieces, "\n").alias("text"))
    return joined.mapInArrow(run, schema)
