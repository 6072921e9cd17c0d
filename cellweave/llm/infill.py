"""Fill-in-middle: documents cut in three, reordered by sorting pieces, and put back by sorting them again.

A text is units, each a run of Latin letters or one other character. It is emitted as pieces of at most PIECE_UNITS units, keyed by
document and by position in the output; a control string is a piece of its own. ``repartition`` by document and
``sortWithinPartitions`` by position (a secondary sort, with the shuffle's own spilling) then stream the output past each task, which
holds one piece at a time whatever a document's length. Restoration reads that stream, tells from form and control strings which
section each piece belongs to, and sorts the pieces again inside their partition, without another shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm import tables

# Units of a piece at most, and bytes of one; a longer run of letters is cut again.
PIECE_UNITS = 2048
PIECE_BYTES = 1 << 18
# Bytes of a text that are looked at together when units are counted.
BLOCK = 1 << 20
# Of a hundred documents so many are reordered, and of a hundred reordered ones so many have the suffix first.
REORDERED = 90
SUFFIX_FIRST = 20
SALT = "1:"

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SECTION = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Control strings and sections (from 0) in the order of each form.
ORDER = {PSM: ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), SPM: ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STARTS = (np.arange(256) & 0xC0) != 0x80

PIECES = "uid long, doc_id long, form string, n long, at long, text binary"
_OUT = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("form", pa.string()), ("n", pa.int64()), ("at", pa.int64()), ("text", pa.binary())])


def unit_starts(data: np.ndarray, after_letter: bool = False) -> np.ndarray:
    """Places in UTF-8 bytes where a unit starts; ``after_letter``: the byte before is a letter."""
    letter = _LETTER[data]
    before = np.empty_like(letter)
    before[:1], before[1:] = after_letter, letter[:-1]
    return np.flatnonzero(_STARTS[data] & ~(letter & before))


class Units:
    """Where the units of a text start, found block by block: a block's number of units is kept, its places are not."""

    def __init__(self, text: bytes):
        self.data = np.frombuffer(text, np.uint8)
        counts = [len(self._block(i)) for i in range(0, len(text), BLOCK)]
        self.before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.n = int(self.before[-1])

    def _block(self, at: int) -> np.ndarray:
        return unit_starts(self.data[at : at + BLOCK], at > 0 and bool(_LETTER[self.data[at - 1]])) + at

    def places(self, first: int, last: int) -> Iterator[int]:
        """Byte offsets of the units ``first``, ``first + PIECE_UNITS`` and so on, and of ``last`` (the text's end for n)."""
        known, starts = -1, None
        for unit in [*range(first, last, PIECE_UNITS), last]:
            if unit >= self.n:
                yield len(self.data)
                continue
            block = int(np.searchsorted(self.before, unit, "right")) - 1
            if block != known:
                known, starts = block, self._block(block * BLOCK)
            yield int(starts[unit - self.before[block]])


def draw(doc_id: int | None, salt: str = SALT) -> tuple[int, ...]:
    """Four whole numbers below 2**32 from the document's id; a null id counts as no digits."""
    digits = hashlib.sha256(f"{salt}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digits[i : i + 8], 16) for i in range(0, 32, 8))


def _cut(text: bytes, ends: list[int]) -> Iterator[bytes]:
    """Pieces between neighbouring ``ends``; a piece that is too long is one run of letters for the most part, cut between characters."""
    for a, b in zip(ends, ends[1:]):
        while b - a > PIECE_BYTES:
            c = a + PIECE_BYTES
            while text[c] & 0xC0 == 0x80:
                c -= 1
            yield text[a:c]
            a = c
        if b > a:
            yield text[a:b]


def split(doc_id: int | None, text: bytes, salt: str = SALT) -> tuple[str, int, Iterator[bytes]]:
    """Form, number of units and the pieces of the output, in order."""
    h = draw(doc_id, salt)
    units = Units(text)
    if not text or any(c in text for c in SECTION) or h[2] % 100 >= REORDERED:
        return PLAIN, units.n, _cut(text, [*units.places(0, units.n)])
    low, high = sorted((h[0] % (units.n + 1), h[1] % (units.n + 1)))
    form = SPM if h[3] % 100 < SUFFIX_FIRST else PSM
    bounds = (0, low, high, units.n)

    def pieces() -> Iterator[bytes]:
        for control, section in ORDER[form]:
            yield control
            yield from _cut(text, [*units.places(bounds[section], bounds[section + 1])])

    return form, units.n, pieces()


def reorder(docs: DataFrame, salt: str = SALT) -> DataFrame:
    """The outputs of all rows of ``docs`` (doc_id, text) as pieces ``uid, doc_id, form, n, at, text``, each document's in order.

    ``uid`` numbers rows by their place in the scan, so repeated rows and ids stay apart and no id gathers rows; ``docs`` must be read
    in the same order if a task runs again, as tables are. Null text is empty. A document without output has one empty piece. Each
    document lies whole in one partition, pieces by ``at``.
    """
    picked = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    tables.workers_find_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                uid, doc, text = (batch.column(k)[i].as_py() for k in range(3))
                form, n, pieces = split(doc, text or b"", salt)
                at = -1
                for at, piece in enumerate(pieces):
                    rows.append((uid, doc, form, n, at, piece))
                    held += len(piece)
                    if held > 4 * PIECE_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if at < 0:
                    rows.append((uid, doc, form, n, 0, b""))
                if len(rows) >= 4096:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)
        tables.give_back()

    return picked.mapInArrow(run, PIECES).repartition("uid").sortWithinPartitions("uid", "at")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT, strict=True)], schema=_OUT)


def _streamed(pieces: DataFrame, document: Callable, schema: pa.Schema, ddl: str) -> DataFrame:
    """Each document's pieces streamed past ``document(row, pieces)``, a generator of rows; a slice's rows go out together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for start in range(0, batch.num_rows, tables.SLICE_ROWS):
                    yield from zip(*(c.to_pylist() for c in batch.slice(start, tables.SLICE_ROWS).columns), strict=True)

        source, held = rows(), []

        def own(first: tuple) -> Iterator[tuple]:
            # the pieces of one document; what follows it waits in ``held``
            yield first
            for row in source:
                if row[0] != first[0]:
                    held.append(row)
                    return
                yield row

        out, size, first = [], 0, next(source, None)
        while first is not None:
            for row in document(first, own(first)):
                out.append(row)
                size += sum(len(x) for x in row if isinstance(x, bytes | str))
                if len(out) >= 4096 or size > 4 * PIECE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)
                    out, size = [], 0
            first = held.pop() if held else None
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)
        tables.give_back()

    return pieces.mapInArrow(run, ddl)


_TEXT = pa.schema([("doc_id", pa.int64()), ("form", pa.string()), ("text", pa.string())])


def outputs(pieces: DataFrame) -> DataFrame:
    """``doc_id, form, text``: whole outputs in one row each, for what ``reorder`` returns."""

    def whole(first: tuple, own: Iterator[tuple]) -> Iterator[tuple]:
        yield first[1], first[2], b"".join(x[5] for x in own).decode()

    return _streamed(pieces, whole, _TEXT, "doc_id long, form string, text string")


_SEEN = pa.schema([
    ("uid", pa.int64()), ("doc_id", pa.int64()), ("form", pa.string()), ("n", pa.int64()), ("section", pa.int32()), ("at", pa.int64()), ("text", pa.binary()),
])


def sections(pieces: DataFrame) -> DataFrame:
    """``uid, doc_id, form, n, section, at, text`` read off the outputs: control strings go, each piece gets its section.

    The last row of each document has section 3 and the output's digest as text. Rows lie in their document's partition, in
    the order of the original text.
    """

    def seen(first: tuple, own: Iterator[tuple]) -> Iterator[tuple]:
        digest, section, at = hashlib.sha256(), 0, 0
        for uid, doc, form, n, at, text in own:
            digest.update(text)
            if form != PLAIN and text in SECTION:
                section = SECTION[text]
            else:
                yield uid, doc, form, n, section, at, text
        yield first[0], first[1], first[2], first[3], 3, at + 1, digest.hexdigest().encode()

    ddl = "uid long, doc_id long, form string, n long, section int, at long, text binary"
    return _streamed(pieces, seen, _SEEN, ddl).sortWithinPartitions("uid", "section", "at")


def restore(pieces: DataFrame) -> DataFrame:
    """``doc_id, form, text``: the original texts, rebuilt from outputs and forms."""

    def whole(first: tuple, own: Iterator[tuple]) -> Iterator[tuple]:
        yield first[1], first[2], b"".join(x[6] for x in own if x[4] < 3).decode()

    return _streamed(sections(pieces), whole, _TEXT, "doc_id long, form string, text string")


_DIGESTS = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
    ("output_sha256", pa.string()), ("restored_sha256", pa.string()),
])


def digests(pieces: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of each document, piece by piece.

    Lengths are in code points, null in plain documents; digests are of UTF-8 bytes.
    """

    def told(first: tuple, own: Iterator[tuple]) -> Iterator[tuple]:
        digest, chars, output = hashlib.sha256(), [0, 0, 0], ""
        for _, _, _, _, section, _, text in own:
            if section == 3:
                output = text.decode()
            else:
                digest.update(text)
                chars[section] += len(text.decode())
        plain = first[2] == PLAIN
        yield first[1], first[3], first[2], None if plain else chars[0], None if plain else chars[1], output, digest.hexdigest()

    ddl = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return _streamed(sections(pieces), told, _DIGESTS, ddl)
