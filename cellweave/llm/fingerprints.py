"""Fingerprints of texts by Lempel-Ziv phrases.

A text is parsed into the phrases of an incremental dictionary: each is a known phrase and one more character. The phrases are
hashed; the fingerprint is the smallest hashes. Two texts are as alike as the smallest hashes of both together are common to
both, which estimates the share of phrases that they have in common, as compressing one with the other's dictionary would.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm import tables
from cellweave.llm.words import CHUNK, U, _powers, mix

HASHES = 64


def parse(text: str, known: set[str], cuts: list[int], at: int = 0) -> int:
    """Parse ``text`` on from ``at``; adds phrases to ``known`` and their ends to ``cuts``. Returns where the last one ends.

    What is left over at the end is a known phrase and adds nothing.
    """
    phrase, add, cut = "", known.add, cuts.append
    for i, c in enumerate(text[at:], at + 1):
        phrase += c
        if phrase not in known:
            add(phrase)
            cut(i)
            phrase = ""
    return cuts[-1] if cuts else 0


def hashes(text: str, cuts: list[int]) -> np.ndarray:
    """Hash of each phrase that ends at one of ``cuts``; the first starts at 0."""
    if not cuts:
        return np.zeros(0, U)
    data = np.frombuffer(text[: cuts[-1]].encode("utf-32-le"), "<u4").astype(U) + U(1)
    ends = np.array(cuts)
    starts = np.concatenate([[0], ends[:-1]])
    up, down = _powers()
    out, first = np.empty(len(ends), U), 0
    while first < len(ends):
        base = starts[first]
        last = int(np.searchsorted(ends, base + CHUNK, "right"))
        if last <= first:  # one phrase longer than a piece
            digest = hashlib.blake2b(data[base : ends[first]].tobytes(), digest_size=8).digest()
            out[first] = int.from_bytes(digest, "little")
            first += 1
            continue
        part = data[base : ends[last - 1]]
        total = np.zeros(len(part) + 1, U)
        np.cumsum(part * up[: len(part)], out=total[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U))
        first = last
    return out


def smallest(h: np.ndarray) -> np.ndarray:
    """The HASHES smallest, sorted, in 32 bits."""
    h = (h >> U(32)).astype(np.uint32)
    if len(h) > 4 * HASHES:
        h = np.partition(h, 4 * HASHES)[: 4 * HASHES]
    return np.unique(h)[:HASHES]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smallest hashes of both together that are in both; 1 if neither has any."""
    both = np.union1d(a, b)[:HASHES]
    if not len(both):
        return 1.0
    return float((np.isin(both, a) & np.isin(both, b)).sum() / len(both))


def bytes_of(mark: np.ndarray) -> bytes:
    return mark.astype(">u4").tobytes()


def text_of(mark: np.ndarray) -> str:
    return bytes_of(mark).hex()


def edit(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much (or all) of the beginning of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def mark_pair(text: str, edited: str, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of both texts, which are equal up to ``shared``: that part is parsed once."""
    known: set[str] = set()
    cuts: list[int] = []
    parse(text[:shared], known, cuts)
    middle = cuts[-1] if cuts else 0
    begin = hashes(text, cuts)
    out = []
    for whole in (text, edited):
        more: list[int] = []
        own = set(known) if whole is text else known
        parse(whole, own, more, middle)
        rest = hashes(whole[middle:], [x - middle for x in more])
        out.append(smallest(np.concatenate([begin, rest])))
    return out[0], out[1]


# fingerprints are bytes until the end: half as much to write as their digits
_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
# null ids come first
_ORDER = ["doc_id", "mark", "uid"]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its fingerprint, an edited text's, the next document's, and their likeness.

    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The next document
    is that of the next doc_id, after the last the first; null ids come before all, and rows of one id are in order of their texts'
    hashes. Null text is empty. One row is its own next. The edited text is ``edit(text, next text)``.

    Rows are dealt into ranges of (doc_id, hash, row number), so that ids may be any numbers and one id any share of the rows. What
    follows the last row of a range is the first of the next one: those pairs, one per range, are judged afterwards. Rows are
    numbered by their place in the scan; ``docs`` must be read in the same order if a task runs again, as tables are.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    picked = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text")
    )
    schema = f"{_RESULT}, edge int, uid long, mark long, text string"
    columns = [x.split()[0] for x in schema.split(", ")]
    tables.workers_find_package(docs.sparkSession)

    def run(batches):
        def edge(side: int) -> pa.RecordBatch:
            uid, doc, mark, text = held
            row = [doc, None, None, None, None, None, None, side, uid, mark, text]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, _KINDS, strict=True)], columns)

        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, tables.SLICE_ROWS):
                out = []
                for row in zip(*(batch[c].slice(at, tables.SLICE_ROWS).to_pylist() for c in ("uid", "doc_id", "mark", "text")), strict=True):
                    if held is None:
                        held = row
                        yield edge(0)
                    else:
                        out.append((held[1], held[3], row[3]))
                        held = row
                if out:
                    judged = _judge(out)
                    yield pa.RecordBatch.from_arrays([*judged.columns, *(pa.nulls(len(out), k) for k in _KINDS[7:])], columns)
        if held is not None:
            yield edge(1)
        tables.give_back()

    ranges = picked.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    found = tables.settle(ranges.mapInArrow(run, schema), "fingerprints")
    whole = found.where("edge IS NULL").select(columns[:7]).unionByName(_at_edges(found.where("edge IS NOT NULL")))
    return whole.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def _at_edges(edges: DataFrame) -> DataFrame:
    """The last row of each range judged with the first of the next; after the last range comes the first. Two rows per range."""
    order = Window.orderBy(*_ORDER, "edge")
    linked = edges.select("doc_id", "mark", "uid", "edge").withColumn("after", F.coalesce(F.lead("uid").over(order), F.first("uid").over(order)))
    lasts = linked.where("edge = 1").select("uid", "after").join(edges.where("edge = 1").select("uid", "doc_id", "text"), "uid")
    firsts = edges.where("edge = 0").select(F.col("uid").alias("after"), F.col("text").alias("following"))

    def run(batches):
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "following")), strict=True):
                yield _judge([row])

    return lasts.join(firsts, "after").select("doc_id", "text", "following").mapInArrow(run, _RESULT)


_KINDS = [
    pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.int64(), pa.int64(), pa.string(),
]


def _judge(rows: list[tuple]) -> pa.RecordBatch:
    found, last = [], None
    for doc, text, following in rows:
        edited = edit(text, following)
        own, changed = mark_pair(text, edited, len(text) - len(text) // 4)
        found.append([doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed, likeness(own, changed)])
    for i, (row, (_, _, following)) in enumerate(zip(found, rows, strict=True)):
        if i + 1 < len(rows) and rows[i + 1][1] == following:
            last = found[i + 1][3]
        else:
            last = mark_pair(following, following, len(following))[0]
        row.append(likeness(row[3], last))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    values = [[bytes_of(r[i]) if i in (3, 4) else r[i] for r in found] for i in range(7)]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, _KINDS, strict=False)], names)
