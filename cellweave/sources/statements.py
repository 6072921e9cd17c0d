"""Triples from statements that go over several lines, with prefixes, lists of predicates and objects, and nested nodes.

Statements are found in every split of a file by the states that lines can leave: between statements, inside one, inside a long
literal of either quote. Each is parsed on its own; names stay names until they are joined with the prefixes that their file declares
before them. What cannot be read is listed with its file and line, not dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from .. import vocab as V
from ..model import BNODE, IRI, LITERAL, TRIPLE_FIELDS
from .segments import Grammar, read_segments

BETWEEN, WITHIN, IN_DOUBLE, IN_SINGLE = range(4)
_LONG = {IN_DOUBLE: '"""', IN_SINGLE: "'''"}
_DECLARES = re.compile(r"\s*(?:PREFIX\s+[^\s:<]*:\s*<[^>]*>|BASE\s+<[^>]*>)\s*(?:#.*)?\Z", re.IGNORECASE)

# Tokens of the text format.
_TOKEN = re.compile(
    r"""(?P<skip>\s+|\#[^\n]*)
    |<(?P<iri>[^\x00-\x20<>"{}|^`]*)>
    |(?P<long>\"\"\"(?:(?:"|"")?(?:[^"\\]|\\.))*+\"\"\"|'''(?:(?:'|'')?(?:[^'\\]|\\.))*+''')
    |(?P<text>"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+')
    |@(?P<tag>[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<type>\^\^)
    |(?P<number>[+-]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)(?![\w:-])
    |_:(?P<node>[\w](?:[\w.·-]*[\w·-])?)
    |(?P<mark>[.;,\[\]()])
    |(?P<name>(?:[^\W\d_](?:[\w.·-]*[\w·-])?)?:(?:(?:[\w:%·-]|\\.)(?:(?:[\w:.%·-]|\\.)*(?:[\w:%·-]|\\.))?)?)
    |(?P<word>[A-Za-z]+)""",
    re.VERBOSE | re.DOTALL,
)
_ESCAPE = re.compile(r"""\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))""", re.DOTALL)
_PLAIN_ESCAPES = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}
# what lines are looked at for, outside of nodes and literals that they close
_SKIPPED = re.compile(
    r"""<[^\x00-\x20<>"{}|^`]*>|\"\"\"(?:(?:"|"")?(?:[^"\\]|\\.))*+\"\"\"|'''(?:(?:'|'')?(?:[^'\\]|\\.))*+'''|(?<!")\"(?!\"\")(?:[^"\\]|\\.)*+\"|(?<!')'(?!'')(?:[^'\\]|\\.)*+'|\\."""
)
_OPEN_OR_COMMENT = re.compile(r"\"\"\"|'''|#")


def after(line: str, state: int) -> int:
    """State at the end of a line that begins in ``state``."""
    if state in _LONG:
        quote = _LONG[state][0]
        closed = re.match(rf"(?:{quote}{{0,2}}(?:[^{quote}\\]|\\.))*+{quote}{{3}}", line)
        if not closed:
            return state
        line, state = "x " + line[closed.end() :], WITHIN
    if state == BETWEEN and _DECLARES.match(line):
        return BETWEEN
    # closed nodes and literals become a letter, so that their dots and quotes do not count
    rest = _SKIPPED.sub("x", line) if any(c in line for c in "<\"'\\") else line
    found = _OPEN_OR_COMMENT.search(rest)
    if found and found[0] != "#":
        return IN_DOUBLE if found[0] == '"""' else IN_SINGLE
    rest = (rest[: found.start()] if found else rest).rstrip()
    return state if not rest else BETWEEN if rest.endswith(".") else WITHIN


def _never(lines: pa.Array) -> pa.Array:
    return pc.equal(pc.binary_length(lines), -1)


def _nothing(lines: pa.Array) -> pa.Array:
    return pc.match_substring_regex(lines, r"^\s*(#.*)?$")


STATEMENTS = Grammar(4, after, _never, _nothing)


@dataclass(frozen=True)
class Name:
    """A name with a prefix, or an IRI relative to a base (prefix ``<>``), until its declaration is known."""

    prefix: str
    local: str


def _unescaped(text: str) -> str:
    def one(m: re.Match) -> str:
        if m[3] is not None:
            if m[3] not in _PLAIN_ESCAPES:
                raise ValueError(f"unknown escape \\{m[3]}")
            return _PLAIN_ESCAPES[m[3]]
        return chr(int(m[1] or m[2], 16))

    out = _ESCAPE.sub(one, text) if "\\" in text else text
    # a pair of surrogates is one character
    return out.encode("utf-16", "surrogatepass").decode("utf-16") if any("\ud800" <= c <= "\udfff" for c in out) else out


class Statement:
    """Reads one piece of text that holds whole statements: ``declared`` (prefix, IRI) and ``triples``.

    A triple is (subject, predicate, object, kind, datatype, language); nodes are texts or names.
    """

    def __init__(self, text: str, label: str):
        self.label, self.made = label, 0
        self.declared: list[tuple[str, str]] = []
        self.triples: list[tuple] = []
        self.tokens = [*self._tokens(text), ("end", "")]
        self.at = 0
        while self.tokens[self.at][0] != "end":
            self._statement()

    @staticmethod
    def _tokens(text: str) -> Iterator[tuple[str, str]]:
        at = 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise ValueError(f"cannot read {text[at : at + 20]!r}")
            at = m.end()
            if m.lastgroup != "skip":
                yield m.lastgroup, m[m.lastgroup]

    def _next(self) -> tuple[str, str]:
        self.at += 1
        return self.tokens[self.at - 1]

    def _take(self, kind: str, value: str | None = None) -> str:
        found, text = self._next()
        if found != kind or value is not None and text != value:
            raise ValueError(f"{value or kind} expected, {text or 'the end'!r} found")
        return text

    def _is(self, value: str) -> bool:
        return self.tokens[self.at] == ("mark", value)

    def _statement(self) -> None:
        kind, text = self.tokens[self.at]
        if kind in ("tag", "word") and text.lower() in ("prefix", "base"):
            self.at += 1
            prefix = "<>" if text.lower() == "base" else self._take("name")
            if prefix != "<>" and not prefix.endswith(":"):
                raise ValueError(f"{prefix!r} is no prefix")
            self.declared.append((prefix if prefix == "<>" else prefix[:-1], _unescaped(self._take("iri"))))
            if kind == "tag":
                self._take("mark", ".")
            return
        alone = self._is("[")
        subject, what, *_ = self._object()
        if what == LITERAL:
            raise ValueError("a literal is no subject")
        if not (alone and self._is(".")):
            self._predicates(subject)
        self._take("mark", ".")

    def _predicates(self, subject) -> None:
        while True:
            kind, text = self.tokens[self.at]
            predicate = V.RDF_TYPE if (kind, text) == ("word", "a") else None
            if predicate is None:
                predicate, what, *_ = self._object()
                if what != IRI:
                    raise ValueError("a predicate is an IRI")
            else:
                self.at += 1
            while True:
                o, what, datatype, lang = self._object()
                self.triples.append((subject, predicate, o, what, datatype, lang))
                if not self._is(","):
                    break
                self.at += 1
            if not self._is(";"):
                return
            while self._is(";"):
                self.at += 1
            if self.tokens[self.at] in (("mark", "."), ("mark", "]")):
                return

    def _fresh(self) -> str:
        self.made += 1
        return f"_:{self.label}_{self.made}"

    def _object(self) -> tuple:
        kind, text = self._next()
        if kind == "iri":
            text = _unescaped(text)
            absolute = re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", text)
            return (text if absolute else Name("<>", text)), IRI, None, None
        if kind == "name":
            prefix, local = text.split(":", 1)
            return Name(prefix, re.sub(r"\\(.)", r"\1", local)), IRI, None, None
        if kind == "node":
            return f"_:{text}", BNODE, None, None
        if kind in ("long", "text"):
            return self._literal(_unescaped(text[3:-3] if kind == "long" else text[1:-1]))
        if kind == "number":
            code = "double" if "e" in text.lower() else "decimal" if "." in text else "integer"
            return text, LITERAL, V.XSD + code, None
        if kind == "word" and text in ("true", "false"):
            return text, LITERAL, V.XSD + "boolean", None
        if (kind, text) == ("mark", "["):
            node = self._fresh()
            if not self._is("]"):
                self._predicates(node)
            self._take("mark", "]")
            return node, BNODE, None, None
        if (kind, text) == ("mark", "("):
            return self._collection()
        raise ValueError(f"a node is expected, {text or 'the end'!r} found")

    def _literal(self, value: str) -> tuple:
        kind, text = self.tokens[self.at]
        if kind == "tag":
            self.at += 1
            return value, LITERAL, None, text
        if kind == "type":
            self.at += 1
            datatype, what, *_ = self._object()
            if what != IRI:
                raise ValueError("a datatype is an IRI")
            return value, LITERAL, datatype, None
        return value, LITERAL, None, None

    def _collection(self) -> tuple:
        items = []
        while not self._is(")"):
            items.append(self._object())
        self.at += 1
        if not items:
            return V.RDF + "nil", IRI, None, None
        nodes = [self._fresh() for _ in items]
        for node, item, following in zip(nodes, items, [*nodes[1:], None], strict=True):
            self.triples.append((node, V.RDF + "first", *item))
            rest = (following, BNODE) if following else (V.RDF + "nil", IRI)
            self.triples.append((node, V.RDF + "rest", *rest, None, None))
        return nodes[0], BNODE, None, None


_NODES = ("s", "p", "o", "o_datatype")
_FIELDS = [
    ("file_no", pa.int32()), ("record", pa.int64()), ("line", pa.int64()), ("place", pa.int32()), *((c, pa.string()) for c in TRIPLE_FIELDS),
    *((f"{c}_prefix", pa.string()) for c in _NODES), ("declares", pa.string()), ("text", pa.string()), ("reason", pa.string()),
]
_SCHEMA = pa.schema(_FIELDS)
_DDL = ", ".join(f"{n} {'int' if t == pa.int32() else 'long' if t == pa.int64() else 'string'}" for n, t in _FIELDS)


def _read(file: int, records: list[tuple[int, int, str]]) -> pa.RecordBatch:
    """Rows of three kinds: triples, declarations (prefix in ``declares``, IRI in ``o``) and rejects (``text`` and ``reason``)."""
    rows = []
    for record, line, text in records:
        head = (file, record, line)
        try:
            read = Statement(text.removeprefix("\ufeff"), f"f{file}s{record}")
        except ValueError as error:
            rows.append((*head, 0, *[None] * 11, text, str(error)))
            continue
        for prefix, iri in read.declared:
            rows.append((*head, 0, None, None, iri, None, None, None, None, None, None, None, prefix, None, None))
        for place, (s, p, o, kind, datatype, lang) in enumerate(read.triples):
            nodes = [(x.local, x.prefix) if isinstance(x, Name) else (x, None) for x in (s, p, o, datatype)]
            (s, s1), (p, p1), (o, o1), (d, d1) = nodes
            rows.append((*head, place, s, p, o, kind, d, lang, s1, p1, o1, d1, None, None, None))
    columns = zip(*rows, strict=True) if rows else [[]] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)], schema=_SCHEMA)


@dataclass(frozen=True)
class Statements:
    """``triples``, and ``rejects``: ``file, line`` (from 1), ``text, reason`` of what could not be read."""

    triples: DataFrame
    rejects: DataFrame


def read_statements(spark: SparkSession, path: str, glob: str | None = None) -> Statements | None:
    """Triples and rejects of the file or folder at ``path``; None where there are no statements.

    Prefixes hold from their declaration to the end of the file or to the next one of that name. Relative IRIs are put behind the
    base, up to its last slash. Nodes without a label get one made of their file's and statement's numbers. A statement that a file does not
    end is a reject; so is one with a prefix that is not declared before it, but for its other triples.
    """
    found = read_segments(spark, path, STATEMENTS, _read, _DDL, glob, closed=False)
    if found is None:
        return None
    rows = session.settle(found.rows)
    rejects = rows.filter("reason IS NOT NULL").select("file_no", "line", "text", "reason")
    told = F.array_sort(F.collect_list(F.struct("record", F.col("o").alias("iri"))))
    declared = rows.filter("declares IS NOT NULL").groupBy("file_no", F.col("declares").alias("prefix")).agg(told.alias("told"))
    declared = session.broadcast_if_small(session.settle(declared), 1024)
    triples = rows.filter("p IS NOT NULL")
    for c in _NODES:
        side = declared.select("file_no", F.col("prefix").alias(f"{c}_prefix"), F.col("told").alias("_told"))
        triples = triples.join(side, ["file_no", f"{c}_prefix"], "left")
        triples = triples.withColumn(f"{c}_iri", _resolved(F.col(c), F.col(f"{c}_prefix"), F.col("_told"))).drop("_told")
    # a name without its declaration
    lost = [F.when(F.col(f"{c}_prefix").isNotNull() & F.col(f"{c}_iri").isNull(), F.col(f"{c}_prefix")) for c in _NODES]
    unknown = F.coalesce(*lost)
    reason = F.concat(F.lit("prefix not declared: "), unknown)
    triples = triples.withColumn("reason", reason)
    bad = triples.filter("reason IS NOT NULL").select("file_no", "line", F.concat_ws(" ", "s", "p", "o").alias("text"), "reason")
    files = found.files.select("file_no", "file")
    rejects = rejects.unionByName(bad).join(session.broadcast_if_small(files, 512), "file_no")
    good = triples.filter("reason IS NULL").select(*[F.col(f"{c}_iri").alias(c) if c in _NODES else F.col(c) for c in TRIPLE_FIELDS])
    return Statements(good, rejects.select("file", (F.col("line") + 1).alias("line"), "text", "reason"))


def _resolved(local: Column, prefix: Column, told: Column) -> Column:
    """The IRI that a name stands for by the last declaration up to its statement; what is no name stays as it is."""
    before = F.filter(told, lambda x: x["record"] <= F.col("record"))
    iri = F.when(F.size(before) > 0, F.element_at(before, -1)["iri"])
    folder = F.when(local.startswith("#") | (local == ""), F.substring_index(iri, "#", 1)).otherwise(F.regexp_replace(iri, "[^/]*$", ""))
    return F.when(prefix.isNull(), local).when(prefix == "<>", F.concat(folder, local)).otherwise(F.concat(iri, local))

