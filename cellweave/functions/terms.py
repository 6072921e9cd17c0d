"""Scalar expressions on names, IRIs and literal text. All are built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab as V

# Fixed value: a character that is not white space (Unicode white space and the four separator controls).
NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"


def _c(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def is_present(value) -> Column:
    """True unless null, empty or only white space (non-breaking spaces count as white space)."""
    value = _c(value)
    return value.isNotNull() & value.rlike(NOT_BLANK)


def percent_encode(value) -> Column:
    """Percent-encode every character outside A-Z a-z 0-9 - . _ ~ (UTF-8 bytes, upper-case hex)."""
    encoded = F.url_encode(_c(value))
    for form, text in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(form), F.lit(text))
    return encoded


def node_url(iri, page="") -> Column:
    """Link to a node's page: ``?node=`` and the encoded ``<iri>``; slashes stay readable."""
    encoded = F.replace(percent_encode(F.concat(F.lit("<"), _c(iri), F.lit(">"))), F.lit("%2F"), F.lit("/"))
    return F.concat(F.lit(page + "?node="), encoded)


def escape_literal(value) -> Column:
    escaped = _c(value)
    for plain, form in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(form))
    return escaped


def unescape_literal(value) -> Column:
    """Inverse of :func:`escape_literal`; also tabs and escapes by number, ``\\u`` and ``\\U``, from other writers."""
    value = _c(value)

    def plain_piece(piece: Column) -> Column:
        for form, text in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
            piece = F.replace(piece, F.lit(form), F.lit(text))
        return piece

    def short_numbers(piece: Column) -> Column:
        """Numbers of eight digits as four-digit ones where they fit, else as their character."""
        parts = F.split(F.regexp_replace(piece, r"\\U0000([0-9A-Fa-f]{4})", r"\\u$1"), r"\\U", -1)
        first, rest = F.get(parts, F.lit(0)), F.slice(parts, F.lit(2), F.size(parts))
        char = lambda x: F.decode(F.unhex(F.substring(x, 1, 8)), "UTF-32")
        return F.concat(first, F.array_join(F.transform(rest, lambda x: F.concat(char(x), F.substring(x, 9, 2**31 - 1))), ""))

    pieces = F.split(value, r"\\\\", -1)
    by_pieces = F.array_join(F.transform(pieces, plain_piece), "\\")
    short = F.when(value.contains("\\U"), F.array_join(F.transform(pieces, short_numbers), "\\\\")).otherwise(value)
    by_json = F.from_json(
        F.concat(F.lit('{"v":"'), short, F.lit('"}')), "v string", {"allowUnquotedControlChars": "true"}
    )["v"]
    numbered = value.contains("\\u") | value.contains("\\U")
    return F.when(~value.contains("\\"), value).when(numbered, by_json).otherwise(by_pieces)


def format_term(o="o", kind="o_kind", datatype="o_datatype", lang="o_lang") -> Column:
    """Text of an object on one line: ``<iri>``, ``_:node``, ``"text"``, with ``^^<type>`` or ``@lang``."""
    o, kind, datatype, lang = _c(o), _c(kind), _c(datatype), _c(lang)
    quoted = F.concat(F.lit('"'), escape_literal(o), F.lit('"'))
    literal = (
        F.when(datatype.isNotNull(), F.concat(quoted, F.lit("^^<"), datatype, F.lit(">")))
        .when(lang.isNotNull(), F.concat(quoted, F.lit("@"), lang))
        .otherwise(quoted)
    )
    return F.when(kind == "iri", F.concat(F.lit("<"), o, F.lit(">"))).when(kind == "bnode", o).otherwise(literal)


def format_node(node) -> Column:
    node = _c(node)
    return F.when(node.startswith("_:"), node).otherwise(F.concat(F.lit("<"), node, F.lit(">")))


def triple_line() -> Column:
    """The whole triple as one line of text, from the columns of the triples schema."""
    return F.concat_ws(" ", format_node("s"), F.concat(F.lit("<"), F.col("p"), F.lit(">")), format_term(), F.lit("."))


def safe_identifier(name) -> Column:
    """``column_`` and the name with every character outside A-Z a-z 0-9 _ - replaced by ``_``."""
    return F.concat(F.lit("column_"), F.regexp_replace(_c(name), r"[^a-zA-Z0-9_-]", "_"))


def local_name(iri, base: str = V.CATALOGUE_BASE) -> Column:
    """The part of an IRI after ``base``, or null if it lies elsewhere."""
    iri = _c(iri)
    return F.when(iri.startswith(base), F.substring(iri, len(base) + 1, 2**31 - 1))


def last_segment(iri) -> Column:
    return F.substring_index(_c(iri), "/", -1)


def file_name(path) -> Column:
    return F.substring_index(_c(path), "/", -1)


def file_stem(path) -> Column:
    """File name without its last extension; a leading dot is not an extension."""
    return F.regexp_replace(file_name(path), r"^(.+)\.[^.]*$", "$1")


def chunk_name(index) -> Column:
    return F.format_string("chunk_%04d", _c(index))


def page_name(index) -> Column:
    return F.format_string("page_%d", _c(index))


def timestamp_text(ts) -> Column:
    """ISO text of a timestamp, as used for xsd:dateTime; fractions of a second only when there are any."""
    ts = _c(ts)
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, "SSSSSS")
    return F.when(fraction == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), fraction))


def datatype_iri(code) -> Column:
    """XSD type of a datatype code; unknown codes mean string, a missing code gives null."""
    code = _c(code)
    known = F.when(code.isin(*V.DATATYPE_CODES), code).otherwise(F.lit(V.DEFAULT_DATATYPE))
    return F.when(code.isNotNull(), F.concat(F.lit(V.XSD), known))


def datatype_code(iri) -> Column:
    """Datatype code of an XSD type; null for any other IRI."""
    code = local_name(iri, V.XSD)
    return F.when(code.isin(*V.DATATYPE_CODES), code)
