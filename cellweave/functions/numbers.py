"""Literal types of cell texts and the canonical text of numbers.

Nearly all cells are plain integers, plain decimals or text that cannot be a number; short tests settle
those inside generated code. What is left (odd spellings, exponents, long numbers) goes through ``_let``,
which names intermediate results instead of repeating them, so that the code for the common case stays
small enough to be compiled.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab as V

# The number grammars. Digits may be of any script, with single underscores between them;
# white space around a number is ignored. Only character classes repeat, so long texts need no deep stack.
_DIGITS = r"\d[\d_]*+"
INTEGER = rf"(?U)^\s*+[+-]?{_DIGITS}\s*+\z"
DECIMAL = (
    rf"(?Ui)^\s*+[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?|inf|infinity|nan)\s*+\z"
)
_STRAY_UNDERSCORE = r"(?U)(?<!\d)_|_(?!\d)"
# Fixed value: integers with more digits are read as floating point numbers.
MAX_INTEGER_DIGITS = 4300

# Texts that are canonical already, and the beginnings that a number can have.
_PLAIN_INTEGER = r"^(?:0|-?[1-9][0-9]{0,17})\z"
_PLAIN_DECIMAL = r"^-?(?!0\.0000)(?=.{3,15}\z)(?:0|[1-9][0-9]*)\.(?:0|[0-9]*[1-9])\z"
_SIMPLE_DECIMAL = r"^-?[0-9]++\.[0-9]++\z"
_MAY_BE_NUMBER = r"(?U)^\s*+[+-]?(?:\.?\d|[iInN])"

INTEGER_TYPE = V.XSD + "integer"
DECIMAL_TYPE = V.XSD + "decimal"


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body``, in which ``name`` stands for ``value``; that is computed once however often it is used."""
    return f"transform(array({value}), {name} -> {body})[0]"


def infer_datatype(value: str) -> Column:
    """XSD integer, XSD decimal or null (plain string) for the text in a column."""
    few_digits = rf"(length(v) <= {MAX_INTEGER_DIGITS} OR length(regexp_replace(v, r'(?U)\D', '')) <= {MAX_INTEGER_DIGITS})"
    careful = f"""CASE WHEN contains(v, '_') AND v RLIKE r'{_STRAY_UNDERSCORE}' THEN NULL
        WHEN v RLIKE r'{INTEGER}' AND {few_digits} THEN '{INTEGER_TYPE}'
        WHEN v RLIKE r'{DECIMAL}' THEN '{DECIMAL_TYPE}' END"""
    return F.expr(f"""CASE WHEN `{value}` RLIKE r'{_PLAIN_INTEGER}' THEN '{INTEGER_TYPE}'
        WHEN `{value}` RLIKE r'{_SIMPLE_DECIMAL}' THEN '{DECIMAL_TYPE}'
        WHEN `{value}` RLIKE r'{_MAY_BE_NUMBER}' THEN {_let(f'`{value}`', 'v', careful)} END""")


def lexical_form(value: str, datatype: str) -> Column:
    """The text to write for a column of texts and their datatypes: numbers re-rendered, all else unchanged.

    Integers lose spaces, underscores, plus signs and leading zeros. Decimals are read as doubles and
    written with the fewest digits that read back the same, in fixed point for exponents -4 to 15 and as
    ``d.ddde+XX`` beyond.
    """
    integer = r"regexp_replace(regexp_replace(bare, r'^\+?(-?)0*(?=\d)', '$1'), r'^-0\z', '0')"
    double = r"try_cast(regexp_replace(bare, r'^[+-]nan\z', 'nan') AS double)"
    rendered = _let(double, "d", double_text("d"))
    number = _let(_bare("c.v"), "bare", f"IF(c.t = '{INTEGER_TYPE}', {integer}, {rendered})")
    return F.expr(f"""CASE WHEN `{datatype}` IS NULL
        OR `{datatype}` = '{INTEGER_TYPE}' AND `{value}` RLIKE r'{_PLAIN_INTEGER}'
        OR `{value}` RLIKE r'{_PLAIN_DECIMAL}' THEN `{value}`
        ELSE {_let(f"struct(`{value}` AS v, `{datatype}` AS t)", "c", number)} END""")


@cache
def _digits_of_other_scripts() -> tuple[str, str]:
    """All decimal digits beyond ASCII, and their ASCII forms."""
    digits = [chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.digit(d)) for d in digits)


def _bare(value: str) -> str:
    """A number's text without spaces and underscores, in lower case and ASCII digits."""
    digits, ascii_digits = _digits_of_other_scripts()
    ascii_text = rf"IF({value} RLIKE r'[^\x00-\x7f]', translate({value}, '{digits}', '{ascii_digits}'), {value})"
    return rf"lower(regexp_replace({ascii_text}, r'(?U)[_\s]', ''))"


def double_text(number: str) -> str:
    """SQL for the shortest text of a double.

    Java's own text is the shortest but for some long mantissas and numbers close to zero; there the first
    rounding that reads back as the same number is taken.
    """
    roundings = f"transform(sequence(0, 16), n -> format_string(concat('%.', n, 'e'), {number}))"
    shortest = f"coalesce(filter({roundings}, x -> CAST(x AS double) = {number})[0], j)"
    sure = f"abs({number}) >= 2.3e-308D AND length(substring_index(j, 'E', 1)) <= 16"
    scientific = rf"regexp_replace(lower(IF({sure}, j, {shortest})), r'\.?0*e\+?', 'e')"
    scientific = rf"regexp_replace(regexp_replace({scientific}, r'e(?=\d)', 'e+'), r'(?<=e[+-])(?=\d$)', '0')"
    fixed = rf"regexp_replace(CAST(CAST({number} AS decimal(38, 20)) AS string), r'^(-?\d+\.\d+?)0*$', '$1')"
    return _let(f"CAST({number} AS string)", "j", f"""CASE WHEN isnan({number}) THEN 'nan'
        WHEN j = 'Infinity' THEN 'inf' WHEN j = '-Infinity' THEN '-inf' WHEN NOT contains(j, 'E') THEN j
        WHEN abs({number}) >= 1e-4D AND abs({number}) < 1e16D THEN {fixed} ELSE {scientific} END""")
