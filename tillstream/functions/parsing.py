"""Strict JSON, lenient numbers and the strict event time, as JVM-side expressions.

Helpers take and return SQL expression text, to be used with `F.expr` or `selectExpr`.
"""

from __future__ import annotations

from tillstream.functions.text import strip
from tillstream.schemas import WIRE_FIELDS

# Token shapes.
JSON_SPACE = r"[ \t\r\n]*"
# `$` would also match before a last line end, `\z` does not.
INTEGER = r"^[+-]?[0-9]+\z"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
EVENT_TIME = (
    r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    r"[Tt][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}[Zz]\z"
)


def parse_fields(text: str, fields: list[str] = WIRE_FIELDS) -> str:
    """The named members as text (last one wins), plus `corrupt` when the JSON is malformed."""
    schema = ", ".join(f"{name} string" for name in [*fields, "corrupt"])
    return f"""from_json({text}, '{schema}', map(
        'mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', 'corrupt',
        'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false'))"""


def is_single_value(text: str) -> str:
    """True when nothing follows the first JSON value in `text`.

    The reader stops after the first value, so `{"a":1} x` looks fine to it. Inside `[..]` the
    value can only be followed by `,` or `]`, inside `{"v":..}` only by `,` or `}`; text that is
    accepted by both, with one array element, holds nothing but the value itself.
    """
    return f"""coalesce(json_array_length(concat('[', {text}, ']')) = 1
        AND json_object_keys(concat('{{"v":', {text}, '}}')) IS NOT NULL, false)"""


def is_one_object(text: str) -> str:
    """Text is a lone JSON object, given that the reader accepted its first value.

    An object with a single pair of braces that ends the text needs no second look, which spares
    ordinary events the two extra scans of `is_single_value`.
    """
    return f"""CASE
        WHEN {text} RLIKE r'^{JSON_SPACE}\\{{[^{{}}]*\\}}{JSON_SPACE}\\z' THEN true
        WHEN {text} RLIKE r'^{JSON_SPACE}\\{{' THEN {is_single_value(text)}
        ELSE false END"""


def is_json(text: str) -> str:
    return f"(try_parse_json({text}) IS NOT NULL AND {is_single_value(text)})"


def _stripped_match(text: str, pattern: str) -> str:
    """The text, stripped where that is needed, when it fits the pattern."""
    return f"""CASE WHEN {text} RLIKE r'{pattern}' THEN {text}
        WHEN {strip(text)} RLIKE r'{pattern}' THEN {strip(text)} END"""


def integer_text(text: str) -> str:
    """Digits of an int-like value, else null."""
    return _stripped_match(text, INTEGER)


def number(text: str) -> str:
    """Double of a numeric value, else null."""
    return f"try_cast({_stripped_match(text, NUMBER)} AS double)"


def event_time(text: str) -> str:
    """`yyyy-MM-ddTHH:mm:ssZ` (one-digit parts and lower case allowed), else null."""
    return f"CASE WHEN {text} RLIKE r'{EVENT_TIME}' THEN try_cast(upper({text}) AS timestamp) END"
