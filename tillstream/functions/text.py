"""Text expressions: lossy decoding, trimming, quoted values in error messages.

Helpers take and return SQL expression text, to be used with `F.expr` or `selectExpr`.
"""

from __future__ import annotations

# The characters that count as white space around a value.
WHITESPACE = (
    r"\t\n\u000b\u000c\r "
    r"\u001c\u001d\u001e\u001f\u0085\u00a0\u1680"
    r"\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    r"\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: str) -> str:
    return f"btrim({value}, '{WHITESPACE}')"


def lossy_text(value: str) -> str:
    """Bytes as text, with U+FFFD in place of bad sequences and '' when absent."""
    return f"coalesce(make_valid_utf8(cast({value} AS string)), '')"


def lossy_key(key: str) -> str:
    """Message key as text; an absent or empty key gives null."""
    return f"nullif(make_valid_utf8(cast({key} AS string)), '')"


def quoted(text: str) -> str:
    """A string the way error messages show it: in single quotes unless it holds only those."""
    body = text
    for plain, shown in [("\\\\", "\\\\\\\\"), ("\\n", "\\\\n"), ("\\r", "\\\\r"), ("\\t", "\\\\t")]:
        body = f"replace({body}, '{plain}', '{shown}')"
    return f"""CASE
        WHEN contains({text}, '\\'') AND NOT contains({text}, '"') THEN concat('"', {body}, '"')
        ELSE concat('\\'', replace({body}, '\\'', '\\\\\\''), '\\'') END"""


def float_text(value: str) -> str:
    """A double in shortest form: plain digits from 1e-4 up to 1e16, else `1e+16`, `1e-05`."""
    java = f"cast({value} AS string)"
    plain = f"regexp_replace(cast(cast({value} AS decimal(38,20)) AS string), r'(\\.\\d+?)0+$', '$1')"
    mantissa = f"regexp_replace(split_part({java}, 'E', 1), r'\\.0$', '')"
    exponent = f"try_cast(split_part({java}, 'E', 2) AS int)"
    return f"""CASE
        WHEN {value} = 0 OR abs({value}) >= 1e-3 AND abs({value}) < 1e7 THEN {java}
        WHEN abs({value}) >= 1e-4 AND abs({value}) < 1e16 THEN {plain}
        WHEN isnan({value}) THEN 'nan'
        WHEN abs({value}) = double('infinity') THEN if({value} > 0, 'inf', '-inf')
        ELSE concat({mantissa}, 'e', if({exponent} < 0, '-', '+'),
                    lpad(cast(abs({exponent}) AS string), greatest(2, length(cast(abs({exponent}) AS string))), '0'))
        END"""
