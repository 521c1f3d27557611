"""Text expressions: trimming, quoted literals and number text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: characters that count as white space when raw text is trimmed.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def stripped(column: Column) -> Column:
    """Text without white space of any kind at both ends; null becomes ''."""
    return F.coalesce(F.btrim(column, F.lit(WHITE_SPACE)), F.lit(""))


def quoted(column: str) -> str:
    """SQL for text as a quoted literal: 'abc', "it's", None for null.

    Backslashes, tabs and line ends are escaped.
    """
    body = column
    for char, escape in (("\\\\", "\\\\\\\\"), ("\\t", "\\\\t"), ("\\n", "\\\\n"), ("\\r", "\\\\r")):
        body = f"replace({body}, '{char}', '{escape}')"
    single, double = f"contains({column}, '\\'')", f"contains({column}, '\"')"
    body = f"if({single} AND {double}, replace({body}, '\\'', '\\\\\\''), {body})"
    mark = f"if({single} AND NOT {double}, '\"', '\\'')"
    return f"coalesce(concat({mark}, {body}, {mark}), 'None')"


def float_text(column: str) -> str:
    """SQL for the shortest text of a double: plain from 1e-4 to 1e16, exponent form outside."""
    text, size = f"cast({column} AS string)", f"abs({column})"
    plain = f"rtrim('0', cast(cast({text} AS decimal(38,18)) AS string))"
    power = f"try_cast(substring_index({text}, 'E', -1) AS int)"
    return f"""CASE
        WHEN isnan({column}) THEN 'nan'
        WHEN {size} = double('infinity') THEN if({column} > 0, 'inf', '-inf')
        WHEN {size} = 0 OR ({size} >= 1e-3 AND {size} < 1e7) THEN {text}
        WHEN {size} >= 1e-4 AND {size} < 1e16
            THEN if(endswith({plain}, '.'), concat({plain}, '0'), {plain})
        ELSE concat(regexp_replace(substring_index({text}, 'E', 1), '[.]0$', ''),
                    if({power} < 0, 'e-', 'e+'),
                    lpad(cast(abs({power}) AS string), greatest(2, length(cast(abs({power}) AS string))), '0'))
        END"""


def fixed_text(column: Column, places: int) -> Column:
    """Number with a fixed count of decimals, halves rounded away from zero."""
    return F.round(column.cast("decimal(38,12)"), places).cast(f"decimal(38,{places})").cast("string")
