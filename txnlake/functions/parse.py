"""Text to typed values, inside whole-stage code.

The common shape takes a fast path; rare shapes are only looked at where it gives null. The
timestamp parser works in steps with helper columns, so no step's expression is copied into
the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txnlake.functions.text import stripped

# ---------------------------------------------------------------------------
# Fixed patterns: the grammar of numbers and timestamps accepted from raw text.
# ---------------------------------------------------------------------------
PLAIN_NUMBER = r"^[+-]?\d{1,15}(\.\d+)?$"
NUMBER = r"^[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
INFINITE = r"^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"

_OFFSET = r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:[.]\d{1,6})?)?)?)"
_FULL_OFFSET = r"(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2}(?:[.]\d{1,6})?)?)"
COMMON_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+]00:00)?$"
WEEK_DATE = r"^\d{4}(?:-W\d{2}(?:-[1-7])?|W\d{2}[1-7]?)(?=$|\D)"
PLAIN_DATE = r"^(\d{4})(\d{2})(\d{2})(?=$|\D)"
# Any one character may stand between a padded date and its time.
DATE_GAP = r"(?s)^(\d{4}-\d{2}-\d{2}).(?=\d{2})"
STRICT = (
    r"^\d{4}-\d{2}-\d{2}(?: \d{2}(?:(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{2}(?:\d{2}(?:[.,]\d+)?)?)"
    + _OFFSET + r"?)?$"
)
# Unpadded fields are accepted only in these three layouts.
LOOSE_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
LOOSE_SPACE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
LOOSE_T = (
    r"^(\d{4}-\d{1,2}-\d{1,2})T(\d{1,2}:\d{1,2}:\d{1,2}(?:(?:[.]\d{1,6})?" + _FULL_OFFSET + r")?)$"
)
CALENDAR_DATE = (
    r"^\s*(\d{1,6})([-/ \\])(\d{1,2})\2(\d{1,2})(?:[ T]\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d+)?)?\s*$"
)
PARTS = r"^(\S+)(?: ([\d:.,]+)(" + _OFFSET + r")?)?$"


def parse_amount(column: Column) -> Column:
    """Double, or null where the text is no number.

    Single underscores between digits and the words for infinity are accepted. Text that
    spells "not a number" is not an amount.
    """
    body = stripped(column)
    return (
        F.when(body.rlike(PLAIN_NUMBER), body.try_cast("double"))
        .when(body.rlike(NUMBER), F.replace(body, F.lit("_"), F.lit("")).try_cast("double"))
        .when(body.rlike(INFINITE),
              F.when(body.startswith("-"), float("-inf")).otherwise(float("inf")))
    )


def parse_date(column: Column) -> Column:
    """Date from year, month and day with one kind of separator, or null."""
    year = F.regexp_extract(column, CALENDAR_DATE, 1)
    return F.concat(
        F.when(F.length(year) < 4, F.lpad(year, 4, "0")).otherwise(year),
        F.lit("-"), F.regexp_extract(column, CALENDAR_DATE, 3),
        F.lit("-"), F.regexp_extract(column, CALENDAR_DATE, 4)).try_cast("date")


def _week_date(text: Column) -> Column:
    """Date of a year-week[-day] text as text; null when the year has no such week."""
    year = F.substring(text, 1, 4).try_cast("int")
    week = F.regexp_extract(text, r"W(\d{2})", 1).try_cast("int")
    day = F.coalesce(F.regexp_extract(text, r"W\d{2}-?([1-7])", 1).try_cast("int"), F.lit(1))
    first = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    last = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))
    date = F.date_add(first, (week - 1) * 7 + day - 1)
    return F.when((year >= 1) & (week >= 1) & (week <= last), date.cast("string"))


def _two_digits(text: Column, start: int) -> Column:
    return F.coalesce(F.substring(text, start, 2).try_cast("int"), F.lit(0))


def with_timestamp(df: DataFrame, source: str, utc: str, east: str) -> DataFrame:
    """Add `utc` (TIMESTAMP_NTZ in UTC) and `east` (seconds of the written offset).

    Both are null where the text is no timestamp. Text without an offset is taken as UTC.
    """
    body, rare = F.col("_t_body"), F.col("_t_rare")
    trimmed = stripped(F.col(source))
    df = df.withColumn("_t_body", F.when(~trimmed.isin("", "None", "nan"), trimmed))
    df = df.withColumn("_t_common", F.when(body.rlike(COMMON_TIMESTAMP),
                                           body.try_cast("timestamp_ntz")))

    # Rare shapes: spell the date with dashes and put a space before the time.
    text = F.when(body.rlike(WEEK_DATE),
                  F.concat(_week_date(body), F.regexp_replace(body, WEEK_DATE, ""))).otherwise(body)
    text = F.regexp_replace(F.regexp_replace(text, PLAIN_DATE, "$1-$2-$3"), DATE_GAP, "$1 ")
    spelled = (
        F.when(body.rlike(LOOSE_T), F.regexp_replace(body, LOOSE_T, "$1 $2"))
        .when(body.rlike(LOOSE_SPACE) | body.rlike(LOOSE_DATE), body)
        .otherwise(F.regexp_substr(text, F.lit(STRICT)))
    )
    df = df.withColumn("_t_rare", F.when(F.col("_t_common").isNull(), spelled))

    clock = F.regexp_extract(rare, PARTS, 2)
    clock = F.regexp_replace(clock, r"^(\d{2})(\d{2})(\d{2})?(?=$|[.,])", "$1:$2:$3")
    clock = F.replace(F.regexp_replace(clock, r":$", ""), F.lit(","), F.lit("."))
    df = df.withColumns({
        "_t_local": F.when(rare.isNotNull(), F.concat_ws(
            " ", F.regexp_extract(rare, PARTS, 1), F.nullif(clock, F.lit("")))
            .try_cast("timestamp_ntz")),
        "_t_offset": F.regexp_extract(rare, PARTS, 3),
        "_t_digits": F.regexp_replace(F.regexp_extract(rare, PARTS, 3), "[^0-9.]", ""),
    })

    offset, digits = F.col("_t_offset"), F.col("_t_digits")
    seconds = (_two_digits(digits, 1) * 3600 + _two_digits(digits, 3) * 60
               + _two_digits(digits, 5)
               + F.coalesce(F.substring(digits, 7, 7).try_cast("decimal(7,6)"), F.lit(0)))
    signed = F.when(offset.isin("", "Z"), 0).when(
        seconds < 86400, F.when(offset.startswith("-"), -seconds).otherwise(seconds))
    common, local = F.col("_t_common"), F.col("_t_local")
    df = df.withColumn("_t_east", F.when(common.isNotNull(), 0).otherwise(signed)
                       .cast("decimal(12,6)"))
    shift = F.col("_t_east")
    moment = F.when(common.isNotNull(), common).when(shift == 0, local).otherwise(
        local - F.make_dt_interval(secs=shift))
    first_year = F.year(F.coalesce(common, local)) >= 1
    return df.withColumns({
        utc: F.when(first_year, moment),
        east: F.when(first_year & moment.isNotNull(), shift),
    }).drop("_t_body", "_t_common", "_t_rare", "_t_local", "_t_offset", "_t_digits", "_t_east")


def offset_iso_text(utc: str, east: str) -> str:
    """SQL for ISO text in the offset (seconds east) the timestamp was written with."""
    local = f"({utc} + make_dt_interval(0, 0, 0, {east}))"
    micros = f"cast((abs({east}) - floor(abs({east}))) * 1000000 AS int)"
    part = lambda value: f"lpad(cast({value} AS string), 2, '0')"
    whole = f"cast(floor(abs({east})) AS int)"
    return f"""concat(
        date_format({local}, "yyyy-MM-dd'T'HH:mm:ss"),
        if(date_format({local}, 'SSSSSS') = '000000', '', date_format({local}, '.SSSSSS')),
        if({east} < 0, '-', '+'), {part(f'{whole} div 3600')}, ':', {part(f'{whole} div 60 % 60')},
        if({east} % 60 = 0, '', concat(':', {part(f'{whole} % 60')})),
        if({micros} = 0, '', concat('.', lpad(cast({micros} AS string), 6, '0'))))"""


def iso_text(moment: Column, separator: str) -> Column:
    """yyyy-MM-dd HH:mm:ss with six fraction digits only where the fraction is not zero."""
    gap = "'T'" if separator == "T" else " "
    base = f"yyyy-MM-dd{gap}HH:mm:ss"
    return F.when(F.date_format(moment, "SSSSSS") == "000000",
                  F.date_format(moment, base)).otherwise(F.date_format(moment, base + ".SSSSSS"))


def hours_before(moment: Column, hours: int) -> Column:
    return moment - F.make_dt_interval(hours=F.lit(hours))
