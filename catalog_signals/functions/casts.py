"""Tolerant casts. A value that does not parse becomes NULL instead of failing the job.

The builders take ``(df, name)`` because the right expression depends on the column's type: the same
logical column arrives as text from one source and already typed from another.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Unicode calls white space, plus the four separators U+001C..U+001F.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
#: A time of day, then Z or an offset.
_OFFSET = r":\d{2}(\.\d+)?\s*(Z|UTC|GMT|[+-]\d{2}:?\d{2})$"

#: Money is summed in this type, so that a total does not depend on the order of its rows.
EXACT_MONEY = "decimal(28,6)"


def clean_text(col: Column) -> Column:
    """Strip any leading and trailing white space (``trim`` strips spaces only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def safe_bigint(df: DataFrame, name: str) -> Column:
    """Whole number, or NULL for anything else (``'1.5'``, ``'5d'``, ``'0x1F'``, overflow). ``'7.0'`` is 7.

    For text ``try_cast`` itself takes nothing but a sign, digits and surrounding white space.
    """
    col, dtype = F.col(name), df.schema[name].dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.when(col == F.floor(col), col.try_cast("bigint"))
    if isinstance(dtype, T.StringType):
        whole = F.regexp_replace(col, r"(?<=\d)\.0*(?=\s*$)", "")
        return F.when(F.contains(col, F.lit(".")), whole).otherwise(col).try_cast("bigint")
    return col.try_cast("bigint")


def strict_bigint(name: str) -> Column:
    """Whole number; a malformed value fails the query (ANSI cast)."""
    return F.col(name).cast("bigint")


def safe_timestamp(df: DataFrame, name: str) -> Column:
    """Zone-less timestamp, or NULL for text that is no date.

    A moment, be it a TIMESTAMP or text with an offset, is read as the time in UTC, whatever the zone
    of the session. Text may be ISO, ``6/1/2024``, ``20240601``, ``Jun 1, 2024`` or ``1 June 2024``.
    """
    col, dtype = F.col(name), df.schema[name].dataType
    if isinstance(dtype, T.TimestampType):
        return _in_utc(col)
    if not isinstance(dtype, T.StringType):
        return col.try_cast("timestamp_ntz")
    return F.coalesce(_plain_date(col).try_cast("timestamp_ntz"), _computed_once(clean_text(col), _read_date))


def _plain_date(col: Column) -> Column:
    """ISO text for the usual ways to write a date in digits, whole and without white space, which needs neither
    stripping nor a lambda; all else is left to ``_read_date``, which gives the same for these."""
    def char(at: int) -> Column:
        return F.substring(col, at, 1)

    dashes = (F.length(col) == 10) & (char(5) == "-") & (char(8) == "-")
    slashes = (F.length(col) == 10) & (char(3) == "/") & col.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$")
    digits = (F.length(col) == 8) & col.rlike("^[0-9]{8}$")
    by_slash = F.concat_ws("-", F.substring(col, 7, 4), F.substring(col, 1, 2), F.substring(col, 4, 2))
    by_place = F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2))
    return F.when(dashes, col).when(slashes, by_slash).when(digits, by_place)


def _computed_once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value computed once however often it is referred to.

    A filter on the result is pushed below the projections that make the value, and has a copy of it
    for every reference; the argument of a lambda stays one.
    """
    return F.transform(F.array(value), then)[0]


def _read_date(text: Column) -> Column:
    """Plain ISO text is the common case and takes one cast; offsets need a colon to be looked for."""
    moment = F.contains(text, F.lit(":")) & text.rlike(_OFFSET)
    local = F.coalesce(text.try_cast("timestamp_ntz"), _other_formats(text).try_cast("timestamp_ntz"))
    return F.when(moment, _in_utc(text.try_cast("timestamp"))).otherwise(local)


def _other_formats(text: Column) -> Column:
    """ISO text for the other ways to write a date. Only what is no ISO text comes here, and a look at its
    characters decides which one expression it goes through."""
    numbers = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    slashes = F.regexp_replace(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})\b", "$3-$1-$2")
    month_first = F.regexp_replace(text, r"^([A-Za-z]{3})[a-z]*\.? (\d{1,2}),? (\d{4})\b", "$3-$1-$2")
    day_first = F.regexp_replace(text, r"^(\d{1,2}) ([A-Za-z]{3})[a-z]*\.? (\d{4})\b", "$3-$2-$1")
    return (
        F.when(F.contains(text, F.lit("/")), slashes)
        .when(text >= "A", _month_number(month_first))
        .when((F.length(text) == 8) & (text.try_cast("int") > 0), numbers)
        .when(F.contains(text, F.lit(" ")), _month_number(day_first))
    )


def _month_number(iso: Column) -> Column:
    """``2024-Jun-1`` with the month as a number, 0 if there is no such month."""
    month = F.lower(F.substring(iso, 6, 3))
    number = F.floor((F.instr(F.lit(_MONTHS), month) + 3) / 4)
    return F.concat(F.substring(iso, 1, 5), number.cast("string"), F.substring(iso, 9, 100))


def _in_utc(moment: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), epoch)


def is_true(df: DataFrame, name: str) -> Column:
    """True for boolean true or numeric 1, false for everything else, NULL and text included."""
    col, dtype = F.col(name), df.schema[name].dataType
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(col, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(col == 1, F.lit(False))
    return F.lit(False)


def parse_money(df: DataFrame, name: str) -> Column:
    """Accounting text to a double: ``'$1,200.50'`` is 1200.5, ``'($45)'`` is -45.

    Parentheses around the whole text, once ``,`` and ``$`` are gone, mean a negative amount. ``nan``
    and ``inf`` are no amounts, nor is what is too large for a double.
    """
    if isinstance(df.schema[name].dataType, T.NumericType):
        amount = F.col(name).cast("double")
        return F.when(F.abs(amount) < float("inf"), amount)
    # digits and points between blanks are the common case; 300 of them are no infinite number
    bare = F.replace(F.replace(F.col(name), F.lit("$"), F.lit("")), F.lit(","), F.lit(""))
    plain = F.when(bare.rlike(r"^ *[0-9.]{1,300} *$"), bare.try_cast("double"))
    return F.coalesce(plain, _computed_once(F.translate(clean_text(F.col(name)), ",$", ""), _read_money))


def _read_money(text: Column) -> Column:
    digits = F.translate(text, "()", "")
    number = F.when(digits.rlike(DECIMAL), digits.try_cast("double"))
    bracketed = text.startswith("(") & text.endswith(")")
    return _computed_once(
        number, lambda n: F.when(F.abs(n) < float("inf"), F.when(bracketed, -F.abs(n)).otherwise(n))
    )


def as_timestamp(moment: dt.datetime | str) -> Column:
    """The run's reference time as a zone-less timestamp literal."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def years_before(moment: dt.datetime | str, years: int) -> Column:
    """``moment`` minus whole years, keeping the time of day (29 February becomes the 28th)."""
    return as_timestamp(moment) - F.make_ym_interval(F.lit(years))


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods between two zone-less timestamps (23:00 to 01:00 is 0 days)."""
    return F.extract(F.lit("DAY"), end - start)
