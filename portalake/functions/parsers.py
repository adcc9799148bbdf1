"""One parser per column kind: raw text column -> typed column, NULL where unusable.

All are plain column expressions and none can raise under ANSI mode. A parser has two steps,
tidying the text and reading it. Reading names its input several times, so a wide projection
does the two steps in two projections and tidies each value once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from portalake.functions.text import WHITE_SPACE, strip

_DAY = "^(?!0000)[0-9]{8}$"
_MONTH = "^(?!0000)[0-9]{4}(0[1-9]|1[0-2])$"
_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INT = r"^[+-]?[0-9]+$"
_ZERO_FRACTION = r"^[+-]?[0-9]+\.0*$"
# Whole doubles from here up no longer fit 64 bits.
_LONG_LIMIT = 9223372036854775808.0


@dataclass(frozen=True)
class Parser:
    tidy: Callable[[Column], Column]
    read: Callable[[Column], Column]

    def __call__(self, c: Column) -> Column:
        return self.read(self.tidy(c))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _number_text(c: Column) -> Column:
    return strip(F.replace(c, F.lit(","), F.lit("")))


def _read_day(x: Column) -> Column:
    # A cast from ISO text checks the calendar faster than a format pattern does.
    iso = F.overlay(F.overlay(x, F.lit("-"), 7, 0), F.lit("-"), 5, 0)
    return F.when(x.rlike(_DAY) & iso.try_cast("date").isNotNull(), iso)


def _read_month(x: Column) -> Column:
    return F.when(x.rlike(_MONTH), F.overlay(x, F.lit("-"), 5, 0))


def _read_text(x: Column) -> Column:
    return F.when(~x.isin("", "nan", "None"), x)


def _read_integer(x: Column) -> Column:
    value = x.try_cast("double")
    whole = (value % 1 == 0) & (F.abs(value) < _LONG_LIMIT)
    # A try_cast that fails costs an exception, so patterns sort the values first; the usual
    # ones stop at the first line.
    return (F.when(x.rlike(_INT), x.try_cast("bigint"))
            .when(x.rlike(_ZERO_FRACTION), F.substring_index(x, ".", 1).try_cast("bigint"))
            .when(x.rlike(_FLOAT) & whole, value.try_cast("bigint")))


def _read_whole(x: Column) -> Column:
    value = x.try_cast("double")
    whole = (value % 1 == 0) & (F.abs(value) < _LONG_LIMIT)
    exact = "decimal(38,0)"
    return (F.when(x.rlike(_INT), x.try_cast(exact))
            .when(x.rlike(_ZERO_FRACTION), F.substring_index(x, ".", 1).try_cast(exact))
            .when(x.rlike(_FLOAT) & whole, value.try_cast("bigint").cast(exact)))


def _read_ratio(x: Column) -> Column:
    # The pattern keeps out what a cast would also take, such as a hexadecimal number or a
    # type suffix.
    value = x.try_cast("double")
    return F.when(x.rlike(_FLOAT) & (F.abs(value) < float("inf")), value)


# ``20240105`` -> ``2024-01-05``; anything but eight digits of a real date -> NULL.
date_ymd = Parser(strip, _read_day)
# ``202401`` or ``2024.01`` -> ``2024-01``; only the digits count.
date_ym = Parser(_digits, _read_month)
# Stripped text; blank, ``nan`` and ``None`` are missing.
text = Parser(strip, _read_text)
# Exact whole number: ``1,234`` and ``1234.0`` are whole, ``3.8`` is NULL; scientific notation
# counts if its value is whole. Beyond 64 bits -> NULL.
integer = Parser(_number_text, _read_integer)
# The same as DECIMAL(38, 0), for columns whose numbers may pass 64 bits. One in scientific notation
# is a double, and beyond 64 bits not exact: NULL.
whole = Parser(_number_text, _read_whole)
# Finite double; commas dropped.
ratio = Parser(_number_text, _read_ratio)
# Same reading as a ratio; a kind of its own so that schemas say what a column holds.
decimal = ratio

BY_KIND = {
    "date_ymd": date_ymd,
    "date_ym": date_ym,
    "text": text,
    "int": integer,
    "whole": whole,
    "ratio": ratio,
    "decimal": decimal,
}


def out_of_range(tidy: Column) -> Column:
    """Whether a tidied value that was not read is a whole number, so one that is too large for its
    column."""
    value = tidy.try_cast("double")
    return F.coalesce(tidy.rlike(_FLOAT) & (value % 1 == 0) & (F.abs(value) >= _LONG_LIMIT), F.lit(False))


def perhaps_large(tidy: Column) -> Column:
    """A quick look that no number out of range fails: it takes 19 digits or an exponent."""
    return (F.length(tidy) > 18) | tidy.contains("e") | tidy.contains("E")


def whole_number(c: Column) -> Column:
    """Optional sign and digits, blanks around allowed, as BIGINT; anything else -> NULL."""
    x = strip(c)
    return F.when(x.rlike(_INT), x.try_cast("bigint"))


def retry_after(c: Column) -> Column:
    """Seconds form of a Retry-After header; a date form or a negative value -> NULL."""
    seconds = whole_number(c)
    return F.when(seconds >= 0, seconds)


def deal_date(raw: Column) -> Column:
    """``yyyyMMdd`` from the separate year, month and day tokens of a contract row. Where one
    is missing or not a number, or the year has fewer than four digits, the text that comes
    out is no date and is dropped by the date parser."""
    tokens = [raw[t] for t in ("dealYear", "dealMonth", "dealDay")]
    # The usual spelling needs one pattern. Tokens are named seldom here, as the test for a date
    # repeats this expression.
    year, month, day = (F.trim(t) for t in tokens)
    date = F.concat(year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    usual = (F.length(year) == 4) & (F.length(month) <= 2) & (F.length(day) <= 2) & date.rlike("^[1-9][0-9]{7}$")
    parts = F.concat_ws("|", *[F.trim(t, F.lit(WHITE_SPACE)) for t in tokens])
    two_digits = F.regexp_replace(parts, r"\|(?=[0-9](\||$))", "|0")
    unusual = F.regexp_replace(
        two_digits, r"^\+?0*([1-9][0-9]{3})\|\+?0*([0-9]{2})\|\+?0*([0-9]{2})$", "$1$2$3")
    return F.when(usual, date).otherwise(unusual)
