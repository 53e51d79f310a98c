"""Scalar cleaning rules as Spark Column expressions (all JVM-side, codegen'd).

Each function takes a column (name or Column) and returns a Column, so rules
compose inside one ``select`` and stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Decimal widths, date formats and the reporting time zone.
AMOUNT_TYPE = "decimal(14,2)"
PERCENT_TYPE = "decimal(7,4)"
DATE_PLAIN = "MMddyyyy"          # 01152024
DATE_SLASH = "M/d/yyyy"          # 01/15/2024 and 1/15/2024
# MMDDYYYY that is a date in every year, and what no text of an integer holds.
_EVERY_YEAR = ("^(?:(?:0[13578]|1[02])(?:0[1-9]|[12][0-9]|3[01])|(?:0[469]|11)(?:0[1-9]|[12][0-9]|30)"
               "|02(?:0[1-9]|1[0-9]|2[0-8]))[0-9]{4}\\z")
_NO_INTEGER = "[!-*,./:-~]"
REPORTING_TZ = "America/Los_Angeles"
PREVIEW_CHARS = 5000
BULK_BASE_URL = "https://www.fec.gov/files/bulk-downloads"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: ColumnOrName) -> Column:
    """Strip spaces only (tabs and other whitespace stay)."""
    return F.trim(_col(c))


def zip5(c: ColumnOrName) -> Column:
    """First five characters after trimming; NULL stays NULL, blank stays ''."""
    return F.left(F.trim(_col(c)), F.lit(5))


def blank_to_null(c: ColumnOrName) -> Column:
    """Trimmed text, blank turned into NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def amount(c: ColumnOrName, rounded: bool = False) -> Column:
    """Money as decimal(14,2); half-up at the cast, bad text or overflow -> NULL.

    ``rounded`` mirrors the extra ``round(.., 2)`` of the contribution model;
    Spark widens ``round`` to (15,2), so the result is cast back.
    """
    value = blank_to_null(c).try_cast(AMOUNT_TYPE)
    if rounded:
        value = F.round(value, 2).cast(AMOUNT_TYPE)
    return value


def percent(c: ColumnOrName) -> Column:
    """P5: percentage as decimal(7,4)."""
    return blank_to_null(c).try_cast(PERCENT_TYPE)


def to_bigint(c: ColumnOrName) -> Column:
    """Identifier as bigint; only clean digits survive (no fractions, exponents).

    Text with letters or other marks is not handed to the cast: a cast that fails
    makes an error with its message first, at a hundred times the time of one that does not.
    """
    t = blank_to_null(c)
    return F.when(~t.rlike(_NO_INTEGER), t).try_cast("bigint")


def year4(c: ColumnOrName) -> Column:
    """A year only when the trimmed text has exactly four characters."""
    t = F.trim(_col(c))
    return F.when(F.length(t) == 4, t).try_cast("smallint")


def _plain_date(t: Column) -> Column:
    """``try_to_date`` by MMDDYYYY. Eight characters are a date by their digits alone, or
    on 29 February; fewer never are, and more only with a sign before the year."""
    iso = F.concat_ws("-", F.substring(t, 5, 4), F.substring(t, 1, 2), F.substring(t, 3, 2))
    return (F.when(t.rlike(_EVERY_YEAR), iso.try_cast("date"))
            .when((F.length(t) > 8) | t.startswith("0229"), F.try_to_date(t, DATE_PLAIN)))


def date_mmddyyyy(c: ColumnOrName) -> Column:
    """MMDDYYYY text to a date; anything else -> NULL."""
    return _plain_date(blank_to_null(c))


def date_two_formats(c: ColumnOrName) -> Column:
    """Slash form first (one or two digit month/day), then MMDDYYYY."""
    t = blank_to_null(c)
    return F.when(t.contains("/"), F.try_to_date(t, DATE_SLASH)).otherwise(_plain_date(t))


def text_length(c: ColumnOrName) -> Column:
    """P10: characters (code points), as bigint."""
    return F.length(_col(c)).cast("bigint")


def cycle_of(date_col: ColumnOrName) -> Column:
    """Two-year cycle ending in the even year: year + year % 2."""
    y = F.year(_col(date_col))
    return (y + y % 2).cast("int")


def preview(c: ColumnOrName, n: int = PREVIEW_CHARS) -> Column:
    """The first ``n`` characters."""
    return F.substring(_col(c), 1, n)


def source_url(file_type: ColumnOrName, cycle: ColumnOrName, base: str = BULK_BASE_URL) -> Column:
    """``<base>/<cycle>/<type><yy>.zip`` with a two-digit year."""
    cyc = _col(cycle).cast("string")
    return F.concat(F.lit(base + "/"), cyc, F.lit("/"), _col(file_type), F.right(cyc, F.lit(2)), F.lit(".zip"))


def local_date(ts: ColumnOrName, tz: str = REPORTING_TZ) -> Column:
    """The reporting-zone calendar date of a UTC wall-clock ``timestamp_ntz``.

    ``convert_timezone`` works on wall clocks, so the answer does not depend
    on the session time zone.
    """
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), _col(ts)))


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(ts: ColumnOrName) -> Column:
    """Microseconds since the epoch of a UTC wall-clock ``timestamp_ntz`` (session zone ignored)."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), _col(ts))


def from_epoch_micros(us: ColumnOrName) -> Column:
    """The UTC wall-clock ``timestamp_ntz`` of epoch microseconds (session zone ignored)."""
    return F.timestamp_add("MICROSECOND", _col(us), _epoch_ntz())


# Rule names used by the staging rule maps.
RULES = {
    "trim": trim_spaces,
    "zip5": zip5,
    "blank_null": blank_to_null,
    "amount": amount,
    "amount_round": lambda c: amount(c, rounded=True),
    "percent": percent,
    "bigint": to_bigint,
    "year": year4,
    "date": date_mmddyyyy,
    "date2": date_two_formats,
}


def apply_rule(rule: str, c: ColumnOrName) -> Column:
    if rule == "pass":
        return _col(c)
    return RULES[rule](c)
