"""Date and time column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfprice.functions.text import ColumnOrName, _col

# Layouts of date text: day first with / - or . between, or year first with - or /;
# years of two or four digits, an optional time, optional seconds and fraction.
DAYFIRST_TEXT = r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4}|\d{2})(?:[ T]+(\d{1,2}):(\d{2})(?::(\d{2})(\.\d+)?)?)?$"
YEARFIRST_TEXT = r"^(\d{4})([/-])(\d{1,2})\2(\d{1,2})(?:[ T]+(\d{1,2}):(\d{2})(?::(\d{2})(\.\d+)?)?)?$"
# week label and export date layouts
WEEK_LABEL_PATTERN = "dd-MMM"
DATE_TEXT_PATTERN = "dd/MM/yyyy"


def _two_digit_year(y: Column) -> Column:
    """Two-digit years count from 1969 to 2068, like strptime's."""
    return F.when(F.length(y) == 2, F.concat(F.when(y.cast("int") < 69, "20").otherwise("19"), y)).otherwise(y)


def parse_dayfirst(c: ColumnOrName) -> Column:
    """Timestamp without zone from a date or timestamp value, or from text by pattern;
    bad text → null. Text is taken apart once, so no parse fails by exception, and no
    session zone takes part."""
    s = F.trim(_col(c).cast("string"))
    day = F.regexp_replace(s, DAYFIRST_TEXT, "$4|$3|$1|$5|$6|$7|$8")
    year = F.regexp_replace(s, YEARFIRST_TEXT, "$1|$3|$4|$5|$6|$7|$8")
    parts = F.split(F.when(s.rlike(DAYFIRST_TEXT), day).when(s.rlike(YEARFIRST_TEXT), year), r"\|")
    clock = [F.when(F.get(parts, F.lit(i)) == "", "0").otherwise(F.get(parts, F.lit(i))) for i in (3, 4, 5)]
    text = F.concat(_two_digit_year(F.get(parts, F.lit(0))), F.lit("-"), F.get(parts, F.lit(1)), F.lit("-"),
                    F.get(parts, F.lit(2)), F.lit(" "), clock[0], F.lit(":"), clock[1], F.lit(":"), clock[2],
                    F.substring(F.get(parts, F.lit(6)), 1, 7))
    return text.try_cast("timestamp_ntz")


def floor_minute(c: ColumnOrName) -> Column:
    return F.date_trunc("minute", _col(c))


def week_start(c: ColumnOrName) -> Column:
    """Monday of the week, as a DATE."""
    return F.date_trunc("week", _col(c)).cast("date")


def calendar_year_iso_week(c: ColumnOrName, iso_year: bool = False) -> tuple[Column, Column]:
    """(year, ISO week). By default the calendar year is paired with the ISO week,
    so 2024-12-30 is (2024, 1); ``iso_year=True`` gives the ISO week-numbering year."""
    d = _col(c).cast("date")
    year = F.extract(F.lit("YEAROFWEEK"), d) if iso_year else F.year(d)
    return year.cast("int"), F.weekofyear(d).cast("int")


def week_label(c: ColumnOrName) -> Column:
    """'dd-mmm' lower case, e.g. '05-jan' (display only: no year)."""
    return F.lower(F.date_format(_col(c), WEEK_LABEL_PATTERN))


def date_text(c: ColumnOrName) -> Column:
    return F.date_format(_col(c), DATE_TEXT_PATTERN)
