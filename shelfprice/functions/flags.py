"""Report flags (what the spreadsheet colours were based on) as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfprice.functions.text import ColumnOrName, _col, to_number


def round_half_even(c: ColumnOrName, scale: int = 0) -> Column:
    return F.bround(_col(c).cast("double"), scale)


def period_ratio(cur: ColumnOrName, prev: ColumnOrName) -> Column:
    """(cur - prev) / prev; null when either side is missing or prev is 0."""
    p = _col(prev)
    return F.try_divide(_col(cur) - p, F.when(p != 0, p))


def shown_percent(c: ColumnOrName) -> Column:
    """Ratio as a percentage rounded to the 3 decimals shown, half even on the exact
    binary value of ratio * 100."""
    return round_half_even_exact(_col(c) * 100, 3)


def pct_label(c: ColumnOrName) -> Column:
    """Ratio as a percent label with 3 decimals ('12.500%'); null → ''."""
    return F.when(_col(c).isNotNull(), F.format_string("%.3f%%", shown_percent(c))).otherwise(F.lit(""))


def direction(c: ColumnOrName) -> Column:
    """+1 / -1 / 0 from the percent shown with 3 decimals; null stays null."""
    return F.signum(shown_percent(c)).cast("int")


def single_unit_numeric(c: ColumnOrName) -> Column:
    """Cost reports: the unit value truncates to 1."""
    return F.coalesce(to_number(c).try_cast("bigint") == 1, F.lit(False))


def single_unit_text(c: ColumnOrName) -> Column:
    """Price lists: the unit text starts with '1-'."""
    s = F.upper(F.trim(_col(c).cast("string")))
    return F.coalesce(s.startswith("1-"), F.lit(False))


def ends_in_99(c: ColumnOrName) -> Column:
    """Integer part of the price ends in 99 (sign ignored)."""
    return F.abs(_col(c).cast("double").try_cast("bigint")) % 100 == 99


def sign_class(c: ColumnOrName) -> Column:
    """-1 / 0 / +1; null → null."""
    return F.signum(_col(c)).cast("int")


def valid_price(c: ColumnOrName, round_first: bool) -> tuple[Column, Column]:
    """(value, keep) for the 'sin IVA' gate: numeric, non-null, non-zero.
    With ``round_first`` the value is rounded half-even before the test."""
    x = to_number(c)
    if round_first:
        x = F.bround(x, 0)
    return x, x.isNotNull() & (x != 0)


# Veltkamp splitting constant (2^27 + 1) for the exact product error below
_SPLITTER = 134217729.0


def _product_error(a: Column, b: float) -> Column:
    """e such that a*b == fl(a*b) + e exactly (Dekker's two-product; plain IEEE
    double arithmetic, which Spark evaluates without re-association)."""
    p = a * b
    c = a * _SPLITTER
    ah = c - (c - a)
    al = a - ah
    bc = b * _SPLITTER
    bh = bc - (bc - b)
    bl = b - bh
    return ((ah * bh - p) + ah * bl + al * bh) + al * bl


def round_half_even_exact(c: ColumnOrName, scale: int) -> Column:
    """Round a double half-even on its exact binary value (what Python's
    ``round(x, n)`` does): 94.67875 is stored just below the tie, so it rounds
    down. ``bround`` would round the shortest decimal text instead."""
    x = _col(c).cast("double")
    m = float(10 ** scale)
    p = x * m
    err = _product_error(x, m)
    fl = F.floor(p).cast("double")
    tie = (p - fl) == 0.5
    r = (F.when(tie & (err > 0), fl + 1)
         .when(tie & (err < 0), fl)
         .otherwise(F.rint(p)))
    return r / m
