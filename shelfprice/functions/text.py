"""Text and number cleaning as Spark column expressions (all JVM-side).

Every function takes a Column (or a column name) and returns a Column, so the
expressions stay inside whole-stage codegen and compose in select/where.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# Fixed values (must equal the reference's behaviour):
# a plain decimal number, optional sign and exponent; nothing else counts as numeric
NUMERIC_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# characters that may not appear in a file name
UNSAFE_NAME_PATTERN = r'[\\/:*?"<>|]'
# separators of a multi-valued cell
LIST_SEPARATORS = "[;,]"

PRICE_TYPE = T.DecimalType(18, 4)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: ColumnOrName) -> Column:
    """Numeric coercion, bad → null (text is trimmed; only plain decimals pass,
    so 'nan', 'inf', '5d' and '1_0' are all invalid)."""
    s = F.trim(_col(c).cast("string"))
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))


def blank_to_null(c: ColumnOrName) -> Column:
    """'' (after trim) → null; other text unchanged."""
    s = _col(c).cast("string")
    return F.when(F.trim(s) != "", s)


def clean_str(c: ColumnOrName) -> Column:
    """Null or 'nan' → ''; otherwise trimmed text."""
    s = F.trim(_col(c).cast("string"))
    return F.when(s.isNull() | (F.lower(s) == "nan"), F.lit("")).otherwise(s)


def norm_key(c: ColumnOrName) -> Column:
    """Collapse whitespace runs, trim, lower case; null → ''."""
    s = F.coalesce(_col(c).cast("string"), F.lit(""))
    return F.lower(F.trim(F.regexp_replace(s, r"\s+", " ")))


def safe_name(c: ColumnOrName) -> Column:
    """Path-safe text: trim, unsafe characters → '_', whitespace runs → one space."""
    s = F.trim(_col(c).cast("string"))
    return F.regexp_replace(F.regexp_replace(s, UNSAFE_NAME_PATTERN, "_"), r"\s+", " ")


def strip_cluster_word(c: ColumnOrName, upper: bool = False) -> Column:
    """Remove the word CLUSTER (case-sensitive) and trim; optionally upper-case first."""
    s = _col(c).cast("string")
    if upper:
        s = F.upper(s)
    return F.trim(F.replace(s, F.lit("CLUSTER"), F.lit("")))


def split_list(c: ColumnOrName) -> Column:
    """Split a multi-valued cell on ';' or ',', trim the parts, drop blanks."""
    s = clean_str(c)
    parts = F.transform(F.split(s, LIST_SEPARATORS), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def code_or_zero(c: ColumnOrName) -> Column:
    """Article code: numeric text truncated to an integer; bad or missing → 0."""
    return F.coalesce(to_number(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def code_or_null(c: ColumnOrName) -> Column:
    """Article code: numeric text truncated to an integer; bad → null (row dropped later)."""
    return to_number(c).try_cast("bigint")


def clean_price(c: ColumnOrName) -> Column:
    """Price text → decimal(18,4).

    Numbers pass through. Text is trimmed, '$' and spaces removed; with both ','
    and '.', the dots are thousands separators and the comma is the decimal mark;
    with only ',', it is the decimal mark; with only '.', it is the decimal point.
    Zero, blank, unparsable and out-of-range values give null; 4 decimals, half even.

    On a DataFrame prefer :func:`with_clean_price`, which parses once and rounds
    in a second projection (the rounding reads its input several times).
    """
    return price_from_double(parse_price_text(c))


def _strip_price(c: ColumnOrName) -> Column:
    s = F.trim(_col(c).cast("string"))
    return F.replace(F.replace(s, F.lit("$"), F.lit("")), F.lit(" "), F.lit(""))


def _normalise_separators(s: Column) -> Column:
    has_comma = F.instr(s, ",") > 0
    has_dot = F.instr(s, ".") > 0
    return (F.when(has_comma & has_dot,
                   F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
            .when(has_comma, F.replace(s, F.lit(","), F.lit(".")))
            .otherwise(s))


def _plain_to_double(s: Column) -> Column:
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))


def parse_price_text(c: ColumnOrName) -> Column:
    """The text → double step of :func:`clean_price` (null when unparsable)."""
    return _plain_to_double(_normalise_separators(_strip_price(c)))


def with_clean_price(df, source: str, out: str):
    """``df`` plus ``out`` = clean_price(``source``). Each stage is its own
    projection, so every intermediate value is computed once per row (inside
    CASE branches Catalyst would otherwise re-evaluate the shared parts)."""
    a, b, v = f"_{out}_s", f"_{out}_n", f"_{out}_v"
    return (df.withColumn(a, _strip_price(source))
              .withColumn(b, _normalise_separators(F.col(a)))
              .withColumn(v, _plain_to_double(F.col(b)))
              .withColumn(out, price_from_double(F.col(v))).drop(a, b, v))


def price_from_double(value: Column) -> Column:
    """0 → null; half-even to 4 decimals (on the exact binary value); values
    outside decimal(18,4) → null."""
    from shelfprice.functions.flags import round_half_even_exact
    rounded = round_half_even_exact(value, 4)
    return F.when(value != 0, rounded.try_cast(PRICE_TYPE))


def clean_price_number(c: ColumnOrName) -> Column:
    """The numeric branch of :func:`clean_price` for a double column."""
    return price_from_double(_col(c).cast("double"))


def normalise_ratio(c: ColumnOrName) -> Column:
    """'vs previous list' text → ratio: drop '%', ',' → '.', numeric;
    values with |x| > 1 are percentages and are divided by 100."""
    s = F.replace(F.replace(_col(c).cast("string"), F.lit("%"), F.lit("")),
                  F.lit(","), F.lit("."))
    x = to_number(s)
    return F.when(F.abs(x) <= 1, x).otherwise(x / 100)
