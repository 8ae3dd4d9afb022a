"""SQL (DuckDB) scalar expressions shared by the oracle and the stand-in SQL."""

from __future__ import annotations

# to_number(): plain decimal text only, else NULL; integers truncate like a cast in Spark
NUM_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(x: str) -> str:
    t = f"trim(CAST({x} AS VARCHAR))"
    return f"(CASE WHEN regexp_matches({t}, '{NUM_RE}') THEN TRY_CAST({t} AS DOUBLE) END)"


def trunc_bigint(x: str) -> str:
    return f"TRY_CAST(trunc({x}) AS BIGINT)"


def round_exact(v: str, scale: int) -> str:
    """Half-even rounding on the exact binary value, via the two-product error."""
    m = float(10 ** scale)
    sp = 134217729.0
    p = f"(({v}) * {m})"
    c = f"(({v}) * {sp})"
    ah = f"({c} - ({c} - ({v})))"
    al = f"(({v}) - {ah})"
    bc = m * sp
    bh = bc - (bc - m)
    bl = m - bh
    err = f"((({ah} * {bh} - {p}) + {ah} * {bl} + {al} * {bh}) + {al} * {bl})"
    fl = f"floor({p})"
    tie = f"(({p} - {fl}) = 0.5)"
    return (f"((CASE WHEN {tie} AND {err} > 0 THEN {fl} + 1 WHEN {tie} AND {err} < 0 THEN {fl} "
            f"ELSE round_even({p}, 0) END) / {m})")


def price_from_double(v: str) -> str:
    return f"(CASE WHEN {v} <> 0 THEN TRY_CAST({round_exact(v, 4)} AS DECIMAL(18,4)) END)"
