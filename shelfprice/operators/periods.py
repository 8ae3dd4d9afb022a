"""Period (week) operators: last-N selection, first-valid values, keep-first /
keep-last dedup, week ranking, slot pivot and week-over-week change.

Design notes (scale):
* order-dependent "first"/"last" use ``min_by``/``max_by`` over an explicit
  ``seq`` ordering column. These are aggregates with map-side partial
  aggregation, so a hot key never collects its rows into one task.
* the set of periods is bounded by the calendar (52 per year) and by ``n``;
  only that set is broadcast, if it isn't per group.
* the change computation runs over per-(key, period) cells, whose count per key
  is bounded by the number of periods, never by the raw row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfprice.functions.dates import week_label
from shelfprice.functions.flags import direction, pct_label, period_ratio
from shelfprice.operators import versions as V


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def _not_null(names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).isNotNull()
    return cond


def last_n_periods(df: DataFrame, period: str, n: int | None,
                   by: Sequence[str] = ()) -> DataFrame:
    """Rows whose period is one of the ``n`` most recent distinct periods
    (per ``by`` group). ``n=None`` keeps every row with a period."""
    if n is None:
        return df.where(F.col(period).isNotNull())
    periods = df.where(_not_null([*by, period])).select(*by, period).distinct()
    w = Window.partitionBy(*by).orderBy(F.col(period).desc())
    keep = periods.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")
    return df.join(by_calendar(keep, by), [*by, period], "left_semi")


def last_n_of_table(spark: SparkSession, path: str, period: str, n: int | None,
                    by: Sequence[str] = ()) -> DataFrame:
    """:func:`last_n_periods` of a table in versions. Where ``period`` and ``by`` are partition
    columns the newest periods come from its manifest and only their folders are read;
    other tables are scanned."""
    v = V.current(spark, path)
    if v is not None and {period, *by} <= set(v.partition_cols):
        return V.read_table_version(spark, path, v.number, V.newest_partitions(v, period, n, by))
    return last_n_periods(V.read_table_version(spark, path, v and v.number), period, n, by)


def by_calendar(periods: DataFrame, by: Sequence[str]) -> DataFrame:
    """A table of periods, hinted for broadcast when it has one row per period (bounded
    by the calendar). With groups its size is theirs too, and the planner decides."""
    return periods if by else F.broadcast(periods)


def first_valid(df: DataFrame, keys: Sequence[str], value: str, seq: str,
                out: str | None = None) -> DataFrame:
    """First non-null ``value`` per key in ``seq`` order; keys whose values are
    all null give no row; rows with a null key are dropped."""
    out = out or value
    v = F.col(value)
    first = F.min_by(v, F.when(v.isNotNull(), F.col(seq)))
    return (df.where(_not_null(keys)).groupBy(*keys).agg(first.alias(out))
            .where(F.col(out).isNotNull()))


def keep_first(df: DataFrame, keys: Sequence[str], cols: Sequence[str], seq: str) -> DataFrame:
    """The whole first row (nulls included) per key, in ``seq`` order."""
    row = F.min_by(F.struct(*_cols(cols)), F.col(seq)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*")


def keep_last(df: DataFrame, keys: Sequence[str], cols: Sequence[str], seq: str) -> DataFrame:
    """The whole last row per key in ``seq`` order; a later null value beats an
    earlier non-null one (values are carried in a struct)."""
    row = F.max_by(F.struct(*_cols(cols)), F.col(seq)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*")


def change_long(cells: DataFrame, keys: Sequence[str], period: str, slot: str,
                value: str, prev: str = "prev_value") -> DataFrame:
    """Long form of the change: one row per present (key, slot) with the value of
    the next older slot (slot + 1) when that cell exists; gaps are not bridged."""
    w = Window.partitionBy(*keys).orderBy(F.col(slot))
    nxt_slot = F.lead(F.col(slot)).over(w)
    nxt_val = F.lead(F.col(value)).over(w)
    out = cells.withColumn(prev, F.when(nxt_slot == F.col(slot) + 1, nxt_val))
    pct = period_ratio(F.col(value), F.col(prev))
    return out.withColumns({
        "pct_change": pct,
        "pct_label": pct_label(pct),
        "direction": direction(pct),
        "prev_is_zero": F.coalesce(F.col(prev) == 0, F.lit(False)),
        "week_label": week_label(F.col(period)),
    })
