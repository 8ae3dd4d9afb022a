"""Weekly article × week reports (cost, commercial cost, price list).

Plan: a small aggregate picks the ≤ n newest weeks and ranks those having a
value (0 = newest) → that bounded set is broadcast and joined to the input →
ONE aggregate per row key computes every slot's first valid value (``min_by``
over the input order) and the article's first row → week-over-week change as
column arithmetic. One shuffle of partial aggregates; no windows over raw rows;
no driver round trip (the slot list is fixed: 0..n-1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfprice.functions.flags import direction, period_ratio, single_unit_numeric, single_unit_text
from shelfprice.operators.periods import by_calendar, change_long

ATTRS = ("description", "category", "article_type", "unit")
DEFAULT_WEEKS = 4


def week_slots(rows: DataFrame, *, value: str, n: int | None, by: Sequence[str] = (),
               row_keys: Sequence[str] = ("article",), period: str = "week",
               slot: str = "slot") -> DataFrame:
    """The ``n`` newest periods (per ``by`` group; all when ``n`` is None) with
    ``slot`` = rank among those having a valid value (0 = newest; null when the
    period has no value at all, so it drops out of the matrix).

    One small aggregate over the input (the output has one row per period:
    bounded by the calendar, not by the row count)."""
    valid = F.col(value).isNotNull()
    for k in [*by, *row_keys]:
        valid = valid & F.col(k).isNotNull()
    keys_ok = F.col(period).isNotNull()
    for k in by:
        keys_ok = keys_ok & F.col(k).isNotNull()
    per = rows.where(keys_ok).groupBy(*by, period).agg(F.max(valid).alias("_has"))
    if n is not None:
        w = Window.partitionBy(*by).orderBy(F.col(period).desc())
        per = per.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")
    w2 = Window.partitionBy(*by, "_has").orderBy(F.col(period).desc())
    return per.select(*by, period, F.when(F.col("_has"), F.dense_rank().over(w2) - 1)
                      .cast("int").alias(slot))


def period_report(rows: DataFrame, *, value: str, n: int = DEFAULT_WEEKS,
                  row_keys: Sequence[str] = ("article",), master_key: str = "article",
                  attrs: Sequence[str] = ATTRS, by: Sequence[str] = (),
                  period: str = "week", seq: str = "seq", unit_flag=single_unit_numeric,
                  unit: str = "unit") -> DataFrame:
    """Wide report: by..., master_key, attrs (unit last), wk_0..wk_{n-1} (value
    rounded half-even, 0 = newest), pct_k/dir_k/prev_zero_k against slot k+1,
    single_unit flag. Rows: one per row-key combination having any value; the
    attributes come from the first input row of the ``master_key``.

    Plan: the ≤ n week slots are broadcast (bounded by n) and joined to the input
    (semi join + slot); then ONE aggregate per row key computes every slot's first
    valid value and the first row — a single shuffle of partial aggregates."""
    slots = week_slots(rows, value=value, n=n, by=by, row_keys=row_keys, period=period)
    j = rows.join(by_calendar(slots, by), [*by, period], "inner")
    v = F.col(value)
    aggs = [F.min_by(v, F.when((F.col("slot") == k) & v.isNotNull(), F.col(seq))).alias(f"wk_{k}")
            for k in range(n)]
    aggs += [F.min_by(F.struct(*[F.col(a) for a in attrs]), F.col(seq)).alias("_first"),
             F.min(seq).alias("_first_seq")]
    agg = j.groupBy(*by, *row_keys).agg(*aggs)
    if list(row_keys) != [master_key]:
        # first row of the master key across its row-key groups: an aggregate (map-side
        # partial, so a key with many groups is not gathered in one task) joined back
        master = (agg.groupBy(*by, master_key)
                  .agg(F.min_by(F.col("_first"), F.col("_first_seq")).alias("_master")))
        agg = (agg.join(master, [*by, master_key], "left")
               .withColumn("_first", F.col("_master")).drop("_master"))
    keep = F.coalesce(*[F.col(f"wk_{k}") for k in range(n)]).isNotNull()
    for k in [*by, *row_keys]:
        keep = keep & F.col(k).isNotNull()
    # one projection for rounding, changes, flags and attributes (cheap to analyse)
    wk = [F.bround(F.col(f"wk_{k}"), 0) for k in range(n)]
    cols, flags = [], []
    for k in range(n):
        cols.append(wk[k].alias(f"wk_{k}"))
        if k < n - 1:
            cols.append(period_ratio(wk[k], wk[k + 1]).alias(f"pct_{k}"))
    flags += [direction(period_ratio(wk[k], wk[k + 1])).alias(f"dir_{k}") for k in range(n - 1)]
    flags += [F.coalesce(wk[k].isNotNull() & (wk[k + 1] == 0), F.lit(False)).alias(f"prev_zero_{k}")
              for k in range(n - 1)]
    keep_keys = [k for k in row_keys if k not in attrs]
    lead_attrs = [a for a in attrs if a != unit]
    return agg.where(keep).select(
        *by, *keep_keys, *[F.col(f"_first.{a}").alias(a) for a in lead_attrs], *cols,
        F.col(f"_first.{unit}").alias(unit), unit_flag(F.col(f"_first.{unit}")).alias("single_unit"),
        *flags)


def period_long(rows: DataFrame, *, value: str, n: int | None = DEFAULT_WEEKS,
                row_keys: Sequence[str] = ("article",), by: Sequence[str] = (),
                period: str = "week", seq: str = "seq") -> DataFrame:
    """Long form of the same matrix: one row per present (key, week) with the
    rounded value, the value of the next older week slot (no gap bridging), the
    change ratio, its label and direction, and the week label. ``n=None`` runs
    over every week of the input."""
    slots = week_slots(rows, value=value, n=n, by=by, row_keys=row_keys, period=period)
    slots = slots.where(F.col("slot").isNotNull())
    j = rows.join(by_calendar(slots, by), [*by, period], "inner")
    v = F.col(value)
    cells = (j.groupBy(*by, *row_keys, period, "slot")
             .agg(F.min_by(v, F.when(v.isNotNull(), F.col(seq))).alias("value")))
    keep = F.col("value").isNotNull()
    for k in [*by, *row_keys]:
        keep = keep & F.col(k).isNotNull()
    cells = cells.where(keep).withColumn("value", F.bround("value", 0))
    return change_long(cells, [*by, *row_keys], period, "slot", "value")


def weekly_cost_report(rows: DataFrame, n: int = DEFAULT_WEEKS) -> DataFrame:
    return period_report(rows, value="cost", n=n)


def weekly_commercial_report(rows: DataFrame, n: int = DEFAULT_WEEKS) -> DataFrame:
    """One row per (article, description) with values; every row shows the
    article's first description."""
    return period_report(rows, value="commercial_cost", n=n,
                         row_keys=("article", "description"))


def price_list_report(rows: DataFrame, n: int = DEFAULT_WEEKS,
                      list_id: int | None = None, lists: DataFrame | None = None,
                      validate: bool = False) -> DataFrame:
    """Price-list report; every list at once (``list_id`` leading key), or one
    list when ``list_id`` is given (pruned at the scan when the table is
    partitioned by list). With ``validate`` (one list only) the input must be
    non-empty, hold exactly that one list id and, given ``lists``, the id must be
    a known list — three small actions before the plan runs."""
    if list_id is not None:
        rows = rows.where(F.col("list_id") == list_id)
        if validate:
            from shelfprice.operators.quality import (DataQualityError, require_columns,
                                                      require_rows, single_value)
            require_columns(rows, ["unit"])
            require_rows(rows, f"list {list_id}")
            single_value(rows, "list_id")
            if lists is not None and lists.where(F.col("list_id") == list_id).isEmpty():
                raise DataQualityError(f"unknown list id {list_id}")
    return period_report(rows, value="price", n=n, by=("list_id",),
                         unit_flag=single_unit_text)


def report_header(rows: DataFrame, *, value: str, n: int = DEFAULT_WEEKS,
                  by: Sequence[str] = (), row_keys: Sequence[str] = ("article",),
                  period: str = "week") -> DataFrame:
    """(by..., slot, week, week_label) for the column headers of a report."""
    from shelfprice.functions.dates import week_label
    slots = week_slots(rows, value=value, n=n, by=by, row_keys=row_keys, period=period)
    return (slots.where(F.col("slot").isNotNull())
            .withColumn("week_label", week_label(F.col(period))))
