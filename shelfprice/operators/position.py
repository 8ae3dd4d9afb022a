"""Dense 0-based position of every row within and across groups, without a window
over all rows: rows are numbered inside their group, and a group is shifted by the
sizes of the groups before it. Both depend on values only, not on how Spark deals
the rows out or whether it runs a stage twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def grouped_position(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                     name: str = "pos") -> DataFrame:
    """Add ``name`` = 0-based rank of each row ordered by ``group_cols``, then
    ``order_cols`` (rows should be distinct on both). The offsets come from one row
    per group, so ``group_cols`` should be a short dimension."""
    inside = Window.partitionBy(*group_cols).orderBy(*order_cols)
    before = Window.orderBy(*group_cols).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (df.withColumn("_in", F.row_number().over(inside) - 1)
            .join(offsets, list(group_cols))
            .withColumn(name, (F.col("_off") + F.col("_in")).cast("int"))
            .drop("_off", "_in"))
