"""Report sinks: the weekly reports and the competitor matrix as tables.

The reference wrote cells into a workbook; here each report is a Parquet table
stamped with its report id, title, width and run time, replaced per report id
(dynamic partition overwrite), so a rerun of the same report is idempotent.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp(df: DataFrame, report_id: str, title: str, n_weeks: int | None,
          run_ts: _dt.datetime | None = None) -> DataFrame:
    ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return df.select(F.lit(report_id).alias("report_id"), F.lit(title).alias("title"),
                     F.lit(n_weeks).cast("int").alias("n_weeks"),
                     F.lit(ts).cast("timestamp").alias("run_ts"), "*")


def publish_report(report: DataFrame, header: DataFrame, path: str, report_id: str,
                   title: str, n_weeks: int | None,
                   order_by: tuple[str, ...] = ("article",)) -> None:
    """Write the report rows (sorted by ``order_by``, e.g. ascending article) and
    its column header (slot → week, label) under ``path/rows`` and
    ``path/header``, replacing only this report id."""
    keys = [c for c in order_by if c in report.columns]
    if keys:
        report = report.orderBy(*keys)
    for part, df in (("rows", report), ("header", header)):
        (stamp(df, report_id, title, n_weeks).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("report_id")
         .parquet(f"{path}/{part}"))


def publish_competitor_matrix(matrix: DataFrame, columns: DataFrame, spans: DataFrame,
                              path: str, report_id: str, title: str = "Competencias") -> None:
    """Three tables: the long matrix, the column list with dates, the cluster spans."""
    for part, df in (("matrix", matrix), ("columns", columns), ("spans", spans)):
        (stamp(df, report_id, title, None).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("report_id")
         .parquet(f"{path}/{part}"))
