"""Weekly fact refresh: price history → weekly price fact, cost rows → weekly
cost fact, run in order (prices, then costs), each step's outcome appended to a
run log.

Two ways to refresh: :func:`refresh_weekly` makes the facts of all rows it is given;
:func:`refresh_changed` remakes only the weeks that loads have touched since the fact was
last made. For the latter the history is a table in versions by week: its manifests and
the load ids noted in them are the ledger, so touched weeks are found without reading rows.

The warehouse procedures behind the reference's refresh are not public; the
semantics here are an explicit assumption: for each key and week, the last
value dated within that week wins (ties broken by the load order).
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.functions.dates import week_start
from shelfprice.operators import versions as V


def weekly_last(rows: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str],
                seq: str = "seq", week: str = "week") -> DataFrame:
    """Per (keys, week of ``ts``): the values of the row with the latest
    (``ts``, ``seq``), that timestamp, and the number of rows in the week.
    One partial-aggregated shuffle on (keys, week)."""
    order = F.struct(F.col(ts), F.col(seq))
    last = F.max_by(F.struct(*[F.col(v) for v in values], F.col(ts).alias("_ts")), order)
    out = (rows.where(F.col(ts).isNotNull())
           .groupBy(*keys, week_start(ts).alias(week))
           .agg(last.alias("_l"), F.count(F.lit(1)).alias("n_rows")))
    return out.select(*keys, week, *[F.col(f"_l.{v}").alias(v) for v in values],
                      F.col("_l._ts").alias(f"last_{ts}"), "n_rows")


def weekly_price_fact(history: DataFrame) -> DataFrame:
    return weekly_last(history, ["id_lista", "cod_art"], "fecha", ["precio"])


def weekly_cost_fact(rows: DataFrame) -> DataFrame:
    """Per (article, week): the costs of the last row of the week in load order."""
    last = F.max_by(F.struct("cost", "commercial_cost"), F.col("seq"))
    return (rows.where(F.col("week").isNotNull() & F.col("article").isNotNull())
            .groupBy("article", "week")
            .agg(last.alias("_l"), F.count(F.lit(1)).alias("n_rows"))
            .select("article", "week", "_l.cost", "_l.commercial_cost", "n_rows"))


RUN_LOG_SCHEMA = "run_id string, step string, status string, started_at timestamp, " \
                 "seconds double, message string"


def run_steps(spark: SparkSession, steps: Sequence[tuple[str, Callable[[], None]]],
              log_path: str, run_id: str | None = None) -> DataFrame:
    """Run the steps in order, stopping at the first failure; append one row per
    attempted step (OK / ERROR, elapsed seconds) to the run log at ``log_path``.
    Returns the rows appended."""
    run_id = run_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    rows = []
    for name, fn in steps:
        started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        t0 = time.monotonic()
        try:
            fn()
            rows.append((run_id, name, "OK", started, time.monotonic() - t0, ""))
        except Exception as e:  # noqa: BLE001 - the failure is the logged outcome
            rows.append((run_id, name, "ERROR", started, time.monotonic() - t0, str(e)))
            break
    log = spark.createDataFrame(rows, RUN_LOG_SCHEMA)
    log.write.mode("append").parquet(log_path)
    return log


def refresh_weekly(spark: SparkSession, history: DataFrame, costs: DataFrame, path: str,
                   run_id: str | None = None) -> DataFrame:
    """The weekly refresh as a batch: write the price fact, then the cost fact, each
    replacing the weeks it holds, and the run log; a failed step ends the run."""
    def write(fact: DataFrame, name: str) -> None:
        # rows of a week meet before the write: one file each, not one per task and week
        (fact.repartition("week").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("week").parquet(f"{path}/{name}"))
    return run_steps(spark, [
        ("price_fact", lambda: write(weekly_price_fact(history), "price_fact")),
        ("cost_fact", lambda: write(weekly_cost_fact(costs), "cost_fact")),
    ], f"{path}/run_log", run_id)


def by_week(rows: DataFrame, week: str = "week") -> DataFrame:
    """Rows of a week meet before a write by week: a few files each, not one per task and
    week. A week too large for one task is split by size."""
    return rows.hint("rebalance", F.col(week))


def append_load(rows: DataFrame, path: str, load_id: str, week: str = "week", before_switch=None) -> V.Version:
    """Add the rows of a load to the history at ``path``, a table in versions by ``week``. The
    load's id is noted in the version that adds it: a load that comes again, after a writer
    died or by mistake, adds nothing. Of two loads at once one fails (``VersionConflict``)."""
    base = V.current(rows.sparkSession, path)
    loads = base.notes.get("loads", []) if base else []
    if load_id in loads:
        return base
    return V.commit(by_week(rows, week), path, [week], append=True, base=base, before_switch=before_switch,
                    notes={"loads": [*loads, load_id]})


def refresh_changed(spark: SparkSession, source: str, path: str, fact: Callable[[DataFrame], DataFrame],
                    week: str = "week", before_switch=None) -> V.Version | None:
    """Bring the fact at ``path`` up to date with the history at ``source``: only weeks whose
    files changed since the version it was made from (noted with the fact) are read and
    replaced; None where there are none. ``fact`` makes a week's rows from that week's rows.
    Without a fact yet, or where that version has been cleared, all weeks are made."""
    src, base = V.current(spark, source), V.current(spark, path)
    if src is None:
        raise FileNotFoundError(f"no version of a table in {source}")
    done = base.notes.get("source_version") if base else None
    if done in V.version_numbers(spark, source):
        weeks = V.changed_partitions(spark, source, done, src.number)
        if not weeks:
            return None
        replaced = weeks
    else:
        weeks, replaced = None, [dict(zip(base.partition_cols, values)) for values, _ in base.parts] if base else None
    rows = V.read_table_version(spark, source, src.number, weeks)
    return V.commit(by_week(fact(rows), week), path, [week], replaced=replaced, base=base, before_switch=before_switch,
                    notes={"source_version": src.number})


def refresh_weekly_changed(spark: SparkSession, prices: str, costs: str, path: str, run_id: str | None = None) -> DataFrame:
    """The weekly refresh from two histories in versions, prices then costs, touched weeks
    only, with the run log; a failed step ends the run."""
    return run_steps(spark, [
        ("price_fact", lambda: refresh_changed(spark, prices, f"{path}/price_fact", weekly_price_fact)),
        ("cost_fact", lambda: refresh_changed(spark, costs, f"{path}/cost_fact", weekly_cost_fact)),
    ], f"{path}/run_log", run_id)
