"""Data-quality gates: emptiness, single value, required columns, profiles and
reject isolation (bad rows are set aside with a reason; the rest still load)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataQualityError(Exception):
    pass


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise when ``df`` has no rows (reads at most one row)."""
    if df.isEmpty():
        raise DataQualityError(f"{what}: no rows")
    return df


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise DataQualityError(f"missing required columns: {missing}")
    return df


def single_value(df: DataFrame, column: str):
    """The one non-null value of ``column``; raise unless exactly one exists."""
    row = df.agg(F.count_distinct(column).alias("n"), F.max(column).alias("v")).first()
    if row["n"] != 1:
        raise DataQualityError(f"{column}: expected one distinct value, found {row['n']}")
    return row["v"]


def unknown_keys(df: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys are missing from ``dimension``."""
    return df.join(dimension.select(*keys).distinct(), list(keys), "left_anti")


def gate_report(df: DataFrame, key: str, dimension: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The load gates as rows (gate, found, ok), in one pass over ``df`` and a join with
    the dimension: it has rows, exactly one non-null ``key``, all ``columns``, and no key
    that the dimension lacks."""
    missing = len([c for c in columns if c not in df.columns])
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dimension.select(key).distinct().withColumn("_known", F.lit(True))
    found = per_key.join(known, key, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(key).alias("keys"),
        F.count(F.when(F.col(key).isNotNull() & F.col("_known").isNull(), 1)).alias("unknown"))
    gates = (("require_rows", F.col("rows"), F.col("rows") > 0),
             ("single_value", F.col("keys"), F.col("keys") == 1),
             ("require_columns", F.lit(missing).cast("bigint"), F.lit(missing == 0)),
             ("known_keys", F.col("unknown"), F.col("unknown") == 0))
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(g).alias("gate"), n.alias("found"), ok.alias("ok")) for g, n, ok in gates])))


def profile(df: DataFrame, key: str) -> DataFrame:
    """Row count and distinct key count (one row)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct(key).alias("n_distinct"))


def split_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]],
                  reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(valid, rejects). ``rules`` are (reason, bad-row predicate) pairs checked
    in order; a row gets the first reason whose predicate is true."""
    why = F.lit(None).cast("string")
    for name, bad in reversed(list(rules)):
        why = F.when(F.coalesce(bad, F.lit(False)), F.lit(name)).otherwise(why)
    tagged = df.withColumn(reason, why)
    return (tagged.where(F.col(reason).isNull()).drop(reason),
            tagged.where(F.col(reason).isNotNull()))


def label_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]],
                  reason: str = "reject_reason") -> DataFrame:
    """Every row with its first failing rule (null when valid)."""
    why = F.lit(None).cast("string")
    for name, bad in reversed(list(rules)):
        why = F.when(F.coalesce(bad, F.lit(False)), F.lit(name)).otherwise(why)
    return df.withColumn(reason, why)
