"""Article × (cluster, competitor) price matrix with its column list, the
competitors' last-modified dates and the cluster header spans.

The matrix is produced long — (article, cluster, competitor, col_pos, price) —
because its width grows with the number of competitors; ``matrix_wide`` gives
it in groups of a fixed number of columns.

Columns are keyed by (cluster, competitor) (a competitor present in two
clusters gives two columns) and ordered by (cluster rank, cluster, competitor):
listed clusters first in list order, unlisted ones share rank 999 and are kept
contiguous by the cluster name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.functions.dates import date_text
from shelfprice.operators.periods import last_n_periods
from shelfprice.operators.position import grouped_position
from shelfprice.session import land

ATTRS = ("description", "category", "article_type")
UNLISTED_RANK = 999


def cluster_rank_table(spark: SparkSession, cluster_order: Sequence[str]) -> DataFrame:
    """(cluster, cluster_rank) from the custom order parameter."""
    rows = [(c, i) for i, c in enumerate(cluster_order)]
    return spark.createDataFrame(rows, "cluster string, cluster_rank int")


def competitor_columns(rows: DataFrame, cluster_order: Sequence[str],
                       cluster: str = "cluster", competitor: str = "competitor") -> DataFrame:
    """Distinct (cluster, competitor) of the input with cluster_rank and the
    0-based column position."""
    spark = rows.sparkSession
    pairs = (rows.where(F.col(cluster).isNotNull() & F.col(competitor).isNotNull())
             .select(cluster, competitor).distinct())
    # the order parameter is a literal list of a few names
    ranks = F.broadcast(cluster_rank_table(spark, cluster_order))
    pairs = pairs.join(ranks, cluster, "left").withColumn(
        "cluster_rank", F.coalesce(F.col("cluster_rank"), F.lit(UNLISTED_RANK)))
    return grouped_position(pairs, ["cluster_rank", cluster], [competitor], "col_pos")


def matrix_long(rows: DataFrame, cluster_order: Sequence[str], n_weeks: int | None = 1,
                key: str = "cod_art", value: str = "price", seq: str = "seq") -> DataFrame:
    """One row per (article, cluster, competitor) with a price: the first
    non-null price in input order, the article's attributes (its first input
    row) and the column position. Articles without any price do not appear."""
    if n_weeks is not None:
        rows = last_n_periods(rows, "week", n_weeks)
    v, named = F.col(value), F.col("cluster").isNotNull() & F.col("competitor").isNotNull()
    # one pass over the input: per (article, cluster, competitor) the first price and the
    # first row's attributes with its place; the columns and the article's attributes
    # follow from these cells
    cells = land(rows.groupBy(key, "cluster", "competitor").agg(
        F.min_by(v, F.when(v.isNotNull(), F.col(seq))).alias(value),
        F.min(F.struct(F.col(seq).alias("s"), *[F.col(a) for a in ATTRS])).alias("_f")), "matrix-cells")
    master = cells.groupBy(key).agg(F.min("_f").alias("_m"))
    cols = competitor_columns(cells, cluster_order)
    present = cells.where(named & v.isNotNull() & F.col(key).isNotNull())
    return (present.join(cols, ["cluster", "competitor"])
            .join(master, key)
            .select(key, *[F.col(f"_m.{a}").alias(a) for a in ATTRS], "cluster", "competitor",
                    "cluster_rank", "col_pos", value))


def last_modified(fact: DataFrame, competitor: str = "competencia",
                  date: str = "fecha_modificacion") -> DataFrame:
    """Last-modified date per (cluster, competitor) from the competitor fact
    (non-null dates; the latest wins)."""
    return (fact.where(F.col(date).isNotNull())
            .groupBy("cluster", F.trim(F.col(competitor)).alias("competitor"))
            .agg(F.max(date).alias("modified_on")))


def columns_with_dates(rows: DataFrame, fact: DataFrame, cluster_order: Sequence[str],
                       n_weeks: int | None = 1) -> DataFrame:
    """The matrix column list with each competitor's last-modified date."""
    if n_weeks is not None:
        rows = last_n_periods(rows, "week", n_weeks)
    cols = competitor_columns(rows, cluster_order)
    dates = last_modified(fact)
    return (cols.withColumn("_k", F.trim("competitor"))
            .join(dates.withColumnRenamed("competitor", "_k"), ["cluster", "_k"], "left")
            .drop("_k")
            .withColumn("modified_text", date_text(F.col("modified_on"))))


def header_spans(columns: DataFrame) -> DataFrame:
    """Runs of equal cluster over the ordered columns: (cluster, cluster_rank,
    first_pos, last_pos, n_columns). Clusters are contiguous by construction."""
    return (columns.groupBy("cluster", "cluster_rank")
            .agg(F.min("col_pos").alias("first_pos"), F.max("col_pos").alias("last_pos"),
                 F.count(F.lit(1)).alias("n_columns")))


def matrix_wide(long: DataFrame, width: int = 16, key: str = "cod_art", value: str = "price") -> DataFrame:
    """Wide matrix in groups of ``width`` columns, from one aggregate: a row per article and
    group in which it has a price; column position = ``col_group`` * width + i for ``c{i}``.
    The schema does not depend on the number of competitors."""
    at = F.pmod(F.col("col_pos"), F.lit(width))
    cells = [F.max(F.when(at == i, F.col(value))).alias(f"c{i}") for i in range(width)]
    return long.groupBy(key, *ATTRS, F.floor(F.col("col_pos") / width).cast("int").alias("col_group")).agg(*cells)
