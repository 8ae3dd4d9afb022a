"""Keyed loads into fact tables: insert-if-absent, upsert, load counts and
idempotent replacement of (year, week) slices.

The reference applied one MERGE statement per source row. Applied in order,
those statements have a closed form that Spark computes in one pass:

* insert-only: the first source row of each key is inserted if the key is
  absent; every later row of that key is skipped;
* upsert: the descriptive columns come from the target row, or from the first
  source row when the key is new; the update columns come from the last source
  row of the key.

Both are a ``groupBy(keys)`` with ``min_by``/``max_by`` over the load order
(partial aggregation, so a key repeated a million times costs one row per map
task) followed by one join with the target on the keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfprice.operators import versions as V

# The price-history fact (column order of the target table) and its key
HISTORY_COLUMNS = ("origen", "id_lista", "lista", "fecha", "product_id", "cod_art",
                   "producto", "precio", "uom", "unidad_me", "invoicing_type",
                   "contenido", "box_kgs", "precioxkg", "ing_hora")
HISTORY_KEYS = ("id_lista", "cod_art", "fecha")
HISTORY_UPDATE_COLS = ("precio", "precioxkg", "ing_hora")
# the competitor fact: row key and replaced slice
COMPETITOR_COLUMNS = ("cod_art", "cluster", "competencia", "precio", "anio", "semana",
                      "fecha_modificacion")
COMPETITOR_KEYS = ("cod_art", "cluster", "competencia", "anio", "semana")
COMPETITOR_SLICE = ("anio", "semana")


def _others(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def collapse_insert_only(source: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """First source row per key (later repeats would be skipped)."""
    cols = _others(source, [*keys, seq])
    return (source.groupBy(*keys)
            .agg(F.min_by(F.struct(*cols), F.col(seq)).alias("_r"), F.min(seq).alias(seq))
            .select(*keys, "_r.*", seq))


def collapse_upsert(source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                    seq: str, counts: bool = False) -> DataFrame:
    """Per key: descriptive columns of the first row, update columns of the last (and with
    ``counts`` the number of rows, ``_n``)."""
    desc = _others(source, [*keys, *update_cols, seq])
    return (source.groupBy(*keys)
            .agg(F.min_by(F.struct(*desc), F.col(seq)).alias("_d"),
                 F.max_by(F.struct(*update_cols), F.col(seq)).alias("_u"),
                 F.min(seq).alias(seq), *([F.count(F.lit(1)).alias("_n")] if counts else []))
            .select(*keys, "_d.*", "_u.*", seq, *(["_n"] if counts else [])))


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                      seq: str) -> DataFrame:
    """New table state after inserting the absent keys of ``source``."""
    cols = target.columns
    new = collapse_insert_only(source, keys, seq).join(target.select(*keys), list(keys),
                                                       "left_anti")
    return target.unionByName(new.select(*cols))


def new_rows_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                         seq: str) -> DataFrame:
    """Only the rows an insert-only load appends."""
    cols = target.columns
    return (collapse_insert_only(source, keys, seq)
            .join(target.select(*keys), list(keys), "left_anti").select(*cols))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str], seq: str, counts: bool = False) -> DataFrame:
    """New table state after the keyed upsert (full outer join on the keys). With ``counts``
    two columns more: ``_m_rows`` source rows of the key, ``_m_new`` whether it is new."""
    cols = target.columns
    src = collapse_upsert(source, keys, update_cols, seq, counts).drop(seq)
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols if c not in keys],
                      F.lit(True).alias("_in_t"))
    s = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols if c not in keys],
                   F.lit(True).alias("_in_s"), *(["_n"] if counts else []))
    j = t.join(s, list(keys), "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in update_cols:
            out.append(F.when(F.col("_in_s"), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.when(F.col("_in_t"), F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}")).alias(c))
    if counts:
        out += [F.coalesce("_n", F.lit(0)).cast("bigint").alias("_m_rows"), F.col("_in_t").isNull().alias("_m_new")]
    return j.select(*out)


def merge_stats(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Load counts of both modes, a row each (a row per source row, as the per-row
    statements would have counted them): mode, total, inserted, updated, skipped."""
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    known = target.select(*keys).distinct().withColumn("_hit", F.lit(True))
    inserted = F.when(F.col("_hit").isNull(), 1).otherwise(0)
    zero = F.lit(0).cast("bigint")
    counts = per_key.join(known, list(keys), "left").agg(
        F.coalesce(F.sum("_n"), zero).cast("bigint").alias("t"),
        F.coalesce(F.sum(inserted), zero).cast("bigint").alias("i"))
    rest = F.col("t") - F.col("i")
    modes = F.array(*[F.struct(F.lit(m).alias("mode"), F.col("t").alias("rows_total"), F.col("i").alias("rows_inserted"),
                               u.alias("rows_updated"), k.alias("rows_skipped"))
                      for m, u, k in (("upsert", rest, zero), ("insert_only", zero, rest))])
    return counts.select(F.inline(modes))


def replace_slices(existing: DataFrame, new: DataFrame, slices: Sequence[Mapping]) -> DataFrame:
    """Table state after replacing the given slices (column → value each) by ``new``; a
    load knows its slices, so ``existing`` is only filtered. An empty load replaces
    nothing: its slices are none (:func:`load_slices`)."""
    if not slices:
        return existing
    kept = existing.where(~_in_slices(slices))
    return kept.select(*existing.columns).unionByName(new.select(*existing.columns))


def load_slices(new: DataFrame, slices: Sequence[Mapping]) -> Sequence[Mapping]:
    """The slices a load replaces: ``slices``, or none when it has no rows (one row is
    looked for)."""
    return () if new.isEmpty() else slices


def _in_slices(slices: Sequence[Mapping]) -> Column:
    """True for the rows of any slice (never null)."""
    tests = [reduce(and_, (F.col(c).eqNullSafe(F.lit(v)) for c, v in s.items())) for s in slices]
    return reduce(or_, tests)


# ------------------------------------------------------------------ writes
#
# Targets are tables in versions (``operators.versions``): a writer that dies leaves the
# state before, a rerun gives the new one, and other partitions' files are taken over.

def touched_slices(source: DataFrame, partition_cols: Sequence[str]) -> list[dict]:
    """The partitions a load touches (few: a load is a list or a week). A load that knows
    them passes them on instead."""
    return [r.asDict() for r in source.select(*partition_cols).distinct().collect()]


def write_slices(new: DataFrame, path: str, slice_cols: Sequence[str], slices: Sequence[Mapping] | None = None,
                 before_switch=None) -> V.Version | None:
    """Replace ``slices`` (by default those present in ``new``) in the table at ``path`` by
    ``new``. An empty load changes nothing: the slices it would replace stay (None)."""
    base = V.current(new.sparkSession, path)
    if base is not None and new.isEmpty():
        return None
    return V.commit(new, path, slice_cols, replaced=slices, before_switch=before_switch, base=base)


def write_insert_only(spark, path: str, source: DataFrame, keys: Sequence[str], seq: str,
                      slices: Sequence[Mapping] | None = None) -> V.Version:
    """Append the absent keys of ``source`` to the table at ``path``; only the touched
    partitions are read."""
    base = V.current(spark, path)
    slices = touched_slices(source, base.partition_cols) if slices is None else slices
    target = V.read_table_version(spark, path, base.number, slices)
    return V.commit(new_rows_insert_only(target, source, keys, seq), path, append=True, base=base)


def write_upsert(spark, path: str, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str], seq: str,
                 slices: Sequence[Mapping] | None = None, before_switch=None) -> V.Version:
    """Upsert into the table at ``path``. Only the partitions the source touches are read and
    written anew. The version's ``metrics`` are the load's counts, taken by the write: source
    rows (``rows_total``), keys inserted, and the others, which updated."""
    base = V.current(spark, path)
    slices = touched_slices(source, base.partition_cols) if slices is None else slices
    target = V.read_table_version(spark, path, base.number, slices)
    merged = merge_upsert(target, source, keys, update_cols, seq, counts=True)
    zero = F.lit(0).cast("bigint")
    total, inserted = F.sum("_m_rows"), F.sum(F.when(F.col("_m_new"), 1).otherwise(0))
    counts = {"rows_total": F.coalesce(total, zero), "rows_inserted": F.coalesce(inserted, zero),
              "rows_updated": F.coalesce(total - inserted, zero)}
    return V.commit(merged, path, replaced=slices, metrics=counts, before_switch=before_switch, base=base)
