"""Tables in versions: a write becomes visible as a whole, or not at all.

A table is a folder with two parts::

    data/_v=<write id>/<partition folders>   the files of one write; never changed again
    versions/<number>.json                   what a version consists of

A version lists, for each partition, the folders that hold its rows, with the table's
schema. It is written last, by a rename that fails where the number is taken. So a writer
that dies before has left only unlisted folders: readers stay at the version before, and a
rerun starts anew. Of two writers of the same number one fails (``VersionConflict``) and
has changed nothing. A write that replaces some partitions takes over the folders of the
others as they are; nothing is copied.

What the driver handles is one entry per partition folder (a list, a week), never rows.
Counts of a write (``written``) are taken by an ``Observation`` while it is written.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfprice.session import create_file, delete_folder, freeing_shuffles, list_folder, read_file

WRITE_ID = "_v"


class VersionConflict(Exception):
    """Another writer has made the version that this one was about to make."""


@dataclass
class Version:
    number: int
    schema: T.StructType
    partition_cols: list[str]
    # partition values as text in the order of ``partition_cols``, folder below data/
    parts: list[tuple[tuple[str | None, ...], str]] = field(default_factory=list)
    metrics: dict = field(default_factory=dict)
    # what writers keep with the table (a ledger of loads, the source version a fact was made from)
    notes: dict = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"number": self.number, "schema": self.schema.jsonValue(), "partition_cols": self.partition_cols,
                           "parts": [[list(values), folder] for values, folder in self.parts], "metrics": self.metrics,
                           "notes": self.notes})

    @staticmethod
    def of(text: str) -> Version:
        d = json.loads(text)
        return Version(d["number"], T.StructType.fromJson(d["schema"]), d["partition_cols"],
                       [(tuple(values), folder) for values, folder in d["parts"]], d["metrics"], d.get("notes", {}))


def _name(number: int) -> str:
    return f"{number:012d}.json"


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions of the table at ``path``, oldest first."""
    names = list_folder(spark, f"{path}/versions")
    return sorted(int(n.removesuffix(".json")) for n, _ in names if n.endswith(".json") and not n.startswith((".", "_")))


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version, or the one of ``number``; None where there is no table."""
    numbers = version_numbers(spark, path)
    if number is None and not numbers:
        return None
    return Version.of(read_file(spark, f"{path}/versions/{_name(numbers[-1] if number is None else number)}"))


def _partition_text(values: Mapping, cols: Sequence[str]) -> tuple[str | None, ...]:
    return tuple(None if values[c] is None else str(values[c]) for c in cols)


def read_table_version(spark: SparkSession, path: str, number: int | None = None,
                       partitions: Sequence[Mapping] | None = None) -> DataFrame:
    """The rows of a version (the newest by default). ``partitions`` (column → value each)
    names the ones to read: others are not even listed."""
    v = current(spark, path, number)
    if v is None:
        raise FileNotFoundError(f"no version of a table in {path}")
    parts = v.parts
    if partitions is not None:
        wanted = {_partition_text(p, v.partition_cols) for p in partitions}
        parts = [p for p in parts if p[0] in wanted]
    if not parts:
        return spark.createDataFrame([], v.schema)
    schema = T.StructType([*v.schema.fields, T.StructField(WRITE_ID, T.StringType())])
    return (spark.read.schema(schema).option("basePath", f"{path}/data")
            .parquet(*[f"{path}/data/{folder}" for _, folder in parts]).select(*v.schema.names))


def _folders(spark: SparkSession, root: str, cols: Sequence[str]) -> list[tuple[tuple[str | None, ...], str]]:
    """The partition folders below ``root``: (values, path below it)."""
    from urllib.parse import unquote
    found: list[tuple[tuple[str | None, ...], str]] = [((), "")]
    for _ in cols:
        found = [((*values, None if (text := n.split("=", 1)[1]) == "__HIVE_DEFAULT_PARTITION__" else unquote(text)), f"{below}/{n}")
                 for values, below in found for n, is_folder in list_folder(spark, f"{root}{below}") if is_folder and "=" in n]
    return found


def _stage(df: DataFrame, path: str, cols: Sequence[str], metrics: Mapping[str, Column]
           ) -> tuple[list[tuple[tuple[str | None, ...], str]], dict]:
    """Write ``df`` to a folder of its own; its partition folders and counts."""
    write_id = uuid.uuid4().hex
    seen = Observation()
    counted = {"rows_written": F.count(F.lit(1)), **metrics}
    out = df.observe(seen, *[c.alias(n) for n, c in counted.items()])
    helpers = [c for c in df.columns if c.startswith("_m_")]  # columns for counts only
    writer = out.drop(*helpers).write
    root = f"{path}/data/{WRITE_ID}={write_id}"
    with freeing_shuffles(df.sparkSession):
        (writer.partitionBy(*cols) if cols else writer).parquet(root)
    parts = [(values, f"{WRITE_ID}={write_id}{below}") for values, below in _folders(df.sparkSession, root, cols)]
    return parts, {k: v or 0 for k, v in seen.get.items()}


def _publish(spark: SparkSession, path: str, v: Version) -> Version:
    if not create_file(spark, f"{path}/versions/{_name(v.number)}", v.text()):
        raise VersionConflict(f"version {v.number} of {path} has been made by another writer")
    return v


def commit(df: DataFrame, path: str, partition_cols: Sequence[str] = (), replaced: Sequence[Mapping] | None = None,
           append: bool = False, metrics: Mapping[str, Column] | None = None,
           before_switch: Callable[[], None] | None = None, base: Version | None = None,
           notes: Mapping | None = None) -> Version:
    """Make a new version of the table at ``path``. By default ``df`` replaces the partitions
    it has rows in, and those in ``replaced`` (column → value each) whether it has rows in
    them or not; with ``append`` its rows are added to what is there. A first commit, or
    one without partition columns, makes the whole table. ``metrics`` are aggregates over
    ``df`` taken by the write (columns named ``_m_*`` serve them and are not written).
    ``base`` is the version the rows were derived from, where the caller has read one.
    ``before_switch`` is called when everything is written and nothing visible. ``notes`` are
    kept with the version and taken over by later ones."""
    spark = df.sparkSession
    base = base or current(spark, path)
    cols = list(base.partition_cols) if base else list(partition_cols)
    schema = base.schema if base else T.StructType([f for f in df.schema.fields if not f.name.startswith("_m_")])
    helpers = [c for c in df.columns if c.startswith("_m_")]
    staged, counts = _stage(df.select(*schema.names, *helpers), path, cols, metrics or {})
    if before_switch:
        before_switch()
    kept = list(base.parts) if base and (append or cols) else []
    if not append:
        gone = {values for values, _ in staged} | {_partition_text(p, cols) for p in replaced or ()}
        kept = [p for p in kept if p[0] not in gone]
    return _publish(spark, path, Version(base.number + 1 if base else 0, schema, cols, kept + staged, counts,
                                         {**(base.notes if base else {}), **(notes or {})}))


def changed_partitions(spark: SparkSession, path: str, since: int, number: int | None = None) -> list[dict[str, str | None]]:
    """The partitions (column → value as text) whose files differ between the version ``since``
    and the one of ``number`` (the newest by default): new, added to, replaced or gone. The
    manifests tell; no data is read."""
    def folders(v: Version) -> dict:
        found: dict = {}
        for values, folder in v.parts:
            found.setdefault(values, set()).add(folder)
        return found
    new = current(spark, path, number)
    a, b = folders(current(spark, path, since)), folders(new)
    changed = sorted((values for values in a.keys() | b.keys() if a.get(values) != b.get(values)), key=str)
    return [dict(zip(new.partition_cols, values)) for values in changed]


def newest_partitions(v: Version, col: str, n: int | None, by: Sequence[str] = ()) -> list[dict[str, str | None]]:
    """The partitions that hold the ``n`` greatest values of the partition column ``col`` (per
    values of the partition columns ``by``); null values are left out. A version lists only
    partitions with rows, so these are the values a scan would find. ``n=None`` takes all."""
    kind = v.schema[col].dataType
    if not isinstance(kind, (T.IntegralType, T.DateType, T.StringType)):
        raise TypeError(f"partitions by {col} ({kind.simpleString()}) have no order as text")
    order = int if isinstance(kind, T.IntegralType) else str
    parts = {values: dict(zip(v.partition_cols, values)) for values, _ in v.parts}
    groups: dict = {}
    for p in parts.values():
        if all(p[c] is not None for c in (col, *by)):
            groups.setdefault(tuple(p[c] for c in by), set()).add(order(p[col]))
    newest = {g: set(sorted(values, reverse=True)[:n]) for g, values in groups.items()}
    return [p for p in parts.values() if all(p[c] is not None for c in (col, *by))
            and order(p[col]) in newest[tuple(p[c] for c in by)]]


def clear_versions(spark: SparkSession, path: str, keep: int = 2, older_than: float = 86400.0) -> list[str]:
    """Delete all but the last ``keep`` versions, and data folders that none of them lists if
    they were last changed ``older_than`` seconds ago (a running writer's are younger).
    Returns the folders deleted."""
    numbers = version_numbers(spark, path)
    for n in numbers[:-keep]:
        delete_folder(spark, f"{path}/versions/{_name(n)}")
    used = {folder.split("/")[0] for n in numbers[-keep:] for _, folder in current(spark, path, n).parts}
    limit = time.time() - older_than
    gone = [n for n, _ in list_folder(spark, f"{path}/data", changed_before=limit) if n not in used]
    for n in gone:
        delete_folder(spark, f"{path}/data/{n}")
    return gone
