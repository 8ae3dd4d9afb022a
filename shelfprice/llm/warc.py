"""WARC 1.1 archives as a PySpark Python data source.

``spark.read.format("warc").load(folder)`` plans one partition per group of archive
files (``split_mb`` of compressed bytes; the writer rolls its files, so none is
large). Each task parses a record's header block first, tests the pushed predicates
on it (record type, record id, target URI, digests, length, refers-to), and skips the
content of an unwanted record without decoding or keeping it. Without a ``payload``
column in the read schema, no payload is kept at all.

``df.write.format("warc").mode("append").save(folder)`` writes gzip archives, one
member per record. A task writes under ``_attempt-*`` names, which readers don't
list; the commit renames the files of the successful attempts only, so a lost
executor or a second attempt leaves no record twice. Files go through
``pyarrow.fs``, so the folder may be any address it understands.

``mark_revisits`` decides which records repeat an earlier payload. The digest table
is pre-aggregated before its shuffle and joined on (digest, length), a join whose hot
keys Spark's adaptive execution can split.

Defined results: a null payload counts as empty. A null record id writes an empty id
and reads back as null. Rows that repeat a whole record are all kept: those with the
smallest id of a payload are all responses. Among records of one payload, null ids
are never the smallest; a payload with null ids only has responses only. A null URI
has no header; control characters in a header are percent-encoded. An empty table
writes nothing and reads back empty. Other input columns pass through
``mark_revisits``; those that clash with its outputs are replaced.
"""

from __future__ import annotations

import gzip
import posixpath
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe,
                                    EqualTo, In, InputPartition, IsNotNull, StringStartsWith,
                                    WriterCommitMessage)

from .common import scratch, table

SCHEMA = T.StructType([
    T.StructField("record_type", T.StringType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("target_uri", T.StringType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("payload_length", T.LongType()),
    T.StructField("refers_to", T.StringType()),
    T.StructField("payload", T.BinaryType()),
])

# Fixed values of the WARC 1.1 and HTTP formats.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
           "payload_digest": "WARC-Payload-Digest", "payload_length": "X-Payload-Length",
           "refers_to": "WARC-Refers-To"}
URN = "urn:record:"

ROLL_BYTES = 64 << 20
CHUNK = 1 << 20


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"\w+:", path):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(row: dict, date: str) -> bytes:
    """One uncompressed WARC record from the columns of ``SCHEMA``."""
    body = b"" if row["record_type"] == "revisit" else row["payload"] or b""
    content = HTTP + body
    lines = [f"WARC-Type: {row['record_type']}",
             f"WARC-Record-ID: <{URN}{_clean(row['record_id'] or '')}>",
             f"WARC-Date: {date}"]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_clean(row['target_uri'])}")
    lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"WARC-Payload-Digest: sha256:{row['payload_digest']}")
    lines.append(f"X-Payload-Length: {row['payload_length']}")
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Refers-To: <{URN}{_clean(row['refers_to'] or '')}>")
        lines.append(f"WARC-Profile: {PROFILE}")
    lines.append(f"Content-Length: {len(content)}")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, options: dict[str, str]):
        self.path = path
        self.level = int(options.get("level", "3"))
        self.roll = int(options.get("roll_bytes", ROLL_BYTES))
        self.date = options.get("date", "2000-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, path = _store(self.path)
        attempt, names, out, size = uuid.uuid4().hex, [], None, 0
        for batch in iterator:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in SCHEMA.names}
                if out is None:
                    if not names:
                        fs.create_dir(path, recursive=True)
                    names.append(f"{attempt}-{len(names):05d}.warc.gz")
                    out, size = fs.open_output_stream(posixpath.join(path, f"_attempt-{names[-1]}"),
                                                      compression=None), 0
                member = gzip.compress(record_bytes(row, self.date), self.level, mtime=0)
                out.write(member)
                size += len(member)
                if size >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        message = WriterCommitMessage()
        message.names = names
        return message

    def commit(self, messages: list) -> None:
        fs, path = _store(self.path)
        fs.create_dir(path, recursive=True)
        for m in messages:
            for name in m.names if m else ():
                fs.move(posixpath.join(path, f"_attempt-{name}"), posixpath.join(path, name))

    def abort(self, messages: list) -> None:
        fs, path = _store(self.path)
        for m in messages:
            for name in m.names if m else ():
                fs.delete_file(posixpath.join(path, f"_attempt-{name}"))


class Files(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, options: dict[str, str]):
        self.path, self.names = path, schema.names
        self.split = int(options.get("split_mb", "16")) << 20
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Take the predicates that a header block can answer; give the others back."""
        kinds = {EqualTo: "=", EqualNullSafe: "=", In: "in", StringStartsWith: "starts", IsNotNull: "set"}
        for f in filters:
            value = getattr(f, "value", None)
            if type(f) in kinds and len(f.attribute) == 1 and f.attribute[0] in HEADERS \
                    and not (type(f) is not IsNotNull and value is None):
                self.tests.append((f.attribute[0], kinds[type(f)], value))
            else:
                yield f

    def partitions(self) -> list[Files]:
        fs, path = _store(self.path)
        found = sorted((x for x in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
                        if x.type == pafs.FileType.File and not x.base_name.startswith(("_", "."))
                        and re.search(r"\.warc(\.gz)?$", x.base_name)), key=lambda x: x.path)
        groups: list[list[str]] = []
        size = self.split
        for x in found:
            if size + x.size > self.split:
                groups.append([])
                size = 0
            groups[-1].append(x.path)
            size += x.size
        return [Files(g) for g in groups] or [Files([])]

    def wanted(self, row: dict) -> bool:
        for name, kind, value in self.tests:
            x = row[name]
            if x is None or kind == "=" and x != value or kind == "in" and x not in value \
                    or kind == "starts" and not x.startswith(value):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = _store(self.path)
        kinds = pa.schema([(f.name, {"payload": pa.binary(), "payload_length": pa.int64()}
                            .get(f.name, pa.string())) for f in SCHEMA if f.name in self.names])
        kinds = pa.schema([kinds.field(n) for n in self.names])
        rows, held = [], 0
        for file in partition.files:
            with fs.open_input_stream(file, compression=None) as raw:
                stream = gzip.GzipFile(fileobj=raw) if file.endswith(".gz") else raw
                for row in records(stream, "payload" in self.names, self.wanted, file):
                    rows.append({n: row.get(n) for n in self.names})
                    held += len(row.get("payload") or b"") + 200
                    if held >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)


def records(stream, payloads: bool, wanted, name: str = "") -> Iterator[dict]:
    """Parse records one by one: header block, predicates, then the content only of
    the records that are wanted."""
    buffer = memoryview(b"")

    def more(n: int) -> bytes:
        nonlocal buffer
        if len(buffer) < n:
            parts, have = [bytes(buffer)], len(buffer)
            while have < n:
                part = stream.read(max(CHUNK, n - have))
                if not part:
                    raise ValueError(f"{name}: a record is cut off")
                parts.append(part)
                have += len(part)
            buffer = memoryview(b"".join(parts))
        got, buffer = buffer[:n], buffer[n:]
        return bytes(got)

    def skip(n: int) -> None:
        nonlocal buffer
        while n > len(buffer):
            n -= len(buffer)
            buffer = memoryview(stream.read(CHUNK))
            if not buffer:
                raise ValueError(f"{name}: a record is cut off")
        buffer = buffer[n:]

    def head() -> bytes | None:
        nonlocal buffer
        data, at = bytes(buffer), -1
        while (at := data.find(b"\r\n\r\n")) < 0:
            part = stream.read(CHUNK)
            if not part:
                if data.strip():
                    raise ValueError(f"{name}: a header block is cut off")
                return None
            data += part
        buffer = memoryview(data)[at + 4:]
        return data[:at]

    while (block := head()) is not None:
        first, *lines = block.lstrip(b"\r\n").decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"{name}: not a WARC record: {first[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        row: dict = {c: fields.get(h.lower()) for c, h in HEADERS.items()}
        for c in ("record_id", "refers_to"):
            if row[c] is not None:
                row[c] = unquote(row[c].strip("<>").removeprefix(URN)) or None
        if row["target_uri"] is not None:
            row["target_uri"] = unquote(row["target_uri"])
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].rpartition(":")[2]
        length = int(fields.get("content-length", "0"))
        row["payload_length"] = int(row["payload_length"]) if row["payload_length"] else None
        if not wanted(row):
            skip(length + 4)
            continue
        if payloads and row["record_type"] != "revisit":
            content = more(length)
            skip(4)
            if fields.get("content-type", "").startswith("application/http"):
                content = content[content.find(b"\r\n\r\n") + 4:]
            row["payload"] = content
        else:
            skip(length + 4)
        yield row


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        unknown = set(schema.names) - set(SCHEMA.names)
        if unknown:
            raise ValueError(f"no such column in a WARC archive: {sorted(unknown)}")
        return WarcReader(self.options["path"], schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to; write to a new folder")
        if schema.names != SCHEMA.names:
            raise ValueError(f"a WARC archive takes the columns {SCHEMA.names}")
        return WarcWriter(self.options["path"], dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let it take filters."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_archives(df: DataFrame, path: str, **options: str) -> None:
    """Append the records of ``df`` (columns of ``SCHEMA``) to the folder ``path``."""
    register(df.sparkSession)
    df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMA]).write.format("warc") \
        .options(**options).mode("append").save(path)


def read_archives(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Records of the archives in ``path``; only ``columns`` are decoded."""
    register(spark)
    schema = T.StructType([f for f in SCHEMA if columns is None or f.name in columns])
    return spark.read.format("warc").schema(schema).load(path)


def mark_revisits(df: DataFrame, record_id: Column, payload: Column, min_bytes: int = 100) -> DataFrame:
    """``df`` with ``payload`` (binary), ``payload_digest``, ``payload_length``,
    ``record_type`` and ``refers_to``: among records of equal payloads of at least
    ``min_bytes`` bytes, the smallest id is the response and the others revisit it."""
    made = ("payload", "payload_digest", "payload_length", "record_type", "refers_to", "_id")
    rows = df.select(*[c for c in df.columns if c not in made], record_id.alias("_id"),
                     F.coalesce(payload.cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256),
                             "payload_length": F.length("payload").cast("long")})
    firsts = (rows.where(F.col("payload_length") >= min_bytes)
              .groupBy("payload_digest")
              .agg(F.min("payload_length").alias("payload_length"), F.min("_id").alias("_first"),
                   F.max("_id").alias("_last"))
              .where("_first < _last").drop("_last"))
    # joined on both columns: the aggregate's partitioning by digest alone doesn't
    # serve, so both sides are exchanged for the join and a hot digest can be split
    rows = rows.join(firsts, ["payload_digest", "payload_length"], "left")
    again = F.col("_first").isNotNull() & F.coalesce(F.col("_id") > F.col("_first"), F.lit(True))
    return rows.withColumns({
        "record_type": F.when(again, "revisit").otherwise("response"),
        "refers_to": F.when(again, F.col("_first"))}).drop("_first", "_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: archive every page, read the archives back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch(spark, "warc")
    marked = mark_revisits(pages, F.col("page_id"), F.col("html"))
    write_archives(marked.select(
        "record_type", F.col("page_id").cast("string").alias("record_id"),
        F.col("url").alias("target_uri"), "payload_digest", "payload_length",
        F.col("refers_to").cast("string"), "payload"), path)
    back = read_archives(spark, path)
    full = F.col("record_type") == "response"
    return back.select(
        F.col("record_id").cast("long").alias("page_id"),
        F.when(full, F.length("payload").cast("long")).otherwise(F.col("payload_length"))
        .alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", F.col("refers_to").cast("long").alias("refers_to"))


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
