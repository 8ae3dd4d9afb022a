"""Session helpers: a local session for tests and the bench, and landing of derived
inputs in the folder that all executors share (``spark.checkpoint.dir``). Nothing is
ever staged in a machine-local folder: without a shared one, plans stay lazy.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on; applied only when building our own session.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep post-shuffle parallelism for CPU-heavy stages over small shuffles
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shelfprice") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """The folder shared by the driver and all executors, if the session names one."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def staging_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder; raises when there is none."""
    base = shared_folder(spark)
    if not base:
        raise RuntimeError("this write needs a folder shared by all executors: "
                           "set spark.checkpoint.dir")
    return f"{base.rstrip('/')}/staging/{name}-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    """(file system, its path object) of ``path``, whatever store it lies in."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder or file through the file system it lies in."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def list_folder(spark: SparkSession, path: str, changed_before: float | None = None) -> list[tuple[str, bool]]:
    """(name, is it a folder) of what lies in ``path``; nothing where there is none."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return [(f.getPath().getName(), f.isDirectory()) for f in fs.listStatus(where)
            if changed_before is None or f.getModificationTime() / 1000 <= changed_before]


def read_file(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file or folder; False where ``target`` is there already."""
    from py4j.protocol import Py4JJavaError
    jvm = spark.sparkContext._jvm
    _, old = _at(spark, source)
    fs, new = _at(spark, target)
    fs.mkdirs(new.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(old), fs.makeQualified(new), plain)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception) or "rename destination" in str(e.java_exception):
            return False
        raise
    return True


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that is seen whole or not at all; False where it is there
    already."""
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    fs, where = _at(spark, hidden)
    stream = fs.create(where, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if rename(spark, hidden, path):
        return True
    fs.delete(where, False)
    return False


@contextmanager
def freeing_shuffles(spark: SparkSession):
    """What is executed within leaves no shuffle files: without this they lie on the
    executors' disks until the driver happens to collect its garbage, so that the steps of a
    job add up. For writes, which nothing reads again but from their files."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def land(df: DataFrame, name: str) -> DataFrame:
    """Where a shared folder is configured, write ``df`` there as Parquet and read it
    back (lineage is cut, later scans prune columns); else ``df`` itself."""
    spark = df.sparkSession
    if not shared_folder(spark):
        return df
    path = staging_path(spark, name)
    with freeing_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
