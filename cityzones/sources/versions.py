"""Tables that are overwritten in whole versions.

A table is a folder with one subfolder per version and a small file, CURRENT,
that names the version in use.  A writer fills a fresh subfolder and only then
swaps CURRENT by a rename: readers see the old table or the new one, a job may
overwrite the table it reads, and a writer that dies in between leaves the old
table as it was.  The rename is atomic on HDFS and on local disks; stores that
copy on rename need a table format of their own.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from cityzones.sources.sinks import write_parquet

POINTER = "CURRENT"
_VERSION = re.compile(r"v(\d{9})-[0-9a-f]{8}")


def _files(spark: SparkSession, path: str):
    """(file system, path object) of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the version folders below ``root``, oldest first, unfinished ones included."""
    fs, p = _files(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in names if _VERSION.fullmatch(n))


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version in use, None for a table never written."""
    fs, p = _files(spark, f"{root.rstrip('/')}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def write_version(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a version that nobody reads yet; returns its name."""
    known = list_versions(df.sparkSession, root)
    number = 1 + max((int(_VERSION.fullmatch(n).group(1)) for n in known), default=0)
    name = f"v{number:09d}-{uuid.uuid4().hex[:8]}"
    write_parquet(df, f"{root.rstrip('/')}/{name}", mode="error", partition_by=partition_by)
    return name


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Put ``version`` in use (an older one too: a roll-back).  It must be complete."""
    root = root.rstrip("/")
    fs, done = _files(spark, f"{root}/{version}/_SUCCESS")
    if not fs.exists(done):
        raise ValueError(f"version {version} of {root} is missing or unfinished")
    jvm = spark.sparkContext._jvm
    _, fresh = _files(spark, f"{root}/_{POINTER}-{uuid.uuid4().hex[:8]}")
    stream = fs.create(fresh, False)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fresh.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(_files(spark, f"{root}/{POINTER}")[1]), options)


def expire(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Remove all but the version in use and the ``keep - 1`` complete ones before it; returns what went.

    Versions newer than the one in use stay: a writer may be at work on them."""
    if keep < 1:
        raise ValueError("keep is 1 or more")
    current = current_version(spark, root)
    older = [n for n in list_versions(spark, root) if current is not None and n < current]
    complete = []
    for n in older:
        fs, done = _files(spark, f"{root.rstrip('/')}/{n}/_SUCCESS")
        if fs.exists(done):
            complete.append(n)
    kept = set(complete[len(complete) - (keep - 1):]) if keep > 1 else set()
    gone = [n for n in older if n not in kept]
    for n in gone:
        fs, p = _files(spark, f"{root.rstrip('/')}/{n}")
        fs.delete(p, True)
    return gone


def overwrite_table(df: DataFrame, root: str, partition_by: list[str] | None = None, keep: int = 3) -> str:
    """Replace the table by ``df``, which may read the table itself; returns the new version's name.

    The last ``keep`` versions stay readable: jobs that began on an older one end on it."""
    version = write_version(df, root, partition_by)
    publish(df.sparkSession, root, version)
    expire(df.sparkSession, root, keep)
    return version


def read_table(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The table as of now (or of ``version``).  The version is chosen here, once, and stays the frame's own."""
    version = version or current_version(spark, root)
    if version is None:
        raise ValueError(f"no version of {root} is in use")
    return spark.read.parquet(f"{root.rstrip('/')}/{version}")
