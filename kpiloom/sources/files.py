"""Hadoop's file system, for what Spark's readers and writers don't offer."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: How whole tables are packed that are written on the way. A file can be read by
#: as many tasks as it has blocks.
PACKED = {"compression": "zstd", "parquet.block.size": str(16 << 20)}


def located(spark: SparkSession, path: str):
    """Hadoop's path object and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = located(spark, path)
    return files.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder; none if there is no such folder."""
    where, files = located(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    where, files = located(spark, path)
    return files.getContentSummary(where).getLength()


def remove(spark: SparkSession, path: str) -> None:
    where, files = located(spark, path)
    files.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Renames, unless the target is there already."""
    (here, files), (there, _) = located(spark, source), located(spark, target)
    return not files.exists(there) and files.rename(here, there)


def read_text(spark: SparkSession, path: str) -> str:
    where, files = located(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    where, files = located(spark, path)
    stream = files.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
