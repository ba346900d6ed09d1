"""The few file-system calls the log's commit protocol needs, through Spark's Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; empty when there is none."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def create_marker(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there; False when another writer was first."""
    p, fs = _path(spark, path)
    if fs.exists(p):
        return False
    try:
        fs.create(p, False).close()
    except Exception:  # the file system refused because the file appeared meanwhile
        if fs.exists(p):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8") if size else ""
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; an existing one is replaced by a move, so a reader never sees half of it."""
    p, fs = _path(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(new, p)


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.delete(p, True)


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Move a file, unless it was moved before; its new folder is made."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return False
    target, _ = _path(spark, to)
    fs.mkdirs(target.getParent())
    return fs.rename(p, target)
