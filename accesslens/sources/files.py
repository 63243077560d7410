"""Small files and folders beside the tables, through Hadoop's file systems.

For what Spark's readers and writers do not cover: remembering a value next to
a checkpoint, listing and dropping folders. Works on any store Spark can name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.getFileStatus(where).isDirectory()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The file appears with all of its text or not at all."""
    fs, where = _at(spark, path)
    _, draft = _at(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(draft, where):
        raise OSError(f"cannot write {path}")


def remembered(spark: SparkSession, path: str, make: Callable[[], str]) -> str:
    """The text of a file; made and written on the first call."""
    if not exists(spark, path):
        write_text(spark, path, make())
    return read_text(spark, path)
