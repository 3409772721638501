"""The few file operations that Spark's readers and writers lack, on any Hadoop file system."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from renown.session import work_dir


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder, hidden files left out; nothing if there is no such folder."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return []
    found = (entry.getPath().getName() for entry in files.listStatus(where))
    return sorted(name for name in found if not name.startswith("."))


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def create(spark: SparkSession, path: str, content: bytes = b"") -> None:
    """A new file; fails if there is one already."""
    files, where = _at(spark, path)
    stream = files.create(where, False)
    stream.write(content)
    stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """A file or a whole folder; nothing happens if there is none."""
    files, where = _at(spark, path)
    files.delete(where, True)


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """A fresh folder for tables of one job, gone when the job is over or has failed."""
    path = work_dir(spark)
    try:
        yield path
    finally:
        delete(spark, path)
