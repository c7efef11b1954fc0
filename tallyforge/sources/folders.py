"""Folders of any store that Spark reaches: names, markers, removal. Few and small calls; rows go through DataFrames."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _at(spark, path)
    return store.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is missing."""
    store, where = _at(spark, path)
    return sorted(found.getPath().getName() for found in store.listStatus(where)) if store.exists(where) else []


def numbered(spark: SparkSession, path: str, prefix: str = "") -> list[int]:
    """The numbers in the names ``<prefix><number>``, in order."""
    names = [name.removeprefix(prefix) for name in children(spark, path) if name.startswith(prefix)]
    return sorted(int(name) for name in names if name.isdigit())


def mark(spark: SparkSession, path: str, text: str = "") -> None:
    """A file that holds ``text``; a reader sees it complete or not at all where the store closes files atomically."""
    store, where = _at(spark, path)
    out = store.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def text_of(spark: SparkSession, path: str) -> str | None:
    """What :func:`mark` wrote; None if there is no such file."""
    store, where = _at(spark, path)
    if not store.exists(where):
        return None
    held = store.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
    finally:
        held.close()


def drop(spark: SparkSession, path: str) -> None:
    store, where = _at(spark, path)
    store.delete(where, True)
