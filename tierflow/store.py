"""Names in the store that Spark reads: what DataFrames cannot tell or do."""

from __future__ import annotations

import re
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

VERSION = re.compile(r"v\d{9}")


def _handles(spark: SparkSession, path: str) -> tuple[Any, Any]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder in order; none if there is no such folder."""
    fs, folder = _handles(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the numbered versions in a folder, in order."""
    return [n for n in names(spark, path) if VERSION.fullmatch(n)]


def next_version(spark: SparkSession, path: str) -> str:
    """The name after the last one that is there."""
    return f"v{max((int(n[1:]) for n in versions(spark, path)), default=0) + 1:09d}"


def exists(spark: SparkSession, path: str) -> bool:
    fs, file = _handles(spark, path)
    return fs.exists(file)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; False if there is.

    The store decides, so of several callers one succeeds. A caller lost half-way
    leaves an empty file.
    """
    fs, file = _handles(spark, path)
    try:
        out = fs.create(file, False)
    except Py4JJavaError as e:
        if fs.exists(file):
            return False
        raise e
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file whole."""
    fs, file = _handles(spark, path)
    source = fs.open(file)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it, if it is there."""
    fs, folder = _handles(spark, path)
    fs.delete(folder, True)
