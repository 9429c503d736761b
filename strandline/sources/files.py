"""Small files and folders on the file system Spark uses for a path, whatever its scheme."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it doesn't exist."""
    fs, p = _at(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def read(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> None:
    """A small file with its whole text, in place at once; raises FileExistsError where there is one already.

    Written aside and renamed, since a file is visible while it is written.  A
    distributed file system refuses to rename onto a file; a local one doesn't, so
    there the name is given by a link.
    """
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getScheme() == "file":
            os.link(aside.toUri().getPath(), p.toUri().getPath())
        elif fs.exists(p) or not fs.rename(aside, p):
            raise FileExistsError(path)
    finally:
        fs.delete(aside, False)
