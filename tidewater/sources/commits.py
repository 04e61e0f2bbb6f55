"""Files that exactly one writer can create, through Hadoop's file systems.

A commit is such a file.  Two writers that started from the same state name
the same next file; the one that comes second learns it, rereads the state and
starts over (optimistic concurrency).  Nothing is ever overwritten.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer committed first."""


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return jvm, fs, fs.makeQualified(at)


def _exists(error: Py4JJavaError) -> bool:
    return "FileAlreadyExists" in str(error.java_exception)


def publish(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create ``path`` with its whole content; False if it is there already.

    The content is complete before the name appears: on a local file system by
    a hard link, elsewhere by a rename, neither of which replaces a file.
    """
    jvm, fs, at = _file_system(spark, path)
    fs.mkdirs(at.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if fs.getScheme() != "file":
            return not fs.exists(at) and fs.rename(draft, at)
        paths = jvm.java.nio.file.Paths
        jvm.java.nio.file.Files.createLink(paths.get(at.toUri()), paths.get(draft.toUri()))
        return True
    except Py4JJavaError as error:
        if _exists(error):
            return False
        raise
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty ``path``; False if somebody else did."""
    jvm, fs, at = _file_system(spark, path)
    fs.mkdirs(at.getParent())
    if fs.getScheme() == "file":
        return jvm.java.io.File(at.toUri()).createNewFile()
    try:
        fs.create(at, False).close()
        return True
    except Py4JJavaError as error:
        if _exists(error):
            return False
        raise
