"""Numbered snapshots of a catalog, each written once and by one writer.

A snapshot lists the current version of every table, so a reader opens one file however many there have been. The next
number can only be created by one of several writers; the others look at what has changed and try the number after.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_SUFFIX = ".json"


class ConflictError(RuntimeError):
    """Another build has replaced some of the same tables in the meantime."""


def newest(spark: SparkSession, folder: str) -> int:
    """The number of the last snapshot, 0 without any. Looks at names only."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*{_SUFFIX}")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    names = [status.getPath().getName() for status in found or []]
    return max((int(name.removesuffix(_SUFFIX)) for name in names), default=0)


def snapshot_path(folder: str, number: int) -> str:
    return f"{folder}/{number:020d}{_SUFFIX}"


def commit(spark: SparkSession, folder: str, following: Callable[[int], list[dict]]) -> int:
    """Write the snapshot after the newest one and return its number.

    ``following`` gives the rows that follow the snapshot of a number, or raises ``ConflictError``. It is asked again
    whenever another writer was first.
    """
    while True:
        number = newest(spark, folder)
        text = "".join(json.dumps(row) + "\n" for row in following(number))
        if create_if_absent(spark, snapshot_path(folder, number + 1), text.encode()):
            return number + 1


def create_if_absent(spark: SparkSession, path: str, content: bytes) -> bool:
    """Create a file with its whole content, or leave the one that is there. One of several writers at once succeeds.

    The content is written aside first. On a file system of a machine it is then linked to its name, on others renamed to
    it, and neither replaces a file. That needs a store whose renames are atomic, as HDFS has.
    """
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(settings)
    target = files.makeQualified(target)
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    stream = files.create(aside, False)
    try:
        stream.write(bytearray(content))
        stream.close()
        if files.getUri().getScheme() == "file":
            name = jvm.java.nio.file.Paths.get(target.toUri())
            jvm.java.nio.file.Files.createLink(name, jvm.java.nio.file.Paths.get(aside.toUri()))
        else:
            kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            no_replacing = spark.sparkContext._gateway.new_array(kinds, 1)
            no_replacing[0] = kinds.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), settings).rename(aside, target, no_replacing)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        files.delete(aside, False)
    return True
