"""Intermediate tables shared by several branches of one job."""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Callable, Sequence
from functools import wraps
from urllib.parse import unquote

from py4j.protocol import Py4JError, Py4JNetworkError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"

# More tasks than this per core would only write more and smaller files. On large data a
# task still takes few shuffle partitions.
FILES_PER_CORE = 4
PARTITIONS_PER_FILE = 8

FILES_LOOKED_UP = 32
_URI = re.compile("[a-z][a-z0-9+.-]*:/")

_cleared_at_exit: set[str] = set()


def staging_folder(spark: SparkSession) -> str:
    """Where this application stages: below ``spark.checkpoint.dir``, or else the folder given to ``setCheckpointDir``.

    All executors must reach it. Without either there is an error, since any folder chosen
    here might be local to one machine. It goes with ``clear_staged``, at the latest when the program ends.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    path = f"{folder.rstrip('/')}/staged-{spark.sparkContext.applicationId}"
    if path not in _cleared_at_exit:
        _cleared_at_exit.add(path)
        atexit.register(_clear_quietly, spark, path)
    return path


def compact(df: DataFrame) -> DataFrame:
    """``df`` in fewer partitions, without a shuffle; a task then takes several in turn."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = FILES_PER_CORE * spark.sparkContext.defaultParallelism
    return df.coalesce(max(least, partitions // PARTITIONS_PER_FILE))


def staged(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written once to ``folder`` (``staging_folder`` by default) and read back.

    Readers then scan only the columns they need, and a lost executor costs a re-read
    and not the work before it. What is staged in the default folder goes with
    ``clear_staged``, at the latest when the program ends.
    """
    spark = df.sparkSession
    if folder is None:
        folder = staging_folder(spark)
    path = f"{folder}/{uuid.uuid4().hex}"
    compact(df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> int:
    """A number that changes with the files below ``paths``: with their names, lengths or times of modification.

    No file is read. A few files are looked up one by one; many, or folders, are listed in a job that gives one row.
    """
    if not paths:
        return 0
    # Spark names the files of a frame by URI
    paths = [unquote(path) if _URI.match(path) else path for path in paths]
    if len(paths) <= FILES_LOOKED_UP:
        states = [_state(spark, path) for path in paths]
        if None not in states:
            return hash(frozenset(states))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    mark = F.xxhash64("path", "length", "modificationTime")
    found = listed.agg(F.count(F.lit(1)).alias("files"), F.bit_xor(mark).alias("mark")).first()
    return hash((found["files"], found["mark"]))


def _state(spark: SparkSession, path: str) -> tuple[str, int, int] | None:
    """Name, length and time of a file; nothing for a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
    return None if status.isDirectory() else (path, status.getLen(), status.getModificationTime())


def once_for_inputs(*tables: str):
    """A builder is called once per application and state of the ``tables`` of its folder; later calls read what it
    staged. When one of their files changes, it is called anew."""

    def wrapped(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        built: dict[tuple, tuple[int, DataFrame]] = {}

        @wraps(build)
        def stored(spark: SparkSession, folder: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, folder)
            state = fingerprint(spark, [f"{folder}/{name}.parquet" for name in tables])
            if key not in built or built[key][0] != state:
                built[key] = (state, build(spark, folder))
            return built[key][1]

        return stored

    return wrapped


def clear_staged(spark: SparkSession, folder: str | None = None) -> None:
    """Delete all that this application has staged; frames that read it can no longer be used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder or staging_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _clear_quietly(spark: SparkSession, folder: str) -> None:
    try:
        clear_staged(spark, folder)
    except (Py4JError, Py4JNetworkError, OSError):  # the JVM has gone already
        pass
