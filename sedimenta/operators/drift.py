"""Expected against observed: columns of a table, and sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.profiling import columns
from sedimenta.sources.delimited import source_exists


def schema_drift(expected: Mapping[str, list[str]], observed: Mapping[str, DataFrame]) -> DataFrame:
    """``(source, column, status, non_null)`` for every expected or observed column.

    ``status`` is ``ok``, ``missing`` (expected only) or ``unexpected``. Names come from the
    schemas. Only unexpected columns are scanned: ``non_null`` tells those that carry no
    values from others, and is null elsewhere.
    """
    spark = next(iter(observed.values())).sparkSession
    compared = _compare(_names(spark, expected), _names(spark, {s: df.columns for s, df in observed.items()}))
    counts = []
    for source, df in observed.items():
        unknown = [name for name in df.columns if name not in expected.get(source, [])]
        if unknown:
            counted = columns(df.select(*[f"`{name}`" for name in unknown]))
            counts.append(counted.select(F.lit(source).alias("source"), "column", "non_null"))
    if not counts:
        return compared.withColumn("non_null", F.lit(None).cast("long"))
    found = reduce(DataFrame.unionByName, counts)
    return compared.join(found, ["source", "column"], "left").orderBy("source", "column")


def header_drift(spark: SparkSession, expected: Mapping[str, list[str]], headers: Mapping[str, list[str]]) -> DataFrame:
    """``(source, column, status)`` from headers alone, without reading the rows."""
    return _compare(_names(spark, expected), _names(spark, headers))


def missing_sources(spark: SparkSession, folder: str, expected: Mapping[str, str]) -> DataFrame:
    """``(source, file_name, critical)`` for the expected files and folders that are absent.

    ``expected`` maps a source to its name in ``folder``. Every source is critical.
    """
    absent = {source: name for source, name in expected.items() if not source_exists(spark, f"{folder}/{name}")}
    return _sources(spark, absent).withColumn("critical", F.lit(True)).orderBy("source")


def source_status(expected: Mapping[str, str], counts: DataFrame) -> DataFrame:
    """``(source, file_name, status, n_rows)`` of every expected file.

    ``counts`` has a row ``(file_name, n_rows)`` for each file that is there.
    """
    both = _sources(counts.sparkSession, expected).join(counts.select("file_name", "n_rows"), "file_name", "left")
    status = F.when(F.col("n_rows").isNull(), "missing").otherwise("ok")
    return both.select("source", "file_name", status.alias("status"), "n_rows").orderBy("source")


def _sources(spark: SparkSession, expected: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame(list(expected.items()), "source string, file_name string")


def _names(spark: SparkSession, columns_of: Mapping[str, list[str]]) -> DataFrame:
    pairs = [(source, name) for source, names in columns_of.items() for name in names]
    return spark.createDataFrame(pairs, "source string, column string")


def _compare(expected: DataFrame, found: DataFrame, *extra: str) -> DataFrame:
    both = expected.withColumn("is_expected", F.lit(True)).join(
        found.withColumn("is_found", F.lit(True)), ["source", "column"], "full_outer"
    )
    status = (
        F.when(F.col("is_found").isNull(), "missing").when(F.col("is_expected").isNull(), "unexpected").otherwise("ok")
    )
    return both.select("source", "column", status.alias("status"), *extra).orderBy("source", "column")
