"""Profiles of many tables at once, whatever their columns, from records in long form.

The records of all tables are one frame with a column that tells the tables apart and one that holds
the fields, so the number of jobs and the size of the plans do not grow with the number of tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions import percentage, round2
from sedimenta.operators.lookups import attach
from sedimenta.operators.profiling import KINDS, comparable_text
from sedimenta.sources.staging import staged


@dataclass(frozen=True)
class Exploration:
    """Profiles of several files: a row per table, per column, and per column with nulls, and
    the first rows of each file as JSON."""

    tables: DataFrame
    columns: DataFrame
    nulls: DataFrame
    first_rows: DataFrame


def headers(fields: DataFrame) -> DataFrame:
    """``(table_name, names)`` from rows ``(table_name, fields)``: a column without a name is called by its position,
    and names that differ in case at most get theirs appended."""
    names = F.transform(
        "fields",
        lambda name, i: F.when(name == "", F.concat(F.lit("_c"), i.cast("string")))
        .when(
            F.size(F.filter("fields", lambda other: F.lower(other) == F.lower(name))) > 1,
            F.concat(name, i.cast("string")),
        )
        .otherwise(name),
    )
    return fields.select("table_name", names.alias("names"))


def explored(records: DataFrame, names: DataFrame, all_tables: DataFrame, n_first: int) -> Exploration:
    """Profiles of the tables in ``all_tables`` from ``records`` ``(table_name, start, position, fields)`` without headers.

    ``names`` has the columns of each table (``headers``) and ``all_tables`` every ``table_name``. ``start`` and ``position``
    give the order of a table's records. Both inputs are read several times, so they should be stored. A record with
    fewer fields than its table has columns is filled with nulls; one with more fails this call. Copies are counted as
    numbers or truth values in columns that have one such type in all tables of a header.
    """
    columns = staged(_columns(records, names))
    missing = F.col("n_rows") - F.col("non_null")
    nulls = columns.select(
        "table_name", "column", missing.alias("null_count"), round2(percentage(missing, F.col("n_rows"))).alias("null_pct")
    )
    return Exploration(
        tables=_tables(records, names, columns, all_tables).orderBy("table_name"),
        columns=columns.select("table_name", "position", "column", "type", "non_null").orderBy("table_name", "position"),
        nulls=nulls.filter("null_count > 0").orderBy("table_name", F.desc("null_count"), "column"),
        first_rows=_first_rows(records, names, n_first),
    )


def _columns(records: DataFrame, names: DataFrame) -> DataFrame:
    """``(table_name, position, column, type, non_null, n_rows)``; tables without rows have columns of strings."""
    value = F.col("value")
    counted = (
        records.select("table_name", F.posexplode("fields").alias("position", "value"))
        .groupBy("table_name", "position")
        .agg(
            F.count(F.lit(1)).alias("n_records"),
            F.count(value).alias("n"),
            *[F.count_if(fits(value)).alias(kind) for kind, fits in KINDS.items()],
        )
    )
    # every record has a first field
    whole = Window.partitionBy("table_name")
    kind = F.lit("string")
    for known in reversed(KINDS):
        kind = F.when((F.col("n") > 0) & (F.col(known) == F.col("n")), known).otherwise(kind)
    named = names.select("table_name", F.posexplode("names").alias("position", "column"), F.size("names").alias("width"))
    both = named.join(counted, ["table_name", "position"], "full")
    extra = F.concat(F.lit("more fields than the header in "), F.col("table_name"))
    known = F.when(F.col("width").isNull(), F.raise_error(extra).cast("string")).otherwise(F.col("table_name"))
    return both.select(
        known.alias("table_name"),
        "position",
        "column",
        kind.alias("type"),
        F.coalesce("n", F.lit(0)).alias("non_null"),
        F.coalesce(F.max(F.when(F.col("position") == 0, F.col("n_records"))).over(whole), F.lit(0)).alias("n_rows"),
    )


def _tables(records: DataFrame, names: DataFrame, columns: DataFrame, all_tables: DataFrame) -> DataFrame:
    """``(table_name, n_rows, n_columns, duplicate_rows)``."""
    filled = columns.filter("n_rows > 0").join(names, "table_name")
    by_header = filled.groupBy("names", "position").agg(F.collect_set("type").alias("found"))
    one = F.when(F.size("found") == 1, F.col("found")[0]).otherwise("string")
    in_order = F.array_sort(F.collect_list(F.struct("position", one.alias("kind"))))
    kinds = by_header.groupBy("names").agg(F.array_join(F.transform(in_order, lambda x: x["kind"]), ",").alias("kinds"))
    of_table = names.join(kinds, "names").select("table_name", "kinds")

    rows = attach(records.select("table_name", "fields"), of_table, "table_name")
    same = F.zip_with(F.split("kinds", ","), F.col("fields"), _comparable)
    copies = rows.select("table_name", same.alias("row")).groupBy("table_name", "row").agg(F.count(F.lit(1)).alias("n"))
    counted = copies.groupBy("table_name").agg(
        F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("duplicate_rows")
    )
    widths = names.select("table_name", F.size("names").alias("n_columns"))
    return (
        all_tables.join(widths, "table_name", "left")
        .join(counted, "table_name", "left")
        .select(
            "table_name", *[F.coalesce(name, F.lit(0)).alias(name) for name in ("n_rows", "n_columns", "duplicate_rows")]
        )
    )


def _comparable(kind: Column, value: Column) -> Column:
    """Texts that are equal for values that are equal."""
    number = value.try_cast("double") + F.lit(0.0)  # one zero
    return (
        F.when(kind == "bigint", value.try_cast("bigint").cast("string"))
        .when(kind == "double", number.cast("string"))
        .when(kind == "boolean", F.lower(value))
        .otherwise(comparable_text(value))
    )


def _first_rows(records: DataFrame, names: DataFrame, n_first: int) -> DataFrame:
    """``(table_name, row)``: the first records of each table as JSON objects of texts."""
    at = F.row_number().over(Window.partitionBy("table_name").orderBy("start", "position"))
    first = records.withColumn("at", at).filter(F.col("at") <= n_first).join(names, "table_name")
    values = F.transform("names", lambda name, i: F.get("fields", i))
    row = F.to_json(F.map_from_arrays("names", values), {"ignoreNullFields": "false"})
    return first.orderBy("table_name", "at").select("table_name", row.alias("row"))
