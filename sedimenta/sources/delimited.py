"""CSV scans with declared types.

No type inference: every field is read as text, missing-value texts become null,
then columns are cast to the declared types. That costs one pass over the data,
and a file that breaks the declaration fails instead of changing its types.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions import null_tokens_to_null
from sedimenta.sources.records import csv_records, field_count
from sedimenta.sources.records import file_name as file_name_of

MALFORMED = "_malformed"
_RECORD, _FIELDS, _FILE, _TOO_LONG = "_record", "_fields", "_file", "_too_long"
EXTRA_FIELDS = "extra_fields"

_DIALECT = {"header": True, "sep": ",", "quote": '"', "escape": '"'}
# Files with line breaks inside quotes, read in splits.
SPLIT = "split"

_INTEGRAL = ("tinyint", "smallint", "int", "integer", "bigint", "long")


def csv_columns(spark: SparkSession, path: str, multi_line: bool = True) -> list[str]:
    """Column names in the header; reads one record."""
    return spark.read.options(**_DIALECT, multiLine=multi_line).csv(path).columns


def source_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; looks at names only."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def source_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """One row ``(file_name, path, n_bytes)`` per file. Lists only, reads no content."""
    if not source_exists(spark, folder):
        return spark.createDataFrame([], "file_name string, path string, n_bytes bigint")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return listed.select(name.alias("file_name"), "path", F.col("length").alias("n_bytes"))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    types: Mapping[str, str] | None = None,
    multi_line: bool | str = True,
    extra_fields: str = "fail",
    file_name: str | None = None,
) -> DataFrame:
    """All columns of a CSV file or folder, those in ``types`` cast to the given type.

    ``path`` can be a list of files with one header. ``multi_line`` allows line breaks
    inside quotes but makes a file one task; turn it off for large files without such
    breaks and they are read in splits. A break inside quotes then fails the job. With
    ``"split"`` (``SPLIT``) files that hold such breaks are read in splits too, in three
    scans; see ``csv_records`` for what it asks of quotes. Breaks inside quotes then stay as
    they are; elsewhere those of files whose lines end in ``\\r\\n`` become ``\\n``.

    A row shorter than the header is padded with nulls. A row with more fields
    fails the job; ``extra_fields="flag"`` keeps its leading fields instead and
    adds a boolean column ``extra_fields``, so that no row is cut unnoticed. With
    ``file_name`` a column of that name says which file a row is from.
    """
    if extra_fields not in ("fail", "flag"):
        raise ValueError(f"extra_fields must be 'fail' or 'flag', not {extra_fields!r}")
    types = dict(types or {})
    names = csv_columns(spark, path if isinstance(path, str) else path[0], bool(multi_line))
    absent = [name for name in types if name not in names]
    if absent:
        raise ValueError(f"columns missing from {path}: {', '.join(absent)}")

    if multi_line == SPLIT:
        fields = _split_fields(spark, path, names).withColumnRenamed(_FILE, file_name or _FILE)
        typed = [_typed(name, types.get(name, "string")) for name in names]
        named = [F.col(f"`{file_name}`")] if file_name else []
        return _without_extra_fields(fields, [*typed, *named], F.col(_TOO_LONG), len(names), F.col(_RECORD), extra_fields)

    text = T.StructType([T.StructField(name, T.StringType()) for name in [*names, MALFORMED]])
    raw = (
        spark.read.schema(text)
        .options(
            **_DIALECT,
            multiLine=multi_line,
            # every file must carry this header, in this order
            enforceSchema=False,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=MALFORMED,
            # the field count of a row is only known when the whole row is parsed
            columnPruning=False,
        )
        .csv(path)
    )
    # A query on the malformed text alone is refused, so a data column takes part: its
    # length is never negative.
    never = F.octet_length(F.col(f"`{names[0]}`")) < 0
    too_long = F.coalesce(_field_count(F.col(MALFORMED)) > len(names), never, F.lit(False))
    typed = [_typed(name, types.get(name, "string")) for name in names]
    if file_name:
        typed.append(file_name_of(F.col("_metadata.file_path")).alias(file_name))
    if not multi_line:
        quotes = F.length(F.col(MALFORMED)) - F.length(F.replace(F.col(MALFORMED), F.lit('"')))
        cut = F.concat(F.lit("a line break inside quotes, read with multi_line off: "), F.col(MALFORMED))
        whole = F.when(F.coalesce(quotes % 2 == 1, F.lit(False)), F.raise_error(cut).cast("boolean"))
        raw = raw.filter(whole.otherwise(True))
    return _without_extra_fields(raw, typed, too_long, len(names), F.col(MALFORMED), extra_fields)


def _without_extra_fields(
    raw: DataFrame, typed: list[Column], too_long: Column, n_fields: int, record: Column, extra_fields: str
) -> DataFrame:
    if extra_fields == "flag":
        return raw.select(*typed, too_long.alias(EXTRA_FIELDS))
    message = F.concat(F.lit(f"more than {n_fields} fields: "), record)
    return raw.filter(F.when(too_long, F.raise_error(message).cast("boolean")).otherwise(True)).select(*typed)


def _split_fields(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """The fields of all records but the headers, which are checked, beside the record and its file."""
    records = csv_records(spark, path).withColumn(_TOO_LONG, field_count(F.col("record")) > len(names))
    layout = ", ".join(f"_{i} string" for i in range(len(names)))
    options = {**{key: str(value) for key, value in _DIALECT.items() if key != "header"}, "multiLine": "true"}
    parsed = records.withColumn(_FIELDS, F.from_csv("record", layout, options))
    conforms = ~F.col(_TOO_LONG)
    for i, name in enumerate(names):
        # a column without a name, or with that of another column, is told by its position
        own = F.coalesce(F.col(_FIELDS)[f"_{i}"], F.lit(f"_c{i}"))
        conforms &= own.isin(name, name.removesuffix(str(i)))
    refused = F.raise_error(F.concat(F.lit("CSV header does not conform to the schema: "), F.col("record"))).cast("boolean")
    is_header = (F.col("start") == 0) & (F.col("position") == 0)
    data = parsed.filter(F.when(is_header, F.when(conforms, False).otherwise(refused)).otherwise(True))
    return data.select(
        *[F.col(_FIELDS)[f"_{i}"].alias(name) for i, name in enumerate(names)],
        F.col(_TOO_LONG),
        F.col("record").alias(_RECORD),
        file_name_of(F.col("path")).alias(_FILE),
    )


def _field_count(record: Column) -> Column:
    """Fields in a raw record: separators outside quotes, plus one."""
    unquoted = F.regexp_replace(record, r'"([^"]|"")*"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","))) + 1


def _typed(name: str, type_name: str) -> Column:
    value = null_tokens_to_null(F.col(f"`{name}`"))
    if type_name in _INTEGRAL:
        # a whole number written with a decimal point, as exports of nullable columns do
        value = F.regexp_replace(value, r"\.0+\s*$", "")
    return value.cast(type_name).alias(name)
