"""Column helpers shared by all layers.

Every helper is a composition of built-in Spark expressions, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that a CSV field must hold to be read as missing.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# year, month and day with the same separator, then an optional time of day
_TIME = r"([01]?\d|2[0-3]):[0-5]?\d(:[0-5]?\d(\.\d*)?)?"
_DATE_SHAPE = rf"^\s*\d+(-\d{{1,2}}-|/\d{{1,2}}/)\d{{1,2}}([ T]{_TIME})?\s*$"


def null_tokens_to_null(column: Column) -> Column:
    """The text, or null when the whole text is one of ``NULL_TOKENS``."""
    return F.when(column.isin(*NULL_TOKENS), F.lit(None)).otherwise(column)


def or_default(column: Column, default: str) -> Column:
    return F.coalesce(column, F.lit(default))


def as_date(column: Column, strict: bool = True) -> Column:
    """Date from ``YYYY-MM-DD`` or ``YYYY/MM/DD`` text with an optional time of day.

    Text of any other shape, a bare year among them, is not a date: it fails the
    job, or gives null with ``strict=False``. The outcome is the same whether or
    not the session runs in ANSI mode.
    """
    separator = F.substring(column, 5, 1)
    midnight = (F.length(column) == 19) & (F.substring(column, 11, 9) == " 00:00:00")
    # the usual forms, recognised without a regular expression
    usual = (
        ((F.length(column) == 10) | midnight)
        & separator.isin("-", "/")
        & (F.substring(column, 8, 1) == separator)
    )
    dashed = F.replace(column, F.lit("/"), F.lit("-"))
    parsed = F.when(usual | column.rlike(_DATE_SHAPE), dashed.try_cast("date"))
    if not strict:
        return parsed
    message = F.concat(F.lit("not a date: "), column)
    return F.coalesce(parsed, F.when(column.isNotNull(), F.raise_error(message).cast("date")))


def round2(column: Column) -> Column:
    """Two decimals by scaling the double, half away from zero.

    ``round(x, 2)`` works on the printed decimal instead, so 1.005 would become
    1.01 rather than 1.0.
    """
    scaled = column.cast("double") * F.lit(100.0)
    return F.round(scaled) / F.lit(100.0)


def percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as a double; null when ``whole`` is zero."""
    return F.try_divide(F.lit(100.0) * part, whole.cast("double"))
