"""Data-quality checks: one value each, a predicate on it, and a severity.

A value is made of one or two aggregates. All aggregates over the same table, from
whichever checks, are computed in a single scan of it. Checks that need a shuffle of
their own (uniqueness, references) are separate branches of the same job.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    SparkRuntimeException,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions import exact_sums, percentage

CRITICAL = "critical"
WARNING = "warning"

FAIL = "FAIL"
ERROR = "ERROR"

RESULT_SCHEMA = (
    "position int, layer string, name string, description string, severity string, "
    "value double, passed boolean, status string, error string"
)

# Counts and totals of amounts; a double holds any count below 2**53.
VALUE = "double"

Tables = Mapping[str, DataFrame]

# A table that is not there, or a column, or an expression of the wrong type.
PLANNING_ERRORS = (AnalysisException, LookupError)

# Values that an expression cannot take, as the engine reports them. A lost executor or
# unreadable storage is none of these.
DATA_ERRORS = (
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    SparkRuntimeException,
)


@dataclass(frozen=True)
class Part:
    """One aggregate over a table, or over a frame made from the tables.

    It is ``aggregate``, or the exact sum of the column ``exact``. Counts merge by addition; another aggregate needs a
    ``merge`` of its own. ``refused`` counts the rows that the aggregate could not take, and ``example`` is one of them.
    """

    over: str | Callable[[Tables], DataFrame]
    aggregate: Column | None = None
    exact: str | None = None
    merge: Callable[[str], Column] = lambda name: _total_or_zero(F.col(name))
    refused: Column | None = None
    example: Column | None = None

    def frame(self, tables: Tables) -> DataFrame:
        return self.over(tables) if callable(self.over) else tables[self.over]


@dataclass(frozen=True)
class Check:
    """A named check.

    ``value`` combines the parts, and ``passes`` judges the value. A value for which
    that is unknown (null) counts as not passed, with the status ``on_null``.
    """

    layer: str
    name: str
    parts: Sequence[Part]
    passes: Callable[[Column], Column]
    severity: str = CRITICAL
    description: str = ""
    value: Callable[..., Column] = lambda part: part
    on_null: str = FAIL


Members = list[tuple[int, Check]]


# ---- check types -----------------------------------------------------------------
# Each takes the layer, a name, what to look at, and optionally the severity and a
# description.


def row_count_at_least(layer: str, name: str, table: str, n: int, **options) -> Check:
    return Check(layer, name, [Part(table, _rows())], lambda v: v >= n, on_null=ERROR, **options)


def not_empty(layer: str, name: str, table: str, **options) -> Check:
    return Check(layer, name, [Part(table, _rows())], lambda v: v > 0, on_null=ERROR, **options)


def no_rows_where(
    layer: str, name: str, table: str, predicate: Column, columns: Sequence[str] = (), **options
) -> Check:
    """No row meets the predicate; rows for which it is unknown do not count.

    Rows with values that the predicate cannot take are counted in the same scan and make the check an ERROR, with
    ``columns`` of one of them as an example.
    """
    outcome = _tried(predicate)
    example = F.min(F.when(outcome.isNull(), F.to_json(F.struct(*columns)))) if columns else None
    part = Part(table, F.count_if(outcome == 1), refused=F.count_if(outcome.isNull()), example=example)
    return Check(layer, name, [part], _is_zero, **options)


def positive(layer: str, name: str, table: str, column: str, **options) -> Check:
    return no_rows_where(layer, name, table, F.col(column) <= 0, [column], **options)


def in_range(layer: str, name: str, table: str, column: str, low, high, **options) -> Check:
    return no_rows_where(layer, name, table, (F.col(column) < low) | (F.col(column) > high), [column], **options)


def in_order(layer: str, name: str, table: str, first: str, second: str, **options) -> Check:
    return no_rows_where(layer, name, table, F.col(first) > F.col(second), [first, second], **options)


def every_group_has(layer: str, name: str, table: str, count_column: str, n: int = 1, **options) -> Check:
    return no_rows_where(layer, name, table, F.col(count_column) < n, **options)


def no_nulls(layer: str, name: str, table: str, column: str, **options) -> Check:
    """The null percentage is zero. It is null, and the check fails, on an empty table."""
    parts = [Part(table, F.count_if(F.col(column).isNull())), Part(table, _rows())]
    return Check(layer, name, parts, _is_zero, value=percentage, **options)


def unique(layer: str, name: str, table: str, key: str, **options) -> Check:
    """No repeated key. Rows with a null key count as repeats.

    Rows are counted per key first, so a key on many rows leaves each task once.
    """

    def per_key(tables: Tables) -> DataFrame:
        return tables[table].groupBy(F.col(key).alias("k")).agg(_rows().alias("n"))

    beyond_first = F.when(F.col("k").isNull(), F.col("n")).otherwise(F.col("n") - 1)
    return Check(layer, name, [Part(per_key, _total_or_zero(beyond_first))], _is_zero, **options)


def references(
    layer: str, name: str, table: str, key: str, parent: str, parent_key: str | None = None, **options
) -> Check:
    """Every non-null key is found in the parent table; the value counts rows.

    Both sides are reduced to one row per key before the anti join, whichever keys
    hold most of the rows.
    """

    def orphans(tables: Tables) -> DataFrame:
        children = tables[table].filter(F.col(key).isNotNull())
        per_key = children.groupBy(F.col(key).alias("k")).agg(_rows().alias("n"))
        known = tables[parent].select(F.col(parent_key or key).alias("k")).distinct()
        return per_key.join(known, "k", "left_anti")

    return Check(layer, name, [Part(orphans, _total_or_zero(F.col("n")))], _is_zero, **options)


def totals_reconcile(
    layer: str, name: str, left: tuple[str, str], right: tuple[str, str], tolerance: float = 1, **options
) -> Check:
    """Two ``(table, column)`` totals differ by less than the tolerance.

    Totals are exact sums, rounded once. A total over no rows is null, and the comparison is then an error.
    """
    parts = [Part(table, exact=column) for table, column in (left, right)]
    return Check(
        layer,
        name,
        parts,
        lambda v: v < tolerance,
        value=lambda one, other: F.abs(one - other),
        on_null=ERROR,
        **options,
    )


def _rows() -> Column:
    return F.count(F.lit(1))


def _total_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def _is_zero(value: Column) -> Column:
    return value == 0


def _tried(predicate: Column) -> Column:
    """1, 0 or 2 for true, false or unknown, and null where the predicate raises an error.

    Of the functions that try, the sum of a date and an interval is one that takes any error of its arguments, so the
    outcome is passed through it as a date.
    """
    day = F.lit(datetime.date(2000, 1, 1))
    coded = F.date_add(day, F.coalesce(predicate.cast("int"), F.lit(2)))
    return F.datediff(F.try_add(coded, F.expr("INTERVAL '0' MONTH")), day)


# ---- running ---------------------------------------------------------------------


def check_rows(tables: Tables, checks: Sequence[Check], spark: SparkSession | None = None) -> DataFrame:
    """One lazy result row per check, in a single job.

    A check that cannot be planned, for a missing table or column, becomes an ERROR
    row and the others go on. So does one that meets values its predicate cannot take.
    """
    planned, broken = _planned(tables, list(enumerate(checks)))
    if not broken:
        return _results(tables, planned)
    errors = (spark or _spark(tables)).createDataFrame(broken, RESULT_SCHEMA)
    return _results(tables, planned).unionByName(errors) if planned else errors


def run_checks(tables: Tables, checks: Sequence[Check], spark: SparkSession | None = None) -> DataFrame:
    """Result rows, computed on call; an error in one check leaves the others alone.

    All checks run as one job, in which predicates that meet values they cannot take
    become ERROR rows. If an aggregate of another kind fails on the data, the halves run by
    themselves, and so on, until the failing ones are alone and become ERROR rows. Other
    failures, of an executor or the storage, are not answers and end the run. Only result
    rows reach the driver, one per check.
    """
    planned, broken = _planned(tables, list(enumerate(checks)))
    rows = sorted([*broken, *_collected(tables, planned)], key=lambda row: row[0])
    return (spark or _spark(tables)).createDataFrame(rows, RESULT_SCHEMA)


def _planned(tables: Tables, members: Members) -> tuple[Members, list[tuple]]:
    """The checks that can be planned, and ERROR rows for the others."""
    try:
        if members:
            _results(tables, members)
        return members, []
    except PLANNING_ERRORS as error:
        if len(members) == 1:
            position, check = members[0]
            return [], [_error_row(position, check, error)]
    half = len(members) // 2
    one, other = _planned(tables, members[:half]), _planned(tables, members[half:])
    return [*one[0], *other[0]], [*one[1], *other[1]]


def _collected(tables: Tables, members: Members) -> list[tuple]:
    if not members:
        return []
    try:
        return _results(tables, members).collect()
    except DATA_ERRORS as error:
        if len(members) == 1:
            position, check = members[0]
            return [_error_row(position, check, error)]
    half = len(members) // 2
    return _collected(tables, members[:half]) + _collected(tables, members[half:])


def _results(tables: Tables, members: Sequence[tuple[int, Check]]) -> DataFrame:
    """Parts by table, one row each; gathered into a single row; then one row per check."""
    by_table, names = {}, []
    for position, check in members:
        for i, part in enumerate(check.parts):
            name = f"part_{position}_{i}"
            names.append(name)
            by_table.setdefault(part.over, []).append((name, part))
    frames = [_computed(parts[0][1].frame(tables), parts) for parts in by_table.values()]
    gathered = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if len(frames) > 1:
        gathered = gathered.agg(*[F.max(name).alias(name) for name in gathered.columns])
    judged = gathered.select(F.inline(F.array(*[_judged(position, check) for position, check in members])))
    unknown = F.col("outcome").isNull()
    return judged.select(
        "position",
        "layer",
        "name",
        "description",
        "severity",
        "value",
        F.coalesce("outcome", F.lit(False)).alias("passed"),
        F.when(unknown, F.col("on_null")).when(F.col("outcome"), "PASS").otherwise(FAIL).alias("status"),
        F.when(unknown & (F.col("on_null") == ERROR), F.coalesce("refusal", F.lit("the value is null"))).alias("error"),
    )


def _computed(frame: DataFrame, parts: Sequence[tuple[str, Part]]) -> DataFrame:
    """One row with all parts over one frame, in one scan of it, and with what they refused."""
    exact = {name: F.col(part.exact) for name, part in parts if part.exact is not None}
    own, merged = [], []
    for name, part in parts:
        if part.aggregate is not None:
            own.append(part.aggregate.cast(VALUE).alias(name))
            merged.append(part.merge(name).cast(VALUE).alias(name))
        if part.refused is not None:
            own.append(part.refused.alias(f"refused_{name}"))
            merged.append(F.sum(f"refused_{name}").alias(f"refused_{name}"))
        if part.example is not None:
            own.append(part.example.alias(f"example_{name}"))
            merged.append(F.min(f"example_{name}").alias(f"example_{name}"))
    if not exact:
        return frame.agg(*own)
    # one row for each band of an exact sum, and then one
    rows = exact_sums.with_digits(frame, exact).groupBy(*map(exact_sums.band, exact))
    by_band = rows.agg(*own, *(column for name in exact for column in exact_sums.sums(name)))
    return by_band.agg(*merged, *(exact_sums.total_of(name).alias(name) for name in exact))


def _judged(position: int, check: Check) -> Column:
    names = [f"part_{position}_{i}" for i in range(len(check.parts))]
    value = check.value(*map(F.col, names))
    guarded = [(name, part) for name, part in zip(names, check.parts) if part.refused is not None]
    refused = reduce(lambda a, b: a + b, [F.coalesce(f"refused_{name}", F.lit(0)) for name, _ in guarded], F.lit(0))
    value = F.when(refused == 0, value) if guarded else value
    examples = [F.concat(F.lit(", such as "), F.col(f"example_{name}")) for name, part in guarded if part.example is not None]
    refusal = F.concat(F.format_string("%d rows have values that the check cannot take", refused), F.coalesce(*examples, F.lit("")))
    known = {
        "position": position,
        "layer": check.layer,
        "name": check.name,
        "description": check.description,
        "severity": check.severity,
    }
    return F.struct(
        *[F.lit(constant).alias(name) for name, constant in known.items()],
        F.when(refused > 0, ERROR).otherwise(check.on_null).alias("on_null"),
        value.cast("double").alias("value"),
        check.passes(value).alias("outcome"),
        F.when(refused > 0, refusal).alias("refusal"),
    )


def _error_row(position: int, check: Check, error: Exception) -> tuple:
    text = f"{type(error).__name__}: {error}"
    return (position, check.layer, check.name, check.description, check.severity, None, False, ERROR, text)


def _spark(tables: Tables) -> SparkSession:
    return next(iter(tables.values())).sparkSession
