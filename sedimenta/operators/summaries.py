"""Grouped summaries described as data.

A measure is made of parts that can be merged: counts, sums, maxima. Spark reduces
the rows of a group within each task before the shuffle, so a group holding most of
the rows costs no more than others. Because parts merge, a summary by a lookup's
columns can also group by the lookup key first and join afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import exact_sums, percentage, round2
from sedimenta.operators.lookups import attach


@dataclass(frozen=True)
class Measure:
    """Aggregates over rows, how two results of each merge, and the value they give.

    With ``exact``, the name of a column, the last argument of ``value`` is its exact sum.
    """

    parts: Sequence[Column]
    merge: Callable[[str], Column]
    value: Callable[..., Column] = lambda part: part
    exact: str | None = None


def rows() -> Measure:
    return Measure([F.count(F.lit(1))], F.sum)


def rows_where(predicate: Column) -> Measure:
    """Rows for which the predicate is true; unknown is not counted."""
    return Measure([F.count_if(predicate)], F.sum)


def share_where(predicate: Column) -> Measure:
    """Percentage of rows for which the predicate is true, two decimals."""
    parts = [F.count_if(predicate), F.count(F.lit(1))]
    return Measure(parts, F.sum, lambda part, whole: round2(percentage(part, whole)))


def total(column: str) -> Measure:
    """Exact sum of an amount, rounded to a double once."""
    return Measure([], F.sum, exact=column)


def mean_money(column: str) -> Measure:
    """Mean of an amount from the exact sum, two decimals."""
    return Measure([F.count(column)], F.sum, lambda n, amount: _mean(amount, n), exact=column)


def mean_whole(column: str) -> Measure:
    """Mean of an integer column from the exact sum, two decimals."""
    return Measure([F.sum(F.col(column).cast("long")), F.count(column)], F.sum, _mean)


def largest(column: str) -> Measure:
    return Measure([F.max(column)], F.max)


def smallest(value: Column) -> Measure:
    return Measure([F.min(value)], F.min)


def _mean(amount: Column, n: Column) -> Column:
    return round2(F.try_divide(amount.cast("double"), n.cast("double")))


@dataclass(frozen=True)
class Summary:
    """Group keys and measures, both by output name.

    ``order`` holds output names, a leading ``-`` for descending. Nulls sort last
    both ways, and the keys break ties.
    """

    keys: Mapping[str, Column]
    measures: Mapping[str, Measure]
    order: Sequence[str] = ()
    required: Sequence[str] = ()


def summarise(df: DataFrame, spec: Summary) -> DataFrame:
    return ordered(grouped(df, spec), spec)


def grouped(df: DataFrame, spec: Summary) -> DataFrame:
    """The summary without its order, for storing."""
    keys = [expr.alias(name) for name, expr in spec.keys.items()]
    reduced = _prepared(df, spec).groupBy(*keys, *_bands(spec)).agg(*_parts(spec))
    return _finished(_gathered(reduced, spec), spec)


def grouped_before_attach(df: DataFrame, spec: Summary, lookup: DataFrame, key: str, **join_options) -> DataFrame:
    """Same as ``grouped`` of ``attach(df, lookup, key)``, with the rows reduced first.

    The rows are grouped by ``key``, one of the summary's keys, and any other keys that
    ``df`` has. What is joined and regrouped is one row per group instead of one per
    row. No measure may read a column of ``lookup``.
    """
    own = [expr.alias(name) for name, expr in spec.keys.items() if name not in lookup.columns or name == key]
    reduced = _prepared(df, spec).groupBy(*own, *_bands(spec)).agg(*_parts(spec))
    # a key has a row for each band of an exact sum, which are few
    joined = attach(reduced, lookup, key, one_row_per_key=len(own) == 1, **join_options)
    exact = [part for name in _exact(spec) for part in exact_sums.merged(name)]
    merged = joined.groupBy(*spec.keys, *_bands(spec)).agg(*_merged(spec), *exact)
    return _finished(_gathered(merged, spec), spec)


def ordered(summary: DataFrame, spec: Summary) -> DataFrame:
    """Sort a summary, also one read back: stored tables keep no order."""
    given = [name.lstrip("-") for name in spec.order]
    ties = [name for name in spec.keys if name not in given]
    return summary.orderBy(*[_sort_key(name) for name in (*spec.order, *ties)])


def _with_required(df: DataFrame, spec: Summary) -> DataFrame:
    for name in spec.required:
        df = df.filter(F.col(name).isNotNull())
    return df


def _exact(spec: Summary) -> dict[str, Column]:
    """The columns with exact sums, each once."""
    return {f"_{m.exact}": F.col(m.exact) for m in spec.measures.values() if m.exact is not None}


def _bands(spec: Summary) -> list[str]:
    return [exact_sums.band(name) for name in _exact(spec)]


def _prepared(df: DataFrame, spec: Summary) -> DataFrame:
    exact = _exact(spec)
    rows = _with_required(df, spec)
    return exact_sums.with_digits(rows, exact) if exact else rows


def _parts(spec: Summary) -> list[Column]:
    parts = [
        part.alias(_part(name, i)) for name, measure in spec.measures.items() for i, part in enumerate(measure.parts)
    ]
    return [*parts, *(part for name in _exact(spec) for part in exact_sums.sums(name))]


def _merged(spec: Summary) -> list[Column]:
    return [
        measure.merge(_part(name, i)).alias(_part(name, i))
        for name, measure in spec.measures.items()
        for i in range(len(measure.parts))
    ]


def _gathered(reduced: DataFrame, spec: Summary) -> DataFrame:
    """One row per group from one for each of its bands; there is a single band unless amounts differ extremely."""
    exact = _exact(spec)
    if not exact:
        return reduced
    every = [part for name in exact for part in exact_sums.gathered(name)]
    whole = reduced.groupBy(*spec.keys).agg(*_merged(spec), *every)
    return whole.withColumns({_total(name): exact_sums.total(name) for name in exact})


def _total(name: str) -> str:
    return f"{name}__total"


def _part(name: str, i: int) -> str:
    return f"{name}__{i}"


def _finished(parts: DataFrame, spec: Summary) -> DataFrame:
    values = [
        measure.value(
            *[F.col(_part(name, i)) for i in range(len(measure.parts))],
            *([] if measure.exact is None else [F.col(_total(f"_{measure.exact}"))]),
        ).alias(name)
        for name, measure in spec.measures.items()
    ]
    return parts.select(*spec.keys, *values)


def _sort_key(name: str) -> Column:
    return F.desc_nulls_last(name[1:]) if name.startswith("-") else F.asc_nulls_last(name)
