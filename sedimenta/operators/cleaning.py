"""Cleaning: filter on raw columns, project, drop exact copies, then derive."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CleanSpec:
    """What a cleaned table holds.

    ``required`` columns must not be null and ``positive`` ones must exceed zero.
    Both name raw columns: a default set in ``select`` cannot rescue a row. The
    columns in ``derived`` are computed from those in ``select``.
    """

    select: Sequence[Column]
    required: Sequence[str] = ()
    positive: Sequence[str] = ()
    derived: Mapping[str, Column] = field(default_factory=dict)


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Rows that meet the spec, projected and distinct.

    ``distinct`` is planned as an aggregation with a map-side step, so a row copied
    many times leaves each task only once. Derived columns follow from the others and
    are added after it, so they are not shuffled.
    """
    wanted = [F.col(name).isNotNull() for name in (*spec.required, *spec.positive)]
    wanted += [F.col(name) > 0 for name in spec.positive]
    kept = df.filter(reduce(lambda a, b: a & b, wanted)) if wanted else df
    return kept.select(*spec.select).distinct().withColumns(dict(spec.derived))
