"""Exact quantiles with linear interpolation, without gathering a column in one task."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F

from sedimenta.sources.staging import staged

# A band of the values is ranked by one task once it holds no more than this.
BAND_VALUES = 100_000
ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame, names: Sequence[str], probabilities: Sequence[float], band_values: int = BAND_VALUES
) -> list[list[float | None]]:
    """The quantiles of each numeric column, nulls left out.

    Two passes over the data, however many columns there are and however they are
    distributed. The first finds approximate quantiles just below and above each wanted
    rank; these cut the values into bands. The second counts the rows up to every cut
    exactly, and in the same scan stores the few values of the narrow bands around the
    wanted ranks (``staged``). Ranks are then found among the stored values, by closing
    in on them where a band has more than ``band_values``. A rank outside the narrow
    bands, which the approximation has missed, is looked for in the data. The driver sees
    rows of counts. Where the cuts fall decides the number of passes and nothing else.
    """
    values = df.select(*[F.col(name).cast("double").alias(f"v{i}") for i, name in enumerate(names)])
    outline = values.agg(*[part for v in values.columns for part in _outline(v, probabilities)]).first()
    cuts = {v: _cuts(outline, v) for v in values.columns}
    narrow = {v: _narrow(cuts[v], outline[f"{v}_near"], probabilities) for v in values.columns}
    wanted = [part for v in values.columns for part in _counts(v, cuts[v])]
    if any(narrow.values()):
        counted = Observation()
        kept = [F.when(_inside_any(v, narrow[v]), F.col(v)).alias(v) for v in values.columns]
        some = F.coalesce(*[F.col(v) for v in values.columns]).isNotNull()
        near = staged(values.observe(counted, *wanted).select(*kept).filter(some))
        counts = counted.get
    else:  # every wanted rank is at a cut
        near, counts = values, values.agg(*wanted).first().asDict()
    return [
        _interpolated(near.select(v), values.select(v), v, probabilities, outline[f"{v}_n"], cuts[v], narrow[v], counts, band_values)
        for v in values.columns
    ]


def _narrow(cuts: list[float], near: list[float] | None, probabilities: Sequence[float]) -> list[tuple[float, float]]:
    """The bands between an approximate quantile below a wanted rank and the one above it."""
    if not near:
        return []
    at = dict(zip(_near_fractions(probabilities), near))
    around = [(at[low], at[high]) for low, high in map(_around, probabilities)]
    return [(low, high) for low, high in zip(cuts, cuts[1:]) if any(a <= low and high <= b for a, b in around)]


def _inside_any(v: str, bands: list[tuple[float, float]]) -> Column:
    inside = [(F.col(v) > low) & (F.col(v) < high) for low, high in bands]
    return reduce(lambda one, other: one | other, inside, F.lit(False))


def _interpolated(
    near: DataFrame,
    values: DataFrame,
    v: str,
    probabilities: Sequence[float],
    n_values: int,
    cuts: list[float],
    narrow: list[tuple[float, float]],
    counts: Mapping[str, int],
    band_values: int,
) -> list[float | None]:
    if not n_values:
        return [None for _ in probabilities]
    positions = [p * (n_values - 1) for p in probabilities]
    ranks = sorted({rank for at in positions for rank in (math.floor(at), math.ceil(at))})
    in_narrow = {rank for rank in ranks if _band_of(rank, v, cuts, counts) in narrow}
    found = _among_bands(near, v, sorted(in_narrow), cuts, counts, band_values)
    found |= _among_bands(values, v, [rank for rank in ranks if rank not in in_narrow], cuts, counts, band_values)
    result = []
    for at in positions:
        low, high = found[math.floor(at)], found[math.ceil(at)]
        # equal neighbours may be infinite, and their difference is then not a number
        result.append(low if low == high else low + (high - low) * (at - math.floor(at)))
    return result


def _band_of(rank: int, v: str, cuts: list[float], counts: Mapping[str, int]) -> tuple[float, float] | None:
    """The cuts that the value at a rank lies between, nothing if it is one of them."""
    for i in range(1, len(cuts)):
        if counts[f"{v}_upto{i - 1}"] <= rank < counts[f"{v}_below{i}"]:
            return cuts[i - 1], cuts[i]
    return None


def _search(values: DataFrame, v: str, ranks: list[int], n_rows: int, band_values: int) -> dict[int, float]:
    """Values at zero-based ranks among ``n_rows`` values, too many for one task."""
    cuts = _cuts(values.agg(*_outline(v, [rank / n_rows for rank in ranks])).first(), v)
    return _among_bands(values, v, ranks, cuts, values.agg(*_counts(v, cuts)).first().asDict(), band_values)


def _among_bands(
    values: DataFrame, v: str, ranks: list[int], cuts: list[float], counts: Mapping[str, int], band_values: int
) -> dict[int, float]:
    """Ranks that fall on a cut are found by counting, the others between two cuts.

    The bands that one task can rank are ranked together.
    """
    found, small, before, rank_of = {}, [], 0, {}
    for i, cut in enumerate(cuts):
        below, upto = counts[f"{v}_below{i}"], counts[f"{v}_upto{i}"]
        found.update({rank: cut for rank in ranks if below <= rank < upto})
        passed = counts[f"{v}_upto{i - 1}"] if i else 0
        between = [rank for rank in ranks if passed <= rank < below]
        if not between:
            continue
        inside = (F.col(v) > cuts[i - 1]) & (F.col(v) < cut)
        if below - passed <= band_values:
            small.append(inside)
            rank_of.update({rank - passed + before: rank for rank in between})
            before += below - passed
        else:
            moved = [rank - passed for rank in between]
            deeper = _search(values.filter(inside), v, moved, below - passed, band_values)
            found.update({rank + passed: value for rank, value in deeper.items()})
    if small:
        part = values.filter(reduce(lambda one, other: one | other, small))
        ranked = _ranked_in_one_task(part, v, list(rank_of))
        found.update({rank_of[rank]: value for rank, value in ranked.items()})
    return found


def _outline(v: str, fractions: Iterable[float]) -> list[Column]:
    return [
        F.count(v).alias(f"{v}_n"),
        F.min(v).alias(f"{v}_low"),
        F.max(v).alias(f"{v}_high"),
        F.percentile_approx(v, _near_fractions(fractions), ACCURACY).alias(f"{v}_near"),
    ]


def _around(fraction: float) -> tuple[float, float]:
    margin = 2 / ACCURACY
    return max(0.0, fraction - margin), min(1.0, fraction + margin)


def _near_fractions(fractions: Iterable[float]) -> list[float]:
    return sorted({side for fraction in fractions for side in _around(fraction)})


def _cuts(outline: Row, v: str) -> list[float]:
    """Distinct ascending cuts from the lowest to the highest value.

    The midpoint of the range is one of them, so a pass halves the range even where
    the approximation is of no help.
    """
    low, high, near = (outline[f"{v}_{part}"] for part in ("low", "high", "near"))
    if low is None:
        return []
    middle = low / 2 + high / 2
    return sorted({low, high, *near, *([middle] if math.isfinite(middle) else [])})


def _counts(v: str, cuts: list[float]) -> list[Column]:
    """Rows below each cut and up to it. A value repeated any number of times is a cut
    sooner or later, and is then found by these counts alone."""
    counts = [F.count(F.lit(1)).alias(f"{v}_rows")]
    for i, cut in enumerate(cuts):
        counts += [
            F.count_if(F.col(v) < cut).alias(f"{v}_below{i}"),
            F.count_if(F.col(v) <= cut).alias(f"{v}_upto{i}"),
        ]
    return counts


def _ranked_in_one_task(values: DataFrame, v: str, ranks: list[int]) -> dict[int, float]:
    upto = F.sum("n").over(Window.orderBy(v).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = values.groupBy(v).agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
    wanted = F.array(*[F.lit(rank).cast("long") for rank in ranks])
    hit = F.filter(wanted, lambda rank: (rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto")))
    rows = runs.select(F.explode(hit).alias("rank"), v).collect()
    return {row["rank"]: row[v] for row in rows}
