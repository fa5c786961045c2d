"""Table profiles: shape, columns, missing values, copies, statistics, value counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import exact_sums, percentage, round2
from sedimenta.operators.quantiles import BAND_VALUES, exact_quantiles

# Texts longer than this are compared by their SHA-256 digest. A marked digest is
# itself longer, so it can never equal a text that was left as it is.
_DIGEST_OVER = 64

_COPIES = "_copies_of_a_row"

_FLOATS = ("float", "double")


def shape(df: DataFrame) -> DataFrame:
    """One row ``(n_rows, n_columns)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def columns(df: DataFrame) -> DataFrame:
    """One row per column: ``(position, column, type, non_null)``, from one scan."""
    counted = df.agg(*[F.count(_present(df, name)).alias(str(i)) for i, name in enumerate(df.columns)])
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col(str(i)).alias("non_null"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counted.select(F.inline(F.array(*entries)))


def nulls(df: DataFrame) -> DataFrame:
    """``(column, null_count, null_pct)`` of the columns with missing values, most first."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(_present(df, name)).alias(str(i)) for i, name in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            (F.col("n") - F.col(str(i))).alias("null_count"),
            round2(percentage(F.col("n") - F.col(str(i)), F.col("n"))).alias("null_pct"),
        )
        for i, name in enumerate(df.columns)
    ]
    return (
        counted.select(F.inline(F.array(*entries)))
        .filter(F.col("null_count") > 0)
        .orderBy(F.desc("null_count"), "column")
    )


def duplicates(df: DataFrame) -> DataFrame:
    """One row ``(duplicate_rows)``: rows equal to another row counted before them.

    Long texts are shuffled as digests, and copies are merged before the shuffle.
    """
    narrow = df.select(*[_comparable(df, name) for name in df.columns])
    copies = narrow.groupBy(*narrow.columns).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return copies.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_rows"))


QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, names: Sequence[str], band_values: int = BAND_VALUES) -> DataFrame:
    """Statistics of numeric columns, one row each, two decimals.

    ``(column, count, mean, std, min, q25, q50, q75, max)``: sample deviation, exact
    quantiles with linear interpolation, searched for on call. Mean and deviation come from
    exact sums, of the values and of their distances from the median and the squares of
    those, so they are the same however the rows are partitioned.
    """
    if not names:
        raise ValueError("no columns to describe")
    values = df.select(*[_present(df, name).cast("double").alias(f"v{i}") for i, name in enumerate(names)])
    found = exact_quantiles(values, values.columns, QUARTILES, band_values)
    quartiles = [F.array(*[F.lit(q).cast("double") for q in of_column]) for of_column in found]
    exact, own, merged = {}, [], []
    for i, (quartile, (_, median, _)) in enumerate(zip(quartiles, found)):
        value = F.col(f"v{i}")
        distance = value - F.lit(median).cast("double")
        exact |= {f"sum{i}": value, f"distances{i}": distance, f"squares{i}": distance * distance}
        own += [F.count(value).alias(f"count{i}"), F.min(value).alias(f"min{i}"), F.max(value).alias(f"max{i}")]
        merged += [F.sum(f"count{i}").alias(f"count{i}"), F.min(f"min{i}").alias(f"min{i}"), F.max(f"max{i}").alias(f"max{i}")]
        merged.append(quartile.alias(f"quartiles{i}"))
    by_band = exact_sums.with_digits(values, exact).groupBy(*map(exact_sums.band, exact))
    by_band = by_band.agg(*own, *(part for name in exact for part in exact_sums.sums(name)))
    whole = by_band.agg(*merged, *(part for name in exact for part in exact_sums.gathered(name)))
    moments = {}
    for i in range(len(names)):
        n = F.col(f"count{i}").cast("double")
        distances, squares = exact_sums.total(f"distances{i}"), exact_sums.total(f"squares{i}")
        moments[f"mean{i}"] = F.try_divide(exact_sums.total(f"sum{i}"), n)
        moments[f"std{i}"] = F.when(n > 1, F.sqrt((squares - distances * distances / n) / (n - 1)))
    whole = whole.withColumns({f"count{i}": F.coalesce(f"count{i}", F.lit(0)) for i in range(len(names))}).withColumns(moments)
    described = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"count{i}").alias("count"),
            *[round2(F.col(f"{stat}{i}")).alias(stat) for stat in ("mean", "std", "min")],
            *[round2(F.col(f"quartiles{i}")[j]).alias(f"q{p * 100:.0f}") for j, p in enumerate(QUARTILES)],
            round2(F.col(f"max{i}")).alias("max"),
        )
        for i, name in enumerate(names)
    ]
    return whole.select(F.inline(F.array(*described)))


def value_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` of several columns from one scan, most frequent first."""
    pairs = [F.struct(F.lit(name).alias("column"), _present(df, name).cast("string").alias("value")) for name in names]
    return (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("column", F.desc("n"), "value")
    )


def head(df: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """First ``n`` rows in the order of ``by``; a stored table has no order of its own."""
    return df.orderBy(*[F.asc_nulls_last(name) for name in by]).limit(n)


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)``, one row per table, counted in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


# Types that a column of texts can have, the first that all its values fit.
KINDS = {
    "bigint": lambda text: text.try_cast("bigint").isNotNull(),
    "double": lambda text: text.try_cast("double").isNotNull(),
    "boolean": lambda text: F.lower(text).isin("true", "false"),
}


def columns_by_table(df: DataFrame, table: str, names: Sequence[str]) -> DataFrame:
    """``(table_name, position, column, type, non_null, n_rows)`` for columns of texts.

    ``table`` names the column that tells the tables apart. One aggregate finds how many
    values there are and which types hold them all; a column without values is a string.
    """
    counted = df.groupBy(F.col(table).alias("table_name")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(f"`{name}`")).alias(f"n{i}") for i, name in enumerate(names)],
        *[
            F.count_if(fits(F.col(f"`{name}`"))).alias(f"{kind}{i}")
            for i, name in enumerate(names)
            for kind, fits in KINDS.items()
        ],
    )
    entries = []
    for i, name in enumerate(names):
        kind = F.lit("string")
        for known in reversed(KINDS):
            kind = F.when((F.col(f"n{i}") > 0) & (F.col(f"{known}{i}") == F.col(f"n{i}")), known).otherwise(kind)
        entries.append(
            F.struct(
                F.lit(i).alias("position"), F.lit(name).alias("column"), kind.alias("type"), F.col(f"n{i}").alias("non_null")
            )
        )
    return counted.select("table_name", "n_rows", F.inline(F.array(*entries)))


def copies_by_table(df: DataFrame, table: str, tables: DataFrame) -> DataFrame:
    """``(table_name, n_rows, n_columns, duplicate_rows)`` of the tables told apart by the column ``table``.

    ``tables`` lists all ``table_name``, also of those without rows.
    """
    names = [name for name in df.columns if name != table]
    narrow = df.select(F.col(table).alias(table), *[_comparable(df, name) for name in names])
    copies = narrow.groupBy(*[F.col(f"`{name}`") for name in narrow.columns]).agg(F.count(F.lit(1)).alias(_COPIES))
    counted = copies.groupBy(F.col(table).alias("table_name")).agg(
        F.sum(_COPIES).alias("n_rows"), F.sum(F.col(_COPIES) - 1).alias("duplicate_rows")
    )
    return tables.join(counted, "table_name", "left").select(
        "table_name",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.lit(len(names)).alias("n_columns"),
        F.coalesce("duplicate_rows", F.lit(0)).alias("duplicate_rows"),
    )


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows, n_columns, duplicate_rows)`` of several tables."""
    profiles = []
    for name, df in tables.items():
        narrow = df.select(*[_comparable(df, column) for column in df.columns])
        copies = narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("n"))
        profiles.append(
            copies.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                F.lit(len(df.columns)).alias("n_columns"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    return reduce(DataFrame.unionByName, profiles)


def _present(df: DataFrame, name: str) -> Column:
    """The value, with not-a-number counted as missing."""
    column = F.col(f"`{name}`")
    if dict(df.dtypes)[name] in _FLOATS:
        return F.when(~F.isnan(column), column)
    return column


def _comparable(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    if dict(df.dtypes)[name] != "string":
        return column.alias(name)
    return comparable_text(column).alias(name)


def comparable_text(column: Column) -> Column:
    """The text, or the digest of a long one."""
    digest = F.concat(F.lit("sha256:"), F.sha2(column, 256))
    return F.when(F.octet_length(column) > _DIGEST_OVER, digest).otherwise(column)
