"""Equi joins of a large table to a lookup table that hold up under skew.

The lookup side is broadcast only when its measured size is within a bound.
Otherwise both sides are shuffled, and the keys that hold a large share of the
large side are salted: their rows are spread over tasks in proportion, and only the
lookup rows of those keys are replicated. Null keys never match, so they are spread
without replicating anything. Both ways give the same rows.

Rows that are equal in all columns the salt is taken from stay together; adaptive
execution splits a partition that grows large for that reason.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.sources.staging import fingerprint

BROADCAST_BYTES = 64 * 1024 * 1024

# Tasks that a hot key is spread over for each even partition's worth of its rows.
SALTS_PER_SHARE = 4

# Types of known width, counted with room to spare.
_FIXED_TYPES = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp")
_FIXED_BYTES = 16
# Null keys match nothing, so nothing is replicated for them.
NULL_SALTS = 1 << 30
_SALT = "_salt"
_LOOKUP_SALT = "_lookup_salt"
_LOOKUP_KEY = "_lookup_key"
_HOT_KEY = "_hot_key"
_SALTS = "_salts"

# What has been measured in this application, by the meaning of the plan.
_measured: dict[tuple, tuple[int, object]] = {}


def attach(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str | None = None,
    how: str = "left",
    keys_in: DataFrame | None = None,
    screen: DataFrame | None = None,
    one_row_per_key: bool = False,
    spread_on: Sequence[str | Column] | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Join ``lookup`` to ``df`` on ``df.key = lookup.lookup_key`` (``left`` or ``inner``).

    The result has the columns of ``df`` and those of ``lookup`` but for its key. A
    repeated lookup key multiplies rows, as in any join.

    The other arguments save work and have no effect on the rows. ``keys_in`` is a frame
    with the column ``key`` that is cheaper to scan for hot keys than ``df``.
    ``screen`` is a stored table behind ``lookup`` to count first: where it is too
    large, ``lookup`` is neither measured nor broadcast. ``one_row_per_key`` says that
    ``df`` has been grouped by the key, so that no key can be hot. ``spread_on`` holds
    what to salt the rows of ``df`` by, all columns by default: few columns leave the
    others unread where nobody needs them.

    A hot key is salted in proportion to its rows, so the lookup rows that are replicated
    are at most a few per shuffle partition for each lookup row of a key, however many
    keys are hot.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    shared = set(df.columns) & (set(lookup.columns) - {lookup_key or key})
    if shared:
        raise ValueError(f"columns on both sides: {', '.join(sorted(shared))}")
    if how == "inner":
        df = df.filter(F.col(key).isNotNull())
    lookup = lookup.withColumnRenamed(lookup_key or key, _LOOKUP_KEY)
    match = F.col(key) == F.col(_LOOKUP_KEY)

    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if size_within(lookup, limit, screen):
        return df.join(F.broadcast(lookup), match, how).drop(_LOOKUP_KEY)
    lookup = lookup.filter(F.col(_LOOKUP_KEY).isNotNull())
    if one_row_per_key:
        return df.join(lookup, match, how).drop(_LOOKUP_KEY)

    hot = hot_keys(df if keys_in is None else keys_in, key)
    if not hot and how == "inner":
        return df.join(lookup, match, how).drop(_LOOKUP_KEY)
    spark = df.sparkSession
    # one row per hot key, of which there are fewer than shuffle partitions
    kind = df.select(F.col(key).alias(_HOT_KEY)).schema[_HOT_KEY].dataType
    schema = T.StructType([T.StructField(_HOT_KEY, kind), T.StructField(_SALTS, T.IntegerType())])
    table = F.broadcast(spark.createDataFrame(hot, schema))
    # The salt depends on the row alone, so a task that runs again sends its rows
    # to the same place.
    spread = F.xxhash64(*(spread_on or df.columns))
    salts = F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(F.col(_SALTS))
    salted = df.withColumn(_SALT, F.coalesce(spread, F.lit(0)))
    salted = salted.join(table, F.col(key) == F.col(_HOT_KEY), "left")
    salted = salted.withColumn(_SALT, F.coalesce(F.pmod(F.col(_SALT), salts), F.lit(0)).cast("int"))
    marked = lookup.join(table, F.col(_LOOKUP_KEY) == F.col(_HOT_KEY), "left")
    every_salt = F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)
    replicated = marked.withColumn(_LOOKUP_SALT, F.explode(every_salt)).drop(_HOT_KEY, _SALTS)
    match &= F.col(_SALT) == F.col(_LOOKUP_SALT)
    salted = salted.drop(_HOT_KEY, _SALTS)
    return salted.join(replicated, match, how).drop(_LOOKUP_KEY, _SALT, _LOOKUP_SALT)


def size_within(df: DataFrame, n_bytes: int, screen: DataFrame | None = None) -> bool:
    """Whether the rows of ``df`` take at most ``n_bytes``.

    A row counts with a fixed width per column plus the lengths of its texts. Rows are
    counted first, which for a Parquet table reads no data, so the texts of a large
    table are never measured. The answer is no for columns of other types.
    """
    if n_bytes <= 0 or not all(kind == "string" or kind.startswith(_FIXED_TYPES) for _, kind in df.dtypes):
        return False
    fixed = _FIXED_BYTES * len(df.columns)
    counted = df if screen is None else screen
    if _once(counted, ("rows",), counted.count) * fixed > n_bytes:
        return False
    texts = [name for name, kind in df.dtypes if kind == "string"]
    if screen is None and not texts:
        return True
    width = F.lit(fixed).cast("long")
    for name in texts:
        width += F.coalesce(F.octet_length(name), F.lit(0))
    total = df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("n"))
    return _once(df, ("bytes",), lambda: total.first()["n"]) <= n_bytes


def hot_keys(df: DataFrame, key: str, partitions: int | None = None) -> list[tuple]:
    """Keys with more rows than an even shuffle partition, each with its number of salts.

    The rows of each key are counted, in each task before the shuffle, so the answer is
    exact and there is no least share below which a key is overlooked. Fewer keys than
    partitions can be hot, and their salts add up to a few per partition. It only steers
    the salting and has no effect on results.
    """
    partitions = partitions or _shuffle_partitions(df)

    def count() -> list[tuple]:
        counts = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        share = total / partitions
        hot = counts.filter(F.col("n") > share).collect()
        return sorted((row["k"], math.ceil(SALTS_PER_SHARE * row["n"] / share)) for row in hot)

    return _once(df.select(key), ("hot", partitions), count)


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _once(df: DataFrame, what: tuple, measure: Callable[[], object]):
    """A figure of ``df``, measured once per application for plans that mean the same and files that are the same."""
    spark = df.sparkSession
    key = (spark.sparkContext.applicationId, df.semanticHash(), *what)
    state = fingerprint(spark, df.inputFiles())
    if key not in _measured or _measured[key][0] != state:
        _measured[key] = (state, measure())
    return _measured[key][1]
