"""What several text operators share: words, hidden columns, and joins to counted keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.sources.staging import staged

# Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """All words of a text in order; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col(quoted(name))


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened where ``df`` has such a column."""
    taken = {x.lower() for x in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def require_free(df: DataFrame, *names: str) -> None:
    taken = {x.lower() for x in df.columns}
    if clash := [x for x in names if x.lower() in taken]:
        raise ValueError(f"columns already there: {', '.join(clash)}")


def bounded_batches(df: DataFrame, rows: int = 500) -> None:
    """Let the session send at most so many rows at a time to a Python function, since texts can be long."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, str(rows))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_counted(
    rows: DataFrame, keyed: DataFrame, keys: list[str], count: str, spread_on: list[str], how: str = "inner"
) -> DataFrame:
    """Join ``keyed``, which has one row per key and the number of rows of that key, to ``rows``.

    Keys may be null and then match null. ``keyed`` must be staged, since it is read more
    than once. Keys with more rows than an even partition are split over several tasks, by
    a hash of ``spread_on``, in proportion to their rows; there are at most as many of
    them as partitions, so the table that says so is small enough to be broadcast.
    """
    total = keyed.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    share = max(1, total // shuffle_partitions(rows))
    salt, salts, copy, *hidden = unused(rows, "_salt", "_salts", "_copy", *(f"_key{k}" for k in range(len(keys))))
    split = F.ceil(col(count) / share).cast("int")
    others = [x for x in keyed.columns if x not in keys]
    renamed = keyed.select(*(col(k).alias(h) for k, h in zip(keys, hidden)), *map(col, others))
    hot = renamed.filter(col(count) > share).select(*hidden, split.alias(salts))
    match = F.lit(True)
    for k, h in zip(keys, hidden):
        match = match & col(k).eqNullSafe(col(h))
    spread = F.pmod(F.xxhash64(*map(col, spread_on)), col(salts)).cast("int")
    salted = rows.join(F.broadcast(hot), match, "left").withColumn(salt, F.coalesce(spread, F.lit(0)))
    salted = salted.drop(*hidden, salts)
    every = F.sequence(F.lit(0), F.when(col(count) > share, split - 1).otherwise(F.lit(0)))
    copies = renamed.withColumn(copy, F.explode(every))
    return salted.join(copies, match & (col(salt) == col(copy)), how).drop(*hidden, salt, copy)


__all__ = [
    "WORD", "bounded_batches", "col", "join_counted", "quoted", "require_free", "shuffle_partitions", "staged",
    "unused", "words",
]
