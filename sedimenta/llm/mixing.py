"""Mixing sources to target weights by Sainte-Laguë apportionment, with DataFrame functions only.

Each source has a target in words. Documents are dealt to shards by a hash, laid end to end in a seeded order, and
cut into blocks of equal length (the last of a shard may be shorter). Blocks are given to sources by the highest
quotients, then in the same way to the shards of a source, and each shard takes its number of blocks from a seeded
start on, round the end. A document's share is the part of it that lies in the blocks taken.

The texts are read once, for their sizes. What is sorted in one task is a shard, whose documents are bounded by
``shard_rows``, and the list of sources, with one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import WORD, col, staged, unused

SHARD_ROWS = 50_000
BLOCK_WORDS = 8


def sized(df: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """``key``, ``source`` and ``size``, the words of the text; a null text has none."""
    size = F.coalesce(F.regexp_count(col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return df.select(col(key).alias("key"), col(source).alias("source"), size.alias("size"))


def mixed(
    sizes: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: int = 42,
    block_words: int = BLOCK_WORDS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per row of ``sizes`` (``key``, ``source``, ``size``): these and ``source_size``, ``target``, ``taken``.

    Sources in code point order, null last, have ``weights`` in turn. They share ``share`` of all words by weight; no
    target is over ``most`` times its source, and what is cut off is shared by weight among the rest until none is
    above. ``taken`` adds up, per source, to its target up to about a block per shard, and is at most ``most`` times the
    size. The result depends on the rows and the seed alone. Rows that repeat key, source and size are documents of
    their own; which of them gets which of their shares is open, as they do not differ. An empty source has target 0.
    """
    rows = staged(sizes.withColumn("shard", _shard(sizes, seed, shard_rows)))
    shards = staged(
        rows.groupBy("source", "shard")
        .agg(F.sum("size").alias("shard_size"))
        .withColumn("blocks", F.ceil(F.col("shard_size") / block_words).cast("long"))
    )
    sources = shards.groupBy("source").agg(
        F.sum("shard_size").alias("source_size"), F.sum("blocks").alias("source_blocks")
    )
    sources = staged(_targets(sources, weights, share, most))
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("source_blocks"))
    wanted = F.coalesce(wanted, F.lit(0.0))
    total = sources.agg(F.round(F.sum(wanted)).cast("long")).first()[0] or 0
    given = _apportioned(
        sources.withColumn("votes", wanted).withColumn("seats", F.lit(total)),
        [],
        F.col("source_blocks") * most,
        [F.col("source").asc_nulls_last()],
        "source_quota",
    ).select("source", "source_size", "target", "source_quota")
    same = shards["source"].eqNullSafe(given["source"])
    dealt = shards.join(given, same).drop(given["source"])
    quotas = _apportioned(
        dealt.withColumn("votes", F.col("blocks").cast("double")).withColumn("seats", F.col("source_quota")),
        ["source"],
        F.col("blocks") * most,
        [F.col("shard")],
        "quota",
    )
    quotas = staged(quotas.select("source", "shard", "shard_size", "blocks", "source_size", "target", "quota"))

    order = F.xxhash64(F.lit(seed), F.col("key"))
    window = Window.partitionBy("source", "shard").orderBy(order, "key", "size")
    placed = rows.withColumn("stop", F.sum("size").over(window.rowsBetween(Window.unboundedPreceding, 0)))
    match = placed["source"].eqNullSafe(quotas["source"]) & (placed["shard"] == quotas["shard"])
    full = placed.join(quotas, match).drop(quotas["source"], quotas["shard"])
    return full.select("key", "source", "size", "source_size", "target", _taken(seed, block_words).alias("taken"))


def repeated(df: DataFrame, text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``df`` in the mix, each whole and as often as the mix takes it; ``options`` are those of ``mixed``.

    What is left over when a row's share is made a whole number goes to the next row of its source, from short to long
    ones, and from shard to shard. A source thus comes within about a document of its target per shard, and one with a
    target above zero always has a row. No row comes more than ``most`` times. Rows are told apart by all their
    columns, so ids may repeat or be null; of rows equal in all columns it is open which are taken. Texts without
    words are not taken. All columns stay, whatever their names.
    """
    own, times, rows = unused(df, "_row", "_times", "_rows")
    marked = df.withColumn(own, _identity(df))
    shares = mixed(sized(marked, text, own, source), **options)
    share = F.coalesce(F.try_divide("taken", "size"), F.lit(0.0))
    shares = shares.select("key", "source", "size", share.alias("share"))
    shards = -(-df.count() // options.get("shard_rows", SHARD_ROWS)) or 1
    shard = F.pmod(F.xxhash64(F.lit("share"), F.col("key")), F.lit(shards))
    shares = staged(shares.withColumn("shard", shard))
    by_shard = shares.groupBy("source", "shard").agg(F.sum("share").alias("shares"))
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_shard.select(
        F.col("source").alias("of"), F.col("shard").alias("at"), F.coalesce(F.sum("shares").over(before), F.lit(0.0)).alias("offset")
    )
    same = shares["source"].eqNullSafe(offsets["of"]) & (shares["shard"] == offsets["at"])
    window = Window.partitionBy("source", "shard").orderBy("size", "key").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("offset") + F.sum("share").over(window)
    noise = 1e-6  # of the sums
    whole = (F.ceil(upto - noise) - F.ceil(upto - F.col("share") - noise)).cast("int")
    counted = shares.join(offsets, same).withColumn(times, F.least(whole, F.lit(options.get("most", 2))))
    keyed = staged(
        counted.groupBy("key").agg(F.sum(times).cast("int").alias(times), F.count(F.lit(1)).cast("int").alias(rows))
    ).filter(F.col(times) > 0).withColumnRenamed("key", own)
    joined = marked.join(keyed, own)
    # rows that are equal share their number; what cannot be divided goes to one of them
    each = F.floor(F.col(times) / F.col(rows)).cast("int")
    parts = [joined.withColumn(times, each).filter(F.col(times) > 0)]
    again = keyed.filter(F.col(rows) > 1)
    if not again.isEmpty():
        left = marked.join(again, own, "left_semi").dropDuplicates([own]).join(again, own)
        parts.append(left.withColumn(times, F.col(times) % F.col(rows)).filter(F.col(times) > 0))
    every = [part.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*map(col, df.columns)) for part in parts]
    return every[0] if len(every) == 1 else every[0].union(every[1])


def _identity(df: DataFrame) -> Column:
    """Two hashes of all columns of a row; nulls count by their place."""
    nulls = F.concat(F.lit(""), *(F.when(col(x).isNull(), "1").otherwise("0") for x in df.columns))
    values = [F.to_json(F.struct(col(x))) if "map<" in kind else col(x) for x, kind in df.dtypes]
    return F.struct(*(F.xxhash64(F.lit(seed), nulls, *values).alias(f"h{seed}") for seed in (1, 2)))


def _shard(sizes: DataFrame, seed: int, shard_rows: int) -> Column:
    """All sources use the same number of shards, so a source with a third of the rows has as many as any."""
    shards = -(-sizes.count() // shard_rows) or 1
    return F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), F.col("key")), F.lit(shards))


def _targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: int) -> DataFrame:
    """``sources`` with ``target``.

    A source is above its limit if its part of what the sources with a lower limit per weight leave over is. In the
    order of limit per weight, those that are cut come first, so running sums say where to stop.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))))
    limits = sources.withColumn("weight", weight).withColumn("limit", (F.col("source_size") * most).cast("double"))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        limits.withColumn("goal", F.sum("source_size").over(everything) * share)
        .withColumn("limits_before", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("weights_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("goal") - F.col("limits_before")) / F.col("weights_left"))
        .withColumn("cut", F.col("level") * F.col("weight") > F.col("limit"))
    )
    # the level of the first source that is not cut holds for it and all after it
    final = F.min(F.when(~F.col("cut"), F.struct(F.col("limit") / F.col("weight"), F.col("level").alias("level")))).over(everything)
    return level.withColumn("final", final["level"]).select(
        "source", "source_size", "source_blocks",
        F.when(F.col("cut"), F.col("limit")).otherwise(F.least(F.col("final") * F.col("weight"), F.col("limit"))).alias("target"),
    )


def _apportioned(df: DataFrame, within: list[str], limit: Column, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: seats given by the highest quotients ``votes / (2 k + 1)``, within each ``within``.

    Sainte-Laguë: with any divisor, rounding gives the seats of all quotients above some height. A divisor that is
    too large for sure gives the seats that everyone has in any case, one that is too small bounds what can come, and
    the seats in between, at most two per row, are ranked; ties go by ``order``. ``limit`` is never passed. A row's
    part of the seats by votes must be within it, so it binds by rounding alone.
    """
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    votes, n = F.sum("votes").over(group), F.count(F.lit(1)).over(group)

    def rounded(seats: Column) -> Column:
        per_vote = F.coalesce(F.try_divide(F.greatest(seats, F.lit(0.0)), F.col("_votes")), F.lit(0.0))
        return F.least(F.floor(F.col("votes") * per_vote + 0.5), F.col("_limit")).cast("long")

    counted = df.withColumn("_limit", limit).withColumn("_votes", votes).withColumn("_n", n)
    bounds = counted.withColumn("_low", rounded(F.col("seats") - F.col("_n") / 2 - 1)).withColumn(
        "_high", F.greatest(rounded(F.col("seats") + F.col("_n") / 2 + 1), F.col("_low"))
    )
    open_ = bounds.withColumn("_left", F.col("seats") - F.sum("_low").over(group))
    offers = open_.withColumn(
        "_offer",
        F.explode_outer(F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1))),
    )
    height = F.col("votes") / (2 * F.col("_offer") + 1)
    rank = F.row_number().over(group.orderBy(height.desc_nulls_last(), *order))
    ranked = offers.withColumn("_won", F.when(F.col("_offer").isNotNull() & (rank <= F.col("_left")), 1).otherwise(0))
    keys = [c for c in df.columns]
    return ranked.groupBy(*map(col, keys)).agg((F.first("_low") + F.sum("_won")).alias(name))


def _taken(seed: int, block_words: int) -> Column:
    """Words of a document in the blocks taken: whole rounds, and one run of blocks that may go round the end."""
    size, stop, total, blocks = F.col("size"), F.col("stop"), F.col("shard_size"), F.col("blocks")
    start = stop - size
    rounds = F.floor(F.try_divide(F.col("quota"), blocks))
    rest = F.col("quota") - rounds * blocks
    first = F.pmod(F.xxhash64(F.lit(seed), F.lit("start"), F.col("source"), F.col("shard")), F.greatest(blocks, F.lit(1)))

    def within(low: Column, high: Column) -> Column:
        """Words of the document between two blocks."""
        begin, end = F.least(low * block_words, total), F.least(high * block_words, total)
        return F.greatest(F.least(stop, end) - F.greatest(start, begin), F.lit(0))

    run = within(first, F.least(first + rest, blocks)) + within(F.lit(0), F.greatest(first + rest - blocks, F.lit(0)))
    return F.coalesce(rounds * size + run, F.lit(0)).cast("long")
