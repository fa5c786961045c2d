"""Near-duplicates by SimHash, found with the generalised pigeonhole principle.

Fingerprints within ``distance`` bits of each other are linked. The bits are dealt to ``m`` partitions, correlated
bits together, and each partition gets a threshold of its own so that the thresholds add up to ``distance - m + 1``:
any linked pair then differs within the threshold in some partition. The thresholds are the cheapest vector by
dynamic programming on the candidates that each would give. Probing uses only the bits of the partition, and every
candidate is verified on all bits. Only distinct fingerprints are compared, so copies cost nothing here.

A bucket that holds many fingerprints is not paired off: inside it the same principle is applied to the other bits,
again and again, until buckets are small. Components come from rounds of minima over the links, each round staged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import bounded_batches, col, join_counted, quoted, require_free, staged, unused

BITS = 64
BUCKET = 64  # fingerprints that are compared pair by pair
_ALL = (1 << BITS) - 1


def fingerprints(df: DataFrame, text: str = "text", shingle: int = 3, out: str = "fingerprint") -> DataFrame:
    """``df`` with the SimHash of ``text`` as a signed 64-bit integer.

    A-Z become lower case, words are runs of anything but ASCII white space, and shingles of ``shingle`` words, with
    repeats, are hashed by XXH64 (seed 42) over their words joined by one space. A text of fewer words is one shingle;
    a text without words, or null, has fingerprint zero. A bit is set if it is set in more than half of the hashes.
    """
    require_free(df, out)
    bounded_batches(df)
    return df.withColumn(out, F.arrow_udf(_fingerprinting(shingle), "bigint")(F.col(quoted(text))))


def components(df: DataFrame, fingerprint: str, key: str = "doc_id", distance: int = 2) -> DataFrame:
    """``df`` with ``component_id``: the smallest key reachable over links of at most ``distance`` bits.

    Equal fingerprints are linked, the zero of empty texts like any other. Null keys count only where a component has
    no other. Repeated rows get the same answer each.
    """
    require_free(df, "component_id")
    found = _rooted(df, fingerprint, key, distance)
    least = found.groupBy("root").agg(F.min("least").alias("component_id"))
    keyed = staged(found.join(least, "root").select("fp", "rows", "component_id"))
    (hidden,) = unused(df, "_rows")
    keyed = keyed.select(F.col("fp").alias(fingerprint), F.col("rows").alias(hidden), "component_id")
    return join_counted(df, keyed, [fingerprint], hidden, [key]).drop(hidden)


def near_deduplicated(
    df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """The rows of ``df`` that stay: one of each component, that with the smallest key, null last.

    Where rows of a component repeat that key, the smallest fingerprint and then the first by a hash of all columns
    stays. Keys need not be unique: rows of other components are never touched, whatever their key.
    """
    columns = df.columns
    fingerprint, stays, place, kept = unused(df, "fingerprint", "_stays", "_place", "_row")
    marked = staged(fingerprints(df.select(col(key), col(text)), text, shingle, fingerprint).drop(text))
    found = _rooted(marked, fingerprint, key, distance)
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("first")
    chosen = found.groupBy("root").agg(first).select(F.col("first.least").alias(stays), F.col("first.fp").alias(place))
    chosen = staged(chosen)
    repeated = marked.groupBy(col(key).alias("id")).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    if repeated.isEmpty():
        return df.join(chosen, col(key).eqNullSafe(F.col(stays)), "left_semi").select(*map(col, columns))
    # a key alone does not tell rows apart; copies merge in each task, and null keys are spread by the fingerprint
    row = F.struct(*map(col, columns))
    rows = fingerprints(df, text, shingle, fingerprint)
    one = rows.groupBy(col(key), col(fingerprint)).agg(F.min_by(row, F.xxhash64(row)).alias(kept))
    same = col(key).eqNullSafe(F.col(stays)) & (F.col(fingerprint) == F.col(place))
    return one.join(chosen, same, "left_semi").select(f"{kept}.*")


def _rooted(df: DataFrame, fingerprint: str, key: str, distance: int) -> DataFrame:
    """For each fingerprint ``fp`` its smallest key ``least``, its ``rows`` and the ``root`` of its component."""
    own = df.select(col(fingerprint).alias("fp"), col(key).alias("id"))
    nodes = staged(own.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")))
    label = _connected(nodes.select("fp"), links(nodes.select("fp"), distance))
    return nodes.join(label, "fp")


def links(nodes: DataFrame, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints (column ``fp``) within ``distance`` bits, ``a < b``.

    Pairs can repeat. ``nodes`` must be staged and hold each fingerprint once.
    """
    masks, thresholds = plan(nodes, distance)
    todo = staged(_probed(nodes, [(m, t) for m, t in zip(masks, thresholds) if t >= 0]))
    pieces = []
    while True:
        counted = todo.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
        crowded = staged(counted.filter(F.col("n") > bucket))
        few = todo.join(counted.filter((F.col("n") > 1) & (F.col("n") <= bucket)).select("place"), "place")
        pieces.append(_verified(few, distance))
        if crowded.isEmpty():
            break
        todo = staged(_split(todo.join(crowded.select("place"), "place"), distance))
    return reduce(DataFrame.union, pieces)


def plan(nodes: DataFrame, distance: int, most: int = 3) -> tuple[list[int], list[int]]:
    """Bit masks of the partitions and their thresholds (-1: not probed), the cheapest for these fingerprints.

    For each number of partitions up to ``most``, bits are grouped by their correlation over all fingerprints, the
    pairs that agree in a partition are counted, and the thresholds are chosen by dynamic programming. All the driver
    sees is a matrix of bits by bits and one count per partition.
    """
    n, ones, both = _bit_statistics(nodes)
    if n < 2:
        return [_ALL], [distance]
    share = ones / n
    differ = 2 * share * (1 - share)
    spread = np.sqrt(np.maximum(np.outer(share * (1 - share), share * (1 - share)), 1e-12))
    correlation = np.abs(both / n - np.outer(share, share)) / spread
    dealt = [_grouped(correlation, m) for m in range(1, most + 1)]
    agree = iter(_agreeing(nodes, [sum(1 << b for b in g) for groups in dealt for g in groups]))
    options = []
    for m, groups in enumerate(dealt, 1):
        costs = []
        for g in groups:
            pairs, odds = next(agree), [differ[b] for b in g]
            costs.append([_cost(n, pairs, odds, t) for t in range(distance + 1)])
        total, thresholds = _cheapest(costs, distance - m + 1)
        options.append((total, m, [sum(1 << b for b in g) for g in groups], thresholds))
    _, _, masks, thresholds = min(options)
    return masks, thresholds


def _cost(n: int, pairs: int, differ: list[float], threshold: int) -> float:
    """Rows probed and candidates expected within ``threshold`` bits of a partition in which ``pairs`` pairs agree."""
    odds = [d / max(1 - d, 1e-9) for d in differ]
    reach = _reach(threshold)
    sums = [1.0] + [0.0] * 2 * reach  # elementary symmetric polynomials of the odds
    for odd in odds:
        for k in range(2 * reach, 0, -1):
            sums[k] += sums[k - 1] * odd
    probes = sum(comb(len(differ), k) for k in range(reach + 1))
    return n * probes + pairs * sum(sums)


def _cheapest(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, each at least -1 (free), that add up to ``total`` at the least cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for threshold, more in [(-1, 0.0), *enumerate(row)]:
                option = (cost + more, [*chosen, threshold])
                place = done + threshold
                if place not in after or option < after[place]:
                    after[place] = option
        best = after
    return best[total]


def _grouped(correlation: np.ndarray, m: int) -> list[list[int]]:
    """The bits in ``m`` groups of nearly equal size; each group grows by the bit most correlated with it."""
    left, groups = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        rest = sorted(left)
        start = max(rest, key=lambda b: (correlation[b, [x for x in rest if x != b]].max(initial=0), -b))
        group = [start]
        left.remove(start)
        while len(group) < size:
            bit = max(sorted(left), key=lambda b: (correlation[b, group].sum(), -b))
            group.append(bit)
            left.remove(bit)
        groups.append(sorted(group))
    return groups


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << BITS - 1 else mask


def _masked(fp: Column, mask: int) -> Column:
    return fp.bitwiseAND(F.lit(_signed(mask)))


def _agreeing(nodes: DataFrame, masks: list[int]) -> list[int]:
    """For each mask the pairs of fingerprints that agree in all its bits, counted in one pass."""
    values = [F.struct(F.lit(k).alias("k"), _masked(F.col("fp"), mask).alias("v")) for k, mask in enumerate(masks)]
    each = nodes.select(F.explode(F.array(*values)).alias("x")).select("x.k", "x.v")
    counts = each.groupBy("k", "v").agg(F.count(F.lit(1)).cast("double").alias("c"))
    pairs = counts.groupBy("k").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs"))
    found = {row.k: int(row.pairs) for row in pairs.collect()}
    return [found[k] for k in range(len(masks))]


def _probed(rows: DataFrame, partitions: list[tuple[int, int]]) -> DataFrame:
    """Rows ``fp``, ``used``, ``place``: for each partition where each fingerprint lies, and with a threshold above
    zero every place within half as many bits. Two fingerprints within the threshold in the partition share a place.
    """

    def places(at: int, mask: int, threshold: int) -> Column:
        bits = [b for b in range(BITS) if mask >> b & 1]
        flips = [sum(1 << b for b in chosen) for k in range(_reach(threshold) + 1) for chosen in combinations(bits, k)]
        value = _masked(F.col("fp"), mask)

        def place(flip: Column) -> Column:
            return F.array(F.lit(at).cast("bigint"), value.bitwiseXOR(flip))

        return F.transform(F.array(*(F.lit(_signed(f)).cast("bigint") for f in flips)), place)

    each = [
        F.struct(F.lit(_signed(mask)).cast("bigint").alias("used"), places(at, mask, threshold).alias("places"))
        for at, (mask, threshold) in enumerate(partitions)
    ]
    dealt = rows.select("fp", F.explode(F.array(*each)).alias("one"))
    return dealt.select("fp", F.col("one.used").alias("used"), F.explode("one.places").alias("place"))


def _reach(threshold: int) -> int:
    """Bits to flip on either side so that all pairs within ``threshold`` meet."""
    return -(-threshold // 2)


def _split(rows: DataFrame, distance: int) -> DataFrame:
    """The rows of crowded places, dealt anew by the bits that the place has not used.

    The fingerprints of a place may still differ in at most ``distance`` bits, so of ``distance + 1`` groups of the
    unused bits they agree in one. With fewer unused bits than groups, all are used and every place is one fingerprint.
    """
    groups = distance + 1

    def add(masks: Column, bit: Column) -> Column:
        """The next unused bit goes to the group that is first in turn."""
        power = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
        turn = F.array(*(F.get(masks, F.lit(k)) for k in range(1, groups)), F.get(masks, F.lit(0)).bitwiseOR(power))
        return F.when(F.call_function("getbit", F.col("used"), bit) == 0, turn).otherwise(masks)

    bits = F.array(*(F.lit(b) for b in range(BITS)))
    empty = F.array(*(F.lit(0).cast("bigint") for _ in range(groups)))
    each = rows.select("fp", "used", "place", F.posexplode(F.aggregate(bits, empty, add)).alias("group", "mask"))
    value = F.col("fp").bitwiseAND(F.col("mask"))
    return each.select(
        "fp",
        F.col("used").bitwiseOR(F.col("mask")).alias("used"),
        F.concat("place", F.array(F.col("mask"), value)).alias("place"),
    )


def _verified(rows: DataFrame, distance: int) -> DataFrame:
    one = rows.select("place", F.col("fp").alias("a"))
    other = rows.select(F.col("place").alias("place_b"), F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return one.join(other, (F.col("place") == F.col("place_b")) & (F.col("a") < F.col("b")) & near).select("a", "b")


def _connected(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``fp``, ``root`` for every node: the smallest fingerprint of its component.

    Only linked nodes take part. Each round hangs every root below the smallest root next to it and then lets every
    node look past its root; it ends when no link joins two roots. Each round is staged, so no plan grows and a lost
    executor costs one round.
    """
    pairs = staged(pairs.distinct())
    label = staged(
        pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct().select("fp", F.col("fp").alias("root"))
    )
    between = pairs.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    while not between.isEmpty():
        step = staged(between.groupBy("high").agg(F.min("low").alias("low")))
        while True:  # roots above roots, until each points at one that stays
            up = step.select(F.col("high").alias("low"), F.col("low").alias("lower"))
            look = step.join(up, "low", "left")
            further = staged(look.select("high", F.coalesce("lower", "low").alias("low"), F.col("lower").alias("moved")))
            step = further.select("high", "low")
            if further.filter(F.col("moved").isNotNull()).isEmpty():
                break
        after = label.join(step.withColumnRenamed("high", "root"), "root", "left")
        label = staged(after.select("fp", F.coalesce("low", "root").alias("root")))
        ends = between.select("high", "low")
        tops = step.select(F.col("high").alias("r"), F.col("low").alias("top"))
        ends = ends.join(tops, ends["high"] == tops["r"]).select("low", F.col("top").alias("x"))
        ends = ends.join(tops, ends["low"] == tops["r"], "left").select("x", F.coalesce("top", "low").alias("y"))
        between = staged(
            ends.filter("x <> y").select(F.greatest("x", "y").alias("high"), F.least("x", "y").alias("low")).distinct()
        )
    return nodes.join(label, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def _bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Fingerprints, how many have each bit, and how many have each two bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(values), 65_536):
                part = np.ascontiguousarray(values[at : at + 65_536])
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
                n += len(bits)
                both += bits.T @ bits
        yield pa.RecordBatch.from_pydict({"cell": list(range(BITS * BITS)) + [-1], "n": [*both.ravel().tolist(), float(n)]})

    cells = nodes.select("fp").mapInArrow(count, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n"))
    found = dict(cells.collect())
    both = np.array([found.get(k, 0.0) for k in range(BITS * BITS)]).reshape(BITS, BITS)
    return int(found.get(-1, 0)), np.diag(both).copy(), both


def _fingerprinting(shingle: int):
    def fingerprint(texts: pa.Array) -> pa.Array:
        import xxhash

        digest, found = xxhash.xxh64_intdigest, []
        for text in texts:
            text = text.as_py()
            words = text.encode().lower().split() if text else []
            if not words:
                found.append(0)
                continue
            count = max(1, len(words) - shingle + 1)
            hashes = (digest(b" ".join(words[at : at + shingle]), 42) for at in range(count))
            ones = np.zeros(BITS, np.int64)
            for _ in range(0, count, 65_536):
                part = np.fromiter(islice(hashes, 65_536), np.uint64)
                ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            bits = np.packbits(2 * ones > count, bitorder="little")
            found.append(int(bits.view(np.int64)[0]))
        return pa.array(found, pa.int64())

    return fingerprint
