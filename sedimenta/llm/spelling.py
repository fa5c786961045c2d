"""Spelling variants: words one insertion, deletion or replacement apart, found through a dictionary of trie-node pairs.

All words are put into two tries, one read forwards and one backwards, and the nodes of both are numbered. A number
then stands for a whole prefix or suffix, so a word with one position skipped, and a word with a gap at one position,
are pairs of integers (prefix node, suffix node):

- words with the same pair when one position of each is skipped differ in that position (replacement);
- a word with a position skipped and a word with a gap that have the same pair differ by it (insertion, deletion).

One shuffle on the pairs joins them, exactly. A pair is shared by at most one word for each character of the alphabet
and one word with the gap, so its group is small whatever the words. A word's form is the most frequent word near it,
if that is frequent enough; following forms leads to its root.

The nodes are numbered in a scan over the sorted words, a range of them per task: a node is new where a word leaves
the one before it. Nodes that a range shares with the ranges before it lie on the path of its first word; they get
their first number from a small table with one path per range.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import bounded_batches, col, join_counted, staged

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5

# Fixed value: letters that words consist of, after A-Z have become lower case.
LETTERS = "a-zÀ-ÿ"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# What a task counts before it passes counts on: words, and their characters.
WORDS_KEPT, CHARACTERS_KEPT = 200_000, 8_000_000
# Texts are cut into words by pieces of about so many characters, never inside a word.
PIECE = 1_000_000
# A node's number has the number of its range above these bits.
_RANGE_BITS = 40
_SKIP, _FIRST_SKIP, _GAP = 1, 2, 0


def word_counts(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    slips: int | None = None,
) -> DataFrame:
    """``word``, ``n``: how often each word of at least ``least_length`` characters occurs, from ``least_count`` on.

    Words are maximal runs of ``LETTERS``; only A-Z become lower case. Null and empty texts have none. With ``slips``
    every so many-th word, by the CRC-32 of key and word, loses one character before it is counted: writing errors
    whose number is known. A null key is then the empty text.
    """
    if least_length < 1:
        raise ValueError("words have at least one character")
    bounded_batches(df)
    rows = df.select(F.coalesce(col(key).cast("string"), F.lit("")).alias("key"), col(text).alias("text"))
    counted = rows.mapInArrow(_counting(least_length, slips), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of each of ``words`` (``word``, ``n``).

    ``n_near`` is the number of words at an edit distance of one. ``form`` is the one with the largest ``n``, the
    smallest in code-point order among equals, if its ``n`` is at least ``ratio`` times that of the word, and null
    otherwise. ``root`` is the last word reached over forms, the word itself without any. ``ratio`` must be above 1,
    so that forms never lead in a circle. ``words`` holds each word once; null and empty words are left out.
    """
    if ratio <= 1:
        raise ValueError("the ratio must be above 1")
    nodes = staged(trie_pairs(words))
    near = nearest(nodes)
    # a word's own number grows with its place in code-point order
    known = nodes.select(F.element_at("prefixes", -1).alias("id"), "word", "n")
    ahead = staged(known.join(near, "id", "left"))
    form = F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.minus_id"))
    ahead = ahead.select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), form.alias("up"))
    up = staged(ahead.filter(F.col("up").isNotNull()).select("id", "up"))
    names = known.select("id", "word", "n")
    found = _named(ahead, "up", names, "form", "form_n")
    roots = _named(_followed(up), "up", names, "root", "root_n").select("id", "root")
    joined = found.join(roots, "id", "left")
    return joined.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def trie_pairs(words: DataFrame) -> DataFrame:
    """``words`` with the numbers of their trie nodes: ``prefixes`` (of 0, 1, ... characters) and ``suffixes`` alike."""
    rows = words.filter(F.length("word") > 0).select("word", "n")
    forward = _numbered(rows.withColumn("path", F.col("word")), "prefixes")
    return _numbered(forward.withColumn("path", F.reverse("word")), "suffixes")


def nearest(nodes: DataFrame) -> DataFrame:
    """``id``, ``n_near`` and ``best`` (``n`` and ``minus_id``) of the words that have words near them."""
    length = F.size("prefixes") - 1
    letters = F.split("word", "")

    def pair(before: Column, after: Column, kind: Column) -> Column:
        return F.struct(
            F.get("prefixes", before).alias("prefix"), F.get("suffixes", after).alias("suffix"), kind.alias("kind")
        )

    def skip(at: Column) -> Column:
        # to skip any of several equal letters in a row is the same: only the first stands for a deletion
        repeats = (at > 0) & (F.get("letters", at) == F.get("letters", at - 1))
        return pair(at, F.col("length") - 1 - at, F.when(repeats, _SKIP).otherwise(_FIRST_SKIP))

    def gap(at: Column) -> Column:
        return pair(at, F.col("length") - at, F.lit(_GAP))

    rows = nodes.select("n", "prefixes", "suffixes", letters.alias("letters"), length.alias("length"))
    pairs = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("length") - 1), skip),
        F.transform(F.sequence(F.lit(0), F.col("length")), gap),
    )
    each = rows.select(F.element_at("prefixes", -1).alias("id"), "n", F.explode(pairs).alias("pair"))
    each = each.select("pair.prefix", "pair.suffix", F.struct("n", (-F.col("id")).alias("minus_id"), "pair.kind").alias("one"))
    # at most one entry per character of the alphabet and one with the gap
    groups = each.groupBy("prefix", "suffix").agg(F.collect_list("one").alias("all")).filter(F.size("all") > 1)

    def beside(one: Column) -> Column:
        def is_near(other: Column) -> Column:
            both_skip = one["kind"] * other["kind"] > 0
            gap_and_first = one["kind"] + other["kind"] == F.lit(_FIRST_SKIP)
            return (one["minus_id"] != other["minus_id"]) & (both_skip | gap_and_first)

        others = F.filter("all", is_near)
        best = F.array_max(F.transform(others, lambda x: F.struct(x["n"].alias("n"), x["minus_id"].alias("minus_id"))))
        return F.struct((-one["minus_id"]).alias("id"), F.size(others).alias("count"), best.alias("best"))

    found = groups.select(F.inline(F.transform("all", beside))).filter(F.col("count") > 0)
    return found.groupBy("id").agg(F.sum("count").alias("n_near"), F.max("best").alias("best"))


def _followed(up: DataFrame) -> DataFrame:
    """``id`` and, as ``up``, the last word reached over ``up``; each round doubles the steps taken."""
    while True:
        tops = up.select(F.col("id").alias("up"), F.col("up").alias("top"))
        keyed = staged(tops.join(up.groupBy("up").agg(F.count(F.lit(1)).alias("rows")), "up"))
        if keyed.isEmpty():
            return up
        further = join_counted(up, keyed, ["up"], "rows", ["id"], how="left")
        up = staged(further.select("id", F.coalesce("top", "up").alias("up")))


def _named(rows: DataFrame, number: str, names: DataFrame, name: str, n: str) -> DataFrame:
    """``rows`` with the word and count that the column ``number`` stands for; many rows can name one word."""
    counts = rows.filter(F.col(number).isNotNull()).groupBy(number).agg(F.count(F.lit(1)).alias("rows_named"))
    keyed = names.select(F.col("id").alias(number), F.col("word").alias(name), F.col("n").alias(n)).join(counts, number)
    return join_counted(rows, staged(keyed), [number], "rows_named", ["id"], how="left").drop("rows_named")


def _numbered(rows: DataFrame, out: str) -> DataFrame:
    """``rows`` with the numbers of the trie nodes on each ``path``, from the root on, instead of ``path``."""
    ordered = rows.repartitionByRange("path").sortWithinPartitions("path")
    schema = f"word string, n bigint, {', '.join(f'{x} array<bigint>' for x in rows.columns[2:-1])}{', ' if len(rows.columns) > 3 else ''}"
    placed = ordered.withColumn("range", F.spark_partition_id())
    local = staged(placed.mapInArrow(_numbering, f"{schema}path string, range int, nodes array<bigint>"))
    ends = local.groupBy("range").agg(
        F.min(F.struct("path", "nodes")).alias("first"), F.max(F.struct("path", "nodes")).alias("last")
    )
    shared, before, known = [], "", []
    for row in sorted(ends.collect(), key=lambda row: row["range"]):  # two paths for each range
        depth = _common(before, row["first"]["path"]) + 1 if known else 0
        canon = known[:depth]
        shared.append((row["range"], canon))
        before = row["last"]["path"]
        base = row["range"] << _RANGE_BITS
        known = [canon[node - base] if node - base < depth else node for node in row["last"]["nodes"]]
    # the path of a range's first word is numbered from 0 on: those of its nodes that are shared come first
    table = rows.sparkSession.createDataFrame(shared, "range int, shared array<bigint>")
    place = F.lit((1 << _RANGE_BITS) - 1)
    nodes = F.transform("nodes", lambda x: F.coalesce(F.get("shared", x.bitwiseAND(place).cast("int")), x))
    return local.join(F.broadcast(table), "range").select(*rows.columns[:-1], nodes.alias(out))


def _common(one: str, other: str) -> int:
    """The length of the common prefix."""
    length = min(len(one), len(other))
    if one[:length] == other[:length]:
        return length
    return next(k for k, (a, b) in enumerate(zip(one, other)) if a != b)


def _numbering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before, nodes, count, base = "", [], 0, -1
    for batch in batches:
        paths, values, stops = batch.column("path").to_pylist(), [], [0]
        for path, number in zip(paths, batch.column("range").to_pylist()):
            if base != number << _RANGE_BITS:
                base = number << _RANGE_BITS
                before, nodes, count = "", [base], base + 1
            depth = _common(before, path)
            more = len(path) - depth
            nodes = nodes[: depth + 1]
            nodes.extend(range(count, count + more))
            count += more
            before = path
            values.extend(nodes)
            stops.append(len(values))
        found = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(values, pa.int64()))
        yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "nodes"])


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces that end between words."""
    between = re.compile(f"[^{LETTERS}]").search
    start = 0
    while len(text) - start > PIECE:
        cut = between(text, start + PIECE)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def _counting(least_length: int, slips: int | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[{LETTERS}]{{{least_length},}}").findall
        counts: dict[str, int] = {}
        held = 0

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
            )

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                seed = crc32(f"{key}:".encode())
                for piece in _pieces(text.encode().translate(_LOWER).decode()) if text else ():
                    for word, n in Counter(runs(piece)).items():
                        if slips:
                            h = crc32(word.encode(), seed)
                            if h % slips == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < least_length:
                                    continue
                        if word in counts:
                            counts[word] += n
                        else:
                            counts[word] = n
                            held += len(word)
                    if len(counts) > WORDS_KEPT or held > CHARACTERS_KEPT:
                        yield passed_on()
                        counts, held = {}, 0
        if counts:
            yield passed_on()

    return count
