"""Benchmark decontamination: passages of benchmark items are found in training texts and removed.

A-Z become lower case and words are runs of ASCII letters and digits and of characters beyond ASCII. Each run of
``WINDOW`` words of a benchmark item is a window; an item of fewer words is one window. The windows are a broadcast
hash set. Texts are scanned in one pass without a shuffle: rolling hashes of all their windows are computed over the
bytes of a whole batch at once, and what hits the set is verified word by word, so no hash collision counts.

The set is sent to executors in blocks of at most ``BLOCK_BYTES``. A benchmark beyond one block is scanned for block
by block, and what the blocks found is joined by the digest of the text. Thus memory does not grow with the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import bounded_batches, col, join_counted, require_free, staged, unused

WINDOW = 10
# Windows of the benchmark, with their items, that one scan looks for.
BLOCK_BYTES = 32 << 20

# Fixed value: what is no word, after A-Z have become lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_IS_WORD = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
_NORMAL = bytes(ord(chr(c).lower()) if c < 0x80 and chr(c).isalnum() else c if c >= 0x80 else 0x20 for c in range(256))
# Bytes that are hashed at a time; longer texts and words are hashed in several steps.
_STEP = 1 << 18

FOUND = "struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<start:bigint,stop:bigint>>>"


def windows(benchmark: DataFrame, text: str = "text", item: str = "item_id", window: int = WINDOW) -> DataFrame:
    """Distinct ``window`` (words joined by one space) and ``item`` (as text) of the benchmark, one row each.

    Null texts have no words. An item without an id has windows that count as any, but it cannot be listed: its
    ``item`` is null.
    """
    lowered = F.translate(F.coalesce(col(text), F.lit("")), _UPPER, _LOWER)
    rows = benchmark.select(
        col(item).cast("string").alias("item"), F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("words")
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    each = rows.filter(F.size("words") > 0).select("item", "words", F.explode(starts).alias("at"))
    return each.select(F.array_join(F.slice("words", F.col("at"), F.lit(window)), " ").alias("window"), "item").distinct()


def scanned(
    df: DataFrame,
    known: DataFrame,
    text: str = "text",
    out: str = "found",
    block_bytes: int = BLOCK_BYTES,
    window: int = WINDOW,
) -> DataFrame:
    """``df`` with what of ``known`` (see ``windows``) its texts hold, as the struct ``out``.

    ``n_words`` of the text, ``n_hit`` of them inside occurrences of windows, the distinct ``items`` (sorted as texts)
    whose windows occur, and ``spans``: byte offsets in UTF-8 of the runs of hit words, in order, from the first byte
    of a run's first word to the end of its last. Null and empty texts have no words. Rows that repeat, in
    whichever columns, get the same answer each; other columns stay as they are.
    """
    require_free(df, out)
    bounded_batches(df)
    known = staged(known)
    size = F.octet_length("window") + F.coalesce(F.octet_length("item"), F.lit(0)) + 16
    total = known.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = -(-total // block_bytes)
    if blocks <= 1:
        return df.withColumn(out, _scan(col(text), _block(known), window))
    # blocks by hash: nearly even, so each is collected within a small multiple of the bound
    dealt = staged(known.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks)).cast("int")))
    digest, rows, hidden = unused(df, "_digest", "_rows", "_found")
    texts = df.select(F.coalesce(col(text), F.lit("")).alias("text")).withColumn("digest", F.sha2("text", 256))
    parts = []
    for block in range(blocks):
        found = _scan(F.col("text"), _block(dealt.filter(F.col("block") == block)), window)
        hit = texts.select("digest", found.alias("x")).filter("x.n_hit > 0")
        parts.append(staged(hit.groupBy("digest").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("n"))))
    every = reduce(DataFrame.union, parts).groupBy("digest").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("x.items")))).alias("items"),
        F.flatten(F.collect_list("x.spans")).alias("spans"),
        F.max("n").alias("n"),
    )
    # spans of several blocks can overlap, so words are counted anew from the merged ones
    every = every.select(F.col("digest").alias(digest), F.col("n").alias(rows), F.struct("items", "spans").alias(hidden))
    marked = df.withColumn(digest, F.sha2(F.coalesce(col(text), F.lit("")), 256))
    spread = [x for x in df.columns if x != text] or [text]
    joined = join_counted(marked, staged(every), [digest], rows, spread, how="left")
    merged = F.arrow_udf(_merging, FOUND)(col(text), col(hidden)["items"], col(hidden)["spans"])
    return joined.select(*map(col, df.columns), merged.alias(out))


def decontaminated(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    remove: str = "documents",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``df`` without the passages of ``benchmark``: rows that hold one go (``remove="documents"``), or only the
    passages are cut out of their texts (``remove="spans"``), which changes no other text, null ones included."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    (found,) = unused(df, "_found")
    marked = scanned(df, windows(benchmark, item_text, item), text, found, block_bytes)
    if remove == "documents":
        return marked.filter(F.col(found)["n_hit"] == 0).drop(found)
    cut = F.when(F.col(found)["n_hit"] == 0, col(text)).otherwise(without_spans(col(text), F.col(found)["spans"]))
    return marked.select(*(cut.alias(x) if x == text else col(x) for x in df.columns))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the bytes of ``spans``, which are in order and do not overlap."""
    whole = text.cast("binary")
    stops = F.concat(F.array(F.lit(0).cast("bigint")), spans["stop"])
    starts = F.concat(spans["start"], F.array(F.octet_length(whole).cast("bigint")))
    kept = F.zip_with(stops, starts, lambda a, b: F.substring(whole, (a + 1).cast("int"), (b - a).cast("int")).cast("string"))
    return F.array_join(kept, "")


def _block(known: DataFrame) -> dict[bytes, tuple[str | None, ...]]:
    """The items of each window; ``known`` is within a block."""
    items: dict[bytes, set] = {}
    for row in known.select("window", "item").toLocalIterator():
        items.setdefault(row.window.encode(), set()).add(row.item)
    return {window: tuple(sorted(x for x in of if x is not None)) for window, of in items.items()}


def _scan(text: Column, known: dict[bytes, tuple[str, ...]], window: int) -> Column:
    return F.arrow_udf(_scanning(known, window), FOUND)(text)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end and where each begins, without a copy; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of all texts begin and end; none reaches over the end of its text."""
    inside = _IS_WORD[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


class _Hashing:
    """Hashes of words and windows modulo 2**64: a polynomial over random values of the bytes, then over words."""

    def __init__(self) -> None:
        random = np.random.default_rng(13)
        values = random.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.values = values[np.frombuffer(_NORMAL, np.uint8)]
        base = int(random.integers(1, 1 << 62)) * 2 + 1
        self.powers, self.inverses = (_powers(x, _STEP + 1) for x in (base, pow(base, -1, 1 << 64)))
        self.next = random.integers(1, 1 << 63, dtype=np.uint64) | np.uint64(1)

    def words(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash per word, from sums of all bytes before its begin and its end, taken step by step."""
        before, after, shift = (np.zeros(len(begins), np.uint64) for _ in range(3))
        carried, power, inverse = np.uint64(0), np.uint64(1), np.uint64(1)
        for at in range(0, len(data), _STEP):
            part = data[at : at + _STEP]
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(self.values[part] * self.powers[: len(part)], out=sums[1:])
            sums = sums * power + carried
            low, high = np.searchsorted(begins, (at, at + len(part)))
            inner = begins[low:high] - at
            before[low:high], shift[low:high] = sums[inner], self.inverses[inner] * inverse
            low, high = np.searchsorted(ends, (at, at + len(part)), side="right")
            after[low:high] = sums[ends[low:high] - at]
            carried, power, inverse = sums[-1], power * self.powers[len(part)], inverse * self.inverses[len(part)]
        found = (after - before) * shift
        found ^= found >> np.uint64(29)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        return found ^ (found >> np.uint64(32))

    def windows(self, words: np.ndarray, length: int) -> np.ndarray:
        count = len(words) - length + 1
        found = words[:count].copy()
        for k in range(1, length):
            found *= self.next
            found += words[k : k + count]
        return found ^ (found >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    found = np.ones(count, np.uint64)
    done, step = 1, np.uint64(base)
    while done < count:  # the first 2n from the first n
        more = min(done, count - done)
        found[done : done + more] = found[:more] * step
        done, step = done + more, step * step
    return found


def _scanning(known: dict[bytes, tuple[str, ...]], window: int):
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with np.errstate(over="ignore"):
            hashing = _Hashing()
            table = bytes(_NORMAL)
            sets = []
            for length in range(1, window + 1):
                of_length = [x for x in known if x.count(b" ") + 1 == length]
                if of_length:
                    data, offsets = _bytes_of(pa.array([x.decode() for x in of_length]))
                    # each window is a text of its own, so every length-th hash is that of a whole window
                    hashes = hashing.windows(hashing.words(data, *_words(data, offsets)), length)[::length]
                    bits = max(16, (16 * len(hashes)).bit_length())
                    flags = np.zeros(1 << bits, bool)
                    shift = np.uint64(64 - bits)
                    flags[hashes >> shift] = True
                    sets.append((length, flags, shift, np.sort(hashes)))
            for texts in batches:
                yield answer(hashing, table, sets, texts)

    def answer(hashing, table, sets, texts) -> pa.Array:
        data, offsets = _bytes_of(texts)
        begins, ends = _words(data, offsets)
        firsts = np.searchsorted(begins, offsets)  # the first word of each text, and the end
        items: dict[int, set[str]] = {}
        change = None
        hashes = hashing.words(data, begins, ends) if sets and len(begins) else None
        for length, flags, shift, sorted_hashes in sets if hashes is not None else []:
            if len(begins) < length:
                continue
            rolled = hashing.windows(hashes, length)
            at = np.flatnonzero(flags[rolled >> shift])
            place = np.searchsorted(sorted_hashes, rolled[at])
            at = at[sorted_hashes[np.minimum(place, len(sorted_hashes) - 1)] == rolled[at]]
            row = np.searchsorted(firsts, at, side="right") - 1
            whole = at + length <= firsts[np.minimum(row + 1, len(firsts) - 1)]
            for k, r in zip(at[whole].tolist(), row[whole].tolist()):
                said = data[begins[k] : ends[k + length - 1]].tobytes().translate(table).split()
                of = known.get(b" ".join(said))
                if of is not None:
                    items.setdefault(r, set()).update(of)
                    if change is None:
                        change = np.zeros(len(begins) + 1, np.int32)
                    change[k] += 1
                    change[k + length] -= 1
        count = np.diff(firsts)
        return _answers(len(texts), count, change, firsts, begins, ends, offsets, items)

    return scan


def _answers(n, count, change, firsts, begins, ends, offsets, items) -> pa.Array:
    kind = pa.struct(
        [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
         ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
    )
    hit = np.zeros(len(begins), bool) if change is None else np.cumsum(change[:-1]) > 0
    rows = []
    for r in range(n):
        spans, hits = [], 0
        if r in items:
            own = hit[firsts[r] : firsts[r + 1]]
            hits = int(own.sum())
            edges = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0]))))
            first, last = firsts[r] + edges[::2], firsts[r] + edges[1::2] - 1
            spans = [
                {"start": a, "stop": b}
                for a, b in zip((begins[first] - offsets[r]).tolist(), (ends[last] - offsets[r]).tolist())
            ]
        rows.append({"n_words": int(count[r]), "n_hit": hits, "items": sorted(items.get(r, ())), "spans": spans})
    return pa.array(rows, kind)


def _merging(texts: pa.Array, items: pa.Array, spans: pa.Array) -> pa.Array:
    """What the blocks found of each text, as one answer: a word within any span is hit."""
    data, offsets = _bytes_of(texts)
    begins, ends = _words(data, offsets)
    firsts = np.searchsorted(begins, offsets)
    change, named = np.zeros(len(begins) + 1, np.int32), {}
    for r, (of, found) in enumerate(zip(items.to_pylist(), spans.to_pylist())):
        if found:
            named[r] = set(of)
            starts = np.searchsorted(begins, np.array([x["start"] for x in found]) + offsets[r])
            stops = np.searchsorted(begins, np.array([x["stop"] for x in found]) + offsets[r])
            np.add.at(change, starts, 1)
            np.add.at(change, stops, -1)
    return _answers(len(texts), np.diff(firsts), change, firsts, begins, ends, offsets, named)
