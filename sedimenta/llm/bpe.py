"""Byte-level BPE encoding and decoding.

Encoding runs in one pass over the documents, without a shuffle:

1. an Arrow iterator function cuts each text with the tokenizer's pattern and numbers the words of its
   partition; a row carries its words as numbers, and the texts of those words that are new;
2. Spark higher-order functions fold the ranked merges over the bytes of each new word, against a literal
   table of the merges;
3. a second iterator function replaces the numbers by the ids of their words.

So a word is merged once per partition, or again if it has not been seen for long, and not once per occurrence: what
the first function remembers is bounded by bytes. The numbers start again after ``WORDS_KEPT`` words, which bounds the
memory of the second function. Neither changes a result: words that are forgotten are new again.

Both functions of one task see the same rows in the same order, because nothing between them moves rows. A task
that runs again starts from its input.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.chunks import Cut, Recent, binary_column, buffers_of, give_back, slices
from sedimenta.llm.common import bounded_batches, quoted, require_free, unused

# The fold takes steps in proportion to a word's length, and each copies the word's pieces. Longer words (runs of
# letters or signs without a break) are merged with a heap instead, in the second function: a word of 20 KB would take
# the fold some seconds and one of 1 MB hours.
FOLD_BYTES = 256
# Numbers that are given before they start again.
WORDS_KEPT = 4_000_000

# What is remembered of words after a space, and of others: each of two generations in each task. A task also has the
# workers of the other two functions beside it, so this is less than a function alone could take.
CHUNK_BYTES = 60 << 20
OTHER_BYTES = 20 << 20
# Texts that are cut at a time.
TEXT_BYTES = 4 << 20

_TABLES = ("first", "shifts", "slots")
# Words are looked up so many at a time.
_AT_ONCE = 1 << 16
# Letters, and signs that are cut from letters before them, up to the end of a chunk.
_PLAIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ʯ"
_PLAIN_SIGNS = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
_ID_BITS = 20
_NONE = 1 << _ID_BITS
_LOW = (1 << 2 * _ID_BITS) - 1
_ID = _NONE - 1
_RESTART = ""


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str) -> ByteBPE:
    """The tokenizer of a file of ranks; it and its tables are made once per program."""
    return ByteBPE(read_ranks(path), pattern)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class ByteBPE:
    """Encoder and decoder for one vocabulary.

    ``ranks`` must hold all 256 single bytes; ``pattern`` cuts texts into words. The literal tables have one entry
    for each way to cut a token into two tokens, so they are bounded by the vocabulary.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        if max(ranks.values()) >= _ID or min(ranks.values()) < 0:
            raise ValueError(f"ranks must be within 0 and {_ID - 1}")
        self.ranks = ranks
        self.pattern = pattern
        self._literal: str | None = None

    def encode(self, df: DataFrame, text: str, ids: str = "ids", keep_text: bool = True) -> DataFrame:
        """``df`` with the token ids of ``text`` as little-endian unsigned 32-bit integers (``ids``, binary).

        A null or empty text has no ids. Strings of special tokens are ordinary text. All other columns stay as they
        are, whatever their names; a column called ``ids`` must not be there yet. Without ``keep_text`` the text is
        left out of the result, and then it is not carried through the second function either.
        """
        require_free(df, ids)
        bounded_batches(df)
        words = F.arrow_udf(_numbering(self.pattern), "struct<codes:binary,fresh:array<string>>").asNondeterministic()
        numbered, merged, carried = unused(df, "_words", "_fresh_ids", "_carried")
        kept = [x for x in df.columns if keep_text or x != text]
        others = F.struct(*(F.col(quoted(x)) for x in kept)) if kept else F.struct(F.lit(0).alias("none"))
        table = df.select(others.alias(carried), words(F.col(quoted(text))).alias(numbered))
        table = table.withColumn(merged, self.merged(F.col(numbered)["fresh"]))
        schema = T.StructType([table.schema[carried], T.StructField(ids, T.BinaryType())])
        joined = table.mapInArrow(_joining(self.ranks, numbered, merged, ids), schema)
        return joined.select(*(F.col(carried).getField(x).alias(x) for x in kept), quoted(ids))

    def decode(self, df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
        """``df`` with the bytes of the tokens of ``ids`` put together (``decoded``, binary); null gives null."""
        require_free(df, decoded)
        bounded_batches(df)
        back = F.arrow_udf(_decoding(self.ranks), "binary")
        return df.withColumn(decoded, back(F.col(quoted(ids))))

    def merged(self, words: Column) -> Column:
        """Ids of each of ``words`` (``array<array<int>>``), by folding the ranked merges over the bytes; null over
        ``FOLD_BYTES`` and of the empty word.

        The state is an array of longs, one per piece: the rank of the pair that the piece makes with the one before
        it, the place of its first byte, and its id. The smallest entry is thus the leftmost pair of lowest rank, and
        that rank is the id of the merged piece. Each step takes it out and replaces its two neighbours.
        """
        return _let(self._tables(), lambda tables: F.transform(words, lambda word: self._folded(word, tables)))

    def _folded(self, word: Column, tables: Column) -> Column:
        first, shifts, table = (tables[x] for x in _TABLES)
        size = F.octet_length(word)
        none, unranked = F.lit(_NONE).cast("long"), F.lit(_NONE << 2 * _ID_BITS)

        def ranked(left: Column, right: Column) -> Column:
            """The rank of a pair of pieces, in its place within an entry."""
            slot = F.get(table, (F.get(shifts, left.cast("int")) + right).cast("int"))
            # the id if the slot holds a merge of this left piece, and out of its range otherwise
            rank = F.least((slot - F.shiftleft(left, _ID_BITS)).bitwiseAND(F.lit((1 << 62) - 1)), none)
            return F.shiftleft(rank, 2 * _ID_BITS)

        def id_of(entry: Column) -> Column:
            return entry.bitwiseAND(F.lit(_ID))

        def step(entries: Column, _: Column) -> Column:
            def unless_done(best: Column) -> Column:
                at = F.array_position(entries, best).cast("int")
                return F.when(best >= unranked, entries).otherwise(_let(at, lambda at: replaced(entries, best, at)))

            return _let(F.array_min(entries), unless_done)

        def replaced(entries: Column, best: Column, at: Column) -> Column:
            """The entries without the one at ``at`` (from 1), its piece as part of the one before it."""
            piece = F.shiftright(best, 2 * _ID_BITS)

            def entry(old: Column, place: Column) -> Column:
                follows = ranked(piece, id_of(old)) + old.bitwiseAND(F.lit(_LOW))
                kept = old.bitwiseAND(F.lit(_LOW - _ID)) + piece
                longer = F.when(place > 0, ranked(id_of(F.get(entries, place - 1)), piece)).otherwise(unranked) + kept
                return F.when(place == at - 1, follows).when(place == at - 2, longer).otherwise(old)

            return F.transform(F.array_remove(entries, best), entry)

        def start(codes: Column) -> Column:
            def entry(code: Column, at: Column) -> Column:
                before = F.coalesce(F.get(codes, at - 1), F.lit(256))
                return F.get(first, before * 256 + code) + F.shiftleft(at.cast("long"), _ID_BITS)

            return F.transform(codes, entry)

        latin = F.decode(word.cast("binary"), "ISO-8859-1")
        codes = F.transform(F.split(latin, ""), lambda c: F.ascii(c))
        folded = F.aggregate(F.slice(codes, 2, FOLD_BYTES), _let(codes, start), step)
        ids = F.transform(folded, lambda entry: entry.bitwiseAND(F.lit(_ID)).cast("int"))
        return F.when((size > 0) & (size <= FOLD_BYTES), ids)

    def _tables(self) -> Column:
        """The entry of a byte after each byte and after none, without its place, and the merges as a table of two steps.

        A merge is found without comparing several: its left piece gives a shift, and that with the right piece its
        slot, which says of which left piece it is. All is one constant text that the optimizer turns into a literal once, and the plan has it
        in one place.
        """
        if self._literal is None:
            ranks, merges = self.ranks, {}
            for token, rank in ranks.items():
                # A pair of pieces can only be what the merges of lower ranks leave of their token's bytes.
                left = merge_long(token, ranks, below=rank)
                if len(left) == 2:
                    merges[(left[0] << _ID_BITS) + left[1]] = rank
            single = [ranks[bytes([b])] for b in range(256)]
            merged = [merges.get((a << _ID_BITS) + b, _NONE) for a in single for b in single]
            first = [(rank << 2 * _ID_BITS) + single[at % 256] for at, rank in enumerate([*merged, *[_NONE] * 256])]
            self._literal = json.dumps(dict(zip(_TABLES, (first, *_slotted(merges)))), separators=(",", ":"))
        kinds = ("array<bigint>", "array<int>", "array<bigint>")
        return F.from_json(F.lit(self._literal), ", ".join(f"{x} {kind}" for x, kind in zip(_TABLES, kinds)))


def _slotted(merges: dict[int, int]) -> tuple[list[int], list[int]]:
    """A shift for each left piece, and slots: a merge is at the shift of its left piece and the id of its right one.

    Left pieces with most merges choose first, each the first shift that leaves its places free. A slot holds the left
    piece and the id of the merged one.
    """
    rights: dict[int, list[int]] = {}
    for key in merges:
        rights.setdefault(key >> _ID_BITS, []).append(key & _ID)
    shifts, free = [0] * (max(rights, default=0) + 1), np.ones(1 << 16, bool)
    lowest = 0  # all places before it are taken
    slots = np.full(len(free), -1, np.int64)
    for left, of_left in sorted(rights.items(), key=lambda x: (-len(x[1]), x[0])):
        places = np.array(sorted(of_left))
        while not free[lowest]:
            lowest += 1
        first = shifts[left] = int(lowest - places[0])
        while len(places) > 1:
            tried = np.arange(first, first + 1024)
            end = tried[-1] + places[-1] + 1
            if end > len(free):
                free = np.concatenate((free, np.ones(end, bool)))
                slots = np.concatenate((slots, np.full(end, -1, np.int64)))
            fits = free[tried[:, None] + places].all(axis=1)
            if fits.any():
                shifts[left] = int(tried[np.argmax(fits)])
                break
            first += 1024
        if lowest + 2 > len(free):
            free = np.concatenate((free, np.ones(len(free), bool)))
            slots = np.concatenate((slots, np.full(len(slots), -1, np.int64)))
        free[shifts[left] + places] = False
        slots[shifts[left] + places] = [(left << _ID_BITS) + merges[(left << _ID_BITS) + r] for r in places.tolist()]
    return shifts, slots[: np.flatnonzero(~free).max(initial=-1) + 1].tolist()


def fewer_partitions(df: DataFrame, of: int = 8) -> DataFrame:
    """``df`` with ``of`` input partitions in one, without a shuffle, but one per core at least.

    A word is merged once per partition, so fewer partitions mean less work.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, df.rdd.getNumPartitions() // of))


def token_count(ids: Column) -> Column:
    return F.coalesce(F.octet_length(ids) / 4, F.lit(0)).cast("long")


def as_array(ids: Column) -> Column:
    """The ids of an encoded column as ``array<bigint>``."""
    digits = F.hex(ids)

    def number(at: Column) -> Column:
        four = [F.substring(digits, at * 8 + 1 + 2 * k, F.lit(2)) for k in (3, 2, 1, 0)]
        return F.conv(F.concat(*four), 16, 10).cast("long")

    count = (F.octet_length(ids) / 4).cast("int")
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), number)).when(
        count == 0, F.array().cast("array<bigint>")
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _numbering(pattern: str):
    # In the pattern white space is the Unicode property; the library's \s has some control characters more.
    pattern = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")

    def number(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import regex

        cut = regex.compile(pattern).findall
        plain = re.compile(f"([{_PLAIN_LETTERS}]+)([{_PLAIN_SIGNS}]*)").fullmatch
        # what follows a space, one word or several, without the space; and words that follow none
        chunks, others = Recent(CHUNK_BYTES), Recent(OTHER_BYTES)
        used = 0
        new: list[str] = []

        def numbered(known: Recent, key: str, word: str) -> bytes:
            nonlocal used
            found = used.to_bytes(4, "little")
            used += 1
            new.append(word)
            known.put(key, found)
            return found

        def code(word: str) -> bytes:
            if word[0] == " " and len(word) > 1:
                return chunks.get(word[1:]) or numbered(chunks, word[1:], word)
            return others.get(word) or numbered(others, word, word)

        def chunk_code(chunk: str) -> bytes:
            """The words of a chunk after a space. Letters alone are a word, and signs after them are cut by
            themselves: letters and signs are kept, but not all letters with all signs."""
            if parts := plain(chunk):
                letters, signs = parts.groups()
                found = chunks.get(letters) or numbered(chunks, letters, " " + letters)
                return found + b"".join(map(code, (signs,) if len(signs) == 1 else cut(signs))) if signs else found
            if (found := chunks.get(chunk)) is not None:
                return found
            words = cut(" " + chunk)
            if len(words) == 1:
                return numbered(chunks, chunk, words[0])
            found = b"".join(map(code, words))
            chunks.put(chunk, found)
            return found

        def rows(texts: pa.Array) -> list[bytes]:
            """Words never reach over a single space between other characters, which begins a word: a text is then
            the sequence of its chunks between spaces. A text with other white space beside a space is cut whole."""
            pieces = Cut(texts)
            blank = pc.equal(pc.binary_length(pieces.distinct), 0)
            blank = pc.or_(blank, pc.not_equal(pc.utf8_trim_whitespace(pieces.distinct), pieces.distinct))
            whole = pieces.any_in_row(blank.to_numpy(zero_copy_only=False))
            by_chunk = np.repeat(~whole, np.diff(pieces.starts))
            firsts = pieces.starts[:-1]
            by_chunk[firsts] = False
            said = pieces.texts_of(by_chunk)
            values = list(map(chunks.young.get, said))
            for at in [at for at, value in enumerate(values) if value is None]:
                values[at] = chunk_code(said[at])
            rest = pieces.joined(values)
            begins = pieces.distinct.take(pa.array(pieces.index[firsts])).to_pylist()
            return [
                b"".join(map(code, cut(texts[at].as_py() if whole[at] else first))) + codes
                for at, (first, codes) in enumerate(zip(begins, rest))
            ]

        for texts in batches:
            codes, fresh = [], []
            for some in slices(texts, TEXT_BYTES):
                new = []
                if used > WORDS_KEPT:
                    used = 0
                    chunks.clear()
                    others.clear()
                    new.append(_RESTART)
                codes += rows(some)
                fresh += [new, *([] for _ in range(len(some) - 1))]
            yield pa.StructArray.from_arrays(
                [pa.array(codes, pa.binary()), pa.array(fresh, pa.list_(pa.string()))], ["codes", "fresh"]
            )
            give_back()

    return number


class _Known:
    """The ids of numbered words, on end, in two bytes each if ``most``, the largest, allows it."""

    def __init__(self, most: int) -> None:
        self.ids = np.zeros(1 << 12, "<u2" if most < 1 << 16 else "<u4")
        # where the ids of each word end; four bytes until there are too many
        self.stops, self.count = np.zeros(1 << 10, np.uint32), 0

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        end = int(self.stops[self.count])
        if end + len(ids) > np.iinfo(self.stops.dtype).max:
            self.stops = self.stops.astype(np.int64)
        self.ids = _room(self.ids, end + len(ids))
        self.stops = _room(self.stops, self.count + len(lengths) + 1)
        self.ids[end : end + len(ids)] = ids
        self.stops[self.count + 1 : self.count + 1 + len(lengths)] = end + np.cumsum(lengths)
        self.count += len(lengths)

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of several words on end, and how many each has."""
        starts = self.stops[codes].astype(np.int64)
        lengths = self.stops[codes + 1] - starts
        before = np.cumsum(lengths) - lengths
        return self.ids[np.repeat(starts - before, lengths) + np.arange(lengths.sum())].astype("<u4"), lengths


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    larger = np.zeros(max(size, 2 * len(array)), array.dtype)
    larger[: len(array)] = array
    return larger


def _joining(ranks: dict[bytes, int], numbered: str, merged: str, ids: str):
    def learn(known: _Known, fresh: pa.Array, found: pa.Array) -> None:
        """Take in words that are new, in their order; those that were not folded have no ids yet."""
        lengths = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = found.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        start, stops = 0, np.concatenate(([0], np.cumsum(lengths)))
        for at in np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False)).tolist():
            known.add(flat[stops[start] : stops[at]], lengths[start:at])
            own = np.array(merge_long(fresh[at].as_py().encode(), ranks), "<u4")
            known.add(own, np.array([len(own)]))
            start = at + 1
        known.add(flat[stops[start] :], lengths[start:])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(ranks.values())
        known = _Known(most)
        for batch in batches:
            codes, fresh = batch.column(numbered).flatten()
            rows = np.concatenate(([0], np.cumsum(pc.list_value_length(fresh).to_numpy(zero_copy_only=False))))
            words, found = fresh.flatten(), batch.column(merged).flatten()
            again = np.flatnonzero(pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False))
            held, stops = buffers_of(codes.cast(pa.large_binary()))
            numbers = held[stops[0] : stops[-1]].view("<u4")
            places = (stops - stops[0]) // 4
            # rows before the next restart of the numbers, by the row that it comes with
            restarts = np.searchsorted(rows, again, side="right") - 1
            edges = [0, *restarts.tolist(), len(batch)]
            parts, counts = [], [np.zeros(1, np.int64)]
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                start = rows[a]
                if k:
                    known, start = _Known(most), again[k - 1] + 1
                learn(known, words.slice(start, rows[b] - start), found.slice(start, rows[b] - start))
                for at in range(places[a], places[b], _AT_ONCE):
                    some, lengths = known.of(numbers[at : min(at + _AT_ONCE, places[b])].astype(np.int64))
                    parts.append(some)
                    counts.append(lengths)
            ends = 4 * np.cumsum(np.concatenate(counts))[places]
            whole = np.concatenate([np.zeros(0, "<u4"), *parts]).view(np.uint8)
            names = [x for x in batch.schema.names if x not in (numbered, merged)]
            columns = [*(batch.column(x) for x in names), binary_column(whole, ends)]
            done = pa.RecordBatch.from_arrays(columns, [*names, ids])
            del batch, codes, fresh, words, found, held, numbers, parts, counts, whole, columns
            yield done
            del done
            give_back()

    return join


def _decoding(ranks: dict[bytes, int]):
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        pieces = pa.array(tokens, pa.large_binary())
        for ids in batches:
            rows = ids.to_pylist()
            # one piece after the other in memory: a row is what lies between its first and its last
            flat = pieces.take(pa.array(np.frombuffer(b"".join(row or b"" for row in rows), "<u4")))
            begin = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
            whole = flat.buffers()[2].to_pybytes() if len(flat) else b""
            stops = begin[np.cumsum([0, *(len(row or b"") // 4 for row in rows)])].tolist() if len(flat) else None
            yield pa.array(
                [
                    None if row is None else whole[stops[at] : stops[at + 1]] if row else b""
                    for at, row in enumerate(rows)
                ],
                pa.binary(),
            )
            del rows, flat, begin, whole
            give_back()

    return decode


def merge_long(word: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[int]:
    """Ids of one word of any length: the leftmost pair of lowest rank is merged until none is left (``below`` a rank)."""
    after = list(range(1, len(word) + 1))  # by first byte: where the piece ends
    before = list(range(-1, len(word) - 1))  # where the piece to the left begins
    heap = []

    def offer(start: int) -> None:
        middle = after[start]
        if middle < len(word) and (rank := ranks.get(word[start : after[middle]])) is not None:
            if below is not None and rank >= below:
                return
            heapq.heappush(heap, (rank, start, middle, after[middle]))

    for start in range(len(word) - 1):
        offer(start)
    gone = bytearray(len(word))
    while heap:
        _, start, middle, stop = heapq.heappop(heap)
        if gone[start] or gone[middle] or after[start] != middle or after[middle] != stop:
            continue
        after[start], gone[middle] = stop, 1
        if stop < len(word):
            before[stop] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    found, start = [], 0
    while start < len(word):
        found.append(ranks[word[start : after[start]]])
        start = after[start]
    return found
