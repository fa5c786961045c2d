"""Texts cut at spaces, many at a time, and what is known about the pieces.

Most of a text's pieces have been seen before, so what costs time is done once per distinct piece of a batch and, if
it has been seen lately, not at all. Arrow finds the distinct pieces and puts the results of all occurrences in place.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts that are cut at a time have so many bytes, or are one text.
SLICE_BYTES = 8 << 20
# Each of the two generations of what is kept may take about so much memory.
KEPT_BYTES = 80 << 20
# Pieces with more characters are not kept.
LONGEST_KEPT = 200
_ENTRY_BYTES = 200


def give_back() -> None:
    """Return free memory to the system. Else a worker keeps the most that it ever had, also as it goes on with another
    task, beside all the other workers of its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


class Recent:
    """Values of texts, the recently used ones: when ``young`` is full it becomes ``old``, and the old ones are gone.

    An old value that is asked for is young again. Thus memory is bounded, and what is frequent stays.
    """

    def __init__(self, kept_bytes: int | None = None):
        self.most = KEPT_BYTES if kept_bytes is None else kept_bytes
        self.clear()

    def clear(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.used = 0

    def get(self, text: str) -> bytes | None:
        value = self.young.get(text)
        if value is None:
            value = self.old.get(text)
            if value is not None:
                self.put(text, value)
        return value

    def put(self, text: str, value: bytes) -> None:
        if len(text) > LONGEST_KEPT:
            return
        if self.used > self.most:
            self.old, self.young, self.used = self.young, {}, 0
        self.young[text] = value
        self.used += _ENTRY_BYTES + len(text) + len(value)

    def get_all(self, texts: list[str]) -> list[bytes | None]:
        """The values of distinct texts, or None. Old ones are young again."""
        values = list(map(self.young.get, texts))
        if self.old:
            missing = [at for at, value in enumerate(values) if value is None]
            found = [(at, value) for at in missing if (value := self.old.get(texts[at])) is not None]
            for at, value in found:
                values[at] = value
            self.put_all([texts[at] for at, _ in found], [value for _, value in found])
        return values

    def put_all(self, texts: list[str], values: list[bytes]) -> None:
        """Like ``put`` for each, but what is young becomes old only between two calls."""
        if self.used > self.most:
            self.old, self.young, self.used = self.young, {}, 0
        kept = {text: value for text, value in zip(texts, values) if len(text) <= LONGEST_KEPT}
        self.young.update(kept)
        self.used += _ENTRY_BYTES * len(kept) + sum(map(len, kept)) + sum(map(len, kept.values()))


def slices(texts: pa.Array, most_bytes: int | None = None) -> Iterator[pa.Array]:
    """Consecutive rows of ``texts`` with at most so many bytes together, or one row; null is empty."""
    texts, most_bytes = texts.cast(pa.large_string()).fill_null(""), most_bytes or SLICE_BYTES
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else []
    start, before = 0, 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield texts.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


class Cut:
    """The pieces of some texts between the single character ``at``: which are distinct, and where they are."""

    def __init__(self, texts: pa.Array, at: str = " "):
        pieces = pc.split_pattern(texts, at)
        offsets = pieces.offsets.to_numpy(zero_copy_only=False)
        self.starts = offsets - offsets[0]  # of each text in the pieces of all, and the end
        encoded = pieces.flatten().dictionary_encode()
        self.distinct = encoded.dictionary
        self.index = encoded.indices.to_numpy(zero_copy_only=False)

    def any_in_row(self, of_distinct: np.ndarray) -> np.ndarray:
        """Of each text whether it has a piece that is marked; a text has one piece at least."""
        if not len(self.starts) - 1:
            return np.zeros(0, bool)
        return np.logical_or.reduceat(of_distinct[self.index], self.starts[:-1])

    def texts_of(self, wanted: np.ndarray) -> list[str]:
        """The distinct pieces that occur where ``wanted`` is set, in a fixed order."""
        needed = np.zeros(len(self.distinct), bool)
        needed[self.index[wanted]] = True
        self.wanted, self.place = wanted, np.cumsum(needed) - 1
        return self.distinct.take(pa.array(np.flatnonzero(needed))).to_numpy(zero_copy_only=False).tolist()

    def joined(self, values: list[bytes]) -> list[bytes]:
        """For each text the values of its wanted pieces on end; ``values`` are those of ``texts_of``."""
        taken = pa.array(values, pa.large_binary()).take(pa.array(self.place[self.index[self.wanted]]))
        counts = np.concatenate(([0], np.cumsum(self.wanted)))
        return _on_end(taken, counts[self.starts])

    def all_joined(self, values: pa.Array) -> list[bytes]:
        """For each text the values of all its pieces on end; ``values`` are those of ``distinct``."""
        return _on_end(values.take(pa.array(self.index)), self.starts)


def _on_end(values: pa.Array, starts: np.ndarray) -> list[bytes]:
    held, stops = buffers_of(values)
    edges = stops[starts].tolist()
    return [held[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]


def buffers_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large binary column, and where each value begins and the last one ends."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    stops = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), stops


def binary_column(values: np.ndarray, stops: np.ndarray) -> pa.Array:
    """A binary column over ``values``, bytes on end, whose rows end at ``stops`` (which begins with 0)."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(stops, np.int64)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.large_binary(), len(stops) - 1, buffers).cast(pa.binary())
