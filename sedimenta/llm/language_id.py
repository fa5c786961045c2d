"""Language identification of mixed texts.

The model has, per language, scores of hashed character n-grams, learned from all training words, and the scripts
that the language is written in. A word is a run of letters of one script, and a longer run than ``WORD_LETTERS`` is
several words, so that unspaced text is read whole. A word's candidates are the languages of its script, its score for each is the sum
over its n-grams, and Viterbi with a penalty per switch labels the words of a text, so that runs of words get one
language each. A text's language is the one with the most letters.

The counts of words come from one pass over the training texts, reduced per task and per word before anything is
shuffled; the model is a table of languages by buckets, however many texts there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import bounded_batches, col, require_free

BUCKETS = 1 << 15
SIZES = (1, 2, 3, 4)  # lengths of n-grams, of the word between two marks
SWITCH = 6.0  # penalty of a change of language, in units of a word's score
FLOOR = 30.0  # below the best language's score for a word whose script the language does not use
CUT = 6.0  # a word's languages differ by at most this, so that no single word decides
SCRIPT_SHARE = 1e-3  # part of a language's words that makes a script its own
WORDS_KEPT = 200_000
WORD_LETTERS = 40  # a longer run of letters is cut into words of so many
UNKNOWN = "und"

# First code points of script ranges; a range goes to the next entry.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "han"), (0x3040, "kana"), (0x3130, "hangul"),
    (0x31C0, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"),
    (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
)
_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([start for start, _ in SCRIPTS])
_SCRIPT_AT = np.array([_NAMES.index(name) for _, name in SCRIPTS])


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # buckets by languages: log likelihood of an n-gram
    uses: np.ndarray  # scripts by languages: whether the language is written in the script


def trained(df: DataFrame, text: str = "text", language: str = "lang", mark: Column | None = None) -> Model:
    """The model of the rows with a language, and ``mark`` true if given. Without any there is a model of no language.

    What the driver gathers is one array per language: buckets and scripts, whatever the number of rows.
    """
    bounded_batches(df)
    rows = df if mark is None else df.filter(mark)
    rows = rows.filter(col(language).isNotNull()).select(col(language).alias("lang"), col(text).alias("text"))
    words = rows.mapInArrow(_counted, "lang string, word string, n bigint")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    grams = words.mapInArrow(_weighed, "lang string, cell bigint, n double")
    cells = grams.groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = cells.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("cells")  # at most buckets and scripts of them
    )
    columns = {row.lang: row.cells for row in found.collect()}
    languages = sorted(columns)
    table = np.zeros((BUCKETS + len(_NAMES), len(languages)))
    for at, name in enumerate(languages):
        for cell, n in columns[name]:
            table[cell, at] = n
    grams_, scripts = table[:BUCKETS], table[BUCKETS:]
    scores = np.log((grams_ + 0.5) / (grams_.sum(axis=0) + 0.5 * BUCKETS))
    return Model(languages, scores.astype(np.float32), scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1.0))


def labelled(df: DataFrame, model: Model, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with ``spans``: the runs of one language of each text, as ``start`` and ``stop`` in code points, ``lang``
    and ``letters``. A text without letters, or null, has no spans; without a model all letters are ``und``."""
    require_free(df, spans)
    bounded_batches(df)
    kind = "array<struct<start:int,stop:int,lang:string,letters:int>>"
    return df.withColumn(spans, F.arrow_udf(_labelling(model), kind)(col(text)))


def predicted(
    df: DataFrame, model: Model, text: str = "text", out: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``df`` with the language that has the most letters of each text (the first by name among equals), and its share
    of them; ``und`` and 0 where there is no letter."""
    require_free(df, out, score)
    bounded_batches(df)
    kind = "struct<lang:string,score:double>"
    found = F.arrow_udf(_deciding(model), kind)(col(text))
    (hidden,) = [x for x in ("_found", "_found_", "_found__") if x not in df.columns][:1]
    return df.withColumn(hidden, found).select(
        *map(col, df.columns), col(hidden)["lang"].alias(out), col(hidden)["score"].alias(score)
    )


class _Cutter:
    """Cuts a text into words: runs of letters, cut at each change of script and then after ``WORD_LETTERS`` letters."""

    def __init__(self):
        import re

        letter = r"[^\W\d_]"
        stops = [start for start, _ in SCRIPTS[1:]] + [0x110000]
        others = "".join(f"{chr(a)}-{chr(b - 1)}" for (a, name), b in zip(SCRIPTS, stops) if name != "latin")
        self.runs = re.compile(f"{letter}+")
        self.short = re.compile(f"{letter}{{1,{WORD_LETTERS}}}")
        self.other = re.compile(rf"[{others}](?<![\W\d_])")  # a letter of another script than Latin
        self.known = lru_cache(WORDS_KEPT)(_pieces)

    def words(self, text: str) -> list[str]:
        if self._latin(text):
            return self.short.findall(text)
        return [piece for run in self.runs.findall(text) for piece in self._cut(run)]

    def places(self, text: str) -> list[tuple[int, int]]:
        if self._latin(text):
            return [m.span() for m in self.short.finditer(text)]
        found = []
        for m in self.runs.finditer(text):
            at = m.start()
            for piece in self._cut(m.group()):
                found.append((at, at + len(piece)))
                at += len(piece)
        return found

    def _latin(self, text: str) -> bool:
        return text.isascii() or not self.other.search(text)

    def _cut(self, run: str) -> list[str]:
        return self.known(run) if len(run) <= WORD_LETTERS else _pieces(run)


def _pieces(run: str) -> list[str]:
    scripts = _script_of(np.frombuffer(run.encode("utf-32-le"), "<u4"))
    starts = [0, *(np.flatnonzero(np.diff(scripts)) + 1).tolist()]
    ends = zip(starts, [*starts[1:], len(run)])
    return [run[at : min(at + WORD_LETTERS, stop)] for start, stop in ends for at in range(start, stop, WORD_LETTERS)]


def _script_of(codes: np.ndarray) -> np.ndarray:
    return _SCRIPT_AT[np.searchsorted(_STARTS, codes, "right") - 1]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter = _Cutter()
    counts: dict[str, Counter] = {}

    def rows() -> pa.RecordBatch:
        flat = [(lang, word, n) for lang, words in counts.items() for word, n in words.items()]
        langs, words, ns = zip(*flat) if flat else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(ns, pa.int64())], ["lang", "word", "n"]
        )

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            if text.is_valid:
                counts.setdefault(lang.as_py(), Counter()).update(cutter.words(text.as_py().lower()))
        if sum(map(len, counts.values())) > WORDS_KEPT:
            yield rows()
            counts = {}
    yield rows()


def _weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-gram buckets and of scripts. A word counts by the root of its frequency, so that common words do
    not drown the rest."""
    for batch in batches:
        sums: dict[str, np.ndarray] = {}
        langs = np.array(batch["lang"].to_pylist(), dtype=object)
        words, weight = batch["word"].to_pylist(), np.sqrt(batch["n"].to_numpy())
        if not words:
            continue
        cells, owner = _grams(words)
        scripts = _scripts(words)
        for lang in set(langs.tolist()):
            mine = langs == lang
            table = np.zeros(BUCKETS + len(_NAMES))
            at = mine[owner]
            table[:BUCKETS] = np.bincount(cells[at], weight[owner[at]], BUCKETS)
            table[BUCKETS:] = np.bincount(scripts[mine], weight[mine], len(_NAMES))
            sums[lang] = table
        for lang, table in sums.items():
            used = np.flatnonzero(table)
            arrays = [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(table[used])]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "cell", "n"])


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all words, and the word that each belongs to."""
    text = "".join(f"\x01{w}\x02" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), lengths)
    stop = np.repeat(np.cumsum(lengths), lengths)
    place = np.arange(len(codes))
    cells, owners = [], []
    mixed = np.zeros(len(codes), np.uint64)
    for size in range(1, max(SIZES) + 1):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[: len(codes) - size + 1] = codes[size - 1 :]
        mixed = (mixed * np.uint64(1_000_003) + shifted) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        if size in SIZES:
            whole = place + size <= stop
            cells.append(((mixed[whole] + np.uint64(size)) % np.uint64(BUCKETS)).astype(np.int64))
            owners.append(owner[whole])
    return np.concatenate(cells), np.concatenate(owners)


def _scripts(words: list[str]) -> np.ndarray:
    return _script_of(np.array([ord(w[0]) for w in words]))


class _Words:
    """Scores of words, kept between batches up to a bound."""

    def __init__(self, model: Model):
        self.model, self.cutter = model, _Cutter()
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.rows: list[np.ndarray] = []

    def look_up(self, words: list[str]) -> np.ndarray:
        if len(self.number) > WORDS_KEPT:
            self.clear()
        new = [w for w in dict.fromkeys(words) if w not in self.number]
        if new:
            self.rows.append(self._scored(new))
            self.rows = [np.concatenate(self.rows)] if len(self.rows) > 20 else self.rows
            start = len(self.number)
            self.number.update((w, start + k) for k, w in enumerate(new))
        table = np.concatenate(self.rows)
        self.rows = [table]
        number = self.number
        return table[[number[w] for w in words]]

    def _scored(self, words: list[str]) -> np.ndarray:
        languages = len(self.model.languages)
        sums = np.zeros((len(words), languages), np.float32)
        lowered = [w.lower() for w in words]
        lowered = [x or w for x, w in zip(lowered, words)]
        cells, owner = _grams(lowered)
        number = np.bincount(owner, minlength=len(words))
        for k in range(languages):
            sums[:, k] = np.bincount(owner, self.model.scores[cells, k], len(words)) / np.sqrt(np.maximum(number, 1))
        sums -= sums.max(axis=1, keepdims=True)
        candidates = self.model.uses[_scripts(lowered)]
        candidates[~candidates.any(axis=1)] = True
        return np.where(candidates, np.maximum(sums, -CUT), -FLOOR).astype(np.float32)


def viterbi(scores: np.ndarray, penalty: np.ndarray, block: int = 64) -> np.ndarray:
    """Best labels of a sequence: ``scores`` by step and label, ``penalty`` for a switch before each step.

    Several sequences can be put end to end, with penalty 0 where one begins. Steps are taken in many blocks at once:
    first the best way through each block from any label to any, then over the blocks, then back.
    """
    n, labels = scores.shape
    if n == 0:
        return np.empty(0, np.int64)
    blocks = -(-n // block)
    padded = np.zeros((blocks * block, labels), np.float64)
    padded[:n] = scores
    change = np.full(blocks * block, np.inf)
    change[:n] = penalty
    padded, change = padded.reshape(blocks, block, labels), change.reshape(blocks, block)

    # ways[b, i, j]: best score of block b that is entered from label i and left with label j
    ways = np.where(np.eye(labels, dtype=bool), 0.0, -np.inf)[None].repeat(blocks, axis=0)
    back = np.empty((block, blocks, labels, labels), np.bool_)
    source = np.empty((block, blocks, labels), np.int16)
    for t in range(block):
        best = ways.max(axis=2)
        source[t] = ways.argmax(axis=2)
        moved = (best - change[:, t, None])[:, :, None]
        back[t] = moved > ways
        ways = np.where(back[t], moved, ways) + padded[:, t, None, :]
    entry = np.empty((blocks + 1, labels))
    entry[0] = 0.0
    origin = np.empty((blocks, labels), np.int64)
    for b in range(blocks):
        through = entry[b][:, None] + ways[b]
        origin[b] = through.argmax(axis=0)
        entry[b + 1] = through.max(axis=0)
        entry[b + 1] -= entry[b + 1].max()
    last, first = np.empty(blocks, np.int64), np.empty(blocks, np.int64)
    state = int(entry[blocks].argmax())
    for b in range(blocks - 1, -1, -1):
        last[b], first[b] = state, origin[b, state]
        state = int(first[b])
    path = np.empty((blocks, block), np.int64)
    every, now = np.arange(blocks), last
    for t in range(block - 1, -1, -1):
        path[:, t] = now
        now = np.where(back[t, every, first, now], source[t, every, first], now)
    return path.reshape(-1)[:n]


def _runs(words: _Words, texts: list[str | None]) -> Iterator[tuple[list[tuple[int, int]], np.ndarray]]:
    """For each text the places of its words and their labels."""
    places, found = [], []
    for text in texts:
        places.append(words.cutter.places(text) if text else [])
        found += [text[a:b] for a, b in places[-1]]
    lengths = np.array([len(p) for p in places])
    if not found or not words.model.languages:
        yield from ((p, np.zeros(len(p), np.int64)) for p in places)
        return
    labels = _labels(words, found, lengths)
    stops = np.cumsum(lengths)
    for p, a, b in zip(places, stops - lengths, stops):
        yield p, labels[a:b]


def _labels(words: _Words, found: list[str], lengths: np.ndarray) -> np.ndarray:
    penalty = np.full(len(found), SWITCH)
    starts = np.cumsum(lengths) - lengths
    penalty[starts[lengths > 0]] = 0.0
    return viterbi(words.look_up(found), penalty)


def _labelling(model: Model):
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, names = _Words(model), model.languages or [UNKNOWN]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string()), ("letters", pa.int32())]))
        for texts in batches:
            rows = []
            for at in range(0, len(texts), 64):
                for places, labels in _runs(words, texts.slice(at, 64).to_pylist()):
                    spans: list[dict] = []
                    for (start, stop), label in zip(places, labels.tolist()):
                        if spans and spans[-1]["lang"] == names[label]:
                            spans[-1]["stop"] = stop
                            spans[-1]["letters"] += stop - start
                        else:
                            spans.append({"start": start, "stop": stop, "lang": names[label], "letters": stop - start})
                    rows.append(spans)
            yield pa.array(rows, kind)

    return label


def _deciding(model: Model):
    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, names = _Words(model), model.languages
        for texts in batches:
            langs, scores = [], []
            for at in range(0, len(texts), 128):
                some = texts.slice(at, 128).to_pylist()
                found = [words.cutter.words(x) if x else [] for x in some]
                lengths = np.array([len(x) for x in found])
                flat = [w for x in found for w in x]
                if not flat or not names:
                    langs += [UNKNOWN] * len(some)
                    scores += [0.0] * len(some)
                    continue
                labels = _labels(words, flat, lengths)
                owner = np.repeat(np.arange(len(some)), lengths)
                size = np.fromiter(map(len, flat), np.int64, len(flat))
                letters = np.bincount(owner * len(names) + labels, size, len(some) * len(names))
                letters = letters.reshape(len(some), len(names))
                total, best = letters.sum(axis=1), letters.argmax(axis=1)
                langs += [names[b] if t else UNKNOWN for b, t in zip(best.tolist(), total.tolist())]
                scores += (letters.max(axis=1) / np.maximum(total, 1)).tolist()
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return decide
