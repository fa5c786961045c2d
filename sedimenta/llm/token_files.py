"""Token ids in flat binary files, read back by memory mapping.

A data set is a folder with, per part, ``part-NNNNN.bin`` (the ids, little-endian, two bytes each if the vocabulary
has at most 65,536 ids and four otherwise), ``part-NNNNN.idx`` (64-bit offsets in ids where documents begin and, at
the end, the number of ids) and ``part-NNNNN.ids`` (the 64-bit document ids; of no meaning in the first ``unnamed_parts`` parts, whose documents
have none), and ``manifest.json``, which comes
last. It names the parts in order, and how many documents and ids come before each: prefix sums of the parts' counts.

Parts are ranges of document ids, each sorted and written by one task. A task writes to files of its own and renames
them at the end, so a task that runs twice leaves one result. The folder must be a path that driver and executors
share as a file system (memory mapping needs one).
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.chunks import Cut, Recent, slices
from sedimenta.llm.common import bounded_batches, col

# Signs that may follow letters. No apostrophe, as tokenizers keep it with letters after it.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Letters that lower-casing keeps letters, each by itself.
_PLAIN_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ʯ"
# Words that the library reads at a time.
_AT_ONCE = 1000
MANIFEST = "manifest.json"


def shared_path(uri: str) -> str:
    """The path of a folder given as a path or as ``file:`` URI; an error for any other store."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory mapping needs a file system that all machines share, not {parts.scheme}:")
    return unquote(parts.path) if parts.scheme else uri


def encoded(df: DataFrame, tokenizer: str, end_id: int | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``ids`` (binary, unsigned little-endian) of each row, with ``end_id`` after the last id.

    ``tokenizer`` is the content of a file of the tokenizers library that puts texts in lower case, drops white space
    and keeps letters apart from other signs, so that no token reaches over either. A text is then the sequence of its
    chunks between spaces, tabs and line breaks. A chunk of letters up to U+02AF, with signs of ASCII after them or
    without, is read as letters and signs, any other one as it is. Each is encoded once per task, or again if it has not been
    seen for long. A null text is empty. Special tokens in a text are read as the library does by default, and none
    are added.
    """
    bounded_batches(df)
    return df.select(col(key).alias("doc_id"), F.arrow_udf(_encoding(tokenizer, end_id), "binary")(col(text)).alias("ids"))


def id_width(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_str(tokenizer).get_vocab_size() <= 1 << 16 else 4


def write(ids: DataFrame, keys: DataFrame, folder: str, width: int, parts: int | None = None) -> dict:
    """Write ``ids`` (``doc_id``, ``ids``) to ``folder`` in ascending order of ``doc_id``; the manifest.

    ``keys`` holds the same ``doc_id`` and is cheaper to scan: it is only read for the bounds of the parts. Rows with
    one id stay together, in the order of their ids' bytes. Rows without an id come first, in parts of their own,
    as many as their share of the rows takes; the manifest says which.
    """
    path = shared_path(folder)
    os.makedirs(path, exist_ok=True)
    spark = ids.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = keys.agg(
        F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], 100 * parts).alias("b"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("doc_id").isNull()).alias("unnamed"),
    ).first()
    bounds = sorted(set(found["b"] or []))
    unnamed = -(-found["unnamed"] * parts // max(1, found["rows"]))  # parts of rows without an id
    spread = F.pmod(F.xxhash64("ids"), F.lit(max(1, unnamed))).cast("int")
    place = _place(bounds)(F.coalesce(F.col("doc_id"), F.lit(0).cast("bigint"))) + unnamed
    dealt = ids.withColumn("part", F.when(F.col("doc_id").isNull(), spread).otherwise(place).cast("int"))
    ordered = dealt.repartitionById(len(bounds) + 1 + unnamed, "part").sortWithinPartitions("part", "doc_id", "ids")
    written = ordered.mapInArrow(_writing(path, width), "part int, documents bigint, tokens bigint")
    entries, documents, tokens = [], 0, 0
    for row in sorted(written.collect()):  # one row per part
        entries.append({"part": row.part, "documents": row.documents, "tokens": row.tokens, "documents_before": documents, "tokens_before": tokens})
        documents, tokens = documents + row.documents, tokens + row.tokens
    manifest = {"width": width, "documents": documents, "tokens": tokens, "unnamed_parts": unnamed, "parts": entries}
    draft = f"{path}/.{MANIFEST}-{uuid.uuid4().hex}"
    with open(draft, "w") as out:
        json.dump(manifest, out)
    os.replace(draft, f"{path}/{MANIFEST}")
    return manifest


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` of every document.

    One task per part maps its files; ``ids`` has the width of the files.
    """
    path = shared_path(folder)
    with open(f"{path}/{MANIFEST}") as text:
        manifest = json.load(text)
    rows = [(p["part"], p["tokens_before"]) for p in manifest["parts"]]
    if not rows:
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids binary")
    parts = spark.createDataFrame(rows, "part int, before bigint").repartition(len(rows), "part")
    return parts.mapInArrow(_reading(path, manifest["width"], manifest["unnamed_parts"]), "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def crc32(ids: str, width: int):
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def crc(column: pa.Array) -> pa.Array:
        import zlib

        kind = "<u2" if width == 2 else "<u4"
        return pa.array([zlib.crc32(np.frombuffer(x, kind).astype("<u4").tobytes()) for x in column.to_pylist()], pa.int64())

    return F.arrow_udf(crc, "bigint")(F.col(ids))


def _place(bounds: list[int]):
    """The number of bounds below an id."""

    def place(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(np.array(bounds, np.int64), keys.to_numpy(zero_copy_only=False)), pa.int32())

    return F.arrow_udf(place, "int")


def _encoding(tokenizer: str, end_id: int | None):
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = Tokenizer.from_str(tokenizer)
        kind = "<u2" if library.get_vocab_size() <= 1 << 16 else "<u4"
        end = b"" if end_id is None else np.array([end_id], kind).tobytes()
        letter = re.compile(f"[{_PLAIN_LETTERS}]").fullmatch
        letters = "".join(x for x in map(chr, range(0x300)) if letter(x))
        plain, last, known = f"^[{_PLAIN_LETTERS}]+$", _ends_word(library), Recent()

        def ids_of(words: list[str]) -> list[bytes]:
            codes = library.encode_batch_fast(words, add_special_tokens=False)
            return [np.array(code.ids, kind).tobytes() for code in codes]

        def read(words: list[str]) -> list[bytes]:
            """The ids of words of plain letters, which the library reads several at a time."""
            found = []
            for at in range(0, len(words), _AT_ONCE):
                some = words[at : at + _AT_ONCE]
                whole = ids_of([" ".join(some)])[0]
                stops = np.flatnonzero(last[np.frombuffer(whole, kind)]) + 1
                edges = [0, *(int(kind[2]) * stops).tolist()]
                if len(stops) == len(some) and edges[-1] == len(whole):
                    found += [whole[a:b] for a, b in zip(edges[:-1], edges[1:])]
                else:  # not a vocabulary in which each word has one last token
                    found += ids_of(some)
            return found

        def values_of(texts: pa.Array) -> pa.Array:
            """The ids of each text; distinct texts are looked up once, and those that are not known are encoded."""
            encoded = texts.dictionary_encode()
            said = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
            values = known.get_all(said)
            unknown = [at for at, value in enumerate(values) if value is None]
            by_letters = pc.match_substring_regex(encoded.dictionary.take(pa.array(unknown, pa.int64())), plain)
            by_letters = by_letters.to_numpy(zero_copy_only=False).tolist()
            for reader, wanted in ((read, True), (ids_of, False)):
                places = [at for at, is_plain in zip(unknown, by_letters) if is_plain is wanted]
                words = [said[at] for at in places]
                found = reader(words)
                known.put_all(words, found)
                for at, value in zip(places, found):
                    values[at] = value
            return pa.array(values, pa.large_binary()).take(encoded.indices)

        for texts in batches:
            done = []
            for some in slices(texts):
                pieces = Cut(pc.replace_substring(pc.replace_substring(some, "\n", " "), "\t", " "))
                # what has the same ids as a piece: plain letters and the signs after them, or the piece as it is
                first = pc.utf8_rtrim(pieces.distinct, SIGNS)
                cut = pc.match_substring_regex(first, plain)
                first = pc.if_else(cut, first, pieces.distinct)
                after = pc.if_else(cut, pc.utf8_ltrim(pieces.distinct, letters), "")
                ids = pc.binary_join_element_wise(values_of(first), values_of(after), pa.scalar(b"", pa.large_binary()))
                done += [x + end for x in pieces.all_joined(ids)]
            yield pa.array(done, pa.binary())

    return encode


def _ends_word(library) -> np.ndarray:
    """Of each id whether its token ends a word, by the suffix that the model gives such tokens."""
    suffix = getattr(library.model, "end_of_word_suffix", None)
    found = np.zeros(library.get_vocab_size(), bool)
    if suffix:
        found[[n for token, n in library.get_vocab().items() if token.endswith(suffix)]] = True
    return found


def _writing(path: str, width: int):
    def write_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, part, files, offsets, keys, done = ("bin", "idx", "ids"), None, {}, [0], [], []
        mark = uuid.uuid4().hex

        def close() -> None:
            files["idx"].write(np.array(offsets, "<i8").tobytes())
            files["ids"].write(np.array(keys, "<i8").tobytes())
            for kind in kinds:
                files[kind].flush()
                os.fsync(files[kind].fileno())
                files[kind].close()
                os.replace(f"{path}/.part-{part:05d}.{kind}-{mark}", f"{path}/part-{part:05d}.{kind}")
            done.append((part, len(keys), offsets[-1]))

        for batch in batches:
            for key, ids, at in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist(), batch["part"].to_pylist()):
                if at != part:
                    if part is not None:
                        close()
                    part, offsets, keys = at, [0], []
                    files = {kind: open(f"{path}/.part-{part:05d}.{kind}-{mark}", "wb") for kind in kinds}
                files["bin"].write(ids)
                offsets.append(offsets[-1] + len(ids) // width)
                keys.append(0 if key is None else key)
        if part is not None:
            close()
        if done:
            columns = [pa.array(x, kind) for x, kind in zip(zip(*done), (pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "documents", "tokens"])

    return write_parts


def _reading(path: str, width: int, unnamed: int, at_once: int = 1000):
    def read_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before in zip(batch["part"].to_pylist(), batch["before"].to_pylist()):
                name = f"{path}/part-{part:05d}"
                keys = np.memmap(f"{name}.ids", "<i8", "r")
                offsets = np.memmap(f"{name}.idx", "<i8", "r")
                ids = np.memmap(f"{name}.bin", "u1", "r") if offsets[-1] else np.empty(0, "u1")
                for low in range(0, len(keys), at_once):
                    high = min(low + at_once, len(keys))
                    places = np.asarray(offsets[low : high + 1])
                    rows = [ids[width * a : width * b].tobytes() for a, b in zip(places[:-1], places[1:])]
                    named = pa.nulls(high - low, pa.int64()) if part < unnamed else pa.array(np.asarray(keys[low:high]))
                    columns = [places[:-1] + before, np.diff(places)]
                    arrays = [named, *(pa.array(np.asarray(x), pa.int64()) for x in columns), pa.array(rows, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids"])

    return read_parts
