"""Records of CSV files, read in splits although quoted fields may hold line breaks.

Whether a line break ends a record depends on the number of quotes before it in the file. A first
scan counts the quotes of each block of a file as odd or even; sums over the blocks before tell
how each block begins, inside quotes or not. Every block is then cut into records by itself.
What a block leaves open at its end or closes at its beginning, at most two pieces, is gathered by
a scan of its own and put together, so all text but those pieces stays in the task that read it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Beginnings of blocks are broadcast up to this size. Beyond it lines are shuffled to them by block.
BROADCAST_BYTES = 128 << 20
# A row of the broadcast beside the name of its file.
_ROW_BYTES = 96

_WHOLE, _CLOSES, _OPENS = 0, 1, 2
_BLANK = (b"", b"\r")
_ESCAPE, _MARK = "\x02", "\x01"
_PIECES = "path string, start bigint, position bigint, piece int, text binary"


def csv_records(
    spark: SparkSession, path: str | list[str], broadcast_bytes: int = BROADCAST_BYTES, pattern: str = "*"
) -> DataFrame:
    """One row ``(path, start, position, record)`` per record of UTF-8 files, headers included, blank lines left out.

    ``start`` is the block in which a record begins and ``position`` its place among that block's records, so both give
    the order within a file, and a header has 0 and 0. Lines end in ``\\n`` or ``\\r\\n``. Quotes stand at both ends
    of a field or are doubled inside it: any other quote would shift all that comes after, and fails the job, as does a
    quote that is never closed. So do files that are cut into other blocks in the second scan than in the first, which
    needs a change of the session or of the cluster between them. Only files whose names fit the ``pattern`` are read.
    """
    lines = _lines(spark, path, pattern)
    odd = (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    blocks = lines.groupBy("path", "start").agg((F.sum(odd) % 2).alias("odd"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.select("path", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))

    # inner lines without a beginning must not vanish, so the join keeps them and they fail
    if _most_bytes(spark, path, pattern) <= broadcast_bytes:
        known = lines.join(F.broadcast(begins), ["path", "start"], "left")
    else:
        numbered = lines.withColumn("line", F.monotonically_increasing_id())
        joined = numbered.join(begins.hint("merge"), ["path", "start"], "left")
        known = joined.repartition("path", "start").sortWithinPartitions("path", "start", "line")
    changed = F.raise_error(F.lit("a file was cut into other blocks than before; set spark.sql.files.minPartitionNum"))
    inside = F.coalesce("inside", changed.cast("boolean"))
    pieces = known.select("path", "start", inside.alias("inside"), F.col("value").cast("binary").alias("value"))
    whole = pieces.mapInArrow(partial(_cut, edges=False), _PIECES).select("path", "start", "position", "text")
    records = whole.unionByName(_joined(pieces.mapInArrow(partial(_cut, edges=True), _PIECES)))
    text = F.regexp_replace(F.col("text").cast("string"), r"\r\z", "")
    records = records.select("path", "start", "position", text.alias("record")).filter(F.col("record") != "")
    broken = F.concat(F.lit("a quote inside a field, or one that is not closed: "), F.substring("record", 1, 200))
    return records.filter(F.when(_well_quoted(F.col("record")), True).otherwise(F.raise_error(broken).cast("boolean")))


def file_name(uri: Column) -> Column:
    """The name of a file as it is listed, from its URI."""
    return F.url_decode(F.replace(F.element_at(F.split(uri, "/"), -1), F.lit("+"), F.lit("%2B")))


def csv_fields(record: Column) -> Column:
    """The fields of a well-quoted record of any width, as texts without their quotes.

    Separators outside quotes are replaced by a mark that the escaped record does not hold, and the record is cut there.
    """
    escaped = F.replace(F.replace(record, F.lit(_ESCAPE), F.lit(_ESCAPE + "0")), F.lit(_MARK), F.lit(_ESCAPE + "1"))
    parts = F.transform(
        F.split(escaped, '"', -1),
        lambda part, i: F.when(i % 2 == 0, F.replace(part, F.lit(","), F.lit(_MARK))).otherwise(part),
    )
    marked = F.when(F.contains(record, F.lit('"')), F.array_join(parts, '"')).otherwise(
        F.replace(escaped, F.lit(","), F.lit(_MARK))
    )

    def value(field: Column) -> Column:
        inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
        text = F.when(F.startswith(field, F.lit('"')), inner).otherwise(field)
        return F.replace(F.replace(text, F.lit(_ESCAPE + "1"), F.lit(_MARK)), F.lit(_ESCAPE + "0"), F.lit(_ESCAPE))

    return F.transform(F.split(marked, _MARK, -1), value)


def field_count(record: Column) -> Column:
    """Fields of a well-quoted record: separators outside quotes, plus one."""
    commas = F.length(record) - F.length(F.replace(record, F.lit(","), F.lit("")))
    outside = F.filter(F.split(record, '"', -1), lambda part, i: i % 2 == 0)
    unquoted = F.array_join(outside, "")
    quoted = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit("")))
    return F.when(F.contains(record, F.lit('"')), quoted).otherwise(commas) + 1


def _lines(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    read = spark.read.text(path, lineSep="\n", pathGlobFilter=pattern)
    return read.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _most_bytes(spark: SparkSession, path: str | list[str], pattern: str) -> float:
    """A bound of the size of all beginnings of blocks, from the names and lengths of the files."""
    # smaller blocks than this are cut only where there are fewer of them than cores
    block = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    blocks = F.ceil(F.col("length") / block) + 1
    found = files.agg(
        F.sum(blocks * (F.length("path") + _ROW_BYTES)).alias("size"), F.max(F.length("path")).alias("longest")
    ).first()
    few = 2 * spark.sparkContext.defaultParallelism * ((found["longest"] or 0) + _ROW_BYTES)
    return math.inf if found["size"] is None else found["size"] + few


def _joined(pieces: DataFrame) -> DataFrame:
    """The records that blocks leave open, each with what the blocks after it add up to its end."""
    order = F.struct("start", "piece")
    opened = Window.partitionBy("path").orderBy("start", "piece").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("record", F.count_if(F.col("piece") == _OPENS).over(opened))
    parts = F.sort_array(F.collect_list(F.struct("start", "piece", "text")))
    texts = F.array_join(F.transform(parts, lambda part: part["text"].cast("string")), "\n").cast("binary")
    first = F.min_by(F.struct("start", "position"), order)
    found = numbered.groupBy("path", "record").agg(first.alias("first"), texts.alias("text"))
    return found.select("path", "first.*", "text")


def _well_quoted(record: Column) -> Column:
    """Whether quotes only enclose whole fields or are doubled inside them: what is outside quotes between two quotes
    is nothing, or begins and ends with a separator."""
    outside = F.filter(F.split(record, '"', -1), lambda part, i: i % 2 == 0)
    n = F.size(outside)
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    fits = F.forall(
        F.transform(outside, lambda part, i: F.struct(part.alias("part"), i.alias("i"))),
        lambda x: (x["part"] == "")
        | (
            ((x["i"] == 0) | F.startswith(x["part"], F.lit(",")))
            & ((x["i"] == n - 1) | F.endswith(x["part"], F.lit(",")))
        ),
    )
    return ~F.contains(record, F.lit('"')) | ((quotes % 2 == 0) & fits)


def _cut(batches: Iterator[pa.RecordBatch], edges: bool) -> Iterator[pa.RecordBatch]:
    """The pieces that blocks leave open or close, or else their whole records.

    The lines of a block come one after the other and say whether it begins inside quotes. Blank lines at the
    beginning of a file have no place.
    """
    block, inside, closes, position = None, False, False, 0
    open_lines: list[bytes] = []
    for batch in batches:
        paths, starts, begins, values = batch.columns
        n = len(values)
        if not n:
            continue
        starts = starts.to_numpy()
        paths = paths.dictionary_encode()
        names, codes = paths.dictionary.to_pylist(), paths.indices.to_numpy()
        odd = pc.count_substring(values, b'"').to_numpy() % 2
        changes = 1 + np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1]))
        for low, high in zip([0, *changes], [*changes, n]):
            here = (names[codes[low]], int(starts[low]))
            if here != block:
                if open_lines and edges:
                    yield _piece(block, position, closes, open_lines)
                inside = closes = begins[int(low)].as_py()
                block, position, open_lines = here, 0, []
            after = (np.cumsum(odd[low:high]) + inside) % 2
            inside = bool(after[-1])
            ends = low + np.flatnonzero(after == 0)
            if not len(ends):
                open_lines += values.slice(low, high - low).to_pylist()
                continue
            first = int(low)
            if open_lines or closes:
                first = int(ends[0]) + 1
                open_lines += values.slice(low, first - low).to_pylist()
                if closes and edges:
                    yield _piece(block, position, True, open_lines)
                elif not closes and not edges:
                    yield _pieces(block, position, pa.array([b"\n".join(open_lines)], pa.binary()))
                closes, open_lines, ends, position = False, [], ends[1:], position + 1
            while block[1] == position == 0 and len(ends) and ends[0] == first and values[first].as_py() in _BLANK:
                first, ends = first + 1, ends[1:]
            if len(ends):
                if not edges:
                    offsets = pa.array(np.concatenate([[first], ends + 1]), pa.int32())
                    yield _pieces(block, position, pc.binary_join(pa.ListArray.from_arrays(offsets, values), b"\n"))
                position += len(ends)
                first = int(ends[-1]) + 1
            open_lines = values.slice(first, high - first).to_pylist()
    if open_lines and edges:
        yield _piece(block, position, closes, open_lines)


def _piece(block: tuple[str, int], position: int, closes: bool, lines: list[bytes]) -> pa.RecordBatch:
    return _pieces(block, position, pa.array([b"\n".join(lines)], pa.binary()), _CLOSES if closes else _OPENS)


def _pieces(block: tuple[str, int], position: int, texts: pa.Array, piece: int = _WHOLE) -> pa.RecordBatch:
    path, start = block
    n = len(texts)
    return pa.RecordBatch.from_arrays(
        [
            pa.repeat(path, n),
            pa.repeat(pa.scalar(start, pa.int64()), n),
            pa.array(np.arange(position, position + n, dtype=np.int64)),
            pa.repeat(pa.scalar(piece, pa.int32()), n),
            texts,
        ],
        names=["path", "start", "position", "piece", "text"],
    )
