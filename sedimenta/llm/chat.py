"""Chat formatting from event logs, with DataFrame functions only.

A log holds, per conversation and message, events in sequence: ``message`` and ``edit`` set the text, ``regenerate``
empties it, ``delta`` adds to it. ``folded`` gives the final messages; a long conversation is spread over tasks until
then. ``formatted`` renders one text per conversation, which one task puts together as it is one value, with the
byte spans that a model learns from. ``parsed`` reads messages back.

The template: ``<turn ROLE>``, a line feed, the text, ``</turn>``, a line feed. Inside roles and texts every ``\\``
and ``<`` (in roles also ``>`` and line feeds) is written as ``\\`` and a letter, so no text can hold a control string
and each text is read back as it was.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import col

# The backslash is escaped first and restored last; every other backslash has another letter.
_TEXT = (("\\", "\\b"), ("<", "\\l"))
_ROLE = (*_TEXT, (">", "\\g"), ("\n", "\\n"))
_END = "</turn>\n"
_RESETS = ("message", "edit", "regenerate")


def folded(events: DataFrame, conversation: str, message: list[str], seq: str = "seq") -> DataFrame:
    """One row per message: ``conversation``, the columns of ``message``, ``role`` and ``text``.

    ``events`` has also ``kind``, ``role`` and ``text``. Events count in the order of ``seq``, nulls first, and among
    equals in that of kind, role and text; repeated events count each time. The role is the first one that is not
    null, or empty. Null texts are empty; a kind that is not known is an error. Null keys are keys like any other.
    """
    known = F.col("kind").isin(*_RESETS, "delta")
    kind = F.when(known, F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null")))))
    event = F.struct(col(seq).alias("seq"), kind.alias("kind"), F.col("role"), F.coalesce("text", F.lit("")).alias("text"))
    keys = [col(conversation), *map(col, message)]
    log = events.groupBy(*keys).agg(F.sort_array(F.collect_list(event)).alias("log"))
    resets = F.transform(F.col("log"), lambda e, i: F.when(e["kind"].isin(*_RESETS), i + 1).otherwise(1))
    last = F.slice("log", F.array_max(resets), F.size("log"))
    texts = F.transform(last, lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"]))
    roles = F.filter(F.transform(F.col("log"), lambda e: e["role"]), lambda r: r.isNotNull())
    return log.select(*keys, F.coalesce(F.get(roles, F.lit(0)), F.lit("")).alias("role"), F.array_join(texts, "").alias("text"))


def formatted(messages: DataFrame, conversation: str, order: list[str], learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conversation``, ``formatted`` and ``loss_spans``.

    Messages come in the order of ``order``, nulls first. ``loss_spans`` are the ``start`` and ``length`` in bytes, from
    0, of the texts whose role is ``learn``.
    """
    head = F.concat(F.lit("<turn "), _escaped(F.col("role"), _ROLE), F.lit(">\n"))
    body = _escaped(F.col("text"), _TEXT)
    pieces = messages.select(
        col(conversation), *map(col, order), F.col("role"), head.alias("_head"), body.alias("_body")
    ).withColumn("_piece", F.concat("_head", "_body", F.lit(_END)))
    before = Window.partitionBy(col(conversation)).orderBy(*(col(x).asc_nulls_first() for x in order))
    start = F.coalesce(F.sum(F.octet_length("_piece").cast("long")).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    span = F.struct((start + F.octet_length("_head")).alias("start"), F.octet_length("_body").cast("long").alias("length"))
    placed = pieces.select(
        col(conversation), start.alias("_start"), "_piece", F.when(F.col("role") == learn, span).alias("_span")
    )
    whole = placed.groupBy(col(conversation)).agg(
        F.sort_array(F.collect_list(F.struct("_start", "_piece", "_span"))).alias("_all")
    )
    spans = F.filter(F.transform(F.col("_all"), lambda x: x["_span"]), lambda s: s.isNotNull())
    text = F.array_join(F.transform(F.col("_all"), lambda x: x["_piece"]), "")
    return whole.select(col(conversation), text.alias("formatted"), spans.alias("loss_spans"))


def parsed(text: Column) -> Column:
    """The messages of a formatted text: an array of structs of ``role`` and ``text``."""
    pieces = F.split(text, _END)

    def message(piece: Column) -> Column:
        stop = F.instr(piece, ">\n")
        role = F.substring(piece, F.lit(7), stop - 7)
        return F.struct(_restored(role, _ROLE).alias("role"), _restored(F.substring(piece, stop + 2, F.length(piece)), _TEXT).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), message)


def learned(text: Column, spans: Column) -> Column:
    """The texts under the spans, as they were before formatting."""
    raw = text.cast("binary")
    return F.transform(
        spans,
        lambda s: _restored(F.substring(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"), _TEXT),
    )


def _escaped(value: Column, pairs) -> Column:
    return reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), pairs, value)


def _restored(value: Column, pairs) -> Column:
    return reduce(lambda x, pair: F.replace(x, F.lit(pair[1]), F.lit(pair[0])), reversed(pairs), value)
