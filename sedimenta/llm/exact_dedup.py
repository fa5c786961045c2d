"""Exact deduplication, with DataFrame functions only.

Rows are grouped by a 128-bit content hash and, inside it, by the text itself, so texts are compared byte by byte
and a collision of hashes makes two groups. Copies merge in each task before the shuffle. The verdict goes back to
each row by two hashes of the text, so long texts travel once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import col, join_counted, require_free, staged, unused


def duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "smallest") -> DataFrame:
    """One row per row of ``df``: ``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their bytes are; null counts as the empty text. Of equal texts the row with the smallest key
    stays (``keep="largest"``: the largest). A null key never stays where the group has any other key. Rows that
    repeat both key and text are one document: each of them is counted, and all have the same ``kept``.
    """
    return _judged(df.select(col(key), col(text)), text, key, keep).select(
        col(key), "keep_id", "group_size", F.col("keep_id").eqNullSafe(col(key)).alias("kept"), "text_sha256"
    )


def deduplicated(df: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "smallest") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns. Of rows that repeat key and text, one stays."""
    columns = df.columns
    judged = _judged(df, text, key, keep)
    stay = judged.filter(F.col("keep_id").eqNullSafe(col(key)))
    if df.groupBy(col(key)).count().filter("count > 1").limit(1).count() == 0:
        return stay.select(*map(col, columns))
    # Rows of one key and text are told apart by their other columns: the first by a hash of them all stays.
    row = F.struct(*map(col, columns))
    first = stay.groupBy(col(key), "text_sha256").agg(F.min_by(row, F.xxhash64(row)).alias("row"))
    return first.select("row.*")


def _judged(df: DataFrame, text: str, key: str, keep: str) -> DataFrame:
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    require_free(df, "keep_id", "group_size", "text_sha256")
    content = F.coalesce(col(text), F.lit(""))
    chosen = F.min if keep == "smallest" else F.max
    rows = df.select(col(key).alias("id"), content.alias("content"))
    groups = (
        rows.groupBy(F.unhex(F.md5("content")).alias("hash"), "content")
        .agg(chosen("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", F.sha2("content", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    groups = staged(groups)
    if groups.groupBy("hash", "text_sha256").count().filter("count > 1").limit(1).count():
        raise ValueError("two different texts agree in both hashes")
    hash_, sha = unused(df, "_hash", "_sha")
    hashed = df.withColumn(hash_, F.unhex(F.md5(content))).withColumn(sha, F.sha2(content, 256))
    keyed = groups.select(F.col("hash").alias(hash_), F.col("text_sha256").alias(sha), "keep_id", "group_size")
    judged = join_counted(hashed, keyed, [hash_, sha], "group_size", [key])
    return judged.withColumnRenamed(sha, "text_sha256").drop(hash_)
