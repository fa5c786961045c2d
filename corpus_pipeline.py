"""A corpus from raw documents to token ids, as stages that can be run one by one.

Each stage takes all that the one before it kept. The first four return the columns of ``documents``, the last one
the id, the ids of the tokens and their number.
"""

from __future__ import annotations

from functools import reduce, wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import bpe, exact_dedup, language_id, mixing, simhash
from sedimenta.llm.common import col, staged

# The columns of ``documents``.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_OTHERS = "_other_columns_of_documents"

# A text is rejected if it has no letter, or if its most common language has less than this part of its letters.
LEAST_SHARE = 0.5


def _any_columns(stage):
    """The stage sees the columns of ``documents``; others go with their rows, whatever their names."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [x for x in docs.columns if x not in COLUMNS]
        if not others:
            return stage(spark, docs, sf_dir)
        own = [x for x in docs.columns if x in COLUMNS]
        found = stage(spark, docs.select(*map(col, own), F.struct(*map(col, others)).alias(_OTHERS)), sf_dir)
        return found.select(*(F.col(_OTHERS).getField(x).alias(x) if x in others else col(x) for x in docs.columns))

    return run_stage


@_any_columns
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one language: others have no letters or no language with at least half of them.

    The model is learned from all texts with a language; without any nothing can be judged but the lack of letters.
    """
    model = language_id.trained(docs)
    least = LEAST_SHARE if model.languages else 0.0
    found = language_id.predicted(docs, model, out="_language", score="_share")
    has_letters = F.col("_language") != language_id.UNKNOWN
    if not model.languages:
        has_letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return found.filter(has_letters & (F.col("_share") >= least)).select(*map(col, docs.columns))


@_any_columns
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id, null being the least; of rows with that id and text one."""
    return exact_dedup.deduplicated(docs, keep="largest")


@_any_columns
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id."""
    return simhash.near_deduplicated(docs, shingle=3, distance=2)


@_any_columns
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document whole, as often as the mix takes it: none, once or twice.

    Documents are rows, so null and repeated ids are documents of their own. Those without words are not taken.
    """
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers) of each document.

    Every row is encoded, also with a null or repeated id; null and empty texts have no ids.
    """
    tokenizer = bpe.tokenizer(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = bpe.fewer_partitions(docs.select("doc_id", "text"))
    return tokenizer.encode(texts, "text", keep_text=False).select(
        "doc_id", bpe.token_count(F.col("ids")).alias("n_tokens"), "ids"
    )


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE", encode),
]
# Predicted languages, XXH64 and merges of byte pairs are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def after(kept: DataFrame, stage) -> DataFrame:
        return stage[1](spark, staged(kept), sf_dir)

    return reduce(after, STAGES[1:], STAGES[0][1](spark, docs, sf_dir))
