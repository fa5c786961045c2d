import hashlib
import os
import sys
from collections import Counter
from functools import reduce

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from sedimenta.llm import bpe  # noqa: E402
from sedimenta.llm.common import staged  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    from test_dedup import plain_components, plain_fingerprint

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(1 << 40, None, None, None, 0), ((1 << 40) + 1, "12 34", "en", "s", 5), ((1 << 40) + 2, "", "de", None, 0)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    named, copies, near, mixed, encoded = (stage for _, stage in corpus_pipeline.STAGES)

    kept = spark.createDataFrame(named(spark, docs, FOLDER).collect(), docs.schema)
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {o[0] for o in odd}

    last = {}
    for row in kept.collect():
        last[row.text] = max(last.get(row.text, -1), row.doc_id)
    whole = spark.createDataFrame(copies(spark, kept, FOLDER).collect(), docs.schema)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(last.values())

    components = plain_components({r.doc_id: plain_fingerprint(r.text) for r in whole.collect()}, 2)
    single = spark.createDataFrame(near(spark, whole, FOLDER).collect(), docs.schema)
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(components.values()))

    taken = mixed(spark, single, FOLDER)
    assert taken.columns == COLUMNS
    times = Counter(r.doc_id for r in taken.collect())
    texts = {r.doc_id: r.text for r in single.collect()}
    words = {k: len(t.split()) for k, t in texts.items()}
    total = sum(words[k] * n for k, n in times.items())
    assert max(times.values()) <= 2 and abs(total / (1.5 * sum(words.values())) - 1) < 0.05

    rows = corpus_pipeline.encode(spark, taken, FOLDER).collect()
    library = tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
    )
    assert Counter(r.doc_id for r in rows) == times
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert bytes(row.ids) == np.array(ids, "<u4").tobytes() and row.n_tokens == len(ids)


def test_run_is_the_stages_in_order_and_repeats(spark):
    def digest(df):
        return sorted((r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest()) for r in df.collect())

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
    one = digest(corpus_pipeline.run(spark, FOLDER))
    assert one == digest(corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER))


def test_empty_table(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_other_columns_and_null_ids_go_through_all_stages(spark):
    names = ["_language", "_share", "keep_id", "group_size", "text_sha256", "_times", "_key", "_copy", "_Row", "size", "a.b"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))
    docs = docs.select("*", *(F.concat(F.lit(f"{n} "), F.xxhash64("text").cast("string")).alias(n) for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = staged(stage(spark, docs, FOLDER))
        assert after.columns == docs.columns and 0 < after.count()
        docs = after
    wrong = [F.col(f"`{n}`") != F.concat(F.lit(f"{n} "), F.xxhash64("text").cast("string")) for n in names]
    assert docs.filter(reduce(lambda a, b: a | b, wrong)).isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
