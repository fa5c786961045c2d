import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from sedimenta.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    None, "", " ", "\n\n  x", "tail \n", " lead", "a  b", "a \nb c", "aaaa aaaaa aaaaaaa baaaab", "\x00\x01a b",
    "I'll don't 've  é ñ 日本語テキスト", "12345678 9.0!!!???", "a\x1cb \x1d c", "x y   z", "<|endoftext|>",
    "a" * 900, "日本" * 300, "😀👍🏽 é ǰ", "ab " * 3000, "same text", "same text",
]


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.ByteBPE(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(tokenizer):
    return tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={}
    )


def ids_of(row):
    return np.frombuffer(row["ids"], "<u4").tolist()


def test_encodes_as_the_library_and_decodes_back(spark, tokenizer, library):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    for row in tokenizer.decode(tokenizer.encode(df, "text")).collect():
        text = row["text"] or ""
        assert ids_of(row) == library.encode_ordinary(text), text[:40]
        assert bytes(row["decoded"]) == text.encode()


def test_restarting_the_word_list_changes_nothing(spark, tokenizer, library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 3)
    texts = [f"word{n % 7} and other{n % 5} words {n}" for n in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    for row in tokenizer.encode(df, "text").collect():
        assert ids_of(row) == library.encode_ordinary(row["text"])


@pytest.mark.parametrize("kept,at_once,slice_bytes", [(64 << 20, 1 << 18, 8 << 20), (3000, 5, 300)])
def test_random_texts(spark, tokenizer, library, monkeypatch, kept, at_once, slice_bytes):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", kept)
    monkeypatch.setattr(bpe, "OTHER_BYTES", kept)
    monkeypatch.setattr(bpe, "TEXT_BYTES", slice_bytes)
    monkeypatch.setattr(bpe, "_AT_ONCE", at_once)
    rng = random.Random(7)
    some = ["word", "Über", "été.", "x,", "'s", "9", "12,", "\n", "\xa0", " ", "", "日本", "a.b", "...", "ſ", "ʰ", "ª", "ñandú!", "\x1c", "I'll"]
    texts = [" ".join(rng.choices(some, k=rng.randint(0, 40))) for _ in range(1500)]
    texts += ["x" * 20_000 + "日" * 8000, "ab" * 10_000 + " " + "é" * 300, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    rows = tokenizer.encode(df, "text").collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert ids_of(row) == library.encode_ordinary(row["text"] or ""), row["text"][:40]


def test_plan_holds_the_table_once(spark, tokenizer):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = tokenizer.encode(df, "text")._jdf.queryExecution().toString()
    assert len(plan) < 5_000_000 * 2  # of four plans, two before literals are made and two after


def test_fold_and_heap_agree(spark, tokenizer):
    words = ["internationalisation", " straße", "aaaaaaaaaaaaa", "日本語", "x", "....!!!!----", "\n\n\n\t"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for row in df.select("w", F.get(tokenizer.merged(F.array("w")), F.lit(0)).alias("ids")).collect():
        assert row["ids"] == bpe.merge_long(row["w"].encode(), tokenizer.ranks)


def test_fold_of_repeated_and_random_letters(spark, tokenizer):
    rng = random.Random(3)
    words = ["".join(rng.choices(some, k=rng.randint(1, 40))) for some in ("ab", " etn", "aé日", "the ing", "x.-") for _ in range(60)]
    words += ["a", "b" * 255, "ab" * 128, "e" + "t" * 254, "a" * 257, ""]
    df = spark.createDataFrame([(words,)], "w array<string>")
    for word, ids in zip(words, df.select(tokenizer.merged(F.col("w"))).first()[0]):
        expected = bpe.merge_long(word.encode(), tokenizer.ranks) if 0 < len(word.encode()) <= bpe.FOLD_BYTES else None
        assert ids == expected, word


def test_a_step_of_the_fold_does_not_put_slices_together(spark, tokenizer):
    df = spark.createDataFrame([(["a b"],)], "w array<string>")
    plan = df.select(tokenizer.merged(F.col("w")).alias("ids"))._jdf.queryExecution().analyzed().toString()
    step = plan[plan.index("aggregate(") :]
    assert "array_remove(" in step and "flatten(" not in step and step.count("slice(") == 1


def test_other_columns_stay_and_names_may_clash(spark, tokenizer):
    df = spark.createDataFrame([(1, "a b", [1, 2], "k")], "_words long, text string, _fresh_ids array<int>, `a.b` string")
    found = tokenizer.encode(df, "text")
    assert found.columns == [*df.columns, "ids"]
    assert found.drop("ids").collect() == df.collect()
    assert tokenizer.encode(df, "text", keep_text=False).columns == ["_words", "_fresh_ids", "a.b", "ids"]
    with pytest.raises(ValueError):
        tokenizer.encode(df, "text", ids="text")


def test_empty_table(spark, tokenizer):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokenizer.decode(tokenizer.encode(df, "text")).collect() == []


def test_as_array_and_count(spark, tokenizer, library):
    df = spark.createDataFrame([("hello world",), ("",), (None,)], "text string")
    found = tokenizer.encode(df, "text").select(
        "text", bpe.as_array(F.col("ids")).alias("ids"), bpe.token_count(F.col("ids")).alias("n")
    )
    for row in found.collect():
        assert row["ids"] == library.encode_ordinary(row["text"] or "") and row["n"] == len(row["ids"])


def test_vocabulary_must_hold_all_bytes():
    with pytest.raises(ValueError):
        bpe.ByteBPE({b"a": 0}, "x")


def test_query(spark, library):
    from sedimenta.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op1_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()


def test_letters_are_remembered_once_whatever_signs_follow(monkeypatch):
    kept = []

    class Noted(bpe.Recent):
        def put(self, text, value):
            kept.append(text)
            super().put(text, value)

    monkeypatch.setattr(bpe, "Recent", Noted)
    texts = pa.array(["x alpha### alpha,%%% alpha. alpha", "x beta$$$ beta's"])
    found = list(bpe._numbering(public_tokenizers.PATTERN)(iter([texts])))
    fresh = found[0].field("fresh").flatten().to_pylist()
    assert sorted(fresh) == sorted(["x", " alpha", "###", ",%%%", ".", " beta", "$$$", "'s"])
    assert sorted(kept) == sorted(["x", "alpha", "###", ",%%%", ".", "beta", "$$$", "'s", "beta's"])


def test_free_memory_is_given_back_with_every_batch(monkeypatch):
    times = []
    monkeypatch.setattr(bpe, "give_back", lambda: times.append(1))
    batches = [pa.array(["some words"]), pa.array(["others", None])]
    numbered = list(bpe._numbering(public_tokenizers.PATTERN)(iter(batches)))
    assert len(numbered) == len(times) == 2
    ranks = bpe.read_ranks(PATH)
    merged = [pa.array([[[ranks[x.encode()]] for x in row] for row in b.field("fresh").to_pylist()], pa.list_(pa.list_(pa.int32()))) for b in numbered]
    tables = [pa.RecordBatch.from_arrays([b, m], ["n", "m"]) for b, m in zip(numbered, merged)]
    joined = [b.column("ids") for b in bpe._joining(ranks, "n", "m", "ids")(iter(tables))]
    assert len(times) == 4
    decoded = [x.to_pylist() for x in bpe._decoding(ranks)(iter(joined))]
    assert decoded == [[b"some words"], [b"others", b""]] and len(times) == 6


@pytest.mark.parametrize("most,size", [(50_000, 2), (1 << 16, 4)])
def test_ids_of_words_take_two_bytes_if_they_can(most, size):
    known = bpe._Known(most)
    known.add(np.array([most, 7, 9], "<u4"), np.array([1, 0, 2]))
    assert known.ids.itemsize == size and known.stops.itemsize == 4
    ids, lengths = known.of(np.array([2, 1, 0, 2]))
    assert ids.dtype == "<u4" and ids.tolist() == [7, 9, most, 7, 9] and lengths.tolist() == [2, 0, 1, 2]


def test_very_many_ids_take_longer_places(monkeypatch):
    known = bpe._Known(9)
    known.stops[0] = known.stops[1] = (1 << 32) - 2
    monkeypatch.setattr(bpe, "_room", lambda array, size: array)
    known.ids = type("Held", (), {"__setitem__": lambda *_: None})()
    known.add(np.array([1, 2, 3], "<u4"), np.array([3]))
    assert known.stops.dtype == np.int64 and known.stops[1] == (1 << 32) + 1
